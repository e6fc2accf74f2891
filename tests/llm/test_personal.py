"""Personal data: the rules against their plain patterns, the tagger by held-out accuracy."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from wardflow.llm import catalog, personal, tagger

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def checksum(text: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(re.sub("[^0-9]", "", text))):
        value = int(digit) * (1 + place % 2)
        total += value // 10 + value % 10
    return total % 10 == 0


def plain_spans(text: str) -> list[tuple[str, int, int]]:
    def n(match) -> int:
        return len(re.sub("[^0-9]", "", match.group()))

    found = [("email", m) for m in EMAIL.finditer(text)] if "@" in text else []
    found += [("ip", m) for m in IP.finditer(text) if all(int(p) <= 255 for p in m.group().split("."))]
    found += [("card", m) for m in CARD.finditer(text) if 13 <= n(m) <= 19 and checksum(m.group())]
    found += [("phone", m) for m in PHONE.finditer(text) if 9 <= n(m) <= 15]
    return [(kind, m.start(), m.end()) for kind, m in found]


def op12_base(rows):
    found = Counter()
    for doc_id, text in rows:
        spans = plain_spans(text or "")
        said = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        counts = [sum(s[0] == kind for s in spans) for kind in ("email", "ip", "card", "phone")]
        found[(doc_id, *counts, hashlib.sha256(said.encode()).hexdigest())] += 1
    return found


@pytest.mark.parametrize("alphabet", ["a1.@", "12 -", "+1( )-.", "0123456789.", "ab1.@+-%_ é\n", "25.", "4 1-"])
def test_rules_on_random_texts(alphabet):
    draw = random.Random(len(alphabet))
    for _ in range(3000):
        text = "".join(draw.choice(alphabet) for _ in range(draw.randrange(1, 40)))
        assert personal.base_spans(text) == plain_spans(text), text


def test_rules_do_not_stall_on_long_runs():
    for text in ("1" * 300_000, "a." * 150_000 + "@", "1." * 150_000, "1 " * 150_000, "+1" * 150_000, "@a." * 100_000, "+" + "1(" * 150_000):
        assert len(personal.base_spans(text)) < 100_000


@pytest.mark.parametrize("tables", ["odd", "repeated", "given"])
def test_base_columns(spark, tables, odd_dir, odd_rows, repeated_dir, repeated_rows):
    folder = {"odd": odd_dir, "repeated": repeated_dir, "given": "/root/testdata/sf0.001"}[tables]
    rows = {"odd": odd_rows, "repeated": repeated_rows}.get(tables)
    if rows is None:
        rows = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    found = catalog.queries()["op12_bilstm_crf"](spark, folder).collect()
    assert Counter(tuple(r)[:6] for r in found) == op12_base(rows)
    texts = Counter((i, ",".join(f"{k}:{a}:{b}" for k, a, b in plain_spans(t or ""))) for i, t in rows)
    for r in found:  # base spans stay
        bases = [set(s.split(",")) - {""} for (i, s) in texts if i == r["doc_id"]]
        assert any(b <= set(r["spans"].split(",")) for b in bases)


def test_gradients():
    draw = np.random.default_rng(1)
    weights = tagger._start(2, draw)
    x = draw.integers(0, tagger.N_CHARS, (3, tagger.WIDTH))
    y = np.zeros_like(x)
    y[:, 5], y[:, 6:9], y[1, 20] = 1, 2, 3
    allowed = tagger._allowed(2)
    _, gradients = tagger._gradients(weights, x, y, allowed)
    for name, place in [("moves", (1, 2)), ("chars", (x[0, 6], 2)), ("into", (1, 3, 30)), ("over", (0, 5, 70)), ("out", (30, 1))]:
        was, losses = weights[name][place], []
        for step in (1e-5, -1e-5):
            weights[name][place] = was + step
            losses.append(tagger._gradients(weights, x, y, allowed)[0])
        weights[name][place] = was
        assert abs((losses[0] - losses[1]) / 2e-5 - gradients[name][place]) < 1e-4


@pytest.fixture(scope="module")
def fitted(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    held_out = F.col("doc_id") % 5 == 0
    texts = [r["text"] for r in docs.filter(held_out & F.col("text").rlike("[0-9@]")).select("text").distinct().collect()]
    return personal.fit(docs.filter(~held_out)), texts


def by_tagger(model, texts):
    found = [[] for _ in texts]
    personal._added(model, pa.array(texts, pa.large_string()), found)
    return found


def test_held_out_accuracy(fitted):
    model, texts = fitted
    wanted = {(n, *s) for n, t in enumerate(texts) for s in plain_spans(t)}
    got = {(n, *s) for n, spans in enumerate(by_tagger(model, texts)) for s in spans}
    assert len(wanted) > 100
    assert len(wanted & got) >= 0.9 * len(wanted)
    assert len(wanted & got) >= 0.95 * len(got)


def test_other_spellings_are_met_and_clean_texts_left_alone(fitted):
    model, texts = fitted
    spelled = {
        "call me (555) 123-4567 now": "(555) 123-4567",
        "write to anna.56 at mail9.example.com soon": "anna.56 at mail9.example.com",
        "see bob(at)mail3.example.com thanks": "bob(at)mail3.example.com",
        "card 4111/1111/1111/1111 ok": "4111/1111/1111/1111",
        "the host 10[.]1[.]2[.]3 is down": "10[.]1[.]2[.]3",
    }
    found = by_tagger(model, list(spelled))
    met = sum(any(t[a:b] == want for _, a, b in spans) for (t, want), spans in zip(spelled.items(), found))
    assert met >= 4
    clean = [t for t in texts if not plain_spans(t)]
    clean += ["version 3.0 of 2024, 12 apples and 1234567 pears", "on 2024-05-17 10:22:31 we met", "price 12,345.67 and 99.95 each"]
    assert sum(map(len, by_tagger(model, clean))) <= len(clean) // 200


def test_windows_agree_across_slices(fitted):
    """A text gives the same spans alone and among others."""
    model, texts = fitted
    some = texts[:40]
    together = by_tagger(model, some)
    assert together == [by_tagger(model, [t])[0] for t in some]


def test_own_interface(spark, fitted):
    rows = [(1, "mail a.b@c.org or (555) 123-4567 today", "x"), (2, None, "y"), (3, "", None), (4, "no data", "z")]
    docs = spark.createDataFrame(rows, "id int, body string, personal string")
    found = {r["id"]: r for r in personal.find(docs, fitted[0], "body", redact_to="kind").collect()}
    assert found[1]["kind"].startswith("mail <email> or ")
    assert [(s["kind"], s["base"]) for s in found[1]["personal"]][0] == ("email", True)
    assert found[2]["personal"] == [] and found[2]["body"] is None and found[2]["kind"] == ""
    assert found[4]["kind"] == "no data"
    assert personal.find(docs, None, "body").columns == ["id", "body", "personal"]


def test_no_marks_no_tagger(spark):
    docs = spark.createDataFrame([(1, "plain words"), (2, None)], "doc_id int, text string")
    assert personal.fit(docs) is None
    assert [r["spans"] for r in personal.report(docs).collect()] == ["", ""]


def test_like_reading_every_window(fitted, monkeypatch):
    """Places without a digit or at sign are read where an address may be written out, and spans to their ends."""
    model, texts = fitted
    plain = "please mail bob.smith(at)mail.example.com thanks"
    some = [plain, "word " * 40 + plain, "we met at noon. The day was fine", *texts[:30]]
    found = by_tagger(model, some)
    assert ("email", plain.index("bob"), plain.index(" thanks")) in found[0] and found[1]
    near = personal.tagged
    monkeypatch.setattr(personal, "tagged", lambda m, points, starts, _: near(m, points, starts, np.arange(len(points))))
    assert found == by_tagger(model, some)
