"""Language identification: fit and prediction against a plain version, rejection of strange texts."""

from __future__ import annotations

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from wardflow.llm import language

# Texts in languages that the tables do not have, and letters without any.
STRANGE = {
    "it": "Il vecchio pescatore usciva ogni mattina prima dell'alba con la sua piccola barca e tornava soltanto quando il sole "
    "cominciava a scendere dietro le colline che chiudevano la baia; nessuno nel paese ricordava di averlo visto tornare senza "
    "pesce, anche quando il vento soffiava forte e gli altri uomini restavano a casa a riparare le reti.",
    "pl": "Stary rybak wypływał każdego ranka przed świtem swoją małą łodzią i wracał dopiero wtedy, gdy słońce zaczynało chować "
    "się za wzgórzami zamykającymi zatokę; nikt we wsi nie pamiętał, żeby kiedykolwiek wrócił bez ryb, nawet gdy wiał silny "
    "wiatr, a pozostali mężczyźni zostawali w domach i naprawiali sieci przy piecu.",
    "fi": "Vanha kalastaja lähti joka aamu ennen auringonnousua pienellä veneellään merelle ja palasi vasta kun aurinko alkoi "
    "laskea lahtea reunustavien kukkuloiden taakse; kukaan kylässä ei muistanut hänen koskaan palanneen ilman kalaa, ei edes "
    "silloin kun tuuli puhalsi kovaa ja muut miehet jäivät kotiin korjaamaan verkkojaan.",
}


def random_letters(n: int, seed: int) -> str:
    draw = random.Random(seed)
    return "".join(draw.choice("abcdefghijklmnopqrstuvwxyz" + " " * 5) for _ in range(n))


@pytest.fixture(scope="module")
def tables(spark):
    return spark.read.parquet("/root/testdata/sf0.1/documents.parquet")


@pytest.fixture(scope="module")
def model(tables):
    return language.fit(language.labelled_rows(tables))


def junk(text: str) -> bool:
    """Lines of one word over and over, shouting, or words strewn with marks."""
    lines = [line.split() for line in text.split("\n")]
    dull = sum(len(w) for w in lines if len(w) > 4 and len(set(w)) <= 0.25 * len(w))
    return dull > 0 or "!! " in text or sum(c in "#*$%&|<>" for c in text) > 0.02 * len(text)


def rejected(model, texts):
    array = pa.array(texts, pa.large_string())
    return model.predict(array, np.array([len(t.encode()) for t in texts]))[2]


@pytest.mark.parametrize("size", [200, 400, 800, 2000])
def test_strange_texts_are_rejected(model, size):
    draw = random.Random(size)
    texts = []
    for text in STRANGE.values():
        words = text.split()
        for _ in range(10):
            draw.shuffle(words)
            texts.append((" ".join(words) * (1 + size // len(text)))[:size])
    texts += [random_letters(size, k) for k in range(10)]
    found = rejected(model, texts)
    assert found.sum() >= 0.9 * len(texts), [found[k : k + 10].sum() for k in range(0, 40, 10)]


def test_clean_texts_are_kept(tables, model):
    rows = language.identify(tables.select("doc_id", "text", "lang"), model).collect()
    clean = [r for r in rows if r["text"] and not junk(r["text"])]
    assert len(clean) > 0.8 * len(rows)
    assert sum(r["rejected"] for r in clean) <= 0.002 * len(clean)
    right = [r["lang"] == r["lang_pred"] for r in rows if r["lang"] and not r["rejected"]]
    assert np.mean(right) >= 0.97


def plain_counts(text: str) -> Counter:
    data = [b if b >= 0x80 or chr(b).isalpha() else 0x20 for b in text.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")).encode()]
    found = Counter()
    for width in (1, 2, 3):
        for k in range(len(data) - width + 1):
            code = 0
            for b in data[k : k + width]:
                code = code << 8 | b
            found[((code * 2654435761 + width) % 2**32) >> 20] += 1
    return found


def test_plain_version(spark, tables):
    """One centroid per language is the mean direction of its texts: fit and predict by dictionaries."""
    docs = tables.filter("length(text) < 1500 and lang is not null").limit(300).select("doc_id", "text", "lang").collect()
    train = docs[:200]
    held = Counter(slot for r in train for slot in set(plain_counts(r["text"])))
    idf = {s: math.log((1 + len(train)) / (1 + held[s])) + 1 for s in range(language.DIMENSIONS)}

    def vector(text):
        raw = {s: math.log1p(n) * idf[s] for s, n in plain_counts(text).items()}
        size = math.sqrt(sum(x * x for x in raw.values())) or 1
        return {s: x / size for s, x in raw.items()}

    sums = defaultdict(Counter)
    for r in train:
        for s, x in vector(r["text"]).items():
            sums[r["lang"]][s] += x
    centroids = {lang: (c, math.sqrt(sum(x * x for x in c.values()))) for lang, c in sums.items()}
    model = _with_one_centroid(spark.createDataFrame(train))
    texts = [r["text"] for r in docs[200:]]
    names, scores, _ = model.predict(pa.array(texts, pa.large_string()), np.array([len(t.encode()) for t in texts]))
    for text, name, score in zip(texts, names, scores):
        v = vector(text)
        cosines = {lang: sum(x * c[s] for s, x in v.items()) / size for lang, (c, size) in centroids.items()}
        best = max(cosines, key=cosines.get)
        assert abs(cosines[best] - score) < 1e-4
        assert name == best or abs(cosines[best] - cosines[name]) < 1e-4


def _with_one_centroid(docs):
    # A least size beyond all clusters leaves one; workers see the module's own numbers, so the fit is redone from its parts.
    rows = language.labelled_rows(docs).collect()
    table = {lang: sorted(r["text"] for r in rows if r["lang"] == lang) for lang in {r["lang"] for r in rows}}
    raw = {lang: language.counts(pa.array(texts, pa.large_string())) for lang, texts in table.items()}
    held = sum((x > 0).sum(axis=0) for x in raw.values())
    idf = np.log((1 + len(rows)) / (1 + held)) + 1
    langs = sorted(raw)
    found = [language._kmeans(language.weighted(raw[lang], idf), language.CENTROIDS, least=10**6) for lang in langs]
    assert all(len(c) == 1 for c in found)
    return language.Model(tuple(langs), idf, np.concatenate(found), np.zeros((len(langs), len(language.LENGTHS))))


def test_fit_is_the_same_on_other_partitions(tables):
    some = language.labelled_rows(tables.filter("doc_id < 1500"))
    one, many = language.fit(some.coalesce(1)), language.fit(some.repartition(9))
    assert one.languages == many.languages
    assert np.allclose(one.centroids, many.centroids) and np.allclose(one.floors, many.floors)


def test_odd_rows(spark):
    rows = [(1, None, "en"), (2, "", "de"), (3, "…", "en"), (4, "x" * 100_000, None), (5, "word", "en"), (5, "word", "en")]
    docs = spark.createDataFrame(rows, "doc_id int, text string, lang string")
    found = language.identify(docs, language.fit(language.labelled_rows(docs))).collect()
    assert [r["lang_pred"] for r in sorted(found, key=lambda r: r["doc_id"])][:3] == ["und"] * 3
    assert len(found) == 6 and all(0 <= r["score"] <= 1 for r in found)
    none = language.fit(language.labelled_rows(docs.filter("false")))
    assert {r["lang_pred"] for r in language.identify(docs, none).collect()} == {"und"}
