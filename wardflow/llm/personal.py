"""Personal data: spans by fixed rules, and spans that a trained character tagger adds.

The rules find what is written as rules expect. The tagger (``tagger``) learns from the rules' spans in
a bounded sample, each also in other spellings (other separators, no country code, a written-out sign),
and so finds data that the rules' patterns miss.
"""

from __future__ import annotations

import random
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardflow.llm.arrays import slices
from wardflow.llm.common import bounded_batches, map_texts
from wardflow.llm.tagger import Tagger, tagged, train

KINDS = ("email", "ip", "card", "phone")

#: Texts with a mark that the sample is drawn from, and labelled snippets per kind (and of none) to learn from.
SAMPLE_TEXTS, SAMPLE_SNIPPETS = 4000, 220

#: Characters to each side of a mark in a snippet.
AROUND = 64

#: Mean chance that a span of the tagger needs.
SURE = 0.9

Span = tuple[str, int, int]

# Fixed patterns of the base kinds, written so that a failing place is not tried again from its inside
# (no match could start there): an address is met at its sign and extended to the left.
_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_MARK = re.compile(r"[0-9@]")
_DIGIT = re.compile(r"[0-9]")


def _digits(text: str) -> list[int]:
    return [int(d) for d in _DIGIT.findall(text)]


def luhn(digits: list[int]) -> bool:
    """Whether the last digit is right: every second digit from the right is doubled and its digits summed."""
    doubled = [d * 2 - 9 if d > 4 else d * 2 for d in digits[-2::-2]]
    return (sum(digits[-1::-2]) + sum(doubled)) % 10 == 0


def _is_ip(text: str) -> bool:
    # A part of many digits is compared without being read as a number.
    parts = [p.lstrip("0") for p in re.findall("[0-9]+", text)]
    return len(parts) == 4 and all(len(p) <= 3 and int(p or 0) <= 255 for p in parts)


def _is_card(text: str) -> bool:
    digits = _digits(text)
    return 13 <= len(digits) <= 19 and luhn(digits)


def _is_phone(text: str) -> bool:
    return 9 <= len(_digits(text)) <= 15


def base_spans(text: str) -> list[Span]:
    """Spans of the fixed rules, by kind and place; leftmost matches that do not overlap within a kind."""
    found: list[Span] = []
    if "@" in text:
        free = 0
        for match in _DOMAIN.finditer(text):
            start = sign = match.start()
            while start > free and text[start - 1] in _LOCAL:
                start -= 1
            if start < sign:
                found.append(("email", start, match.end()))
                free = match.end()
    if not _DIGIT.search(text):
        return found
    for kind, pattern, holds in (("ip", _IP, _is_ip), ("card", _CARD, _is_card), ("phone", _PHONE, _is_phone)):
        found += [(kind, m.start(), m.end()) for m in pattern.finditer(text) if holds(m.group())]
    return found


# --- what the tagger learns from -------------------------------------------------------------------


def _snippets(texts: pa.Array) -> Iterator[tuple[str, str, str]]:
    """Stretches of text around marks with their spans, and the kind of the first span."""
    for text in texts.to_pylist():
        marks = [m.start() for m in _MARK.finditer(text)]
        spans, free = base_spans(text) if marks else [], 0
        for mark in marks:
            if mark < free:
                continue
            start, free = max(0, mark - AROUND), mark + AROUND
            inside = [(k, a - start, b - start) for k, a, b in _disjoint(spans) if a < free and b > start]
            named = next((k for k, a, _ in inside if a >= 0), "none")
            yield text[start:free], ",".join(f"{k}:{a}:{b}" for k, a, b in inside), named


def _disjoint(spans: list[Span]) -> list[Span]:
    """Of spans that overlap the earliest, then the longest: a character has one label."""
    found, free = [], 0
    for span in sorted(spans, key=lambda s: (s[1], -s[2], KINDS.index(s[0]))):
        if span[1] >= free:
            found.append(span)
            free = span[2]
    return found


def examples(docs: DataFrame, text_col: str = "text") -> list[tuple[str, list[Span]]]:
    """Labelled snippets: at most ``SAMPLE_SNIPPETS`` of each kind and of none, different ones.

    They come from about ``SAMPLE_TEXTS`` of the texts with a digit or an at sign, chosen by hash, so
    that the same texts give the same snippets whatever their order and partitions.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    marked = docs.select(F.col(f"`{text_col}`").alias("text")).filter(F.col("text").rlike("[0-9@]"))
    every = max(1, marked.count() // SAMPLE_TEXTS)
    sample = marked.filter(F.pmod(F.xxhash64("text"), F.lit(every)) == 0)
    schema = pa.schema([("snippet", pa.string()), ("spans", pa.string()), ("kind", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, texts in slices(batch, "text"):
                rows = list(_snippets(texts))
                yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], pa.string()) for k in range(3)], schema=schema)

    cut = sample.mapInArrow(run, "snippet string, spans string, kind string").distinct()
    order = Window.partitionBy("kind").orderBy(F.xxhash64("snippet"), "snippet", "spans")
    rows = cut.withColumn("nth", F.row_number().over(order)).filter(F.col("nth") <= SAMPLE_SNIPPETS).collect()
    return [(r["snippet"], _parsed(r["spans"])) for r in sorted(rows, key=lambda r: (r["kind"], r["nth"]))]


def _parsed(spans: str) -> list[Span]:
    parts = [s.split(":") for s in spans.split(",") if s]
    return [(k, int(a), int(b)) for k, a, b in parts]


def fit(docs: DataFrame, text_col: str = "text") -> Tagger | None:
    """A tagger for the texts of ``docs``; none where no text holds any labelled span."""
    found = examples(docs, text_col)
    if not any(spans for _, spans in found):
        return None
    draw = random.Random(17)
    varied = [_respelled(text, spans, draw) for text, spans in found]
    varied += [_respelled(text, spans, draw) for text, spans in found if spans]
    return train(found + [v for v in varied if v], KINDS)


def _respelled(text: str, spans: list[Span], draw: random.Random) -> tuple[str, list[Span]] | None:
    """The snippet with each whole span in another spelling; without a span, with other numbers in it."""
    whole = [s for s in spans if s[1] >= 0 and s[2] <= len(text)]
    if not whole:
        return None if spans else (_other_numbers(text, draw), [])
    out, at, labelled = [], 0, []
    for kind, start, end in whole:
        out.append(text[at:start])
        said = _SPELLINGS[kind](text[start:end], draw)
        begin = sum(map(len, out))
        labelled.append((kind, begin, begin + len(said)))
        out.append(said)
        at = end
    cut = [s for s in spans if s not in whole]
    if cut:  # a span that an end of the snippet cuts: leave that end away
        left = max([b for _, a, b in cut if a < 0], default=0)
        right = min([a for _, a, b in cut if b > len(text)], default=len(text))
        return _respelled(text[left:right], [(k, a - left, b - left) for k, a, b in whole], draw)
    out.append(text[at:])
    return "".join(out), labelled


def _respelled_email(text: str, draw: random.Random) -> str:
    name, _, host = text.partition("@")
    sign = draw.choice([" @ ", " at ", "(at)", " (at) ", "[at]", " [at] "])
    return name + sign + (host.replace(".", draw.choice([" dot ", "[dot]", "."])))


def _respelled_ip(text: str, draw: random.Random) -> str:
    return text.replace(".", draw.choice(["[.]", " . ", "(.)", " dot "]))


def _respelled_card(text: str, draw: random.Random) -> str:
    digits = "".join(map(str, _digits(text)))
    return draw.choice([".", "/", "  ", " - ", "_"]).join(digits[k : k + 4] for k in range(0, len(digits), 4))


def _respelled_phone(text: str, draw: random.Random) -> str:
    said = re.sub(r"^\+[0-9]{1,3}[ .-]?", draw.choice(["", "", "001 ", "1-"]), text)
    return re.sub(r"[ -](?=[0-9])", lambda _: draw.choice([" ", ".", "-", " "]), said)


_SPELLINGS = {"email": _respelled_email, "ip": _respelled_ip, "card": _respelled_card, "phone": _respelled_phone}


def _other_numbers(text: str, draw: random.Random) -> str:
    """Numbers of other lengths than the kinds have, so that not every number is taken for one."""

    def number(match: re.Match) -> str:
        size = draw.choice([1, 2, 3, 4, 4, 5, 6, 8, 12, 22])
        return "".join(draw.choice("0123456789") for _ in range(size))

    return re.sub("[0-9]+", number, text)


# --- finding ---------------------------------------------------------------------------------------

_DOT = re.compile(r"\.|\bdot\b", re.I)
#: A written-out sign, a word of the host and its dot.
_SAID = re.compile(r"\bat\b\W{0,3}[\w-]+(?:\.[\w-]|\W{0,3}\bdot\b)", re.I)


def _believable(kind: str, text: str) -> bool:
    """Whether a span of the tagger could be what it is taken for, however it is spelled."""
    if kind == "email":
        sign = text.find("@")
        if sign >= 0:
            return sign > 0 and bool(_DOT.search(text, sign + 1))
        said = _SAID.search(text)
        return bool(said and said.start())
    if kind == "phone":
        return bool(re.search(r"[ ().+-]", text)) and 10 <= len(_digits(text)) <= 15
    return {"ip": _is_ip, "card": _is_card}[kind](text)


def _added(tagger: Tagger, texts: pa.Array, base: list[list[Span]]) -> None:
    """Puts into ``base``, text by text, what the tagger finds beside the spans that are there."""
    strings = texts.to_pylist()
    points = np.frombuffer("".join(strings).encode("utf-32-le"), np.uint32)
    starts = np.concatenate([[0], np.cumsum([len(s) for s in strings])])
    # What is believed holds a digit, an at sign, or one written out as ``_SAID`` has it.
    said = np.array([int(at) + m.start() for at, text in zip(starts, strings) for m in _SAID.finditer(text)], np.int64)
    marks = np.union1d(np.flatnonzero((points >= 48) & (points <= 57) | (points == 64)), said)
    more: dict[int, list[Span]] = {}
    for start, end, kind, chance in tagged(tagger, points, starts, marks):
        n = int(np.searchsorted(starts, start, side="right")) - 1
        start, end = start - int(starts[n]), end - int(starts[n])
        said = strings[n][start:end]
        start, end = start + len(said) - len(said.lstrip(" \t\n.,;:-")), end - len(said) + len(said.rstrip(" \t\n.,;:-"))
        if chance >= SURE and start < end and _believable(kind, strings[n][start:end]):
            more.setdefault(n, []).append((kind, start, end))
    for n, spans in more.items():
        mine = sorted(base[n], key=lambda s: s[1])
        base[n] += [s for s in spans if not any(a < s[2] and b > s[1] for _, a, b in mine)]


PERSONAL = "array<struct<kind:string,start:int,end:int,base:boolean>>"


def find(docs: DataFrame, tagger: Tagger | None, text_col: str = "text", redact_to: str | None = None) -> DataFrame:
    """``docs`` with a column ``personal``: the spans of each whole text, by kind as listed, then by start.

    Places count code points, the end is exclusive; ``base`` tells the rules' spans from the tagger's, of
    which none overlaps a span of the rules. A null or empty text has no spans. ``redact_to`` names a
    further column: the text with each span replaced by its kind in angle brackets. Columns of
    ``docs`` with these names are replaced; all others stay, whatever their names. Rows are independent,
    so repeated rows get the same spans.
    """
    added = f"personal {PERSONAL}" + (f", `{redact_to}` string" if redact_to else "")
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("base", pa.bool_())]))

    def compute():
        def function(texts: pa.Array) -> dict[str, pa.Array]:
            strings = texts.to_pylist()
            spans = [base_spans(s) for s in strings]
            known = [len(s) for s in spans]
            if tagger:
                _added(tagger, texts, spans)
            rows = []
            for all_spans, n in zip(spans, known, strict=True):
                order = sorted(range(len(all_spans)), key=lambda k: (KINDS.index(all_spans[k][0]), *all_spans[k][1:]))
                rows.append([{"kind": k, "start": a, "end": b, "base": at < n} for at, (k, a, b) in ((o, all_spans[o]) for o in order)])
            found = {"personal": pa.array(rows, kind)}
            if redact_to:
                found[redact_to] = pa.array([_redacted(s, x) for s, x in zip(strings, spans, strict=True)], pa.string())
            return found

        return function

    return map_texts(docs, text_col, added, compute)


def _redacted(text: str, spans: list[Span]) -> str:
    """Spans that overlap go as one, under the kind that begins first."""
    out, at = [], 0
    for kind, start, end in sorted(spans, key=lambda s: (s[1], -s[2])):
        if start >= at:
            out += [text[at:start], f"<{kind}>"]
        at = max(at, end)
    return "".join(out) + text[at:]


def report(docs: DataFrame) -> DataFrame:
    """Per document the number of the rules' spans by kind, their digest, and all spans as text."""

    def said(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    base = F.filter("personal", lambda s: s["base"])
    found = find(docs.select("doc_id", "text"), fit(docs))
    kinds = F.transform(base, lambda s: s["kind"])
    counts = [F.size(F.filter(kinds, lambda s: s == kind)).cast("long").alias(f"n_{kind}") for kind in KINDS]
    return found.select("doc_id", *counts, F.sha2(said(base), 256).alias("base_sha256"), said(F.col("personal")).alias("spans"))
