"""The whole verdict of the fertility rules against a plain version."""

from __future__ import annotations

import base64
import math
import re
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import tiktoken

from wardflow.llm import catalog, fertility

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_measures(text, encode, is_byte, size):
    ids = [i for word in WORD.findall(text or "") for i in encode(word)]
    letters = sum(c.isascii() and c.isalnum() or ord(c) >= 0x80 for c in text or "")
    n, counts = len(ids), Counter(ids)
    entropy = -sum(c / n * math.log2(c / n) for c in counts.values()) if n else 0
    even = entropy / math.log2(min(max(n, 2), size)) if n > 1 else 1.0
    return {
        "n_tokens": n,
        "chars_per_token": letters / max(n, 1),
        "byte_share": sum(map(is_byte, ids)) / max(n, 1),
        "evenness": even,
    }


def vocabularies():
    pieces = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    lines = Path(public_tokenizers.path("byte_bpe_multi_50k.tiktoken")).read_bytes().splitlines()
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    coder = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    single = {rank for token, rank in ranks.items() if len(token) == 1 and token[0] >= 0x80}
    return {
        "": (pieces.encode, pieces.is_byte, pieces.get_piece_size()),
        "multi_": (lambda w: coder.encode_ordinary(" " + w), single.__contains__, max(ranks.values()) + 1),
    }


def verdicts(rows, measures):
    """Which measures reject each row, from exact quartiles of the rounded measures of its group."""
    groups = defaultdict(list)
    for row, found in zip(rows, measures):
        if not row.base_failed and row.band_group is not None:
            groups[row.band_group].append(found)
    rejected = []
    for row, found in zip(rows, measures):
        names = set()
        for prefix in ("", "multi_"):
            widening = 1 + 6.0 / math.sqrt(max(found[f"{prefix}n_tokens"], 1))
            for name, room in {"chars_per_token": 0.15, "byte_share": 0.05, "evenness": 0.10}.items():
                held = [round(m[prefix + name], 4) for m in groups.get(row.band_group, [])]
                if not held:
                    continue
                low, mid, high = np.percentile(held, [25, 50, 75])
                far = max(3 * (high - low), room * (mid if name == "chars_per_token" else 1)) * widening
                off = found[prefix + name] - mid
                if {"chars_per_token": abs(off), "byte_share": off, "evenness": -off}[name] > far:
                    names.add(prefix + name)
        rejected.append(names)
    return rejected


@pytest.mark.parametrize("tables", ["given", "odd"])
def test_verdicts_of_whole_tables(spark, tables, odd_dir):
    folder = "/root/testdata/sf0.001" if tables == "given" else odd_dir
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = catalog.queries()["op4_fertility"](spark, folder).collect()
    known = vocabularies()
    measures = []
    for row in rows:
        found = {}
        for prefix, vocabulary in known.items():
            found |= {prefix + k: v for k, v in plain_measures(texts[row.doc_id], *vocabulary).items()}
        assert {k: row[k] for k in found} == pytest.approx(found, abs=1e-9)
        measures.append(found)
    for row, names in zip(rows, verdicts(rows, measures)):
        assert set(row.rejected_by) == names
        assert row.kept == (not row.base_failed and not names)


def test_bands_do_not_depend_on_how_rows_lie(spark):
    rows = [(f"g{k % 3}", 50, 0, 60, (k * 37 % 1000) / 997, 0.1, 0.5 + k % 7 / 100) for k in range(5000)]
    names = "band_group string, n_words long, n_repeat_words long, n_tokens long, chars_per_token double, byte_share double, evenness double"
    frame = spark.createDataFrame(rows, names)
    found = [
        sorted(map(tuple, fertility.bands(frame.repartition(n, "chars_per_token")).collect())) for n in (1, 3, 17)
    ]
    assert found[0] == found[1] == found[2]
    mine = np.percentile([round(r[4], 4) for r in rows if r[0] == "g0"], [25, 50, 75])
    assert list(found[0][0][1]) == pytest.approx(list(mine))
