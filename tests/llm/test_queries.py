"""The operators' queries against plain versions and SQL, on given tables and on odd ones."""

from __future__ import annotations

from collections import Counter

import duckdb
import pytest

from tests.llm import brute
from wardflow.llm import catalog

COLUMNS = {
    "op1_rendezvous": ("doc_id", "size", "text_crc32", "law", "shard", "grown_shard"),
    "op2_bpe_automaton": ("doc_id", "n_tokens", "ids_sha256", "decoded_sha256"),
    "op3_token_files": ("doc_id", "start", "n_tokens", "ids_crc32"),
    "op4_fertility": (
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
    ),
    "op5_bottom_k": ("doc_id", "n_shingles", "component_id", "kept"),
    "op6_line_chunks": ("doc_id", "n_removed_chunks", "n_removed_lines", "kept_bytes", "kept_sha256"),
}
PLAIN = {
    "op1_rendezvous": brute.op1,
    "op2_bpe_automaton": brute.op2,
    "op3_token_files": brute.op3,
    "op4_fertility": brute.op4_base,
    "op5_bottom_k": brute.op5,
    "op6_line_chunks": brute.op6,
}


def result(spark, name, folder):
    return Counter(tuple(r) for r in catalog.queries()[name](spark, folder).select(*COLUMNS[name]).collect())


@pytest.mark.parametrize("name", sorted(PLAIN))
def test_odd_texts(spark, name, odd_dir, odd_rows):
    assert result(spark, name, odd_dir) == PLAIN[name](odd_rows)


@pytest.mark.parametrize("name", sorted(PLAIN))
def test_given_texts(spark, name):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    assert result(spark, name, folder) == PLAIN[name]([tuple(r) for r in docs])


@pytest.mark.parametrize("name", ["op1_rendezvous", "op2_bpe_automaton", "op4_fertility", "op5_bottom_k"])
def test_repeated_rows_and_missing_ids(spark, name, repeated_dir, repeated_rows):
    assert result(spark, name, repeated_dir) == PLAIN[name](repeated_rows)


@pytest.mark.parametrize("name", sorted(set(catalog.queries()) - {"op11_fm_index", "op13_strassen"}))
def test_other_queries_keep_repeated_rows(spark, name, repeated_dir, repeated_rows):
    found = catalog.queries()[name](spark, repeated_dir)
    ids = Counter(r["doc_id"] for r in found.select("doc_id").collect())
    if name != "pipeline":
        assert ids == Counter(i for i, _ in repeated_rows)


@pytest.mark.parametrize("name", sorted(set(catalog.queries())))
def test_empty_tables(spark, name, empty_dir):
    assert catalog.queries()[name](spark, empty_dir).collect() == []


@pytest.mark.parametrize("name", sorted(catalog.checks()))
@pytest.mark.parametrize("tables", ["odd", "given"])
def test_agrees_with_sql(spark, name, tables, odd_dir):
    folder = odd_dir if tables == "odd" else "/root/testdata/sf0.001"
    database = duckdb.connect()
    for table in ("documents", "benchmark", "embeddings"):
        path = f"{folder}/{table}.parquet" + ("/*.parquet" if tables == "odd" else "")
        database.execute(f"create view {table} as select * from '{path}'")
    expected = database.execute(catalog.checks()[name])
    names = [c[0] for c in expected.description]
    found = catalog.queries()[name](spark, folder)
    assert sorted(found.columns) == sorted(names)
    found = found.select(*names)
    got, wanted = Counter(map(tuple, found.collect())), Counter(expected.fetchall())
    assert got == wanted


def test_slots_have_no_gaps(spark, repeated_dir):
    rows = catalog.queries()["op1_rendezvous"](spark, repeated_dir).select("shard", "slot").collect()
    by_shard = {}
    for shard, slot in rows:
        by_shard.setdefault(shard, []).append(slot)
    assert all(sorted(slots) == list(range(len(slots))) for slots in by_shard.values())


def test_pipeline_keeps_one_of_each_kind(spark, odd_dir, odd_rows):
    found = catalog.queries()["pipeline"](spark, odd_dir)
    ids = {r["doc_id"] for r in found.collect()}
    texts = dict(odd_rows)
    full = [i for i, t in odd_rows if t and t == odd_rows[7][1]]
    assert len(ids & set(full)) <= 1 and ids <= set(texts)
    assert found.columns == ["doc_id", "n_tokens", "ids", "decoded_sha256"]
