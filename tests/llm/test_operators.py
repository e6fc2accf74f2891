"""The operators' own interfaces, beside what their queries show."""

from __future__ import annotations

import random
import weakref
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tests.llm import brute
from wardflow.llm import (
    bpe,
    common,
    components,
    decontaminate,
    fertility,
    language,
    licenses,
    line_chunks,
    near_dup,
    repair,
    secret_scan,
    sharding,
    token_files,
)

DOCS = "doc_id bigint, text string"


@pytest.fixture(scope="module")
def given(spark):
    return spark.read.parquet("/root/testdata/sf0.01/documents.parquet")


def merged(piece, ranks):
    """Merges one at a time, the earliest rule first and leftmost."""
    parts = [*piece[:-1], piece[-1] + "</w>"]
    while len(parts) > 1:
        rank, at = min((ranks.get((a, b), 1 << 30), k) for k, (a, b) in enumerate(zip(parts, parts[1:])))
        if rank == 1 << 30:
            break
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
    return parts


def test_the_automaton_reads_what_the_merges_make():
    vocabulary = bpe.Vocabulary.read(public_tokenizers.path("word_bpe_49k.json"))
    automaton = bpe.Automaton(vocabulary)
    ranks = {pair: k for k, pair in enumerate(vocabulary.merges)}
    draw = random.Random(3)
    for _ in range(2000):
        piece = "".join(draw.choice("abeeinorstthhg") for _ in range(draw.randrange(1, 14)))
        assert automaton.encode(piece) == [vocabulary.tokens[p] for p in merged(piece, ranks)]
    assert automaton.encode("a" * 300) == [vocabulary.tokens[p] for p in merged("a" * 300, ranks)]


def test_every_cell_says_whether_two_tokens_follow_each_other():
    vocabulary = bpe.Vocabulary.read(public_tokenizers.path("word_bpe_49k.json"))
    automaton = bpe.Automaton(vocabulary)
    ranks = {pair: k for k, pair in enumerate(vocabulary.merges)}
    names = sorted(automaton.arcs)
    draw = random.Random(4)
    open_names = [n for n in names if not n.endswith("</w>")]
    for _ in range(3000):
        a, b = draw.choice(open_names), draw.choice(names)
        if not b.endswith("</w>"):
            b = draw.choice([n for n in names[:200] if n.endswith("</w>")])
        whole = (a + b).removesuffix("</w>")
        assert automaton.steps(automaton.arcs[a], automaton.arcs[b]) == (merged(whole, ranks) == [a, b])


def test_decoding_gives_labels_and_nulls(spark):
    vocabulary = bpe.Vocabulary.read(public_tokenizers.path("word_bpe_49k.json"))
    rows = spark.createDataFrame([(1, [49406, 320]), (2, []), (3, None)], "doc_id int, ids array<int>")
    found = {r.doc_id: r.decoded for r in bpe.decode(rows, vocabulary).collect()}
    assert found == {1: "<|startoftext|> a</w>", 2: "", 3: None}
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    assert found[1] == library.decode([49406, 320], skip_special_tokens=False)


def test_grammars_expand_to_what_they_compressed():
    draw = np.random.default_rng(1)
    sizes = draw.integers(0, 400, 200)
    ids = np.minimum(draw.zipf(1.4, int(sizes.sum())), 49_000).astype(np.int32)
    symbols, counts, grammar = repair.compress(ids, sizes, 50_257)
    assert len(symbols) < len(ids) and counts.sum() == len(symbols) and len(grammar.left)
    back, each = grammar.expand(symbols)
    assert (back == ids).all()
    ends = np.concatenate([[0], np.cumsum(each)])[np.cumsum(counts)]
    assert (ends == np.cumsum(sizes)).all()
    same = repair.compress(np.full(9, 7, np.int32), np.array([9]), 10)
    assert (same[2].expand(same[0])[0] == 7).all()


def test_one_document_is_read_from_its_shard(spark, given, tmp_path):
    vocabulary = bpe.Vocabulary.read(public_tokenizers.path("byte_bpe_50k.json"))
    path = str(tmp_path / "ids")
    token_files.write_ids(given, vocabulary, path)
    files = token_files.read_files(spark, path)
    text = given.filter("doc_id = 17").first().text
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    wanted = library.encode(text, add_special_tokens=False).ids + [token_files.END_ID]
    assert token_files.read_document(files, 17).first().ids == wanted
    stored = files.select(F.sum(F.length("symbols"))).first()[0]
    assert stored < 2 * token_files.read_ids(files).agg(F.sum("n_tokens")).first()[0]


def test_weights_are_the_shares_of_shards(spark):
    keys = spark.range(40_000).select(F.col("id").alias("doc_id"))
    weights = [1.0, 2.0, 5.0]
    placed = sharding.shard_records(keys, weights)
    counts = {r.shard: r["count"] for r in placed.groupBy("shard").count().collect()}
    assert all(abs(counts[k] / 40_000 - w / 8) < 0.01 for k, w in enumerate(weights))
    grown = sharding.shard_records(placed.withColumnRenamed("shard", "old"), [*weights, 2.0])
    moved = grown.filter("old <> shard")
    assert {r.shard for r in moved.select("shard").distinct().collect()} == {3}
    assert abs(moved.count() / 40_000 - 0.2) < 0.01
    with pytest.raises(ValueError, match="above 0"):
        sharding.rendezvous(F.col("doc_id"), [1.0, 0.0])


def test_languages_are_told_apart(spark, given):
    model = language.fit(language.labelled_rows(given.filter("doc_id % 3 <> 0")))
    found = language.identify(given.filter("doc_id % 3 = 0"), model)
    right = found.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert right > 0.98
    assert found.filter("rejected").count() <= 0.01 * found.count()
    odd = spark.createDataFrame(
        [(1, None), (2, ""), (3, "12 + 34"), (4, "これは日本語の文章です。" * 30), (5, "zqxj wvkq " * 60)], DOCS
    )
    rows = {r.doc_id: r for r in language.identify(odd, model).collect()}
    assert all(rows[k].lang_pred == "und" and rows[k].score == 0 and rows[k].rejected for k in (1, 2, 3))
    assert rows[4].rejected and rows[5].rejected
    none = language.fit(language.labelled_rows(given.limit(0)))
    assert {r.lang_pred for r in language.identify(odd, none).collect()} == {"und"}


def test_junk_is_rejected_and_prose_kept(spark, given):
    from pathlib import Path

    model = Path(public_tokenizers.path("piece_bpe_32k.model")).read_bytes()
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    ranks = Path(public_tokenizers.path("byte_bpe_multi_50k.tiktoken")).read_bytes()
    found = fertility.fertility_rules(given, model, ranks=ranks).join(labels, "doc_id").filter("not base_failed")
    shares = found.groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("kept"), F.count("*").alias("n"))
    by_quality = {r.quality: r.kept for r in shares.collect()}
    assert by_quality[1] > 0.98 and by_quality[0] < 0.5


def test_links_across_long_lists(spark):
    """Near copies of one text, more than a list may hold, some of them linked only through others."""
    draw = random.Random(11)
    words = [f"w{draw.randrange(10**6)}" for _ in range(150)]
    rows = [(0, " ".join(words))]
    for k in range(1, 160):
        changed = list(words)
        for _ in range(draw.randrange(1, 5)):
            changed[draw.randrange(len(changed))] = f"x{draw.randrange(10**6)}"
        rows.append((k, " ".join(changed)))
    # A chain away from the group: each step is similar, the ends are not.
    chain = list(words)
    for k in range(200, 206):
        for place in range(3 * (k - 200), 3 * (k - 199)):
            chain[40 + place] = f"y{place}"
        rows.append((k, " ".join(chain)))
    found = near_dup.near_duplicates(spark.createDataFrame(rows, DOCS), words=4).drop("print")
    assert Counter(tuple(r) for r in found.collect()) == brute.op5(rows)


def test_components_of_chains_and_stars(spark):
    chain = [(k, k + 1) for k in range(40)]
    star = [(100, k) for k in range(101, 140)]
    links = spark.createDataFrame([*chain, *star, (7, 7), (3, 2)], "a bigint, b bigint")
    labels = {r.node: r.label for r in components.connected(links).collect()}
    assert labels == {**{k: 0 for k in range(41)}, **{k: 100 for k in range(100, 140)}}
    assert components.connected(links.limit(0)).collect() == []


def test_lines_keep_their_first_place(spark):
    passage = " ".join(f"p{k}" for k in range(60))
    rows = [(2, f"two\n{passage}\nend"), (1, f"one\n{passage}"), (3, f"one\n{passage}"), (None, None), (4, "")]
    found = line_chunks.dedup_lines(spark.createDataFrame(rows, DOCS).withColumn("removed", F.lit(1)))
    texts = {r.doc_id: r.text for r in found.collect()}
    assert texts == {1: f"one\n{passage}", 2: "two\nend", 3: "", None: None, 4: ""}
    assert found.columns == ["doc_id", "text", "removed", "n_removed_chunks", "n_removed_lines"]


def test_owners_tell_examples_from_live_secrets(spark):
    text = "password = abcdefgh12345678"
    rows = [(k, text, f"owner{k}") for k in range(3)] + [(9, "secret: zyxwvut987654321", "owner0")]
    rows += [(10 + k, "secret: mine00000000000", "owner5") for k in range(5)]
    docs = spark.createDataFrame(rows, DOCS + ", source string")
    found = {r.doc_id: r for r in secret_scan.scan(docs).collect()}
    assert found[0].example and (found[0].n_owners, found[0].n_repos) == (3, 3)
    assert not found[9].example and not found[10].example
    assert (found[10].n_owners, found[10].n_repos) == (1, 5)


def test_templates_are_met_by_share_of_their_words(spark):
    notice = "alpha beta gamma delta epsilon"
    rows = [(1, "beta gamma\nALPHA, delta: beta gamma"), (2, "alpha beta gamma"), (3, notice + " zeta"), (4, None)]
    found = licenses.scan(spark.createDataFrame(rows, DOCS), templates=[("t", notice), ("u", "never seen")])
    assert {r.doc_id: (r.labels, r.score) for r in found.collect()} == {
        1: ("t", 0.8), 2: ("", 0.0), 3: ("t", 1.0), 4: ("", 0.0),
    }


def test_near_but_not_exact_terms(spark):
    item = "the quick brown fox jumps over one lazy dog today"
    rows = [
        (1, f"x {item} y"),
        (2, item.replace("over one lazy", "over one very lazy")),
        (3, "fox and dog"),
        (4, item.replace("fox", "cat")),
    ]
    docs = spark.createDataFrame(rows, DOCS)
    items = decontaminate.read_items(spark.createDataFrame([(7, item)], "item_id bigint, text string"), "item_id", "text")
    chosen = decontaminate.anchors(items, decontaminate.frequencies(docs, items, "text"))
    anchors = sorted((r.offset, r.word) for r in chosen.collect())
    assert len(anchors) == 2
    aligned = decontaminate.alignments(decontaminate.postings(docs, chosen, "doc_id", "text"), chosen)
    expected = set()
    for doc_id, text in rows:
        words = text.split()
        begins = sorted((k - o, o) for o, w in anchors for k, v in enumerate(words) if v == w)
        near = any(0 < b - a <= 4 and p != q for (a, p), (b, q) in zip(begins, begins[1:]))
        expected |= {doc_id} if near else set()
    assert {r.doc_id for r in decontaminate.proximity_matches(aligned).collect()} == expected


def test_slices_hold_whole_texts():
    from wardflow.llm.arrays import SLICE_BYTES, Texts, slices

    texts = pa.array(["a" * (SLICE_BYTES + 5), None, "b c", "d" * SLICE_BYTES, ""])
    batch = pa.RecordBatch.from_arrays([texts], names=["t"])
    parts = [column.to_pylist() for _, column in slices(batch, "t")]
    assert [t for part in parts for t in part] == [t or "" for t in texts.to_pylist()]
    flat = Texts(pa.array(["b c", "", "b", "c\tb"], pa.large_string()))
    owner, start, end = flat.words()
    assert owner.tolist() == [0, 0, 2, 3, 3]
    prints = flat.fingerprints(start, end)
    assert prints[0] == prints[2] == prints[4] and prints[1] == prints[3] != prints[0]


def test_tasks_give_their_memory_back(spark, tmp_path, monkeypatch):
    """Encoders refer to themselves, so idle workers would hold them."""
    ended = str(tmp_path / "ended")

    def noted():
        with open(ended, "w") as file:
            file.write("ended")

    monkeypatch.setattr(common, "release_memory", noted)

    def compute():
        return lambda texts: {"n": pa.array([len(t) for t in texts.to_pylist()], pa.int64())}

    rows = spark.createDataFrame([(1, "word")], DOCS).coalesce(1)
    assert [r["n"] for r in common.map_texts(rows, "text", "n long", compute).collect()] == [4]
    assert (tmp_path / "ended").exists()


def test_released_memory_includes_what_refers_to_itself():
    vocabulary = bpe.Vocabulary.read(public_tokenizers.path("word_bpe_49k.json"))
    encoder = bpe.WordEncoder(vocabulary)
    held = weakref.ref(encoder)
    del encoder
    common.release_memory()
    assert held() is None


def test_unusual_texts_are_split_without_the_tokens():
    vocabulary = bpe.Vocabulary.read(public_tokenizers.path("word_bpe_49k.json"))
    encoder, library = bpe.WordEncoder(vocabulary), Tokenizer.from_str(vocabulary.source)
    assert encoder.library.get_vocab_size() == 0
    texts = ["don't<|endoftext|> ½ ٣٤ 🫠 Á", "ΑΣ \U0001fae8 x​y ｆｕｌｌ Ⅷ", "plain"]
    found = encoder(pa.array(texts, pa.large_string())).to_pylist()
    assert found == [library.encode(t, add_special_tokens=False).ids for t in texts]


def test_a_workers_next_task_knows_its_pieces(monkeypatch):
    source = bpe.Vocabulary.read(public_tokenizers.path("byte_bpe_50k.json")).source
    first = token_files.kept_encoder(source)
    texts = pa.array(["rain over the river, 42 stones", "", "niño's 日本 ½"], pa.large_string())
    ids, sizes = first(texts)
    monkeypatch.setattr(first.coder, "encode", lambda strings: pytest.fail("encoded again"))
    again, same = token_files.kept_encoder(source)(texts)
    assert again.tolist() == ids.tolist() and same.tolist() == sizes.tolist()
    library = Tokenizer.from_str(source)
    assert ids.tolist() == [i for t in texts.to_pylist() for i in library.encode(t, add_special_tokens=False).ids]


def test_kept_encoders_forget_when_they_know_too_much(monkeypatch):
    monkeypatch.setattr(token_files, "PIECES", 3)
    source = bpe.Vocabulary.read(public_tokenizers.path("byte_bpe_50k.json")).source
    encoder = token_files.ByteLevelEncoder(bpe.Vocabulary.parse(source))
    library = Tokenizer.from_str(source)
    for text in ("one two three four", "five six", "one seven one"):
        found = encoder(pa.array([text], pa.large_string()))[0].tolist()
        assert found == library.encode(text, add_special_tokens=False).ids
    assert len(encoder.coder.known) < 8
