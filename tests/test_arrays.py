"""Array files put together from pieces, against Python's own reader."""

from __future__ import annotations

import json

import pytest

from wardflow.sources.arrays import read_array_files

DOCS = [
    {"id": 1, "note": "plain"},
    {"id": 2, "note": 'braces } { ] [ and a quote " and a backslash \\ and both \\" }'},
    {"id": 3, "deep": {"list": [{"a": {}}, {"b": [[], [{}]]}], "text": "},{"}},
    {"id": 4, "note": "ends in a backslash \\", "é": "ünï – 日本 😀"},
    "a text } with a brace",
    7,
    [{"in": "an array"}, [1, {"x": "]"}]],
    {},
    {"id": 5, "note": "line\nbreaks\r\nand\ttabs"},
    [],
    True,
]


def read(spark, path):
    def plain(text):
        try:
            return json.loads(text)
        except json.JSONDecodeError:
            return text

    return sorted(json.dumps(plain(r.raw_data), sort_keys=True) for r in read_array_files(spark, str(path)).collect())


def expected(docs):
    return sorted(json.dumps(d, sort_keys=True) for d in docs)


@pytest.mark.parametrize("block", [40, 1000, 10_000_000])
@pytest.mark.parametrize("indent", [None, 2])
def test_array_files_cut_anywhere(spark, tmp_path, block, indent):
    name = "spark.sql.files.maxPartitionBytes"
    (tmp_path / "a.json").write_text(json.dumps(DOCS, indent=indent, ensure_ascii=False), encoding="utf-8")
    (tmp_path / "b.json").write_text("  \n" + json.dumps(DOCS[:3] * 20, indent=indent) + "\n")
    before = spark.conf.get(name)
    spark.conf.set(name, str(block))
    try:
        assert read(spark, tmp_path) == expected(DOCS + DOCS[:3] * 20)
    finally:
        spark.conf.set(name, before)


def test_documents_one_after_another(spark, tmp_path):
    docs = [d for d in DOCS if isinstance(d, dict)]
    (tmp_path / "lines.json").write_text("\n".join(json.dumps(d) for d in docs))
    (tmp_path / "one.json").write_text(json.dumps(docs[2], indent=1))
    assert read(spark, tmp_path) == expected([*docs, docs[2]])


def test_odd_files(spark, tmp_path):
    for name, text in {"empty": "", "blank": " \n", "none": "[]", "spaced": " [ \n ] ", "bom": '\ufeff[{"a": 1}]'}.items():
        (tmp_path / f"{name}.json").write_text(text, encoding="utf-8")
    (tmp_path / "nobrace.json").write_text('[1, "x"]')
    assert read(spark, tmp_path) == ['"x"', "1", '{"a": 1}']


def test_what_cannot_be_read_stays_as_it_is(spark, tmp_path):
    (tmp_path / "cut.json").write_text('[{"a": 1}, {"b": 2')
    (tmp_path / "more.json").write_text('[{"c": 1}, oops {"d": 2}, {"e": 3}] tail')
    (tmp_path / "shut.json").write_text('[{"f": 1}, 4] {')
    found = [r.raw_data for r in read_array_files(spark, str(tmp_path)).collect()]
    assert sorted(found) == sorted(
        ['{"a":1}', '{"b": 2', '{"c":1}', 'oops {"d": 2}', '{"e":3}', "] tail", '{"f":1}', "4] {"]
    )


def test_no_task_gets_a_file_whole(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps([{"id": i, "pad": "x" * 50} for i in range(2000)]))
    name = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(name)
    spark.conf.set(name, "10000")
    try:
        found = read_array_files(spark, str(tmp_path))
        assert found.count() == 2000
        assert found.selectExpr("max(length(raw_data))").first()[0] < 200
    finally:
        spark.conf.set(name, before)
