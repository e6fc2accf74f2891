"""Putting documents by id: what is written again, what survives a failure, which of several wins."""

from __future__ import annotations

import json

import pytest

from wardflow.sinks import store
from wardflow.sinks.files import write_resources
from wardflow.sources.files import read_resource


def docs(spark, rows):
    full = [(i, None if i is None else json.dumps({"id": i, "v": v}), at) for i, v, at in rows]
    return spark.createDataFrame(full, "id string, resource_json string, at int")


def stored(spark, root):
    found = [json.loads(r["raw_data"]) for r in read_resource(spark, root, "Thing").collect()]
    return sorted((d["id"], d["v"]) for d in found)


def files(tmp_path):
    return {p: p.stat().st_mtime_ns for p in (tmp_path / "Thing").rglob("part-*.txt")}


def test_a_put_writes_one_part_again(spark, tmp_path):
    root = str(tmp_path)
    store.put_documents(docs(spark, [(f"i{k}", 0, 0) for k in range(200)]), root, "Thing", parts=16)
    before = files(tmp_path)
    store.put_documents(docs(spark, [("i7", 1, 0)]), root, "Thing")
    after = files(tmp_path)
    changed = {p.parent.name for p in before.keys() ^ after.keys()}
    assert len(changed) == 1 and len({p.parent for p in after}) == 16
    assert stored(spark, root) == sorted([(f"i{k}", int(k == 7)) for k in range(200)])


def test_new_ids_are_only_added(spark, tmp_path):
    root = str(tmp_path)
    store.put_documents(docs(spark, [("a", 0, 0), ("b", 0, 0)]), root, "Thing", parts=4)
    before = files(tmp_path)
    store.put_documents(docs(spark, [("c", 0, 0), ("d", 0, 0)]), root, "Thing")
    assert before.items() <= files(tmp_path).items()
    store.put_documents(docs(spark, []), root, "Thing")
    assert stored(spark, root) == [(x, 0) for x in "abcd"]


def test_the_last_arrival_wins(spark, tmp_path):
    root = str(tmp_path)
    store.put_documents(docs(spark, [("a", 9, 1), ("a", 1, 2), ("b", 5, None), ("b", 4, 0)]), root, "Thing", arrival="at")
    assert stored(spark, root) == [("a", 1), ("b", 4)]
    store.put_documents(docs(spark, [("a", 0, 0)]), root, "Thing", arrival="at")  # a later put wins whatever it says
    store.put_documents(docs(spark, [("b", 1, 0), ("b", 7, 0)]), root, "Thing")
    assert stored(spark, root) == [("a", 0), ("b", 7)]


@pytest.mark.parametrize("lost", [False, True])
def test_a_failure_while_replacing_loses_nothing(spark, tmp_path, monkeypatch, lost):
    root = str(tmp_path)
    store.put_documents(docs(spark, [(f"i{k}", 0, 0) for k in range(40)]), root, "Thing", parts=4)
    write = store._write

    def failing(rows, path, mode):
        if mode == "overwrite":
            if lost:  # the part is gone and not yet there again
                (part,) = [r["part"] for r in rows.select("part").distinct().collect()]
                for p in (tmp_path / "Thing" / "parts=4" / f"part={part}").iterdir():
                    p.unlink()
            raise RuntimeError("killed")
        write(rows, path, mode)

    monkeypatch.setattr(store, "_write", failing)
    with pytest.raises(RuntimeError):
        store.put_documents(docs(spark, [("i3", 1, 0)]), root, "Thing")
    monkeypatch.undo()
    assert (len(stored(spark, root)) < 40) == lost
    assert store.finish_put(spark, root, "Thing")
    assert stored(spark, root) == sorted([(f"i{k}", int(k == 3)) for k in range(40)])
    assert not store.finish_put(spark, root, "Thing")


def test_a_failure_while_copying_changes_nothing(spark, tmp_path):
    root = str(tmp_path)
    store.put_documents(docs(spark, [("a", 0, 0)]), root, "Thing", parts=4)
    (tmp_path / "_put-Thing" / "parts=4" / "part=0").mkdir(parents=True)
    (tmp_path / "_put-Thing" / "parts=4" / "part=0" / "part-x.txt").write_text("{}\n")
    store.put_documents(docs(spark, [("a", 1, 0)]), root, "Thing")
    assert stored(spark, root) == [("a", 1)]


def test_other_folders_are_refused(spark, tmp_path):
    write_resources(docs(spark, [("a", 0, 0)]), str(tmp_path), "Thing")
    with pytest.raises(ValueError, match="not a store"):
        store.put_documents(docs(spark, [("a", 1, 0)]), str(tmp_path), "Thing")
