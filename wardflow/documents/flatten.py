"""Documents to typed rows.

A flatten spec lists target columns and where they come from. All scalar paths of a spec are read
by one ``from_json`` with a schema made of just those paths, so a document is parsed once however
many columns come out of it, and what no path names is skipped. Leaves are read as text and then
cast, which takes numbers and booleans written either way. Columns that are themselves documents are
variant; they cost a second parse, but only where they are selected.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardflow.functions.text import last_segment

MALFORMED = "_malformed"
_STEP = re.compile(r"(\w+)((?:\[\d+\])*)")


@dataclass(frozen=True)
class Target:
    """A target column: the paths it needs and how their values make it."""

    name: str
    type: str
    paths: tuple[str, ...]
    make: Callable[..., Column]
    subtree: bool = False


def value(name: str, type: str, path: str) -> Target:
    """A scalar of the document, cast to ``type``."""
    return Target(name, type, (path,), lambda v: v)


def tail(name: str, path: str) -> Target:
    """The id after the last slash of a reference."""
    return Target(name, "string", (path,), last_segment)


def joined(name: str, path: str) -> Target:
    """An array of text, joined with a comma and a blank."""
    return Target(name, "string", (path + "[]",), lambda v: F.array_join(v, ", "))


def glued(name: str, *paths: str, by: str = " ") -> Target:
    """Several values with ``by`` between them; null if any is. A path ending in ``[]`` is joined first."""

    def make(*values: Column) -> Column:
        texts = [
            F.array_join(v, ", ") if p.endswith("[]") else v for p, v in zip(paths, values)
        ]
        pieces = [texts[0]]
        for text in texts[1:]:
            pieces += [F.lit(by), text]
        return F.concat(*pieces)

    return Target(name, "string", paths, make)


def subtree(name: str, path: str = "") -> Target:
    """A part of the document (default: all of it) as a document."""
    return Target(name, "variant", (path,), lambda v: v, subtree=True)


def flatten(
    docs: DataFrame,
    spec: Sequence[Target],
    body: str = "raw_data",
    strict: bool = True,
    keep: Sequence[str] = (),
) -> DataFrame:
    """The columns of ``spec``, in order, after those in ``keep``.

    Strict: a malformed document or a value that does not fit its type fails the job. Otherwise
    both read as null; see ``flatten_or_reject``.
    """
    opened = open_documents(docs, spec, body, strict)
    return opened.select(*keep, *[_column(t, body, strict).alias(t.name) for t in spec])


def flatten_or_reject(
    docs: DataFrame, spec: Sequence[Target], body: str = "raw_data", keep: Sequence[str] = ()
) -> tuple[DataFrame, DataFrame]:
    """Flattened rows, and documents that are malformed or hold a value of the wrong type.

    A reject keeps its columns plus ``bad_columns``; a malformed document names ``body`` there.
    """
    opened = open_documents(docs, spec, body, strict=False)
    lost = [
        F.when(_text(t).isNotNull() & _column(t, body, False).isNull(), F.lit(t.name))
        for t in spec
        if not t.subtree and t.type != "string"
    ]
    malformed = F.when(is_malformed(body), F.lit(body))
    checked = opened.withColumn(
        "bad_columns", F.filter(F.array(malformed, *lost), lambda name: name.isNotNull())
    )
    good = checked.filter(F.size("bad_columns") == 0)
    rows = good.select(*keep, *[_column(t, body, False).alias(t.name) for t in spec])
    rejects = checked.filter(F.size("bad_columns") > 0).select(*docs.columns, "bad_columns")
    return rows, rejects


def schema_of(spec: Sequence[Target]) -> T.StructType:
    """The nested schema that covers the scalar paths of a spec and nothing else."""
    tree: dict = {}
    for target in spec:
        if target.subtree:
            continue
        for path in target.paths:
            node = tree
            steps = _steps(path)
            for depth, (name, hops, is_list) in enumerate(steps):
                slot = node.setdefault(name, {"hops": hops + is_list, "fields": {}})
                if slot["hops"] != hops + is_list:
                    raise ValueError(f"{path}: {name} is used with different depths")
                node = slot["fields"]
                if depth < len(steps) - 1 and is_list:
                    raise ValueError(f"{path}: only the last step may end in []")
    return _struct(tree)


def _struct(tree: dict) -> T.StructType:
    fields = []
    for name, slot in tree.items():
        kind: T.DataType = _struct(slot["fields"]) if slot["fields"] else T.StringType()
        for _ in range(slot["hops"]):
            kind = T.ArrayType(kind)
        fields.append(T.StructField(name, kind))
    return T.StructType(fields)


def _steps(path: str) -> list[tuple[str, int, int]]:
    """Name, number of indexes, and 1 for a trailing ``[]``, per step of a path."""
    steps = []
    for part in path.split("."):
        is_list = part.endswith("[]")
        match = _STEP.fullmatch(part.removesuffix("[]"))
        if match is None:
            raise ValueError(f"not a path: {path}")
        steps.append((match[1], match[2].count("["), int(is_list)))
    return steps


def open_documents(
    docs: DataFrame, spec: Sequence[Target], body: str, strict: bool
) -> DataFrame:
    """The documents with ``_doc``, the parsed part that the spec needs."""
    text = F.col(body)
    if isinstance(docs.schema[body].dataType, T.VariantType):
        text = F.to_json(text)
    schema = schema_of(spec)
    options = {"mode": "FAILFAST"}
    if not strict:
        schema = schema.add(MALFORMED, "string")
        options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": MALFORMED}
    parsed = F.from_json(text, schema, options)
    # A one-element explode: filters on parsed values cannot be pushed below it, where the
    # optimizer would parse the document again for each value they use.
    return docs.select("*", F.explode(F.array(parsed)).alias("_doc"))


def is_malformed(body: str) -> Column:
    """True where a leniently opened document could not be read."""
    return F.col(body).isNull() | F.col("_doc").getField(MALFORMED).isNotNull()


def at(path: str) -> Column:
    """The value at a path of an opened document; null beyond the end of an array."""
    node = "_doc"
    for name, indexes in ((m[1], m[2]) for m in _STEP.finditer(path)):
        node = f"{node}.`{name}`"
        for index in re.findall(r"\d+", indexes):
            node = f"get({node}, {index})"
    return F.expr(node)


def _text(target: Target) -> Column:
    return target.make(*[at(p) for p in target.paths])


def _column(target: Target, body: str, strict: bool) -> Column:
    if target.subtree:
        parsed = F.parse_json(F.col(body)) if strict else F.try_parse_json(F.col(body))
        path = target.paths[0]
        return F.variant_get(parsed, f"$.{path}", "variant") if path else parsed
    text = _text(target)
    if target.type == "string":
        return text
    if target.type == "int":
        # Documents may write a whole number as 30.0, and loads round what is not whole.
        number = text.cast("double") if strict else text.try_cast("double")
        whole = F.round(number)
        return whole.cast("int") if strict else whole.try_cast("int")
    return text.cast(target.type) if strict else text.try_cast(target.type)
