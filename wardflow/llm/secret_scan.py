"""Secrets in texts, and who owns them.

Candidates are spans of whole texts that look like credentials. Their values' hashes are counted over
the corpus by distinct repositories and owners: what many owners hold is a copied example, what few
hold looks live. Assignments, access keys and long hexadecimal numbers are always reported; other
strings mixing letter cases and digits only if they look live.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardflow.session import materialize

ASSIGN, ACCESS, HEX, OWNED = "assign", "access", "hex", "owned"
#: In the order in which spans with one start are listed.
KINDS = (ASSIGN, ACCESS, HEX, OWNED)
#: Values held by so many owners are examples.
EXAMPLE_OWNERS = 3

_WORDS = "(?i:password|passwd|secret|token|api_?key)"
_ASSIGNED = _WORDS + r"""["']?\x20*[:=]\x20*["']?"""
_VALUE = "[A-Za-z0-9+/_.=-]"
_LOOSE = "[A-Za-z0-9+/_=-]"
#: Kind: what a text must contain to be searched at all, the pattern searched for, its group that is the value.
PATTERNS = {
    ASSIGN: (f"{_ASSIGNED}{_VALUE}{{12,}}", f"{_ASSIGNED}({_VALUE}+)"),
    ACCESS: ("AKIA[A-Z0-9]{14,}", "(AKIA[A-Z0-9]{14,})"),
    HEX: ("[0-9a-f]{16,}", "([0-9a-f]{16,})"),
    OWNED: (f"{_LOOSE}{{24,}}", f"({_LOOSE}{{24,}})"),
}


def _good(kind: str, value: Column) -> Column:
    if kind == ASSIGN:
        return F.length(value) >= 12
    if kind == OWNED:
        return value.rlike("[0-9]") & value.rlike("[a-z]") & value.rlike("[A-Z]")
    return F.lit(True)


def _found(text: Column, kind: str) -> Column:
    """Leftmost non-overlapping matches as kind, rank, start, end (code points) and value.

    The lengths of matches, and of what lies between them, add up to places.
    """
    needed, pattern = PATTERNS[kind]
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.slice(F.split(text, pattern, -1), 1, F.size(matches))
    parts = F.arrays_zip(gaps.alias("gap"), matches.alias("match"))
    span = "struct<kind:string,rank:int,start:int,end:int,value:string>"
    start = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{span}>").alias("spans"))

    def add(state: Column, part: Column) -> Column:
        begin = state["at"] + F.length(part["gap"])
        end = begin + F.length(part["match"])
        value = F.regexp_extract(part["match"], pattern, 1)
        one = F.struct(
            F.lit(kind).alias("kind"), F.lit(KINDS.index(kind)).alias("rank"),
            begin.alias("start"), end.alias("end"), value.alias("value"),
        )
        kept = F.when(_good(kind, value), F.concat(state["spans"], F.array(one)))
        return F.struct(end.alias("at"), kept.otherwise(state["spans"]).alias("spans"))

    spans = F.aggregate(parts, start, add, lambda state: state["spans"])
    return F.when(text.rlike(needed), spans).otherwise(F.array().cast(f"array<{span}>"))


def candidates(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` without its text, a row per candidate: ``kind``, ``rank``, ``start``, ``end``, ``secret`` (SHA-256).

    Null texts have none. Values themselves are not passed on.
    """
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    others = [c for c in docs.columns if c != text_col]
    spans = F.concat(*[_found(text, kind) for kind in KINDS])
    opened = docs.select(*others, F.explode(spans).alias("span"))
    return opened.select(
        *others, "span.kind", "span.rank", "span.start", "span.end", F.sha2("span.value", 256).alias("secret")
    )


def ownership(found: DataFrame, repo: str, owner: str) -> DataFrame:
    """Per secret the distinct repositories and owners that hold it.

    Counted in three steps that each sum up in the map tasks, so a secret found in a third of all
    documents costs a row per task and owner. A null repository counts as one of its own. A null owner is
    unknown: it is none more, so that nobody's secret is taken for an example because of it.
    """
    once = found.groupBy("secret", owner, repo).agg(F.lit(1).alias("one"))
    repos = once.groupBy("secret", owner).agg(F.count("*").alias("repos"))
    return repos.groupBy("secret").agg(F.sum("repos").alias("n_repos"), F.count(owner).alias("n_owners"))


def scan(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", repo_col: str = "doc_id", owner_col: str = "source"
) -> DataFrame:
    """A row per reported span: ``doc_id``, ``print`` (the text's hash), kind, rank, start, end, secret,
    ``n_repos``, ``n_owners`` and ``example``. Rows that repeat id, text, repository and owner count once.

    Texts are searched once; the candidates, a few rows per text, are written and counted from there.
    """
    rows = docs.select(
        F.col(f"`{id_col}`").alias("doc_id"),
        F.xxhash64(F.col(f"`{text_col}`")).alias("print"),
        F.col(f"`{repo_col}`").alias("repo"),
        F.col(f"`{owner_col}`").alias("owner"),
        F.col(f"`{text_col}`").alias("text"),
    )
    found = materialize(candidates(rows), "secrets")
    held = found.join(ownership(found, "repo", "owner"), "secret")
    example = F.col("n_owners") >= EXAMPLE_OWNERS
    return (
        held.filter((F.col("kind") != OWNED) | ~example)
        .select("doc_id", "print", "kind", "rank", "start", "end", "secret", "n_repos", "n_owners", example.alias("example"))
    )


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", repo_col: str = "doc_id", owner_col: str = "source") -> DataFrame:
    """One row per row of ``docs``: counts per kind, the digest of the always reported spans, all spans,
    and how many distinct spans look live or are examples."""
    spans = scan(docs, id_col, text_col, repo_col, owner_col)
    one = F.struct("start", "rank", "end", "kind", "example")
    per_text = spans.groupBy("doc_id", "print").agg(F.sort_array(F.collect_set(one)).alias("spans"))
    per_text = per_text.select(F.col("doc_id").alias("s_id"), F.col("print").alias("s_print"), "spans")
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.xxhash64(F.col(f"`{text_col}`")).alias("print"))
    both = rows.join(
        per_text, F.col("doc_id").eqNullSafe(F.col("s_id")) & (F.col("print") == F.col("s_print")), "left"
    )
    none = F.array().cast(per_text.schema["spans"].dataType)
    both = both.select("doc_id", F.coalesce("spans", none).alias("spans"))

    def count(test) -> Column:
        return F.size(F.filter("spans", test)).cast("long")

    def listed(column: Column) -> Column:
        return F.array_join(
            F.transform(column, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
        )

    base = F.filter("spans", lambda s: s["kind"] != OWNED)
    return both.select(
        "doc_id",
        count(lambda s: s["kind"] == ASSIGN).alias("n_assign"),
        count(lambda s: s["kind"] == ACCESS).alias("n_access"),
        count(lambda s: s["kind"] == HEX).alias("n_hex"),
        F.sha2(listed(base), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"),
        count(lambda s: ~s["example"]).alias("n_live"),
        count(lambda s: s["example"]).alias("n_example"),
    )


#: The same from DuckDB.
SQL = r"""
with docs as materialized (
    select row_number() over () as row_id, doc_id, source, text from documents
), pieces as (
    select row_id, source, 'assign' as kind, 0 as rank,
        regexp_extract_all(text, '(?s)(.*?)((?i:password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+))', 1) as gaps,
        regexp_extract_all(text, '(?s)(.*?)((?i:password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+))', 2) as hits,
        regexp_extract_all(text, '(?s)(.*?)((?i:password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+))', 3) as vals
    from docs
    union all
    select row_id, source, 'access', 1, regexp_extract_all(text, '(?s)(.*?)(AKIA[A-Z0-9]+)', 1),
        regexp_extract_all(text, '(?s)(.*?)(AKIA[A-Z0-9]+)', 2), regexp_extract_all(text, '(?s)(.*?)(AKIA[A-Z0-9]+)', 2)
    from docs
    union all
    select row_id, source, 'hex', 2, regexp_extract_all(text, '(?s)(.*?)([0-9a-f]+)', 1),
        regexp_extract_all(text, '(?s)(.*?)([0-9a-f]+)', 2), regexp_extract_all(text, '(?s)(.*?)([0-9a-f]+)', 2)
    from docs
    union all
    select row_id, source, 'owned', 3, regexp_extract_all(text, '(?s)(.*?)([A-Za-z0-9+/_=-]+)', 1),
        regexp_extract_all(text, '(?s)(.*?)([A-Za-z0-9+/_=-]+)', 2), regexp_extract_all(text, '(?s)(.*?)([A-Za-z0-9+/_=-]+)', 2)
    from docs
), steps as (
    select row_id, source, kind, rank, unnest(gaps) as gap, unnest(hits) as hit, unnest(vals) as val,
        generate_subscripts(hits, 1) as k
    from pieces
), placed as (
    select *, sum(length(gap) + length(hit)) over (partition by row_id, kind order by k) as stop from steps
), found as (
    select row_id, source, kind, rank, stop - length(hit) as start, stop, val from placed
    where case kind when 'assign' then length(val) >= 12 when 'access' then length(hit) >= 18
        when 'hex' then length(hit) >= 16
        else length(hit) >= 24 and regexp_matches(hit, '[0-9]') and regexp_matches(hit, '[a-z]')
            and regexp_matches(hit, '[A-Z]') end
), owners as (
    select val, count(distinct source) >= 3 as example from found group by val
), reported as (
    select f.*, example, kind || ':' || start::bigint || ':' || stop::bigint as name
    from found f join owners using (val) where kind <> 'owned' or not example
), per_doc as (
    select row_id, count(*) filter (kind = 'assign') as n_assign, count(*) filter (kind = 'access') as n_access,
        count(*) filter (kind = 'hex') as n_hex,
        coalesce(string_agg(name, ',' order by start, rank) filter (kind <> 'owned'), '') as base,
        string_agg(name, ',' order by start, rank) as spans,
        count(*) filter (not example) as n_live, count(*) filter (example) as n_example
    from reported group by row_id
)
select doc_id, coalesce(n_assign, 0) as n_assign, coalesce(n_access, 0) as n_access, coalesce(n_hex, 0) as n_hex,
    sha256(coalesce(base, '')) as base_sha256, coalesce(per_doc.spans, '') as spans,
    coalesce(n_live, 0) as n_live, coalesce(n_example, 0) as n_example
from docs left join per_doc using (row_id)
"""
