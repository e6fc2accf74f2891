"""Text and identifier columns."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def squashed(name: Column | str) -> Column:
    """Lower case without blanks; punctuation stays."""
    return F.lower(F.replace(as_column(name), F.lit(" "), F.lit("")))


def slug(name: Column | str, keep_dash: bool = False) -> Column:
    """Lower-case letters and digits only, optionally with dashes."""
    return F.regexp_replace(squashed(name), "[^a-z0-9-]" if keep_dash else "[^a-z0-9]", "")


def last_segment(reference: Column | str) -> Column:
    """The id after the last slash of ``Type/id``; null when there is none."""
    return F.regexp_substr(as_column(reference), F.lit("[^/]+$"))


def present_parts(*parts: Column | str) -> Column:
    """The given parts as an array, without null and empty ones."""
    everything = F.array(*[as_column(p) for p in parts])
    return F.filter(everything, lambda part: part.isNotNull() & (part != ""))


def first_present(first: Column | str, second: Column | str) -> Column:
    """``first`` unless it is null or empty, else ``second``."""
    return F.coalesce(F.nullif(as_column(first), F.lit("")), as_column(second))


def default_to(value: Column | str, default: Column | str | None) -> Column:
    """``value``, or ``default`` (a literal when given as text) where it is null."""
    fallback = default if isinstance(default, Column) else F.lit(default)
    return F.coalesce(as_column(value), fallback)


def capitalized(word: Column | str) -> Column:
    """First letter upper case, the others lower case."""
    text = as_column(word)
    return F.concat(F.upper(F.left(text, F.lit(1))), F.lower(F.substring(text, 2, 2147483647)))


def padded(number: Column | str, width: int) -> Column:
    """A whole number as text with leading zeros; longer numbers keep all their digits."""
    digits = as_column(number).cast("string")
    return F.lpad(digits, F.greatest(F.length(digits), F.lit(width)), F.lit("0"))


def padded_id(prefix: Column | str, number: Column | str, width: int) -> Column:
    """``prefix`` (a literal when given as text) followed by the padded number."""
    start = prefix if isinstance(prefix, Column) else F.lit(prefix)
    return F.concat(start, padded(number, width))


def patient_key(practice_code: Column | str, number: Column | str) -> Column:
    return padded_id(F.concat(F.lit("P"), as_column(practice_code).cast("string"), F.lit("-")), number, 2)


def practitioner_key(practice_code: Column | str, number: Column | str | None = None) -> Column:
    stem = F.concat(as_column(practice_code).cast("string"), F.lit("-practitioner"))
    return stem if number is None else F.concat(stem, as_column(number).cast("string"))


def text_literal(value: str) -> str:
    """A text as an SQL literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def lookup(code: Column | str, table: Mapping[str, str]) -> Column:
    """Display text of a code; null for codes outside the (fixed, short) table."""
    items = ", ".join(text_literal(item) for pair in table.items() for item in pair)
    return F.try_element_at(F.expr(f"map({items})"), as_column(code))


def email_of(stem: Column, domain: str = "nhs.scot.co.uk") -> Column:
    return F.concat(stem, F.lit("@" + domain))


def site_of(stem: Column, scheme: str = "http") -> Column:
    return F.concat(F.lit(scheme + "://"), stem, F.lit(".com"))
