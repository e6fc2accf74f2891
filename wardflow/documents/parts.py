"""Recurring parts of resource documents as struct columns."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from wardflow import codes
from wardflow.functions.text import first_present, lookup, present_parts

XHTML = "http://www.w3.org/1999/xhtml"


def record(**fields: Column | str | bool | int) -> Column:
    """A struct; plain Python values become literals. A trailing underscore in a name is dropped."""
    return F.struct(
        *[
            (v if isinstance(v, Column) else F.lit(v)).alias(name.rstrip("_"))
            for name, v in fields.items()
        ]
    )


def listed(*items: Column | str) -> Column:
    return F.array(*[i if isinstance(i, Column) else F.lit(i) for i in items])


def coding(system: Column | str, code: Column | str, display: Column | str) -> Column:
    return listed(record(system=system, code=code, display=display))


def concept(
    system: Column | str, code: Column | str, display: Column | str, text: Column | str | None = None
) -> Column:
    """A coded concept, with its text when one is given."""
    coded = coding(system, code, display)
    return record(coding=coded) if text is None else record(coding=coded, text=text)


def coded_as(system: str, code: Column, table: Mapping[str, str], with_text: bool = False) -> Column:
    """A concept whose display comes from a code table."""
    display = lookup(code, table)
    return concept(system, code, display, display if with_text else None)


def reference(kind: str, key: Column, display: Column) -> Column:
    return record(reference=F.concat(F.lit(kind + "/"), key), display=display)


def contact_point(system: str, value: Column, use: str) -> Column:
    return record(system=system, value=value, use=use)


def period(start: Column, end: Column) -> Column:
    return record(
        start=F.date_format(start, "yyyy-MM-dd"), end=F.date_format(end, "yyyy-MM-dd")
    )


def narrative(*text: Column | str) -> Column:
    """Generated narrative of a resource."""
    inner = [t if isinstance(t, Column) else F.lit(t) for t in text]
    div = F.concat(F.lit(f'<div xmlns="{XHTML}">'), *inner, F.lit("</div>"))
    return record(status="generated", div=div)


def practice_city() -> Column:
    return first_present("AddressLine4", "AddressLine3")


def practice_address(*lines: str, use: str | None = None) -> Column:
    """Address of a practice from the given address lines of the register."""
    start = {} if use is None else {"use": use}
    return record(
        **start,
        line=present_parts(*lines),
        city=practice_city(),
        state=F.col("GPCluster"),
        postalCode=F.col("Postcode"),
        country=codes.COUNTRY,
    )
