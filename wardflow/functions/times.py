"""Dates and timestamps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from wardflow.functions.text import as_column

DAY = "yyyy-MM-dd"
SECOND = "yyyy-MM-dd HH:mm:ss"
ISO_OFFSET = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx"


def day_text(when: Column | str) -> Column:
    return F.date_format(as_column(when), DAY)


def second_text(when: Column | str) -> Column:
    return F.date_format(as_column(when), SECOND)


def iso_text(when: Column | str) -> Column:
    """ISO text with offset, as documents carry it."""
    return F.date_format(as_column(when).cast("timestamp"), ISO_OFFSET)


def shifted(when: Column | str, days: Column | int = 0, minutes: Column | int = 0) -> Column:
    """A timestamp moved by whole days and minutes."""

    def whole(amount: Column | int) -> Column:
        return amount if isinstance(amount, Column) else F.lit(amount)

    return as_column(when) + F.make_dt_interval(days=whole(days), mins=whole(minutes))


def hours_ago(hours: int) -> Column:
    return F.current_timestamp() - F.make_dt_interval(hours=F.lit(hours))


def utc_date(when: Column) -> Column:
    """The day of a timestamp in UTC, whatever the session's zone."""
    return F.to_date(F.to_utc_timestamp(when, F.current_timezone()))
