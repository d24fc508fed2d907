"""Dates: periods, days left and windows; the day to count from is always an argument."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def days_left(end: Column, as_of: Column) -> Column:
    """Days from a moment to the end of a day, rounded up; -1 once it is over, null without an end."""
    last = F.unix_timestamp(F.date_add(F.to_date(end), 1)) - 1
    left = F.ceil((last - F.unix_timestamp(as_of)) / 86400.0)
    return F.when(left < 0, F.lit(-1)).otherwise(left).cast("int")


def in_window(day: Column, first: str, last: str) -> Column:
    """Whether the first ten characters are a date from first to last, both included; anything else is not."""
    d = F.try_to_date(F.left(day, F.lit(10)), "yyyy-MM-dd")
    return F.coalesce(d.between(F.lit(first).cast("date"), F.lit(last).cast("date")), F.lit(False))


def period_end(period: Column, open_words: list[str]) -> Column:
    """The last date of a period: none if it never closes, else the trailing date, else the one after a tilde."""
    from .text import contains_any

    trailing = F.nullif(F.regexp_extract(period, r"(\d{4}-\d{2}-\d{2})\s*$", 1), F.lit(""))
    after = F.nullif(F.regexp_extract(period, r"~\s*(\d{4}-\d{2}-\d{2})", 1), F.lit(""))
    return F.when(~contains_any(period, open_words), F.try_to_date(F.coalesce(trailing, after), "yyyy-MM-dd"))


def half_up(x: Column) -> Column:
    """Rounds halves towards positive infinity."""
    return F.floor(x + 0.5)
