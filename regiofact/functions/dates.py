"""Column functions for periods and dates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from regiofact.functions.text import regex_find

# Fixed patterns: the first and the last ISO date of a period text.
FIRST_ISO_DATE = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}"
LAST_ISO_DATE = r"[0-9]{4}-[0-9]{2}-[0-9]{2}$"


def text_date(c: Column, pattern: str) -> Column:
    """The part of a text that matches a pattern, as a date; NULL without a match."""
    return regex_find(c, pattern).cast("date")


def year_start(year: Column) -> Column:
    return F.make_date(year.cast("int"), F.lit(1), F.lit(1))


def year_end(year: Column) -> Column:
    return F.make_date(year.cast("int"), F.lit(12), F.lit(31))


def period_bounds(year_from: Column, year_to: Column, period_type: str) -> dict[str, Column]:
    """Reference period of a year range.

    A due date over one single year has no start; every other range starts on
    1 January of its first year.
    """
    start = year_start(year_from)
    if period_type != "period":
        start = F.when(year_from == year_to, F.lit(None)).otherwise(start)
    return {"period_ref_from": start.cast("date"), "period_ref": year_end(year_to)}


def compact_date(c: Column) -> Column:
    """``yyyyMMdd`` as number or text."""
    return F.to_date(c.cast("string"), "yyyyMMdd")


def snapshot_code(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM-dd")
