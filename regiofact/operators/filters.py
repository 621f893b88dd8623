"""Row filters of the loading steps and of the queries."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regiofact.config import FilterRule
from regiofact.schemas import GEO_LEVELS, GROUPS


def rules_hold(rules: Sequence[FilterRule]) -> Column:
    """All rules of a list."""
    terms = []
    for rule in rules:
        if rule.regex:
            terms.append(F.col(rule.column).rlike(rule.regex))
        if rule.exact_match:
            terms.append(F.col(rule.column) == rule.exact_match)
    return reduce(and_, terms, F.lit(True))


def any_pattern(c: Column, patterns: Sequence[str]) -> Column:
    """At least one regex matches; no patterns means no restriction."""
    return reduce(or_, [c.rlike(p) for p in patterns]) if patterns else F.lit(True)


def known_level(c: Column, prefix: bool = False) -> Column:
    """The level is one of the three supported, or starts like one."""
    if prefix:
        return reduce(or_, [c.startswith(level) for level in GEO_LEVELS])
    return c.isin(*GEO_LEVELS)


def has_value() -> Column:
    return F.col("indicator_value_numeric").isNotNull() | F.col("indicator_value_text").isNotNull()


def publishable() -> Column:
    """A municipality row with a number and a value."""
    return (F.col("geo_code") == "polg") & F.col("geo_value").isNotNull() & has_value()


def optional_columns(df: DataFrame, names: Sequence[str]) -> list[str]:
    """Those of the named columns that this load carries."""
    present = set(df.columns)
    return [n for n in names if n in present]


def known_at(df: DataFrame, knowledge_date: str | None) -> DataFrame:
    """Rows believed true on a day; without a day, the rows still open."""
    if not knowledge_date:
        return df.filter(F.col("knowledge_date_to").isNull())
    day = F.lit(dt.date.fromisoformat(knowledge_date).isoformat()).cast("timestamp_ntz")
    until = F.col("knowledge_date_to")
    return df.filter((F.col("knowledge_date_from") <= day) & ((until > day) | until.isNull()))


def knowledge_label(knowledge_date: str | None, today: dt.date) -> Column:
    """The asked day as text, today's where none was asked."""
    day = dt.date.fromisoformat(knowledge_date) if knowledge_date else today
    return F.lit(day.isoformat())


def expand_groups(df: DataFrame, expand_all: bool = False, *expanded: int) -> DataFrame:
    """Keep totals only in every group that is not expanded."""
    if expand_all:
        return df
    return reduce(
        lambda d, n: d.filter(F.col(f"_group_value_{n}_is_total")),
        [n for n in GROUPS if n not in expanded],
        df,
    )


def where_set(df: DataFrame, **equals: object) -> DataFrame:
    """Equality filters; empty values (None, '', 0) count as not set."""
    for column, value in equals.items():
        if value:
            df = df.filter(F.col(column) == F.lit(value))
    return df
