"""Configured rules as a table: resolved once for the distinct values they look at, then joined.

A rule says which rows it takes, and what becomes of them. Rows with the same values in the
columns that rules look at are taken by the same rules. So patterns are matched on the distinct
values only, and the rows meet their rules in a join. The plan has the same size for one rule
and for hundreds, and a row is copied only for rules that take it.
"""

from __future__ import annotations

from collections.abc import Callable, Hashable, Sequence
from functools import reduce
from operator import and_
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from regiofact.config import FilterRule

#: Tests on named columns that must all hold: a pattern to find, a value to equal.
TESTS = "tests array<struct<name:string,regex:string,exact:string>>"


def rule_table(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """Rules as rows; the fields of ``schema`` are what they look for, and what they emit."""
    return spark.createDataFrame(list(rows), schema)


class Options:
    """Different values of a setting, numbered as rules name them, such as column expressions.

    Settings are columns of the rule table where they are data. Where a setting is an expression,
    rules hold its number, and as many branches are planned as there are different expressions.
    """

    def __init__(self) -> None:
        self.known: dict[Hashable, int] = {}

    def number(self, value: Hashable) -> int:
        return self.known.setdefault(value, len(self.known))

    def choose(self, index: Column, made: Callable[[Any], Column]) -> Column:
        """The expression of the value that ``index`` names; there is one at least."""
        branches = [(made(value), i) for value, i in self.known.items()]
        if len(branches) == 1:
            return branches[0][0]
        return reduce(lambda c, b: c.when(index == b[1], b[0]), branches[1:], F.when(index == branches[0][1], branches[0][0]))


def tests_of(rules: Sequence[FilterRule]) -> list[tuple[str, str | None, str | None]]:
    """Filter rules as the ``tests`` of a rule table."""
    return [(r.column, r.regex or None, r.exact_match or None) for r in rules]


def tests_hold(tests: Column, names: Sequence[str]) -> Column:
    """All tests on the named columns hold; a test on a NULL does not."""
    if not names:
        return F.lit(True)
    values = F.create_map(*[x for n in names for x in (F.lit(n), F.col(n).cast("string"))])

    def holds(t: Column) -> Column:
        value = values[t["name"]]
        found = t["regex"].isNull() | F.rlike(value, t["regex"])
        return F.coalesce(found & (t["exact"].isNull() | (value == t["exact"])), F.lit(False))

    return F.forall(tests, holds)


def any_of(c: Column, patterns: Column) -> Column:
    """At least one of an array of patterns matches; no patterns means no restriction."""
    return (F.size(patterns) == 0) | F.exists(patterns, lambda p: F.rlike(c, p))


def apply_rules(
    df: DataFrame, keys: Sequence[str], rules: DataFrame, takes: Callable[[Column], Column], name: str = "_rule"
) -> DataFrame:
    """Every row of ``df`` beside each rule that takes it, as a struct; others drop out.

    ``takes`` says from a rule whether it takes the rows of given values of ``keys``. It is
    evaluated once for each rule and each distinct combination of those values, NULLs included.
    """
    listed = rules.agg(F.collect_list(F.struct(*rules.columns)).alias("rules")).scalar()
    wanted = F.explode(F.filter("_rules", takes)).alias(name)
    if not keys:
        return df.withColumn("_rules", listed).select(*df.columns, wanted)
    index = df.select(*keys).distinct().withColumn("_rules", listed)
    index = index.select(*[F.col(k).alias(f"_of_{k}") for k in keys], wanted)
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_of_{k}")) for k in keys])
    return df.join(index, same).drop(*[f"_of_{k}" for k in keys])
