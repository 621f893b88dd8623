"""Reshaping, de-duplication and latest-row operators."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from regiofact.operators.joins import lookup_join
from regiofact.session import materialize, spread


def union_tagged(*tables: DataFrame, tag: str = "src_order") -> DataFrame:
    """UNION ALL by name, numbering the inputs from 1 for later precedence."""
    tagged = [df.withColumn(tag, F.lit(n)) for n, df in enumerate(tables, start=1)]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)


def distinct_on(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], rows: int | None = None
) -> DataFrame:
    """First row per key in the given order.

    The rank filter reaches the map side (window group limit), so at most one row
    per key leaves each task however hot the key is.

    Where keys have few rows each, that only sorts all rows once more. With ``rows``, about how many
    there are, they are dealt by key to as many tasks as that asks for, and sorted there.
    """
    if rows is not None:
        df = spread(df, rows, *keys)
    first = Window.partitionBy(*keys).orderBy(*order)
    return (
        df.withColumn("_rank", F.row_number().over(first)).filter(F.col("_rank") == 1).drop("_rank")
    )


def keep_last(df: DataFrame, keys: Sequence[str], ingest_order: Sequence[str]) -> DataFrame:
    """Drop duplicates of a key, keeping the one ingested last."""
    return distinct_on(df, keys, [F.col(c).desc_nulls_last() for c in ingest_order])


def latest_per_entity(df: DataFrame, entity: str, order: str) -> DataFrame:
    """Rows at the greatest ``order`` of their entity; ties all stay.

    A rank filter, so older rows are dropped before the shuffle.
    """
    known = df.filter(F.col(entity).isNotNull() & F.col(order).isNotNull())
    newest = F.rank().over(Window.partitionBy(entity).orderBy(F.col(order).desc()))
    return known.withColumn("_rank", newest).filter("_rank = 1").drop("_rank")


def last_known(df: DataFrame, entity: str, order: str, columns: Sequence[str]) -> DataFrame:
    """Per entity the newest non-NULL value of every column, one row each."""
    return df.groupBy(entity).agg(
        *[
            F.max_by(c, F.when(F.col(c).isNotNull(), F.col(order))).alias(c)
            for c in columns
        ]
    )


def fill_last_known(
    df: DataFrame, entity: str, order: str, columns: Sequence[str]
) -> DataFrame:
    """Replace NULLs by the newest value known for the entity.

    The known values are written first: a join with a table is split where an entity has very
    many rows, one with an aggregate is not.
    """
    renamed = materialize(
        last_known(df, entity, order, columns).select(entity, *[F.col(c).alias(f"_known_{c}") for c in columns])
    )
    joined = lookup_join(df, renamed, [entity])
    return joined.select(
        *[
            F.coalesce(c, f"_known_{c}").alias(c) if c in columns else F.col(c)
            for c in df.columns
        ]
    )


def fan_out(df: DataFrame, rules: Sequence[tuple[Column, Mapping[str, Column]]]) -> DataFrame:
    """One output row per matching rule, all rules in one pass over the input.

    Each rule is a condition and the columns it emits; every rule must emit the
    same names and types.
    """
    if not rules:
        raise ValueError("no rules")
    made = F.array(
        *[
            F.when(condition, F.struct(*[c.alias(name) for name, c in columns.items()]))
            for condition, columns in rules
        ]
    )
    wanted = reduce(or_, [condition for condition, _ in rules])
    return (
        df.filter(wanted)
        .select(F.explode(made).alias("_row"))
        .filter(F.col("_row").isNotNull())
        .select("_row.*")
    )


def melt(df: DataFrame, ids: Sequence[str], columns: Mapping[str, int]) -> DataFrame:
    """Wide to long over measure columns, naming each by its indicator id."""
    values = df.select(*ids, *[F.col(c).cast("decimal(38,18)").alias(c) for c in columns])
    long = values.unpivot(list(ids), list(columns), "_column", "indicator_value_numeric")
    number = F.create_map(*[F.lit(x) for pair in columns.items() for x in pair])
    return long.withColumn("indicator_id", number[F.col("_column")]).drop("_column")


def unpivot_text(
    df: DataFrame,
    keep: Sequence[str],
    drop: Sequence[str] = (),
    name: str = "indicator",
    value: str = "indicator_value",
) -> DataFrame:
    """Every column but ``keep`` and ``drop`` becomes a (name, text value) row."""
    measures = [c for c in df.columns if c not in set(keep) | set(drop)]
    kept = [c for c in keep if c not in set(drop)]
    text = df.select(*kept, *[F.col(f"`{c}`").cast("string").alias(c) for c in measures])
    return text.unpivot(kept, measures, name, value)


def yearly_dates(first: Column, last: Column) -> Column:
    """Array of the 1 January dates within [first, last], empty where there is none."""
    floor = F.trunc(first, "year")
    start = F.when(floor == first, floor).otherwise(F.add_months(floor, 12))
    step = F.make_interval(years=F.lit(1))
    empty = F.array().cast("array<date>")
    return F.when(start <= last, F.sequence(start, last, step)).otherwise(empty)


def snapshot_grid(
    df: DataFrame, valid_from: str, valid_to: str, first: str, now: str, name: str = "snapshot_date"
) -> DataFrame:
    """One row per yearly snapshot day within a row's validity, both ends included.

    The grid runs from ``first`` to ``now``; each row makes its own dates, so
    there is no range join.
    """
    low = F.greatest(F.col(valid_from), F.lit(first).cast("date"))
    high = F.least(F.col(valid_to), F.lit(now).cast("date"))
    known = F.col(valid_from).isNotNull() & F.col(valid_to).isNotNull()
    dates = F.when(known, yearly_dates(low, high))
    return df.withColumn(name, F.explode(dates))
