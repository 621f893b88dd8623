"""Data-quality checks. Each returns the violations, so an empty result is a pass."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def check_columns(df: DataFrame, expected: Sequence[str]) -> DataFrame:
    """Positions where the ordered column list differs, compared in upper case."""
    spark = df.sparkSession

    def listed(names: Sequence[str], label: str) -> DataFrame:
        rows = [(i, n.upper()) for i, n in enumerate(names, start=1)]
        return spark.createDataFrame(rows, f"position int, {label} string")

    pairs = listed(expected, "expected").join(
        listed(df.columns, "actual"), "position", "full_outer"
    )
    return pairs.filter(~F.col("expected").eqNullSafe(F.col("actual")))


def check_unique(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their count."""
    return (
        df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n_records")).filter("n_records > 1")
    )


def check_min_rows(
    df: DataFrame, minimum: int, by: Sequence[str], condition: Column | None = None
) -> DataFrame:
    """Groups with fewer than ``minimum`` rows under a condition."""
    rows = df if condition is None else df.filter(condition)
    counted = rows.groupBy(*by).agg(F.count(F.lit(1)).alias("n_records"))
    return counted.filter(F.col("n_records") < minimum)


def check_row_count(df: DataFrame, low: int, high: int | None = None) -> DataFrame:
    """One row with the count where it lies outside [low, high]."""
    n = F.col("n_records")
    outside = n < low if high is None else (n < low) | (n > high)
    return df.agg(F.count(F.lit(1)).alias("n_records")).filter(outside)


def check_between(df: DataFrame, column: str, low: float, high: float) -> DataFrame:
    """One row with the number of values outside [low, high], if any."""
    c = F.col(column)
    return df.agg(F.count_if((c < low) | (c > high)).alias("n_outside")).filter("n_outside > 0")


def check_figures(
    df: DataFrame,
    rows: tuple[int, int | None] | None = None,
    between: Mapping[str, tuple[float, float]] = {},
    not_null: Sequence[str] = (),
) -> DataFrame:
    """(rule, column, n_records) of broken row counts, ranges and nulls, in one pass.

    For the row count, n_records is the count; for the others, the rows that break the rule.
    """
    low, high = rows or (0, None)
    n = F.count(F.lit(1))
    inside = (n >= low) if high is None else (n >= low) & (n <= high)
    figures = {("rows", ""): (n, ~inside)} if rows is not None else {}
    for c, (least, most) in between.items():
        out = F.count_if((F.col(c) < least) | (F.col(c) > most))
        figures["between", c] = (out, out > 0)
    for c in not_null:
        nulls = F.count_if(F.col(c).isNull())
        figures["not_null", c] = (nulls, nulls > 0)
    found = [
        F.struct(F.lit(rule).alias("rule"), F.lit(c).alias("column"), value.alias("n_records"), broken.alias("broken"))
        for (rule, c), (value, broken) in figures.items()
    ]
    one = df.agg(F.array(*found).alias("f")).select(F.explode("f").alias("f")).select("f.*")
    return one.filter("broken").drop("broken")


def check_contract(
    df: DataFrame, not_null: Sequence[str], unique: Sequence[str], types: Mapping[str, str] = {}
) -> DataFrame:
    """(rule, column, n_records) for every broken rule of a table contract."""
    spark = df.sparkSession
    schema = {f.name: f.dataType.simpleString() for f in df.schema}
    wrong = [("type", c, 1) for c, kind in types.items() if schema.get(c) != kind]
    out = [spark.createDataFrame(wrong, "rule string, column string, n_records bigint")]
    if not_null:
        nulls = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in not_null])
        out.append(
            nulls.unpivot([], list(not_null), "column", "n_records").select(
                F.lit("not_null").alias("rule"), "column", "n_records"
            )
        )
    for c in unique:
        repeated = check_unique(df.filter(F.col(c).isNotNull()), [c])
        out.append(
            repeated.agg(F.count(F.lit(1)).alias("n_records")).select(
                F.lit("unique").alias("rule"), F.lit(c).alias("column"), "n_records"
            )
        )
    return reduce(DataFrame.unionByName, out).filter("n_records > 0")


def match_ratios(df: DataFrame, column: str, patterns: Mapping[str, str]) -> DataFrame:
    """Share of rows that match each pattern, in one pass."""
    return df.agg(
        *[
            F.avg(F.coalesce(F.col(column).rlike(p), F.lit(False)).cast("int")).alias(name)
            for name, p in patterns.items()
        ]
    )


def unmatched_samples(
    df: DataFrame, column: str, patterns: Mapping[str, str], n: int = 20
) -> dict[str, list[tuple[str, int]]]:
    """The most frequent values no pattern explains, for the error message."""
    out = {}
    for name, pattern in patterns.items():
        counted = df.filter(~F.col(column).rlike(pattern)).groupBy(column).count()
        rows = counted.orderBy(F.desc("count"), F.asc(column)).limit(n).collect()
        out[name] = [(r[0], r[1]) for r in rows]
    return out


def detect_format(
    df: DataFrame, column: str, patterns: Mapping[str, str], threshold: float = 0.8
) -> str:
    """The first format that explains more than ``threshold`` of the rows, else raise."""
    ratios = match_ratios(df, column, patterns).first().asDict()
    for name in patterns:
        if (ratios[name] or 0.0) > threshold:
            return name
    samples = unmatched_samples(df, column, patterns)
    detail = "; ".join(f"{name}: {found}" for name, found in samples.items())
    raise ValueError(f"no format explains column {column}: {ratios}; unmatched {detail}")


def qa_counts(df: DataFrame, by: Sequence[str], entity: str) -> DataFrame:
    """Rows and distinct entities per group."""
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_distinct(entity).alias("n_entities")
    )


