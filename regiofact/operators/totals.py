"""Group totals and the aggregations around them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regiofact.config import GroupSpec
from regiofact.schemas import GROUP_TOTAL, GROUPS
from regiofact.session import spread


def map_total(c: Column, total_value: str | Column) -> Column:
    """The source's own total label becomes the reserved one."""
    return F.when(c == total_value, GROUP_TOTAL).otherwise(c.cast("string"))


def group_columns(
    grouping: Sequence[GroupSpec], build_total: str | None
) -> dict[str, Column]:
    """Names and values of the four groups.

    A group whose source has no total row, and for which none is built, is left
    out: its name and value are NULL.
    """
    out: dict[str, Column] = {}
    for n in GROUPS:
        spec = grouping[n - 1] if n <= len(grouping) else None
        name = value = F.lit(None).cast("string")
        if spec is not None and spec.total_value:
            name, value = F.lit(spec.name), map_total(F.col(spec.column), spec.total_value)
        elif spec is not None and build_total:
            name, value = F.lit(spec.name), F.col(spec.column).cast("string")
        out[f"group_{n}_name"] = name
        out[f"group_{n}_value"] = value
    return out


def check_aggregate(df: DataFrame, expression: str) -> None:
    """Reject a configured total that does not aggregate."""
    try:
        df.agg(F.expr(expression))
    except AnalysisException as e:
        raise ValueError(f"not an aggregate over the indicator rows: {expression}") from e


def build_totals(df: DataFrame, n_groups: int, aggregate: str, rows: int | None = None) -> DataFrame:
    """Rows plus totals over the last group, the last two, ... and all groups.

    Only prefixes are kept (ROLLUP): a total over group 1 alone is not built. A
    group that is really NULL in the source stays NULL; only totals get the
    reserved label.

    The keys beside the groups go through unchanged, so rows that lie together by some of them are
    not shuffled again. With ``rows``, about how many there are, they are gathered by the keys in
    as many tasks as that asks for.
    """
    check_aggregate(df, aggregate)
    names = df.columns
    levels = [f"group_{n}_value" for n in range(1, n_groups + 1)]
    measured = {"indicator_value_numeric", "indicator_value_text"}
    keys = [c for c in df.columns if c not in measured and c not in levels]
    by = keys
    if rows is not None and keys:
        # keys may be constants, which a grouping leaves out and could not be recognised by
        by = ["_hash", *keys]
        df = spread(df.withColumn("_hash", F.xxhash64(*keys)), rows, "_hash")
    # how many groups are kept; a total has NULL in the others
    sets = [
        F.struct(
            F.lit(kept).alias("kept"),
            *[F.when(F.lit(i < kept), F.col(c)).alias(c) for i, c in enumerate(levels)],
        )
        for kept in range(n_groups, -1, -1)
    ]
    out = (
        df.withColumn("_set", F.explode(F.array(*sets)))
        .groupBy(*by, F.col("_set"))
        .agg(F.expr(aggregate).alias("indicator_value_numeric"))
    )
    labelled = {
        c: F.when(F.col("_set.kept") <= i, GROUP_TOTAL).otherwise(F.col(f"_set.{c}")) for i, c in enumerate(levels)
    }
    return out.select(
        *[
            F.lit(None).cast("string").alias(c)
            if c == "indicator_value_text"
            else labelled.get(c, F.col(c)).alias(c)
            for c in names
        ]
    )
