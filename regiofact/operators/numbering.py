"""Numbering and paging of sorted rows without a single-task sort."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from regiofact.session import materialize


def content_hash(df: DataFrame) -> Column:
    """A number that tells different rows apart, whatever partition they are in."""
    hashable = [f.name for f in df.schema if not isinstance(f.dataType, (T.MapType, T.VariantType))]
    return F.xxhash64(*[F.col(f"`{n}`") for n in hashable])


def number_rows(df: DataFrame, order: Sequence[Column], name: str) -> DataFrame:
    """Add the 1-based position of every row in the given order.

    Rows are range-partitioned and sorted once and written to the shared folder;
    a position is the size of the earlier partitions plus the place inside the
    own one. Only one count per partition is gathered. Rows equal in the order follow
    a hash of their content, so positions do not depend on the input's partitions; full
    copies are told apart by their place in it, so a large group of them is split as well.
    """
    tie = df.withColumns({"_hash": content_hash(df), "_tie": F.monotonically_increasing_id()})
    total = [*order, F.col("_hash"), F.col("_tie")]
    ranged = tie.repartitionByRange(*total).sortWithinPartitions(*total)
    placed = materialize(
        ranged.withColumn("_part", F.spark_partition_id())
        .withColumn(
            "_place", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
        )
        .drop("_hash", "_tie")
    )
    sizes = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_size"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "_part", F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_offset")
    )
    # one row per partition of the sort, so its size is bounded by the job's own layout
    return placed.join(F.broadcast(offsets), "_part").select(
        *df.columns, (F.col("_offset") + F.col("_place") + 1).alias(name)
    )


def page(
    df: DataFrame, order: Sequence[Column], skip: int | None = None, limit: int | None = None
) -> DataFrame:
    """Rows ``skip + 1 .. skip + limit`` of the given order, ties by content.

    Without either, the rows come back as they are. With a limit nothing is run while planning,
    and each task keeps no more than ``skip + limit`` rows; deep pages are better read one after
    the other by ``page_after``. Without a limit rows are numbered, so that no task sorts them all.
    """
    skip, limit = skip or 0, limit or None
    if not skip and limit is None:
        return df
    if limit is None:
        return number_rows(df, order, "_row").filter(F.col("_row") > skip).orderBy("_row").drop("_row")
    # rows that are equal in content may stand for each other
    hashed = df.withColumn("_hash", content_hash(df))
    return hashed.orderBy(*order, "_hash").offset(skip).limit(limit).drop("_hash")


@dataclass(frozen=True)
class SortKey:
    """A column of an order; NULLs come first in ascending and last in descending order."""

    name: str
    ascending: bool = True

    @property
    def column(self) -> Column:
        return F.col(self.name).asc_nulls_first() if self.ascending else F.col(self.name).desc_nulls_last()

    def is_past(self, value: Any) -> Column:
        """The column lies behind a value in this order."""
        c = F.col(self.name)
        if self.ascending:
            return c.isNotNull() if value is None else c > F.lit(value)
        return F.lit(False) if value is None else c.isNull() | (c < F.lit(value))

    def is_not_before(self, value: Any) -> Column:
        """The column lies at a value or behind it, in a form that scans take."""
        c = F.col(self.name)
        if self.ascending:
            return F.lit(True) if value is None else c >= F.lit(value)
        return c.isNull() if value is None else c.isNull() | (c <= F.lit(value))


@dataclass(frozen=True)
class Place:
    """Where a page ended: the last row's values of the order, its hash, and its copies given so far."""

    values: tuple
    digest: int
    copies: int


def page_after(df: DataFrame, order: Sequence[SortKey], limit: int, after: Place | None = None) -> DataFrame:
    """The next ``limit`` rows of the order behind a place, ties by content; the first ones without.

    The place is a filter on the order's columns, whose first one reaches the scan, so a page costs
    the same wherever it is. Pages neither overlap nor leave rows out, copies of a row included.
    """
    hashed = df.withColumn("_hash", content_hash(df))
    by = [*[k.column for k in order], F.col("_hash")]
    if after is None:
        return hashed.orderBy(*by).limit(limit).drop("_hash")
    behind = F.col("_hash") >= after.digest
    for key, value in reversed(list(zip(order, after.values, strict=True))):
        behind = key.is_past(value) | (F.col(key.name).eqNullSafe(F.lit(value)) & behind)
    rest = hashed.filter(order[0].is_not_before(after.values[0])).filter(behind)
    return rest.orderBy(*by).offset(after.copies).limit(limit).drop("_hash")


def place_of(page: DataFrame, order: Sequence[SortKey], after: Place | None = None) -> Place | None:
    """The place of a page's last row, from which the next page goes on; None for an empty page.

    ``after`` is the place the page began at. One row reaches the driver.
    """
    hashed = page.withColumn("_hash", content_hash(page))
    backwards = [F.col(k.name).desc_nulls_last() if k.ascending else F.col(k.name).asc_nulls_first() for k in order]
    names = [k.name for k in order]
    last = hashed.groupBy(*names, "_hash").count().orderBy(*backwards, F.col("_hash").desc()).first()
    if last is None:
        return None
    values, digest, copies = tuple(last[n] for n in names), last["_hash"], last["count"]
    if after is not None and (after.values, after.digest) == (values, digest):
        copies += after.copies
    return Place(values, digest, copies)
