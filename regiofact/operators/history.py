"""Type-2 history: snapshots by compared columns, merges and backfills."""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from regiofact.sources.versions import latest_version

VALID_FROM, VALID_TO = "valid_from", "valid_to"


def _timestamp(value: str | Column) -> Column:
    return (F.lit(value) if isinstance(value, str) else value).cast("timestamp_ntz")


def open_history(df: DataFrame, now: str | Column) -> DataFrame:
    """A first snapshot: every row is open from ``now``."""
    return df.withColumn(VALID_FROM, _timestamp(now)).withColumn(
        VALID_TO, F.lit(None).cast("timestamp_ntz")
    )


def scd2_changes(
    current: DataFrame,
    incoming: DataFrame,
    key: str,
    check_cols: Sequence[str],
    now: str,
    hard_deletes: bool = True,
) -> DataFrame:
    """What one more load makes of the open rows: each stays open or is closed, and new ones.

    A key with a changed checked column (NULL-safe) closes its open row at ``now``
    and opens a new one; a new key opens one; a key missing from the load closes
    its row, unless ``hard_deletes`` is off. Keys must be unique in the load and among
    the open rows. Applying the same load again changes nothing.
    """
    history = current
    added = [c for c in incoming.columns if c not in history.columns]
    columns = [c for c in history.columns if c not in (VALID_FROM, VALID_TO)] + added
    types = {**{f.name: f.dataType for f in incoming.schema}, **{
        f.name: f.dataType for f in history.schema
    }}

    def side(df: DataFrame) -> Column:
        return F.struct(
            *[
                (F.col(c) if c in df.columns else F.lit(None)).cast(types[c]).alias(c)
                for c in columns
            ]
        )

    before = current.select(
        F.col(key).alias("_key"), side(current).alias("_old"), F.col(VALID_FROM).alias("_since")
    )
    after = incoming.select(F.col(key).alias("_key"), side(incoming).alias("_new"))
    both = before.join(after, "_key", "full_outer")

    moment = _timestamp(now)
    never = F.lit(None).cast("timestamp_ntz")
    has_old, has_new = F.col("_old").isNotNull(), F.col("_new").isNotNull()
    compared = [c for c in check_cols if c in incoming.columns]
    differs = reduce(
        or_, [~F.col(f"_old.{c}").eqNullSafe(F.col(f"_new.{c}")) for c in compared], F.lit(False)
    )
    changed = has_old & has_new & differs
    gone = (has_old & ~has_new) if hard_deletes else F.lit(False)

    def version(row: str, since: Column, until: Column) -> Column:
        return F.struct(
            *[F.col(f"{row}.{c}").alias(c) for c in columns],
            since.alias(VALID_FROM),
            until.alias(VALID_TO),
        )

    kept = version("_old", F.col("_since"), F.when(changed | gone, moment).otherwise(never))
    opened = version("_new", moment, never)
    rows = both.select(
        F.explode(
            F.array(F.when(has_old, kept), F.when(has_new & (~has_old | changed), opened))
        ).alias("_row")
    ).filter(F.col("_row").isNotNull())
    return rows.select("_row.*")


def scd2_apply(
    history: DataFrame,
    incoming: DataFrame,
    key: str,
    check_cols: Sequence[str],
    now: str,
    hard_deletes: bool = True,
) -> DataFrame:
    """The history after one more load: closed rows as they are, open ones by ``scd2_changes``.

    For one load on a history at hand. Histories that grow load by load are kept in a
    ``HistoryTable``, whose plan does not grow with the loads.
    """
    closed = history.filter(F.col(VALID_TO).isNotNull())
    changes = scd2_changes(current_rows(history), incoming, key, check_cols, now, hard_deletes)
    return closed.unionByName(changes, allowMissingColumns=True)


#: Parts of a written version: rows it opens, marks that close earlier ones, rows folded when closed.
OPENED, MARKS, DONE = "opened", "marks", "done"


@dataclass(frozen=True)
class HistoryState:
    """The newest load of a written history, the version its files start from, and its columns."""

    number: int = 0
    base: int = 1
    columns: T.StructType | None = None


@dataclass(frozen=True)
class HistoryTable:
    """A written history whose loads write what they change only.

    A load is one version: the rows it opens, and for each row it closes a mark of its key, the
    version it was opened in, and the time. It reads the key and the compared columns of the
    open rows. Reading joins the marks to the rows. A record written last names the newest version,
    the one to start from, and the columns, so no file footer is read for its schema, and a load
    that ends early leaves the state before it. ``fold`` writes the history as one version.
    One writer at a time.
    """

    spark: SparkSession
    path: str
    key: str
    check_cols: tuple[str, ...]

    def load(self, incoming: DataFrame, now: str, hard_deletes: bool = True) -> None:
        """Apply one load as a new version."""
        last = self.state()
        if last.columns is None:
            rows, columns = incoming.withColumn("_closes", F.lit(None).cast("int")), incoming.schema
        else:
            known = set(last.columns.names)
            columns = T.StructType([*last.columns, *(f for f in incoming.schema if f.name not in known)])
            rows = self._changes(last, incoming, columns, hard_deletes)
        moment, never = _timestamp(now), F.lit(None).cast("timestamp_ntz")
        opens = F.col("_closes").isNull()
        stamped = rows.select(
            *[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in columns],
            F.when(opens, moment).alias(VALID_FROM), F.when(opens, never).otherwise(moment).alias(VALID_TO),
            "_closes", F.when(opens, OPENED).otherwise(MARKS).alias("_part"),
        )
        self._write(stamped, HistoryState(last.number + 1, last.base, columns))

    def read(self, version: int | None = None) -> DataFrame:
        """The history as of a version, the newest by default."""
        state = self.state(version)
        rows = self._files(state)
        names = [*state.columns.names, VALID_FROM, VALID_TO]
        opened = rows.filter(F.col("_part") == OPENED).join(self._marks(rows), self._same(), "left")
        until = F.coalesce("_until", VALID_TO).alias(VALID_TO)
        done = rows.filter(F.col("_part") == DONE)
        return opened.select(*names[:-1], until).unionAll(done.select(*names))

    def current(self, version: int | None = None) -> DataFrame:
        """The rows still open, without reading those that have been closed and folded."""
        state = self.state(version)
        return self._open(state).select(*state.columns.names, VALID_FROM, VALID_TO)

    def fold(self) -> None:
        """Write the history as one version, from which reading starts. Nothing is removed."""
        last = self.state()
        part = F.when(F.col(VALID_TO).isNull(), OPENED).otherwise(DONE)
        rows = self.read().withColumns({"_closes": F.lit(None).cast("int"), "_part": part})
        self._write(rows, HistoryState(last.number + 1, last.number + 1, last.columns))

    def state(self, version: int | None = None) -> HistoryState:
        """What the record of a version says, the newest by default."""
        last = latest_version(self.spark, f"{self.path}/loads") if version is None else version
        if not last:
            return HistoryState()
        row = self.spark.read.parquet(f"{self.path}/loads/version={last}").first()
        return HistoryState(last, row.base, T.StructType.fromJson(json.loads(row.columns)))

    def written(self) -> DataFrame:
        """How many rows and marks every version has written: version, part, n."""
        counted = self._files(self.state(), 1).groupBy(F.col("_version").alias("version"), F.col("_part").alias("part"))
        return counted.agg(F.count(F.lit(1)).alias("n"))

    def _changes(self, last: HistoryState, incoming: DataFrame, columns: T.StructType, hard_deletes: bool) -> DataFrame:
        """The load's columns and _closes: rows to open have none, marks the version they close."""
        compared = [c for c in self.check_cols if c in incoming.columns and c in last.columns.names]
        added = [c for c in self.check_cols if c in incoming.columns and c not in last.columns.names]
        before = self._open(last).select(
            F.col(self.key).alias("_key"), F.struct(F.col("_version"), *compared).alias("_old")
        )
        kinds = {f.name: f.dataType for f in columns}
        sides = [(F.col(f"`{n}`") if n in incoming.columns else F.lit(None)).cast(k).alias(n) for n, k in kinds.items()]
        after = incoming.select(F.col(self.key).cast(kinds[self.key]).alias("_key"), F.struct(*sides).alias("_new"))
        both = before.join(after, "_key", "full_outer")
        has_old, has_new = F.col("_old").isNotNull(), F.col("_new").isNotNull()
        differs = [~F.col(f"_old.{c}").eqNullSafe(F.col(f"_new.{c}")) for c in compared]
        differs += [F.col(f"_new.{c}").isNotNull() for c in added]
        changed = has_old & has_new & reduce(or_, differs, F.lit(False))
        gone = (has_old & ~has_new) if hard_deletes else F.lit(False)
        only_key = [(F.col("_key") if n == self.key else F.lit(None)).cast(k).alias(n) for n, k in kinds.items()]
        opened = F.struct(*[F.col(f"_new.`{n}`").alias(n) for n in kinds], F.lit(None).cast("int").alias("_closes"))
        closed = F.struct(*only_key, F.col("_old._version").alias("_closes"))
        rows = F.array(F.when(changed | gone, closed), F.when(has_new & (~has_old | changed), opened))
        return both.select(F.explode(rows).alias("r")).filter("r is not null").select("r.*")

    def _files(self, state: HistoryState, base: int | None = None) -> DataFrame:
        kinds = [*state.columns, *self._stamps()]
        folders = [f"{self.path}/rows/_version={v}" for v in range(base or state.base, state.number + 1)]
        reader = self.spark.read.schema(T.StructType(kinds).add("_version", T.IntegerType()).add("_part", T.StringType()))
        return reader.option("basePath", f"{self.path}/rows").parquet(*folders)

    @staticmethod
    def _stamps() -> T.StructType:
        return T.StructType().add(VALID_FROM, T.TimestampNTZType()).add(VALID_TO, T.TimestampNTZType()).add("_closes", T.IntegerType())

    def _marks(self, rows: DataFrame) -> DataFrame:
        marks = rows.filter(F.col("_part") == MARKS)
        return marks.select(F.col(self.key).alias("_marked"), F.col("_closes").alias("_of"), F.col(VALID_TO).alias("_until"))

    def _same(self) -> Column:
        return F.col(self.key).eqNullSafe(F.col("_marked")) & (F.col("_version") == F.col("_of"))

    def _open(self, state: HistoryState) -> DataFrame:
        rows = self._files(state)
        return rows.filter(F.col("_part") == OPENED).join(self._marks(rows), self._same(), "left_anti")

    def _write(self, rows: DataFrame, state: HistoryState) -> None:
        rows.write.mode("overwrite").partitionBy("_part").parquet(f"{self.path}/rows/_version={state.number}")
        record = [(state.base, json.dumps(state.columns.jsonValue()))]
        record = self.spark.createDataFrame(record, "base int, columns string").coalesce(1)
        record.write.mode("overwrite").parquet(f"{self.path}/loads/version={state.number}")


def current_rows(history: DataFrame) -> DataFrame:
    """The rows still open."""
    return history.filter(F.col(VALID_TO).isNull())


def close_at_start_of(first: DataFrame, second: DataFrame) -> DataFrame:
    """End the open rows of one history where the other begins."""
    begin = second.agg(F.min(VALID_FROM).alias("begin")).scalar()
    return first.withColumn(VALID_TO, F.coalesce(VALID_TO, begin))


def backfill_window(df: DataFrame, since: str) -> DataFrame:
    """A source without history: known since a fixed day, still open."""
    return df.withColumn("knowledge_date_from", _timestamp(since)).withColumn(
        "knowledge_date_to", F.lit(None).cast("timestamp_ntz")
    )
