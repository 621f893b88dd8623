"""Registry of this subpackage's queries and small helpers of its operators."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regiofact.session import new_path

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function name, with its SQL if there is one."""

    def add(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer(name: str) -> str:
    """Place of a public tokenizer file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def picked(df: DataFrame, **columns: str) -> DataFrame:
    """Only the named columns, under fixed names and without their other columns.

    ``picked(df, doc_id="long", text="string")`` keeps two columns, cast; extra columns of
    the input, whatever their names, go no further.
    """
    return df.select(*[F.col(f"`{n}`").cast(kind).alias(n) for n, kind in columns.items()])


#: Lists that the paths of written steps are added to.
_SCOPES: list[list[str]] = []


@contextmanager
def recorded(paths: list[str]) -> Iterator[None]:
    """Add to ``paths`` what is written inside."""
    _SCOPES.append(paths)
    try:
        yield
    finally:
        _SCOPES.remove(paths)


def released(paths: list[str], reader: DataFrame) -> list[str]:
    """Delete written steps that ``reader`` does not read; those that it reads are returned."""
    files = reader.inputFiles()
    kept = [p for p in paths if any(p.rsplit("/", 1)[1] in f for f in files)]
    spark = reader.sparkSession
    for path in set(paths).difference(kept):
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
    return kept


#: Lets Spark delete a query's shuffle files when the query has ended.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write once into the shared folder as Parquet and read back, which cuts the lineage.

    The shuffle files of the written query are not needed again and go at once.
    """
    spark, path = df.sparkSession, new_path(df.sparkSession, name)
    for scope in _SCOPES:
        scope.append(path)
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def texts_of(batches: Iterable[pa.RecordBatch], budget: int = 8 << 20) -> Iterator[tuple[list, list[str]]]:
    """(ids, texts) of columns 0 and 1 in groups of about ``budget`` characters; null is empty."""
    ids, texts, size = [], [], 0
    for batch in batches:
        for i, t in zip(batch.column(0), batch.column(1), strict=True):
            ids.append(i.as_py())
            texts.append(t.as_py() or "")
            size += len(texts[-1])
            if size >= budget:
                yield ids, texts
                ids, texts, size = [], [], 0
    if ids:
        yield ids, texts
