"""Incremental pickup of new files as a stream that stops when it has caught up."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def load_new_files(
    spark: SparkSession,
    source: str,
    schema: str,
    target: str,
    checkpoint: str,
    fmt: str = "parquet",
    transform: Callable[[DataFrame], DataFrame] = lambda df: df,
    options: dict[str, str] | None = None,
) -> None:
    """Append the files not seen before to a Parquet table, each exactly once.

    What has been loaded is kept in the stream checkpoint, which must be in a shared
    folder, like the target. A lost run resumes where it stood.
    """
    stream = spark.readStream.format(fmt).schema(schema).options(**(options or {})).load(source)
    query = (
        transform(stream)
        .writeStream.format("parquet")
        .option("path", target)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
