"""Tables kept as numbered versions: a new one is written beside the old, then read."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession
from pyspark.sql import functions as F


def latest_version(spark: SparkSession, path: str) -> int | None:
    """The newest version below a path, from the folder names alone; None before the first."""
    try:
        versions = spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise
    return versions.agg(F.max("version")).first()[0]
