"""Which resources to load next."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regiofact.operators.joins import lookup_join


def modified_resources(resources: DataFrame, state: DataFrame) -> DataFrame:
    """Resources modified after their last load; never loaded ones always qualify.

    ``resources`` has (resource_id, last_modified), ``state`` (resource_id,
    last_execution).
    """
    joined = lookup_join(resources, state.select("resource_id", "last_execution"), ["resource_id"])
    since = F.coalesce("last_execution", F.lit("1970-01-01").cast("timestamp_ntz"))
    return joined.filter(F.col("last_modified") > since)


def record_execution(state: DataFrame, loaded: DataFrame, now: str) -> DataFrame:
    """State after a load: the loaded resources carry the new time."""
    done = loaded.select("resource_id", F.lit(now).cast("timestamp_ntz").alias("last_execution"))
    kept = state.join(done, "resource_id", "left_anti")
    return kept.unionByName(done)


def oldest_unloaded(
    listed: DataFrame, stored: DataFrame, date_regex: str, identifier: str = "identifier"
) -> DataFrame:
    """The oldest listed resource that is not stored; its date is in the identifier.

    The first group of the pattern is the date. Equal dates fall back to the
    identifier. The result has one row, or none.
    """
    missing = listed.join(stored.select(identifier).distinct(), identifier, "left_anti")
    dated = missing.withColumn(
        "resource_date",
        F.nullif(F.regexp_extract(identifier, date_regex, 1), F.lit("")).cast("date"),
    ).filter(F.col("resource_date").isNotNull())
    return dated.orderBy("resource_date", identifier).limit(1)
