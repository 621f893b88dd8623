"""Lookup joins, and the lookups built on them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regiofact.session import materialize


def lookup_join(
    rows: DataFrame, lookup: DataFrame, on: Sequence[str], how: str = "left"
) -> DataFrame:
    """Equi-join a large row set with a table that is unique, or nearly so, on its key.

    The planner broadcasts the lookup if its measured bytes allow it; otherwise both sides
    are shuffled and adaptive execution splits the partitions of hot keys. ``how`` is
    ``inner``, ``left``, ``left_semi`` or ``left_anti``.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"unsupported join: {how}")
    return rows.join(lookup, list(on), how)


def lookup_column(
    rows: DataFrame,
    lookup: DataFrame,
    key: str,
    lookup_key: str,
    values: dict[str, str],
    how: str = "left",
) -> DataFrame:
    """Add ``values`` (lookup column -> new name) found by ``rows.key = lookup.lookup_key``."""
    side = lookup.select(
        F.col(lookup_key).alias(key), *[F.col(c).alias(name) for c, name in values.items()]
    )
    return lookup_join(rows, side, [key], how)


def map_code(
    df: DataFrame, column: str, mapping: dict[str, int], target: str = "indicator_id"
) -> DataFrame:
    """Code -> id; rows with a code outside the mapping are dropped."""
    codes = F.create_map(*[F.lit(x) for pair in mapping.items() for x in pair])
    return df.filter(F.col(column).isin(*mapping)).withColumn(target, codes[F.col(column)])


def join_population(facts: DataFrame, population: DataFrame) -> DataFrame:
    """Add ``population`` of the same area and calendar year, NULL where unknown.

    ``population`` holds (geo_code, geo_value, period_ref, indicator_value_numeric).
    """
    side = population.select(
        "geo_code",
        "geo_value",
        F.year("period_ref").alias("_year"),
        F.col("indicator_value_numeric").alias("population"),
    )
    rows = facts.withColumn("_year", F.year("period_ref"))
    joined = lookup_join(rows, side, ["geo_code", "geo_value", "_year"])
    return joined.select(*facts.columns, "population")


def resolve_by_name(
    df: DataFrame,
    places: DataFrame,
    *,
    name: str = "gemeinde_name",
    number: str = "gemeinde_bfs_id",
) -> DataFrame:
    """Fill a missing municipality number by its name; of equal names the highest wins.

    The numbers by name are written first, so that the join is split where a name is hot.
    """
    by_name = materialize(places.groupBy(F.col(name).alias("_name")).agg(F.max(number).alias("_number")))
    searched = (F.col("geo_code") == "polg") & F.col("geo_value").isNull()
    keyed = df.withColumn("_name", F.when(searched, F.col("geo_value_name")))
    found = lookup_join(keyed, by_name, ["_name"])
    return found.withColumn("geo_value", F.coalesce("geo_value", "_number")).select(*df.columns)


def expand_ancestors(maps: DataFrame, edges: DataFrame) -> DataFrame:
    """Walk from each map up the structure, adding ``mother_{i}_id`` and ``_name``.

    ``maps`` has a ``structure_id``; ``edges`` has (child_id, child_name,
    structure_id), the last being the parent. The walk goes over the distinct structures
    until no parent is left, and the maps join its result once. A child with several
    parents gives one row per path. A structure that is its own ancestor raises.
    """
    parents = materialize(edges.distinct())
    children = parents.select(F.col("child_id").alias("_at")).distinct()
    most = children.count()  # a path without a circle is no longer
    paths = maps.select("structure_id").distinct().withColumn("_at", F.col("structure_id"))
    open_paths = paths.join(children, "_at", "left_semi")
    level = 0
    while not open_paths.isEmpty():
        if level >= most:
            raise ValueError("a structure is its own ancestor")
        step = parents.select(
            F.col("child_id").alias("_at"),
            F.col("child_id").alias(f"mother_{level}_id"),
            F.col("child_name").alias(f"mother_{level}_name"),
            F.col("structure_id").alias("_parent"),
        )
        paths = lookup_join(paths, step, ["_at"]).drop("_at").withColumnRenamed("_parent", "_at")
        paths = materialize(paths)
        open_paths = paths.join(children, "_at", "left_semi")
        level += 1
    return lookup_join(maps, paths.drop("_at"), ["structure_id"]).drop("structure_id")
