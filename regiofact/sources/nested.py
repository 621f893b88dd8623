"""Nested sources flattened to long rows: cubes, distributions, catalogues, feeds."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regiofact.functions.text import is_year, matches_at_start
from regiofact.schemas import GEO_LEVELS

# Fixed values of the atlas interface.
MISSING_VALUE = -9999
UNGROUPED = "total"

# ``values`` is kept as raw JSON text: it is a list in some responses, a map in others.
RESPONSE = (
    "content struct<distribution: struct<values: string>, nivgeo: string,"
    " indic: struct<c_id_indicateur: string, c_lib_indicateur: string,"
    " c_desc_indicateur: string, c_source: string, c_id_view: string>>"
)


def explode_cube(
    cubes: DataFrame,
    names: Sequence[str],
    dims: str = "dims",
    values: str = "values",
    value_name: str = "indicator_value",
    offset: str | None = None,
) -> DataFrame:
    """Dense cubes to one row per cell.

    A large cube may come in several rows, each with a part of the values: ``offset`` names
    the column that holds the position of the first of them.

    A cube row has ``dims``, the member texts of each dimension, and ``values``, one
    per cell with the last dimension running fastest. A position is split into its
    member numbers by division, so no member lists are multiplied out.
    """
    others = [c for c in cubes.columns if c not in (dims, values, offset)]
    first = F.lit(0) if offset is None else F.col(offset)
    cells = cubes.select(
        *others, dims, first.cast("bigint").alias("_first"), F.posexplode(values).alias("_pos", value_name)
    )
    place = F.col("_first") + F.col("_pos")
    out: list[Column] = []
    for i in reversed(range(len(names))):
        members = F.get(F.col(dims), F.lit(i))
        size = F.size(members)
        out.insert(0, F.get(members, (place % size).cast("int")).alias(names[i]))
        place = F.floor(place / size).cast("bigint")
    return cells.select(*others, *out, value_name)


def unnest_distribution(responses: DataFrame) -> DataFrame:
    """Atlas responses to one row per area, group and period.

    Input: ``response`` (JSON text), ``codgeo`` and ``libgeo`` (parallel arrays of the
    areas), ``period_ref``. Values are a list, or a map of lists by group. Lists that
    do not match the areas in length are skipped.
    """
    parsed = responses.select(
        "codgeo", "libgeo", "period_ref", F.from_json("response", RESPONSE)["content"].alias("c")
    )
    raw = F.ltrim("c.distribution.values")
    groups = F.when(
        raw.startswith("["), F.create_map(F.lit(UNGROUPED), F.from_json(raw, "array<double>"))
    ).when(raw.startswith("{"), F.from_json(raw, "map<string, array<double>>"))
    base = parsed.select(
        "codgeo",
        "libgeo",
        F.col("c.indic.c_id_indicateur").alias("bfs_indicateur_id"),
        F.col("c.indic.c_lib_indicateur").alias("indicator_name"),
        F.col("c.indic.c_desc_indicateur").alias("indicator_unit"),
        F.col("c.indic.c_source").alias("source"),
        F.col("c.indic.c_id_view").alias("map_id"),
        F.col("c.nivgeo").alias("bfs_nivgeo"),
        "period_ref",
        F.explode(groups).alias("group_name", "_values"),
    )
    size = F.size("_values")
    same = (size == F.size("codgeo")) & (size == F.size("libgeo"))
    cells = base.filter(same).select(
        "*",
        F.explode(
            F.arrays_zip(
                F.col("codgeo").alias("geo_value"),
                F.col("libgeo").alias("geo_name"),
                F.col("_values").alias("indicator_value"),
            )
        ).alias("_cell"),
    )
    return cells.select(
        "_cell.geo_value",
        "_cell.geo_name",
        F.nullif(F.col("_cell.indicator_value"), F.lit(float(MISSING_VALUE))).alias(
            "indicator_value"
        ),
        "group_name",
        "bfs_indicateur_id",
        "indicator_name",
        "indicator_unit",
        "source",
        "map_id",
        "bfs_nivgeo",
        "period_ref",
    ).distinct()


def add_lineage(df: DataFrame, source_name: str, loaded_at: str) -> DataFrame:
    return df.withColumn("_source_name", F.lit(source_name)).withColumn(
        "_source_time", F.lit(loaded_at)
    )


def expand_catalogue(catalogue: DataFrame) -> DataFrame:
    """Indicators with a supported level, one row per view and single year."""
    level = F.exists("nivgeos", lambda x: reduce(or_, [x.startswith(p) for p in GEO_LEVELS]))
    return (
        catalogue.filter(level)
        .select("*", F.explode("c_id_view").alias("view"))
        .select("*", F.explode("mods").alias("year"))
        .filter(is_year(F.col("year")))
        .select("c_id_indicateur", "c_id_dataset", "view", "year")
    )


def select_assets(
    features: DataFrame,
    id_regex: str | None = None,
    key_regex: str | None = None,
    asset_type: str | None = None,
) -> DataFrame:
    """Assets of a feature list by feature id, asset key (both anchored) and type.

    Input: ``id``, ``datetime`` and ``assets``, a map from key to
    struct(type, href, epsg, created, updated).
    """
    if id_regex:
        features = features.filter(matches_at_start(F.col("id"), id_regex))
    out = features.select(
        "id",
        F.col("datetime").alias("feature_datetime"),
        F.explode("assets").alias("asset_key", "_asset"),
    )
    if key_regex:
        out = out.filter(matches_at_start(F.col("asset_key"), key_regex))
    if asset_type:
        out = out.filter(F.col("_asset.type") == asset_type)
    return out.select(
        "id",
        "feature_datetime",
        "asset_key",
        F.col("_asset.type").alias("asset_type"),
        F.col("_asset.href").alias("asset_href"),
        F.coalesce("_asset.epsg", F.lit(2056)).alias("asset_epsg"),
        F.col("_asset.created").alias("asset_created"),
        F.col("_asset.updated").alias("asset_updated"),
    )


def filter_feed(feeds: DataFrame, imported_at: float) -> DataFrame:
    """Drop the entities of a live feed that have no stop times; stamp the import."""
    kept = F.filter("entity", lambda e: e["trip_update"]["stop_time_update"].isNotNull())
    header = F.col("header").withField("_import_timestamp", F.lit(imported_at))
    return feeds.withColumn("entity", kept).withColumn("header", header)
