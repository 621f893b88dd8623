"""Yearly geographic dimensions with a ``latest`` row per area."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from regiofact.functions.dates import compact_date, snapshot_code, year_start
from regiofact.functions.geometry import (
    LV95,
    WGS84,
    centre_in_wgs84,
    force_2d,
    map_vertices,
    point,
    reproject,
    to_wgs84,
)
from regiofact.operators.coverage import SHAPE, coverage_shapes, with_shapes
from regiofact.operators.joins import lookup_join
from regiofact.operators.numbering import page
from regiofact.operators.reshape import (
    distinct_on,
    fill_last_known,
    snapshot_grid,
    union_tagged,
)
from regiofact.session import materialize, save_step

Save = Callable[[DataFrame], DataFrame]
LATEST = "latest"
FIRST_SNAPSHOT = "1850-01-01"
#: Simplified borders and their tolerance in metres.
TOLERANCES = {
    "geom_border_simple_50m": 50.0,
    "geom_border_simple_100m": 100.0,
    "geom_border_simple_500m": 500.0,
}
#: The year and the geometries of a row of a dimension.
GEOMETRIES = ["geometry", "snapshot_year", "geom_border", *TOLERANCES, "geom_center"]
#: Geometry mode of a query -> dimension column; None stands for the default.
GEOMETRY_MODES = {
    None: "geom_border_simple_100m",
    "point": "geom_center",
    "border": "geom_border",
    "border_simple_50_meter": "geom_border_simple_50m",
    "border_simple_100_meter": "geom_border_simple_100m",
    "border_simple_500_meter": "geom_border_simple_500m",
}


@dataclass(frozen=True)
class Level:
    """Columns of one level: target name -> source column, by source."""

    key: str
    past: dict[str, str]
    present: dict[str, str]
    filled: tuple[str, ...] = ()
    default_mode: str = "border_simple_100_meter"

    @property
    def columns(self) -> list[str]:
        return list(self.past)


# Fixed names: columns of the historical and of the current boundary sources.
LEVELS = {
    "polg": Level(
        key="gemeinde_bfs_id",
        past={
            "gemeinde_bfs_id": "GDENR",
            "gemeinde_hist_bfs_id": "GDEHISTID",
            "gemeinde_name": "GDENAME",
            "bezirk_bfs_id": "BEZNR",
            "kanton_bfs_id": "KTNR",
        },
        present={
            "gemeinde_bfs_id": "bfs_nummer",
            "gemeinde_hist_bfs_id": "hist_nr",
            "gemeinde_name": "name",
            "bezirk_bfs_id": "bezirksnummer",
            "kanton_bfs_id": "kantonsnummer",
        },
        filled=("bezirk_bfs_id", "kanton_bfs_id"),
    ),
    "bezk": Level(
        key="bezirk_bfs_id",
        past={"bezirk_bfs_id": "BEZNR", "bezirk_name": "BEZNAME", "kanton_bfs_id": "KTNR"},
        present={
            "bezirk_bfs_id": "bezirksnummer",
            "bezirk_name": "name",
            "kanton_bfs_id": "kantonsnummer",
        },
        default_mode="border_simple_50_meter",
    ),
    "kant": Level(
        key="kanton_bfs_id",
        past={"kanton_bfs_id": "KTNR", "kanton_name": "KTKZ", "icc": "CODE_ISO"},
        present={"kanton_bfs_id": "kantonsnummer", "kanton_name": "name", "icc": "icc"},
    ),
}


def _to_centimetre(v: Column) -> Column:
    return point(F.round(v["x"], 2), F.round(v["y"], 2))


def boundary_snapshots(past: DataFrame, present: DataFrame, level: str, now: str) -> DataFrame:
    """One row per area and yearly snapshot, in LV95.

    ``past`` rows carry a validity (VALID_FROM, VALID_UNTI) and WGS84 borders,
    ``present`` rows a ``_snapshot_year``. Where both cover a year the present source
    wins. Missing parents are filled with the last known ones.
    """
    spec = LEVELS[level]
    dated = past.withColumns(
        {
            "_from": compact_date(F.col("VALID_FROM")),
            "_to": compact_date(F.col("VALID_UNTI")),
            # once, before a row is repeated for its years, and to the centimetre, so that both
            # sources draw a border that they share as one line
            "geometry": map_vertices(reproject(F.col("geometry"), WGS84, LV95), _to_centimetre),
        }
    )
    gridded = snapshot_grid(dated, "_from", "_to", FIRST_SNAPSHOT, now)
    old = gridded.select(
        "snapshot_date",
        *[F.col(src).alias(c) for c, src in spec.past.items()],
        "geometry",
    )
    new = present.select(
        year_start(F.col("_snapshot_year")).alias("snapshot_date"),
        *[F.col(src).alias(c) for c, src in spec.present.items()],
        force_2d(F.col("geometry")).alias("geometry"),
    )
    order = [F.col("src_order").desc()] + [
        F.col(c).asc_nulls_last() for c in spec.columns if c != spec.key
    ]
    one = distinct_on(union_tagged(old, new), [spec.key, "snapshot_date"], order).drop("src_order")
    if not spec.filled:
        return one
    return fill_last_known(materialize(one), spec.key, "snapshot_date", spec.filled)


def add_latest(snapshots: DataFrame, key: str) -> DataFrame:
    """Code every snapshot by its day and repeat the newest of each area as ``latest``."""
    newest = materialize(snapshots.groupBy(key).agg(F.max("snapshot_date").alias("_newest")))
    joined = lookup_join(snapshots, newest, [key])
    codes = F.array(
        snapshot_code(F.col("snapshot_date")),
        F.when(F.col("snapshot_date") == F.col("_newest"), LATEST),
    )
    coded = joined.withColumn("snapshot_code", F.explode(codes))
    return coded.filter(F.col("snapshot_code").isNotNull()).select(
        "snapshot_code", *snapshots.columns
    )


@dataclass(frozen=True)
class GeoDim:
    """A dimension as rows that name their shape, and the shapes with their geometries, each once."""

    level: str
    rows: DataFrame
    shapes: DataFrame

    def frame(self) -> DataFrame:
        """The rows with their geometries."""
        shown = with_shapes(self.rows, self.shapes, ["version"] if "version" in self.rows.columns else [])
        return shown.select("snapshot_code", "snapshot_date", *LEVELS[self.level].columns, *GEOMETRIES)


def in_wgs84(simple: DataFrame) -> DataFrame:
    """The shapes with their borders, simplified borders and centres in WGS84."""
    return simple.select(
        *[c for c in simple.columns if c not in TOLERANCES],
        to_wgs84("geometry").alias("geom_border"),
        *[to_wgs84(c).alias(c) for c in TOLERANCES],
        centre_in_wgs84("geometry").alias("geom_center"),
    )


def geo_dim(past: DataFrame, present: DataFrame, level: str, now: str, save: Save = materialize) -> GeoDim:
    """The dimension of one level with borders, simplified borders and centres in WGS84.

    A shape is made once for all snapshots that cut it at the same vertices; ``save`` writes the shapes.
    """
    spec = LEVELS[level]
    snapshots = boundary_snapshots(past, present, level, now)
    snapshots = snapshots if spec.filled else materialize(snapshots)
    coded = add_latest(snapshots, spec.key)
    rows, shapes = coverage_shapes(coded, [spec.key], "snapshot_code", "geometry", TOLERANCES, lambda simple: save(in_wgs84(simple)))
    return GeoDim(level, rows.withColumn("snapshot_year", F.year("snapshot_date")), shapes)


def build_geo_dim(past: DataFrame, present: DataFrame, level: str, now: str) -> DataFrame:
    """The same as one frame."""
    return geo_dim(past, present, level, now).frame()


def _shapes_saved(level: str, path: str, version: str) -> Save:
    """Writes the shapes of a level beside its rows, as a version that rows name: rows of other years keep theirs."""

    def save(shapes: DataFrame) -> DataFrame:
        folder = f"{path}/shapes/level={level}/version={version}"
        save_step(shapes.write, folder, shapes.sparkSession)
        return shapes.sparkSession.read.schema(shapes.schema).parquet(folder)

    return save


def store_geo_dim(past: DataFrame, present: DataFrame, level: str, now: str, path: str) -> None:
    """Build a level's dimension and write it; only the years it holds are replaced.

    Its shapes are written where they stay, and not once more.
    """
    version = uuid.uuid4().hex
    _write_rows(geo_dim(past, present, level, now, _shapes_saved(level, path, version)), version, path)


def write_geo_dim(dim: DataFrame, level: str, path: str) -> None:
    """Write a level's dimension by snapshot year; only the years it holds are replaced.

    Rows name their shapes, which are written once.
    """
    # every row's shape is whole, so it has but one part
    content = [F.to_json(F.transform(c, lambda p: F.transform(p, F.size))) for c in ("geometry", "geom_border", *TOLERANCES)]
    content += [F.col(c) for c in GEOMETRIES if c != "snapshot_year"]
    named = materialize(dim.withColumns({
        "_g": F.lit(0), "_h1": F.xxhash64(*content), "_h2": F.xxhash64(F.lit(1), *content), "_times": F.lit(1).cast("bigint"), "_bit": F.lit(1).cast("bigint"),
    }))
    shown = [c for c in GEOMETRIES if c != "snapshot_year"]
    shapes = named.groupBy(*SHAPE).agg(F.first("_bit").alias("_mask"), *[F.first(c).alias(c) for c in shown])
    version = uuid.uuid4().hex
    _write_rows(GeoDim(level, named.drop(*shown), _shapes_saved(level, path, version)(shapes)), version, path)


def _write_rows(dim: GeoDim, version: str, path: str) -> None:
    rows = dim.rows.withColumns({"level": F.lit(dim.level), "version": F.lit(version)}).hint("rebalance", "snapshot_year")
    writer = rows.sortWithinPartitions("snapshot_year", LEVELS[dim.level].key).write.mode("overwrite")
    writer = writer.option("partitionOverwriteMode", "dynamic").partitionBy("level", "snapshot_year")
    save_step(writer, path, dim.rows.sparkSession)


def read_geo_dim(spark: SparkSession, level: str, path: str, year: int | None = None) -> DataFrame:
    """A written dimension, or one snapshot year of it, which reads that year's files only."""
    rows = spark.read.parquet(f"{path}/level={level}")  # levels have columns of their own
    rows = rows if year is None else rows.filter(F.col("snapshot_year") == year)
    return GeoDim(level, rows, spark.read.parquet(f"{path}/shapes/level={level}")).frame()


def latest_only(dim: DataFrame) -> DataFrame:
    return dim.filter(F.col("snapshot_code") == LATEST)


def hierarchy(level: str, dims: dict[str, DataFrame]) -> DataFrame:
    """Area -> its parents, keyed by ``geo_value``, one row per area with a full chain.

    ``dims`` holds the latest rows of the levels needed. The chain is resolved among
    the dimensions first, so facts join once.
    """
    own = dims[level].alias("a")
    kanton = dims["kant"].select(
        F.col("kanton_bfs_id").alias("_kant"), F.col("kanton_name")
    ).alias("k")
    if level == "kant":
        return own.select(
            F.col("a.kanton_bfs_id").alias("geo_value"),
            F.col("a.kanton_name").alias("geo_name"),
        )
    parents = own.join(kanton, F.col("a.kanton_bfs_id") == F.col("k._kant"))
    if level == "bezk":
        return parents.select(
            F.col("a.bezirk_bfs_id").alias("geo_value"),
            F.col("a.bezirk_name").alias("geo_name"),
            F.col("k._kant").alias("kanton_bfs_id"),
            F.col("k.kanton_name"),
        )
    bezirk = dims["bezk"].select(
        F.col("bezirk_bfs_id").alias("_bezk"), F.col("bezirk_name")
    ).alias("b")
    return parents.join(bezirk, F.col("a.bezirk_bfs_id") == F.col("b._bezk")).select(
        F.col("a.gemeinde_bfs_id").alias("geo_value"),
        F.col("a.gemeinde_name").alias("geo_name"),
        F.col("b._bezk").alias("bezirk_bfs_id"),
        F.col("b.bezirk_name"),
        F.col("k._kant").alias("kanton_bfs_id"),
        F.col("k.kanton_name"),
    )


def join_geo(facts: DataFrame, areas: DataFrame) -> DataFrame:
    """Facts of areas with a complete hierarchy; the others drop out."""
    return lookup_join(facts, areas, ["geo_value"], "inner")


def add_geometry(facts: DataFrame, dim: DataFrame, level: str, column: str) -> DataFrame:
    """Add the geometry of each fact's area, one of the dimension's geometry columns."""
    shapes = dim.select(F.col(LEVELS[level].key).alias("geo_value"), F.col(column).alias("geometry"))
    return lookup_join(facts, shapes, ["geo_value"])


def geometry_column(mode: str | None) -> str:
    if mode not in GEOMETRY_MODES:
        raise ValueError(f"unknown geometry mode: {mode}")
    return GEOMETRY_MODES[mode]


def list_geo(
    dim: DataFrame,
    level: str,
    year: int,
    geometry_mode: str | None = None,
    skip: int | None = None,
    limit: int | None = None,
    include_latest: bool = True,
) -> DataFrame:
    """Areas of a level in one snapshot year.

    The ``latest`` copies belong to the year of their snapshot and are listed with
    it; ``include_latest=False`` leaves them out.
    """
    spec = LEVELS[level]
    rows = dim.filter(F.col("snapshot_year") == year)
    if not include_latest:
        rows = rows.filter(F.col("snapshot_code") != LATEST)
    shape = geometry_column(geometry_mode or spec.default_mode)
    cut = page(rows, [F.col(spec.key), F.col("snapshot_code")], skip, limit)
    return cut.select("snapshot_date", *spec.columns, F.col(shape).alias("geometry"))
