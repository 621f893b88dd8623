"""File scans and sinks."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce
from itertools import accumulate

from pyspark.sql import Column, DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F

from regiofact.functions.geometry import GEOMETRY_TYPE, to_geojson, to_wkb, to_wkt
from regiofact.operators.numbering import number_rows
from regiofact.session import many, save_step

SEED_INDICATOR = (
    "indicator_id int, indicator_name string, topic_1 string, topic_2 string, topic_3 string,"
    " topic_4 string, indicator_unit string, indicator_description string"
)
SEED_MEASURE = "measure_code string, measure string, measure_short string"
SEED_GEOCODE = "geo_code string, geo_name string"


def read_csv(
    spark: SparkSession,
    paths: str | Sequence[str],
    schema: str,
    sep: str = ",",
    multi_line: bool = False,
) -> DataFrame:
    """CSV with a header and a declared schema.

    ``multi_line`` allows line breaks inside quoted fields; such files cannot be
    split, so it is off unless asked for.
    """
    reader = spark.read.schema(schema)
    return reader.csv(paths, header=True, sep=sep, escape='"', multiLine=multi_line)


def read_map_files(
    spark: SparkSession,
    paths: str | Sequence[str],
    schema: str,
    sep: str = ";",
    map_id_pattern: str | None = None,
) -> DataFrame:
    """Many per-map CSVs as one table without exact duplicates.

    All files are one scan. With a pattern, its first group, found in a file's
    path, is added as ``map_id``.
    """
    df = read_csv(spark, paths, schema, sep)
    if map_id_pattern:
        path = F.col("_metadata.file_path")
        df = df.select("*", F.regexp_extract(path, map_id_pattern, 1).alias("map_id"))
    return df.distinct()


def read_seeds(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """Indicator catalogue, measure labels and level labels."""
    schemas = {
        "seed_indicator": SEED_INDICATOR,
        "seed_measure": SEED_MEASURE,
        "seed_geocode": SEED_GEOCODE,
    }
    return {
        name: read_csv(spark, f"{folder}/{name}.csv", s, multi_line=True)
        for name, s in schemas.items()
    }


def write_extract(df: DataFrame, folder: str, name: str, stamp: str) -> str:
    """Archive an extract as Snappy Parquet; an existing key is never replaced."""
    path = f"{folder}/{name}/extracted_data_{stamp.replace(':', '-')}"
    df.write.mode("errorifexists").option("compression", "snappy").parquet(path)
    return path


def read_extract(spark: SparkSession, folder: str, name: str, stamp: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}/extracted_data_{stamp.replace(':', '-')}")


def write_table(df: DataFrame, path: str) -> None:
    """Replace a raw table."""
    df.write.mode("overwrite").parquet(path)


def write_snapshot_year(df: DataFrame, path: str, year: int | None = None) -> None:
    """Replace only the yearly partitions a load contains, so a rerun adds nothing."""
    if year is not None:
        df = df.withColumn("_snapshot_year", F.lit(year))
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("_snapshot_year")
        .parquet(path)
    )


#: Fact rows of a file where there are many; a task sorts as many at a time.
ROWS_PER_FILE = 500_000


def mart_writer(df: DataFrame, rows: Mapping[int, int] | None = None) -> DataFrameWriter:
    """A writer of fact rows as one partition per indicator.

    Rows are gathered by indicator; the rebalance hint lets adaptive execution split a
    large indicator over many tasks and files and merge small ones. Files are sorted by
    area for min/max skipping.

    Adaptive execution goes by compressed bytes, of which a sort takes many times as much. With
    ``rows``, how many each indicator has, an indicator of large facts is dealt by area and period
    to tasks of about ``ROWS_PER_FILE``.
    """
    order = ["indicator_id", "geo_code", "geo_value"]
    if rows and many(df.sparkSession, sum(rows.values()), ROWS_PER_FILE):
        tasks = {i: -(-n // ROWS_PER_FILE) for i, n in rows.items()}
        first = dict(zip(tasks, accumulate(tasks.values(), initial=0), strict=False))
        places = F.create_map(*[F.lit(x) for i, n in tasks.items() for x in (i, [first[i], n])])
        place = places[F.col("indicator_id").cast("int")]
        task = place[0] + F.pmod(F.xxhash64("geo_code", "geo_value", "period_ref"), place[1])
        dealt = df.repartitionById(sum(tasks.values()), task.cast("int"))
    else:
        dealt = df.hint("rebalance", "indicator_id")
    return dealt.sortWithinPartitions(*order).write.partitionBy("indicator_id")


#: Fact rows that are shuffled at a time, which take about 6 GB of disk.
ROWS_PER_WRITE = 200_000_000


def write_mart(df: DataFrame, path: str, rows: Mapping[int, int] | None = None) -> None:
    """Write fact rows by indicator. Only the partitions in ``df`` are replaced.

    Where ``rows`` says that there are very many, some indicators are written after the others, because
    shuffled rows are several times as large as written ones.
    """
    groups: list[dict[int, int]] = [{}]
    for indicator, n in (rows or {}).items():
        if groups[-1] and sum(groups[-1].values()) + n > ROWS_PER_WRITE:
            groups.append({})
        groups[-1][indicator] = n
    for group in groups:
        some = df
        if len(groups) > 1:
            some = df.filter(reduce(Column.__or__, [F.col("indicator_id").eqNullSafe(F.lit(i)) for i in group]))
        writer = mart_writer(some, group or rows).mode("overwrite").option("partitionOverwriteMode", "dynamic")
        save_step(writer, path, df.sparkSession)


def clear_indicators(
    spark: SparkSession, path: str, contract: Mapping[str, str], indicators: Iterable[int]
) -> None:
    """Replace the partitions of some indicators by empty ones."""
    schema = ", ".join(f"{c} {kind}" for c, kind in contract.items() if c != "indicator_id")
    for indicator in sorted(indicators):
        none = spark.createDataFrame([], schema)
        none.write.mode("overwrite").parquet(f"{path}/indicator_id={indicator}")


def read_mart(spark: SparkSession, path: str, contract: Mapping[str, str]) -> DataFrame:
    """All partitions of the fact, typed and ordered by its contract."""
    schema = ", ".join(f"{c} {kind}" for c, kind in contract.items())
    return spark.read.schema(schema).parquet(path).select(*contract)


def lower_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.lower() for c in df.columns])


def read_features(
    spark: SparkSession,
    paths: Sequence[str],
    properties: str,
    duedates: Sequence[str] | None = None,
    multi_line: bool = False,
) -> DataFrame:
    """GeoJSON features as one table.

    ``properties`` is the DDL of the feature properties; names become lower case.
    All paths, files or folders of files, are one scan; with ``duedates`` each row has the
    one of its path. A line
    is a feature or a feature collection; files with one feature per line can be
    split. ``multi_line`` reads documents that are broken over several lines.
    """
    shape = "struct<type: string, coordinates: array<array<array<array<double>>>>>"
    feature = f"struct<properties: struct<{properties}>, geometry: {shape}>"
    schema = f"features array<{feature}>, properties struct<{properties}>, geometry {shape}"

    raw = spark.read.schema(schema).json(list(paths), multiLine=multi_line)
    single = F.array(F.struct("properties", "geometry"))
    found = F.explode(F.coalesce("features", single)).alias("f")
    each = raw.select(found, _path_only(F.col("_metadata.file_path")).alias("_file"))
    border = F.transform(
        F.col("f.geometry.coordinates"),
        lambda polygon: F.transform(
            polygon,
            lambda ring: F.transform(ring, lambda v: F.struct(v[0].alias("x"), v[1].alias("y"))),
        ),
    )
    rows = lower_names(
        each.select("f.properties.*", border.cast(GEOMETRY_TYPE).alias("geometry"), "_file")
    )
    if duedates is None:
        return rows.drop("_file")
    pairs = spark.createDataFrame(list(zip(paths, duedates, strict=True)), "path string, day string")
    days = pairs.select(
        F.regexp_replace(_path_only(F.col("path")), "/$", "").alias("_file"),
        F.col("day").cast("timestamp_ntz").alias("duedate"),
    )
    folders = days.toDF("_folder", "_of_folder")
    placed = rows.withColumn("_folder", F.regexp_replace("_file", "/[^/]*$", ""))
    dated = placed.join(days, "_file", "left").join(folders, "_folder", "left")
    due = F.coalesce("duedate", "_of_folder").alias("duedate")
    return dated.select(*[c for c in rows.columns if c != "_file"], due)


def _path_only(path: Column) -> Column:
    """A path without scheme and host, as written."""
    bare = F.regexp_replace(path, "^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", "")
    return F.try_url_decode(F.replace(bare, F.lit("+"), F.lit("%2B")))


# Fixed names: the date columns a GeoJSON result carries as text.
DATE_COLUMNS = (
    "snapshot_date", "knowledge_date_from", "knowledge_date_to", "period_ref_from", "period_ref",
)


def as_features(df: DataFrame, geometry: str = "geometry") -> DataFrame:
    """One GeoJSON feature text per row, dates as strings."""
    properties = [
        (F.col(c).cast("string") if c in DATE_COLUMNS else F.col(c)).alias(c)
        for c in df.columns
        if c != geometry
    ]
    props = F.to_json(F.struct(*properties), {"ignoreNullFields": "false"})
    shape = F.coalesce(to_geojson(F.col(geometry)), F.lit("null"))
    return df.select(
        F.concat(
            F.lit('{"type":"Feature","properties":'), props, F.lit(',"geometry":'), shape, F.lit("}")
        ).alias("value")
    )


def as_collection(df: DataFrame, geometry: str = "geometry") -> DataFrame:
    """The lines of one FeatureCollection document, in order.

    Written as text, the part files one after the other are the document, so any number of
    tasks can write it.
    """
    numbered = number_rows(as_features(df, geometry), [F.col("value")], "_n")
    comma = F.when(F.col("_n") > 1, ",").otherwise("")
    body = numbered.select("_n", F.concat(comma, "value").alias("value"))
    ends = [(0, '{"type":"FeatureCollection","features":['), (1 << 62, "]}")]
    around = df.sparkSession.createDataFrame(ends, "_n bigint, value string")
    return body.unionByName(around).orderBy("_n").select("value")


def _with_geometry(df: DataFrame, encode, geometry: str) -> DataFrame:
    return df.withColumn(geometry, encode(F.col(geometry))) if geometry in df.columns else df


def export(df: DataFrame, path: str, fmt: str, geometry: str = "geometry") -> None:
    """Write a result: ``parquet`` (WKB), ``csv`` (WKT), ``json`` records, ``geojson`` or
    ``featurecollection``.

    GeoJSON is written as one feature per line, or as the parts of one collection, so any
    number of tasks can write it.
    """
    if fmt == "parquet":
        _with_geometry(df, to_wkb, geometry).write.mode("errorifexists").parquet(path)
    elif fmt == "csv":
        out = _with_geometry(df, to_wkt, geometry)
        arrays = [f.name for f in out.schema if f.dataType.typeName() == "array"]
        for c in arrays:
            out = out.withColumn(c, F.to_json(c))
        out.write.mode("errorifexists").csv(path, header=True, escape='"')
    elif fmt == "json":
        out = _with_geometry(df, to_wkt, geometry)
        out.write.mode("errorifexists").option("ignoreNullFields", "false").json(path)
    elif fmt == "geojson":
        as_features(df, geometry).write.mode("errorifexists").text(path)
    elif fmt == "featurecollection":
        as_collection(df, geometry).write.mode("errorifexists").text(path)
    else:
        raise ValueError(f"unknown format: {fmt}")


def load_profile(
    df: DataFrame, distinct: Mapping[str, Column | str], before: int | None = None
) -> DataFrame:
    """Row count, column count and distinct counts of a load, one row.

    With the row count of the load ``before``, also the ratio of the two.
    """
    n = F.count(F.lit(1))
    ratio = [] if before is None else [F.try_divide(n, F.lit(before)).alias("size_ratio")]
    return df.agg(
        n.alias("num_records"),
        *ratio,
        F.lit(len(df.columns)).alias("num_cols"),
        *[F.count_distinct(F.col(c) if isinstance(c, str) else c).alias(name)
          for name, c in distinct.items()],
    )


def preview(df: DataFrame, n: int = 5) -> DataFrame:
    """The head of a load, for its log entry."""
    return df.limit(n)
