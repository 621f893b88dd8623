"""Sources, sinks and staging."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regiofact.functions.keys import surrogate_key
from regiofact.functions.text import (
    clean_numeric,
    dot_notation,
    group_key,
    ja_nein,
    joined_sources,
    leading_number,
    mother_path,
    regex_find,
    strip_hierarchy,
    year_range,
)
from regiofact.functions.dates import FIRST_ISO_DATE, LAST_ISO_DATE, compact_date, text_date
from regiofact.operators.quality import match_ratios
from regiofact.functions.text import GEO_PATTERNS
from regiofact.plans.staging import last_quarter, restructure_cube, stage, stage_atlas_v1, stage_cube
from regiofact.session import new_path
from regiofact.sources.files import (
    as_features,
    export,
    load_profile,
    read_csv,
    read_extract,
    read_features,
    read_map_files,
    write_extract,
    write_snapshot_year,
    write_table,
)
from regiofact.sources.nested import (
    expand_catalogue,
    explode_cube,
    filter_feed,
    select_assets,
    unnest_distribution,
)
from regiofact.sources.pickup import modified_resources, oldest_unloaded
from regiofact.streaming.pickup import load_new_files
from regiofact.plans.intake import Intake
from regiofact.sources.releases import save_parquet
from workloads.base import LINES, Interrupted, cell, cell_sql, ends_after, entry, lines, money, table


@entry(
    """SELECT o_orderkey AS order_key, o_orderpriority AS priority,
       CAST(o_totalprice AS DOUBLE) AS price, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day
       FROM orders"""
)
def csv_scan(spark: SparkSession, d: str) -> DataFrame:
    """A CSV table written and scanned with a declared schema."""
    path = new_path(spark, "csv")
    o = table(spark, d, "orders").select(
        F.col("o_orderkey").alias("order_key"),
        F.col("o_orderpriority").alias("priority"),
        money("o_totalprice").alias("price"),
        F.col("o_orderdate").cast("date").alias("day"),
    )
    o.write.csv(path, header=True)
    return read_csv(
        spark, path, "order_key bigint, priority string, price decimal(18,2), day date"
    )


@entry(
    """SELECT DISTINCT l_returnflag AS map_id, CAST(l_suppkey AS VARCHAR) AS "GEO_ID",
       CAST(l_quantity AS DOUBLE) AS "VALUE", l_linestatus AS "STATUS" FROM lineitem"""
)
def map_files(spark: SparkSession, d: str) -> DataFrame:
    """Per-map semicolon files as one table without duplicates; the map is in the path."""
    path = new_path(spark, "maps")
    rows = table(spark, d, "lineitem").select(
        F.col("l_suppkey").alias("GEO_ID"),
        F.col("l_quantity").alias("VALUE"),
        F.col("l_linestatus").alias("STATUS"),
        F.col("l_returnflag").alias("map"),
    )
    rows.write.partitionBy("map").csv(path, header=True, sep=";")
    return read_map_files(
        spark, [f"{path}/map=*"], "GEO_ID string, VALUE double, STATUS string",
        map_id_pattern="map=([^/]+)/",
    )


@entry("SELECT page_id, url, html FROM pages")
def extract_archive(spark: SparkSession, d: str) -> DataFrame:
    """An archived extract read back by its key."""
    folder = new_path(spark, "archive")
    pages = table(spark, d, "pages").select("page_id", "url", "html")
    stamp = "2025-01-23T02:05:00"
    write_extract(pages, folder, "pages", stamp)
    return read_extract(spark, folder, "pages", stamp)


_CUBE_SQL = f"""WITH {LINES}
    SELECT CAST(o_orderkey AS BIGINT) AS o_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber,
           dims.place AS place, dims.kind AS kind, dims.measure AS measure,
           CASE dims.measure WHEN 'quantity' THEN CAST(q * dims.f AS VARCHAR)
                             WHEN 'discount' THEN CAST(disc * dims.f AS VARCHAR)
                             ELSE CAST(tax * dims.f AS VARCHAR) END AS indicator_value
    FROM lines, LATERAL (
        SELECT p.place, k.kind, m.measure, p.f * k.f AS f
        FROM (VALUES (l_returnflag, 1), (l_linestatus, 10)) p(place, f),
             (VALUES ('gross', 1), ('net', 2)) k(kind, f),
             (VALUES ('quantity'), ('discount'), ('tax')) m(measure)) dims"""


def _cubes(spark: SparkSession, d: str) -> DataFrame:
    """Dense three-dimensional cubes, one per order line."""
    cells = [
        (F.col(m) * f).cast("string")
        for f in (1, 2, 10, 20)
        for m in ("q", "disc", "tax")
    ]
    return lines(spark, d).select(
        "o_orderkey",
        "l_linenumber",
        F.array(
            F.array("l_returnflag", "l_linestatus"),
            F.array(F.lit("gross"), F.lit("net")),
            F.array(F.lit("quantity"), F.lit("discount"), F.lit("tax")),
        ).alias("dims"),
        F.array(*cells).alias("values"),
    )


@entry(_CUBE_SQL)
def cube_cells(spark: SparkSession, d: str) -> DataFrame:
    """Dense three-dimensional cubes, one per order line, as one row per cell."""
    return explode_cube(_cubes(spark, d), ["place", "kind", "measure"])


@entry(_CUBE_SQL)
def cube_cells_of_parts(spark: SparkSession, d: str) -> DataFrame:
    """The same cubes when each comes in rows of at most five values."""
    starts = F.explode(F.sequence(F.lit(0), F.size("values") - 1, F.lit(5)))
    parts = _cubes(spark, d).withColumn("start", starts)
    parts = parts.withColumn("values", F.slice("values", F.col("start") + 1, F.lit(5)))
    return explode_cube(parts, ["place", "kind", "measure"], offset="start")


_RESPONSE_SQL = f"""WITH {LINES}, r AS (
    SELECT *, CASE WHEN l_linestatus = 'O' THEN 3 ELSE 2 END AS n_geo FROM lines
), cells AS (
    SELECT *, unnest([0, 1, 2]) AS i FROM r WHERE NOT (l_returnflag <> 'A' AND n_geo = 2)
), grouped AS (
    SELECT *, 'total' AS group_name,
           CASE i WHEN 0 THEN q WHEN 1 THEN CASE WHEN disc = 0 THEN -9999 ELSE disc END ELSE tax END AS val
    FROM cells WHERE l_returnflag <> 'A'
    UNION ALL
    SELECT *, 'small', CASE i WHEN 0 THEN q ELSE disc END FROM cells
    WHERE l_returnflag = 'A' AND n_geo = 2 AND i < 2
    UNION ALL
    SELECT *, 'large', CASE i WHEN 0 THEN tax WHEN 1 THEN q ELSE disc END FROM cells
    WHERE l_returnflag = 'A' AND n_geo = 3
)
SELECT DISTINCT CAST(l_suppkey + i AS BIGINT) AS geo_value, 'Area ' || i AS geo_name,
       CAST(CASE WHEN val = -9999 THEN NULL ELSE val END AS DOUBLE) AS indicator_value,
       group_name, o_orderpriority AS bfs_indicateur_id, 'Lines' AS indicator_name,
       'Number' AS indicator_unit, 'Sales' AS source, 'map' || l_linenumber AS map_id,
       CASE n_geo WHEN 3 THEN 'polg' ELSE 'bezk' END || y AS bfs_nivgeo,
       CAST(y AS VARCHAR) AS period_ref
FROM grouped"""


def _responses(spark: SparkSession, d: str) -> DataFrame:
    """Atlas responses built from order lines: lists and grouped lists, some too short."""
    li = lines(spark, d)
    three = F.col("l_linestatus") == "O"
    geo = F.array(F.col("l_suppkey"), F.col("l_suppkey") + 1, F.col("l_suppkey") + 2)
    names = F.array(F.lit("Area 0"), F.lit("Area 1"), F.lit("Area 2"))
    disc = F.when(F.col("disc") == 0, -9999).otherwise(F.col("disc"))
    plain_list = F.to_json(F.array("q", disc, "tax"))
    grouped = F.to_json(
        F.struct(F.array("q", "disc").alias("small"), F.array("tax", "q", "disc").alias("large"))
    )
    body = F.format_string(
        '{"content":{"distribution":{"values":%s},"nivgeo":"%s%d","indic":{"c_id_indicateur":"%s",'
        '"c_lib_indicateur":"Lines","c_desc_indicateur":"Number","c_source":"Sales",'
        '"c_id_view":"map%d"}}}',
        F.when(F.col("l_returnflag") == "A", grouped).otherwise(plain_list),
        F.when(three, "polg").otherwise("bezk"),
        "y", "o_orderpriority", "l_linenumber",
    )
    return li.select(
        body.alias("response"),
        F.when(three, geo).otherwise(F.slice(geo, 1, 2)).alias("codgeo"),
        F.when(three, names).otherwise(F.slice(names, 1, 2)).alias("libgeo"),
        F.col("y").cast("string").alias("period_ref"),
    )


@entry(_RESPONSE_SQL)
def distribution_rows(spark: SparkSession, d: str) -> DataFrame:
    """Nested value lists zipped with their areas; lists of the wrong length are skipped."""
    return unnest_distribution(_responses(spark, d))


@entry(
    """SELECT p_name || p_partkey AS c_id_indicateur, p_brand AS c_id_dataset, v AS view, ' ' || (1990 + p_size) || ' ' AS year
       FROM part, (VALUES (1), (2)) t(i), LATERAL (SELECT CASE i WHEN 1 THEN p_type ELSE p_brand END AS v)
       WHERE p_type LIKE 'S%' OR p_type LIKE 'E%'"""
)
def catalogue_views(spark: SparkSession, d: str) -> DataFrame:
    """Catalogue entries with a supported level, per view and single year."""
    p = table(spark, d, "part")
    level = F.when(F.col("p_type").startswith("S"), "polg").when(
        F.col("p_type").startswith("E"), "kant"
    ).otherwise("lreg")
    year = (F.col("p_size") + 1990).cast("string")
    catalogue = p.select(
        F.concat("p_name", F.col("p_partkey").cast("string")).alias("c_id_indicateur"),
        F.col("p_brand").alias("c_id_dataset"),
        F.array(F.lit("agglo"), F.concat(level, year)).alias("nivgeos"),
        F.array("p_type", "p_brand").alias("c_id_view"),
        F.array(F.concat(F.lit(" "), year, F.lit(" ")), F.concat(year, F.lit("-2050"))).alias("mods"),
    )
    return expand_catalogue(catalogue)


@entry(
    f"""SELECT CAST(c_custkey AS BIGINT) AS gem_no, c_name AS name, CAST(c_acctbal AS DOUBLE) AS zwg_3150,
       CASE WHEN c_acctbal < 0 THEN '2024-03-31 00:00:00' ELSE '2025-03-31 00:00:00' END AS duedate,
       i, r[i].x AS x, r[i].y AS y
       FROM (SELECT *, {cell_sql('c_custkey')} AS r FROM customer), range(1, 18) t(i)"""
)
def feature_files(spark: SparkSession, d: str) -> DataFrame:
    """Two feature files with their due dates as one table."""
    c = table(spark, d, "customer").select(
        F.col("c_custkey").alias("GEM_NO"),
        F.col("c_name").alias("Name"),
        F.col("c_acctbal").alias("ZWG_3150"),
        cell(F.col("c_custkey")).alias("geometry"),
    )
    paths = [new_path(spark, "features") for _ in range(2)]
    export(c.filter("ZWG_3150 < 0"), paths[0], "geojson")
    export(c.filter("ZWG_3150 >= 0"), paths[1], "geojson")
    both = read_features(
        spark, paths, "GEM_NO: bigint, Name: string, ZWG_3150: double",
        ["2024-03-31", "2025-03-31"],
    )
    vertices = F.posexplode(F.flatten(F.flatten("geometry"))).alias("i", "v")
    each = both.select("gem_no", "name", "zwg_3150", "duedate", vertices)
    return each.select(
        "gem_no", "name", "zwg_3150", "duedate", (F.col("i") + 1).alias("i"), "v.x", "v.y"
    )


@entry(
    f"""WITH {LINES}
    SELECT 'order_' || o_orderkey || '_' || l_linenumber AS id, CAST(od AS VARCHAR) AS feature_datetime,
           'flag_' || l_returnflag || '.gpkg.zip' AS asset_key, 'application/x.gpkg' AS asset_type,
           'https://example.org/' || o_orderkey AS asset_href,
           CAST(CASE WHEN l_linestatus = 'O' THEN 4326 ELSE 2056 END AS BIGINT) AS asset_epsg
    FROM lines WHERE o_orderstatus <> 'P' AND l_returnflag IN ('A', 'R')"""
)
def asset_choice(spark: SparkSession, d: str) -> DataFrame:
    """Assets by feature id and key patterns and by type."""
    li = lines(spark, d)
    prefix = F.when(F.col("o_orderstatus") == "P", "open_order_").otherwise("order_")
    day = F.col("od").cast("string")

    def asset(kind: str, epsg) -> F.Column:
        return F.struct(
            F.lit(kind).alias("type"),
            F.concat(F.lit("https://example.org/"), F.col("o_orderkey").cast("string")).alias("href"),
            epsg.cast("int").alias("epsg"), day.alias("created"), day.alias("updated"),
        )

    features = li.select(
        F.concat(prefix, F.concat_ws("_", F.col("o_orderkey"), F.col("l_linenumber"))).alias("id"),
        day.alias("datetime"),
        F.map_from_arrays(
            F.array(
                F.concat(F.lit("flag_"), "l_returnflag", F.lit(".gpkg.zip")),
                F.concat(F.lit("flag_"), "l_returnflag", F.lit(".csv")),
            ),
            F.array(
                asset("application/x.gpkg", F.when(F.col("l_linestatus") == "O", 4326)),
                asset("text/csv", F.lit(None)),
            ),
        ).alias("assets"),
    )
    out = select_assets(features, r"order_\d+", r"flag_[AR]\.", "application/x.gpkg")
    return out.drop("asset_created", "asset_updated")


@entry(
    """WITH r AS (SELECT user_id, max(ts) AS m, max(ts) FILTER (WHERE event_type = 'purchase') AS e
                  FROM events GROUP BY user_id)
       SELECT CAST(user_id AS BIGINT) AS resource_id, strftime(m, '%Y-%m-%d %H:%M:%S') AS last_modified
       FROM r WHERE m > coalesce(e, TIMESTAMP '1970-01-01')"""
)
def modified_since(spark: SparkSession, d: str) -> DataFrame:
    """Users with events after their last purchase, as resources to load again."""
    e = table(spark, d, "events")
    seen = e.groupBy(F.col("user_id").alias("resource_id")).agg(F.max("ts").alias("last_modified"))
    state = (
        e.filter("event_type = 'purchase'")
        .groupBy(F.col("user_id").alias("resource_id"))
        .agg(F.max("ts").alias("last_execution"))
    )
    return modified_resources(seen, state).select("resource_id", "last_modified")


@entry("SELECT CAST(user_id AS BIGINT) AS user_id, event_type, CAST(value AS DOUBLE) AS value FROM events WHERE event_type <> 'error'")
def new_files_stream(spark: SparkSession, d: str) -> DataFrame:
    """New files picked up by a stream that ends when it has caught up."""
    schema = table(spark, d, "events").schema.simpleString()[7:-1].replace(":", " ")
    target, state = new_path(spark, "picked"), new_path(spark, "picked-state")
    load_new_files(
        spark, d, schema, target, state,
        transform=lambda df: df.filter("event_type <> 'error'").select("user_id", "event_type", "value"),
        options={"pathGlobFilter": "events.parquet"},
    )
    return spark.read.schema("user_id bigint, event_type string, value double").parquet(target)


@entry(
    """SELECT 'orders-' || CAST(o_orderkey AS VARCHAR) || '-' || strftime(o_orderdate, '%Y-%m-%d') AS identifier,
       strftime(o_orderdate, '%Y-%m-%d') AS resource_date
       FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)
       ORDER BY o_orderdate, identifier LIMIT 1"""
)
def oldest_missing(spark: SparkSession, d: str) -> DataFrame:
    """The oldest order that has no line yet."""
    o, li = table(spark, d, "orders"), table(spark, d, "lineitem")
    name = F.concat(
        F.lit("orders-"), F.col("o_orderkey").cast("string"), F.lit("-"),
        F.date_format("o_orderdate", "yyyy-MM-dd"),
    )
    listed = o.select(name.alias("identifier"))
    keys = li.select(F.col("l_orderkey").alias("o_orderkey")).distinct()
    stored = o.join(keys, "o_orderkey", "left_semi").select(name.alias("identifier"))
    return oldest_unloaded(listed, stored, r"-(\d{4}-\d{2}-\d{2})$")


@entry(
    f"""WITH {LINES}
    SELECT CAST(o_orderkey AS BIGINT) AS o_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber,
           CAST(1700000000 AS DOUBLE) AS imported, 'ship' AS stop, CAST(sd AS VARCHAR) AS day
    FROM lines WHERE l_returnflag <> 'N'"""
)
def feed_entities(spark: SparkSession, d: str) -> DataFrame:
    """Feed entities without stop times are dropped."""
    stop = F.struct(F.lit("ship").alias("stop"), F.col("sd").cast("string").alias("day"))

    def entity(stops) -> F.Column:
        return F.struct(F.struct(stops.alias("stop_time_update")).alias("trip_update"))

    feeds = lines(spark, d).select(
        "o_orderkey", "l_linenumber",
        F.struct(F.lit("2.0").alias("version")).alias("header"),
        F.array(
            entity(F.when(F.col("l_returnflag") != "N", F.array(stop))),
            entity(F.lit(None).cast("array<struct<stop:string,day:string>>")),
        ).alias("entity"),
    )
    kept = filter_feed(feeds, 1700000000.0)
    return kept.select(
        "o_orderkey", "l_linenumber",
        F.col("header._import_timestamp").alias("imported"),
        F.explode("entity").alias("e"),
    ).select("o_orderkey", "l_linenumber", "imported", F.inline("e.trip_update.stop_time_update"))


@entry(
    """SELECT CAST(o_orderkey AS BIGINT) AS o_orderkey, o_orderstatus,
       CAST(year(o_orderdate) AS BIGINT) AS _snapshot_year FROM orders"""
)
def snapshot_years(spark: SparkSession, d: str) -> DataFrame:
    """Yearly partitions written twice hold the rows once."""
    path = new_path(spark, "years")
    o = table(spark, d, "orders").select(
        "o_orderkey", "o_orderstatus", F.year("o_orderdate").alias("_snapshot_year")
    )
    write_snapshot_year(o, path)
    write_snapshot_year(o, path)
    return spark.read.parquet(path)


@entry("SELECT CAST(doc_id AS BIGINT) AS doc_id, text FROM documents")
def raw_overwrite(spark: SparkSession, d: str) -> DataFrame:
    """A raw table replaced by its next load."""
    path = new_path(spark, "raw")
    docs = table(spark, d, "documents").select("doc_id", "text")
    write_table(docs.select("doc_id"), path)
    write_table(docs, path)
    return spark.read.parquet(path)


@entry(
    f"""SELECT '{{"type":"Feature","properties":{{"geo_value":' || c_custkey || ',"geo_name":"' || c_name ||
        '","period_ref":"2024-12-31"}},"geometry":{{"type":"MultiPolygon","coordinates":[[[' ||
        list_aggregate(list_transform(r, lambda v: '[' || CAST(v.x AS BIGINT) || ',' || CAST(v.y AS BIGINT) || ']'), 'string_agg', ',')
        || ']]]}}}}' AS value
        FROM (SELECT *, {cell_sql('c_custkey')} AS r FROM customer)"""
)
def geojson_export(spark: SparkSession, d: str) -> DataFrame:
    """Areas as GeoJSON features, written and read back as text."""
    path = new_path(spark, "geojson")
    areas = table(spark, d, "customer").select(
        F.col("c_custkey").alias("geo_value"),
        F.col("c_name").alias("geo_name"),
        F.lit("2024-12-31").cast("date").alias("period_ref"),
        cell(F.col("c_custkey")).alias("geometry"),
    )
    export(areas, path, "geojson")
    return spark.read.text(path)


@entry(
    f"""SELECT CAST(c_custkey AS BIGINT) AS geo_value, 'MULTIPOLYGON (((' ||
        list_aggregate(list_transform(r, lambda v: CAST(v.x AS BIGINT) || ' ' || CAST(v.y AS BIGINT)), 'string_agg', ', ')
        || ')))' AS geometry FROM (SELECT *, {cell_sql('c_custkey')} AS r FROM customer)"""
)
def csv_export(spark: SparkSession, d: str) -> DataFrame:
    """Areas as CSV with WKT borders, written and read back."""
    path = new_path(spark, "wkt")
    areas = table(spark, d, "customer").select(
        F.col("c_custkey").alias("geo_value"), cell(F.col("c_custkey")).alias("geometry")
    )
    export(areas, path, "csv")
    return read_csv(spark, path, "geo_value bigint, geometry string")


@entry(
    """SELECT count(*) AS num_records, CAST(6 AS BIGINT) AS num_cols,
       count(DISTINCT o_orderpriority) AS num_distinct_indicators,
       count(DISTINCT o_custkey) AS num_distinct_sources FROM orders"""
)
def profile_of_load(spark: SparkSession, d: str) -> DataFrame:
    """Counts that are logged with every load."""
    return load_profile(
        table(spark, d, "orders"),
        {"num_distinct_indicators": "o_orderpriority", "num_distinct_sources": "o_custkey"},
    )


@entry(
    """SELECT CAST(o_orderkey AS BIGINT) AS bfs_nr, o_orderstatus AS set_name,
       CAST(CAST(o_totalprice AS INTEGER) AS BIGINT) AS indikator_value FROM orders"""
)
def renamed_projection(spark: SparkSession, d: str) -> DataFrame:
    """Rename and cast to staging names."""
    raw = table(spark, d, "orders").select(
        F.col("o_orderkey").alias("BFS_NR"),
        F.col("o_orderstatus").alias("SET_NAME"),
        F.rint("o_totalprice").alias("INDIKATOR_VALUE"),
    )
    return stage(
        raw,
        {
            "bfs_nr": ("BFS_NR", "bigint"),
            "set_name": ("SET_NAME", "string"),
            "indikator_value": ("INDIKATOR_VALUE", "int"),
        },
    )


_ATLAS_KEY = """md5(concat_ws('-', 'm' || l_linenumber, CAST(o_custkey AS VARCHAR), o_orderpriority,
    CAST(y AS VARCHAR), 'polg', '_' || coalesce(CASE WHEN disc > 0 THEN CAST(disc AS VARCHAR) END, '')
    || '_' || CAST(tax AS VARCHAR)))"""


@entry(
    f"""WITH {LINES}
    SELECT CAST(o_custkey AS VARCHAR) AS geo_id, CAST(v AS VARCHAR) AS value, CAST(sd AS VARCHAR) AS last_update,
           '_' || coalesce(CASE WHEN disc > 0 THEN CAST(disc AS VARCHAR) END, '') || '_' || CAST(tax AS VARCHAR)
               AS mother_path,
           CASE WHEN disc > 0 THEN CAST(disc AS VARCHAR) END AS mother_0_id, {_ATLAS_KEY} AS _surrogate_key
    FROM lines"""
)
def atlas_staging(spark: SparkSession, d: str) -> DataFrame:
    """Atlas rows with the ancestors a load happens to carry, their path and key."""
    li = lines(spark, d)
    raw = li.select(
        F.col("o_custkey").cast("string").alias("GEO_ID"),
        F.lit("x").alias("GEO_NAME"),
        F.col("o_orderpriority").alias("VARIABLE"),
        F.col("v").cast("string").alias("VALUE"),
        *[F.lit("x").alias(c) for c in ("UNIT", "STATUS", "STATUS_DESC", "DESC_VAL")],
        F.col("y").cast("string").alias("PERIOD_REF"),
        F.lit("x").alias("SOURCE"),
        F.col("sd").alias("LAST_UPDATE"),
        F.lit("polg").alias("GEOM_CODE"),
        F.lit("x").alias("GEOM"),
        F.col("sd").alias("GEOM_PERIOD"),
        F.concat(F.lit("m"), F.col("l_linenumber").cast("string")).alias("MAP_ID"),
        F.lit("x").alias("MAP_URL"),
        F.when(F.col("disc") > 0, F.col("disc").cast("string")).alias("mother_0_id"),
        F.lit("x").alias("mother_0_name"),
        F.col("tax").cast("string").alias("mother_1_id"),
        F.lit("x").alias("mother_1_name"),
    )
    return stage_atlas_v1(raw).select(
        "geo_id", "value", "last_update", "mother_path", "mother_0_id", "_surrogate_key"
    )


# Area and year texts as cube sources write them, composed from order lines.
CUBE_TEXT = f"""{LINES}, cube AS (
    SELECT CASE o_orderpriority
               WHEN '5-LOW' THEN '>> District ' || l_suppkey || ' '
               WHEN '4-NOT SPECIFIED' THEN '- Canton ' || l_suppkey
               ELSE '......' || lpad(CAST(o_custkey AS VARCHAR), 9, '0') || ' Customer ' || o_custkey END AS geo,
           CASE o_orderstatus WHEN 'F' THEN CAST(y AS VARCHAR)
                WHEN 'O' THEN y || '/' || lpad(CAST((y + 1) % 100 AS VARCHAR), 2, '0')
                ELSE y || '-' || (y + 3) END AS yr,
           CASE WHEN disc = 0 THEN '"..."' WHEN disc = 1 THEN '' ELSE CAST(v AS VARCHAR) END AS val,
           l_returnflag, l_linestatus
    FROM lines
)"""
_PARSED = """parsed AS (
    SELECT *,
        CASE WHEN starts_with(geo, '-') THEN 'kant' WHEN starts_with(geo, '>>') THEN 'bezk'
             WHEN starts_with(geo, '......') THEN 'polg' ELSE '' END AS geo_code,
        nullif(regexp_extract(geo, '^\\.{6}(\\d+)', 1), '') AS geo_value,
        trim(regexp_extract(geo, '^(?:-|>>|(?:\\.{6}\\d*))(.*)', 1)) AS geo_value_name,
        CASE WHEN length(yr) = 4 THEN yr ELSE substr(yr, 1, 4) END AS year_from,
        CASE WHEN length(yr) = 4 THEN yr WHEN length(yr) = 7 THEN substr(yr, 1, 2) || substr(yr, 6, 2)
             ELSE substr(yr, 6, 4) END AS year_to
    FROM cube
)"""


def cube_text(spark: SparkSession, d: str) -> DataFrame:
    li = lines(spark, d)
    text = lambda c: F.col(c).cast("string")
    geo = (
        F.when(F.col("o_orderpriority") == "5-LOW",
               F.concat(F.lit(">> District "), text("l_suppkey"), F.lit(" ")))
        .when(F.col("o_orderpriority") == "4-NOT SPECIFIED",
              F.concat(F.lit("- Canton "), text("l_suppkey")))
        .otherwise(F.concat(F.lit("......"), F.lpad(text("o_custkey"), 9, "0"),
                            F.lit(" Customer "), text("o_custkey")))
    )
    year = (
        F.when(F.col("o_orderstatus") == "F", text("y"))
        .when(F.col("o_orderstatus") == "O",
              F.format_string("%d/%02d", "y", (F.col("y") + 1) % 100))
        .otherwise(F.format_string("%d-%d", "y", F.col("y") + 3))
    )
    value = (
        F.when(F.col("disc") == 0, '"..."').when(F.col("disc") == 1, "").otherwise(text("v"))
    )
    return li.select(
        geo.alias("geo_value_unstructured"), year.alias("year"), value.alias("indicator_value"),
        "l_returnflag", "l_linestatus",
        F.array(F.lit("Office"), F.col("l_returnflag")).alias("sources"),
    )


@entry(
    f"""WITH {CUBE_TEXT}, {_PARSED}
    SELECT geo_code, geo_value, geo_value_name, year_from, year_to,
           'Office, ' || l_returnflag AS source, val AS indicator_value FROM parsed"""
)
def cube_restructured(spark: SparkSession, d: str) -> DataFrame:
    """Area format detected, area and year texts split, sources joined."""
    return restructure_cube(cube_text(spark, d), sources="sources").drop(
        "geo_value_unstructured", "year", "l_returnflag", "l_linestatus"
    )


@entry(
    f"""WITH {CUBE_TEXT}
    SELECT round(avg(CAST(regexp_matches(geo, '^(?:Schweiz|Ohne Angabe|-|>>|<<|(?:\\.{{6}}\\d*))') AS INTEGER)), 4) AS dot_notation,
           round(avg(CAST(regexp_matches(geo, '^\\d+\\s\\w') AS INTEGER)), 4) AS leading_number FROM cube"""
)
def format_ratios(spark: SparkSession, d: str) -> DataFrame:
    """Share of rows each area format explains."""
    return match_ratios(cube_text(spark, d), "geo_value_unstructured", GEO_PATTERNS)


@entry(
    f"""WITH {CUBE_TEXT}, {_PARSED}, typed AS (
        SELECT CAST(year_from AS INTEGER) AS year_from, CAST(year_to AS INTEGER) AS year_to, l_returnflag, l_linestatus,
               CASE WHEN val IN ('"..."', '') THEN NULL ELSE CAST(val AS DECIMAL(18,2)) END AS v,
               geo_code, CAST(geo_value AS INTEGER) AS geo_value, geo_value_name,
               md5(concat_ws('-', year_from, year_to, l_returnflag, l_linestatus, geo_code,
                   coalesce(geo_value, '_dbt_utils_surrogate_key_null_'), geo_value_name)) AS k
        FROM parsed
    ), one AS (
        SELECT * FROM typed WHERE v IS NOT NULL AND (geo_value IS NOT NULL OR geo_value_name IS NOT NULL)
        QUALIFY row_number() OVER (PARTITION BY k ORDER BY v DESC) = 1
    )
    SELECT CAST(year_from AS BIGINT) AS year_from, CAST(year_to AS BIGINT) AS year_to, l_returnflag, l_linestatus,
           CAST(v AS DOUBLE) AS indicator_value, geo_code, CAST(geo_value AS BIGINT) AS geo_value, geo_value_name,
           k AS _surr_key
    FROM one"""
)
def cube_staging(spark: SparkSession, d: str) -> DataFrame:
    """Typed cube rows with key, missing numbers searched by name."""
    places = table(spark, d, "customer").select(
        F.col("c_custkey").cast("int").alias("gemeinde_bfs_id"),
        F.col("c_name").alias("gemeinde_name"),
    )
    raw = restructure_cube(cube_text(spark, d), sources="sources", fmt="dot_notation")
    return stage_cube(raw, ["l_returnflag", "l_linestatus"], places).drop("source")


@entry(
    f"""WITH {LINES}, t AS (SELECT CASE WHEN l_returnflag = 'N' THEN 'Schweiz'
            ELSE l_suppkey || ' Place ' || o_custkey || ' (' || l_linestatus || ')' END AS geo FROM lines)
    SELECT geo, 'polg' AS geo_code, nullif(regexp_extract(geo, '^(\\d+)\\s\\w', 1), '') AS geo_value,
           nullif(regexp_extract(geo, '^\\d+\\s(.*)', 1), '') AS geo_value_name FROM t"""
)
def leading_number_text(spark: SparkSession, d: str) -> DataFrame:
    """Areas written as number and name."""
    text = F.when(F.col("l_returnflag") == "N", "Schweiz").otherwise(
        F.format_string("%d Place %d (%s)", "l_suppkey", "o_custkey", "l_linestatus")
    )
    df = lines(spark, d).select(text.alias("geo"))
    return df.withColumns(leading_number(F.col("geo")))


@entry(
    """SELECT CAST(o_orderkey AS BIGINT) AS o_orderkey, CAST(year(o_orderdate) AS VARCHAR) AS year
       FROM orders WHERE quarter(o_orderdate) = 4"""
)
def fourth_quarter(spark: SparkSession, d: str) -> DataFrame:
    """The fourth quarter stands for the year."""
    o = table(spark, d, "orders")
    text = F.format_string("%dQ%d", F.year("o_orderdate"), F.quarter("o_orderdate"))
    return last_quarter(o.select("o_orderkey", text.alias("year")))


@entry(
    f"""WITH {LINES}
    SELECT CAST(o_orderkey AS BIGINT) AS o_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber,
           CASE WHEN disc IN (0, 1, 2, 3, 4) THEN NULL ELSE CAST(v AS DOUBLE) END AS cube_value,
           CASE WHEN disc = 5 THEN NULL ELSE CAST(q AS DOUBLE) END AS tax_value,
           CASE l_returnflag WHEN 'A' THEN 'true' WHEN 'R' THEN 'false' END AS answer
    FROM lines"""
)
def cleaned_values(spark: SparkSession, d: str) -> DataFrame:
    """Marks of missing numbers become NULL; yes and no become booleans."""
    marks = ['"..."', '"...."', '"....."', '"......"', ""]
    text = F.col("v").cast("string")
    for i, mark in enumerate(marks):
        text = F.when(F.col("disc") == i, mark).otherwise(text)
    tax = F.when(F.col("disc") == 5, "NA").otherwise(F.col("q").cast("string"))
    answer = F.when(F.col("l_returnflag") == "A", "Ja").when(
        F.col("l_returnflag") == "R", "Nein"
    ).otherwise("k.A.")
    return lines(spark, d).select(
        "o_orderkey", "l_linenumber",
        clean_numeric(text).alias("cube_value"),
        clean_numeric(tax, ["NA"]).alias("tax_value"),
        ja_nein(answer).alias("answer"),
    )


@entry(
    f"""WITH {LINES}
    SELECT CAST(o_orderkey AS BIGINT) AS o_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber,
           CASE WHEN l_returnflag <> 'N' THEN CAST(od AS VARCHAR) END AS first_day,
           CASE WHEN l_linestatus = 'O' THEN CAST(sd AS VARCHAR) END AS last_day,
           CAST(sd AS VARCHAR) AS compact, l_returnflag AS bare, 'Office' AS joined, 'unknown' AS missing,
           l_returnflag || '---' || l_linestatus AS grp,
           '_' || coalesce(CASE WHEN disc > 0 THEN CAST(disc AS VARCHAR) END, '') || '_' || tax AS path,
           md5(coalesce(CASE WHEN disc > 0 THEN CAST(disc AS VARCHAR) END, '_dbt_utils_surrogate_key_null_')
               || '-' || o_orderkey) AS surrogate
    FROM lines"""
)
def text_functions(spark: SparkSession, d: str) -> DataFrame:
    """Dates inside texts, hierarchy marks, joined lists, paths and keys."""
    li = lines(spark, d)
    od, sd = F.col("od").cast("string"), F.col("sd").cast("string")
    period = F.concat(
        F.when(F.col("l_returnflag") != "N", od).otherwise("um 1999"),
        F.lit("/"),
        F.when(F.col("l_linestatus") == "O", sd).otherwise("heute"),
    )
    mother = F.when(F.col("disc") > 0, F.col("disc"))
    marked = F.concat(
        F.when(F.col("l_linestatus") == "O", ">>").otherwise("...."), F.col("l_returnflag")
    )
    return li.select(
        "o_orderkey", "l_linenumber",
        text_date(period, FIRST_ISO_DATE).alias("first_day"),
        text_date(period, LAST_ISO_DATE).alias("last_day"),
        compact_date(F.date_format("sd", "yyyyMMdd").cast("int")).alias("compact"),
        strip_hierarchy(marked, ">>", "-", "<->", r"\.{4}").alias("bare"),
        joined_sources(F.array(F.lit("Office"))).alias("joined"),
        joined_sources(F.lit(None).cast("array<string>")).alias("missing"),
        group_key(F.col("l_returnflag"), F.col("l_linestatus")).alias("grp"),
        mother_path(mother, F.col("tax")).alias("path"),
        surrogate_key(mother, F.col("o_orderkey")).alias("surrogate"),
    )


@entry(
    """SELECT event_id, strftime(ts, '%Y-%m-%d') AS resource_id, CAST(CASE WHEN ts < TIMESTAMP '2024-01-16' THEN 1 ELSE 2 END AS BIGINT) AS loaded_in,
              CAST(2 AS BIGINT) AS releases FROM events WHERE ts < TIMESTAMP '2024-01-25'"""
)
def restarted_pickup(spark: SparkSession, d: str) -> DataFrame:
    """Days of events as resources: a load, a second one that ends after each of its writes, its restart, and one without changes.

    The rows are those of one clean load. Days that did not change were loaded once.
    """
    events, intake = table(spark, d, "events").select("event_id", "ts"), Intake(spark, new_path(spark, "intake"), "events")

    def load(until: str, save=save_parquet):
        seen = events.filter(F.col("ts") < F.lit(until).cast("timestamp_ntz")).withColumn("resource_id", F.date_format("ts", "yyyy-MM-dd"))
        listed = seen.groupBy("resource_id").agg(F.max("ts").alias("last_modified"))
        return intake.load(listed, lambda days: seen.join(days.select("resource_id"), "resource_id"), until, save)

    load("2024-01-16 12:00:00")
    for writes in range(3):
        try:
            load("2024-01-25 00:00:00", ends_after(writes))
        except Interrupted:
            pass
    load("2024-01-25 00:00:00")
    last = load("2024-01-25 00:00:00")
    return intake.rows().select("event_id", "resource_id", "loaded_in", F.lit(last.number).alias("releases"))
