"""Geometry functions, coverage simplification and yearly dimensions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regiofact.functions.geometry import (
    LV95,
    WGS84,
    area,
    centroid,
    force_2d,
    from_wkb,
    map_vertices,
    point,
    point_to_geojson,
    point_to_wkt,
    reproject,
    to_geojson,
    to_wgs84,
    to_wkb,
    to_wkt,
)
from regiofact.operators.coverage import coverage_simplify, inside_loop, segments_meet
from regiofact.plans.geo_dims import (
    add_latest,
    boundary_snapshots,
    list_geo,
    read_geo_dim,
    store_geo_dim,
)
from regiofact.session import materialize, new_path
from regiofact.sources.files import export
from workloads.base import cell, cell_sql, entry, table, to_wgs84_sql

NOW = "2001-12-31"


def _areas(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "customer").select(
        F.col("c_custkey").alias("id"), cell(F.col("c_custkey")).alias("geometry")
    )


_AREAS = f"areas AS (SELECT c_custkey AS id, {cell_sql('c_custkey')} AS r FROM customer)"
_LON, _LAT = to_wgs84_sql("v.x", "v.y")


@entry(
    f"""WITH {_AREAS}, t AS (SELECT id, unnest(range(1, 18)) AS i, r FROM areas), v AS (SELECT id, i, r[i] AS v FROM t)
    SELECT CAST(id AS BIGINT) AS id, CAST(i AS BIGINT) AS i, round({_LON} * 100000, 4) AS lon, round({_LAT} * 100000, 4) AS lat,
           CAST(1 AS BIGINT) AS within_bound, CAST(4326 AS BIGINT) AS srid FROM v"""
)
def reprojected_borders(spark: SparkSession, d: str) -> DataFrame:
    """Borders to WGS84 (in hundred-thousandths of a degree, about a metre), and whether they come back within two millimetres,
    which is what leaving out the height costs."""
    a = _areas(spark, d)
    wgs = a.withColumn("wgs", reproject(F.col("geometry"), LV95, WGS84))
    back = wgs.withColumn("back", reproject(F.col("wgs"), WGS84, LV95))
    both = F.arrays_zip(
        F.flatten(F.flatten("geometry")).alias("g"),
        F.flatten(F.flatten("wgs")).alias("w"),
        F.flatten(F.flatten("back")).alias("b"),
    )
    v = back.select("id", F.posexplode(both).alias("i", "v"))
    error = F.hypot(F.col("v.b.x") - F.col("v.g.x"), F.col("v.b.y") - F.col("v.g.y"))
    return v.select(
        "id", (F.col("i") + 1).alias("i"), (F.col("v.w.x") * 100000).alias("lon"), (F.col("v.w.y") * 100000).alias("lat"),
        (error < 0.002).cast("int").alias("within_bound"), F.lit(WGS84).alias("srid"),
    )


_MOMENTS = f"""{_AREAS}, seg AS (
        SELECT id, r[1].x AS ox, r[1].y AS oy, unnest(range(1, 17)) AS i, r FROM areas
    ), c AS (
        SELECT id, ox, oy, r[i].x - ox AS x0, r[i].y - oy AS y0, r[i + 1].x - ox AS x1, r[i + 1].y - oy AS y1 FROM seg
    ), m AS (
        SELECT id, any_value(ox) AS ox, any_value(oy) AS oy, sum(x0 * y1 - x1 * y0) AS a,
               sum((x0 + x1) * (x0 * y1 - x1 * y0)) AS mx, sum((y0 + y1) * (x0 * y1 - x1 * y0)) AS my FROM c GROUP BY id
    )"""


@entry(
    f"""WITH {_MOMENTS} SELECT CAST(id AS BIGINT) AS id, round(abs(a) / 2, 4) AS area, round(ox + mx / (3 * a), 3) AS x,
        round(oy + my / (3 * a), 3) AS y FROM m"""
)
def centres(spark: SparkSession, d: str) -> DataFrame:
    """Area and area-weighted centre of every area."""
    c = _areas(spark, d).select("id", area(F.col("geometry")).alias("area"), centroid(F.col("geometry")).alias("c"))
    return c.select("id", "area", F.round("c.x", 3).alias("x"), F.round("c.y", 3).alias("y"))


def _point_text(separator: str) -> str:
    return f"list_transform(r, lambda v: CAST(v.x AS BIGINT) || '{separator}' || CAST(v.y AS BIGINT))"


@entry(
    f"""WITH {_AREAS} SELECT CAST(id AS BIGINT) AS id,
        'MULTIPOLYGON (((' || array_to_string({_point_text(' ')}, ', ') || ')))' AS wkt,
        '{{"type":"MultiPolygon","coordinates":[[[[' || array_to_string({_point_text(',')}, '],[') || ']]]]}}' AS geojson,
        'POINT (' || CAST(r[1].x AS BIGINT) || ' ' || CAST(r[1].y AS BIGINT) || ')' AS point_wkt,
        '{{"type":"Point","coordinates":[' || CAST(r[1].x AS BIGINT) || ',' || CAST(r[1].y AS BIGINT) || ']}}' AS point_geojson,
        CAST(1 + 4 + 4 + 1 + 4 + 4 + 4 + 17 * 16 AS BIGINT) AS wkb_bytes FROM areas"""
)
def geometry_texts(spark: SparkSession, d: str) -> DataFrame:
    """Borders and points as WKT, GeoJSON and WKB."""
    a = _areas(spark, d)
    first = F.flatten(F.flatten("geometry"))[0]
    return a.select(
        "id", to_wkt(F.col("geometry")).alias("wkt"), to_geojson(F.col("geometry")).alias("geojson"),
        point_to_wkt(first).alias("point_wkt"), point_to_geojson(first).alias("point_geojson"),
        F.length(to_wkb(F.col("geometry"))).alias("wkb_bytes"),
    )


@entry(
    f"""WITH {_AREAS}, t AS (SELECT id, unnest(range(1, 18)) AS i, r FROM areas)
    SELECT CAST(id AS BIGINT) AS id, CAST(i AS BIGINT) AS i, r[i].x AS x, r[i].y AS y FROM t"""
)
def borders_from_wkb(spark: SparkSession, d: str) -> DataFrame:
    """Borders written as Parquet with WKB, read back and decoded."""
    path = new_path(spark, "wkb")
    export(_areas(spark, d), path, "parquet")
    back = spark.read.parquet(path).select("id", from_wkb(F.col("geometry")).alias("geometry"))
    v = back.select("id", F.posexplode(F.flatten(F.flatten("geometry"))).alias("i", "v"))
    return v.select("id", (F.col("i") + 1).alias("i"), "v.*")


@entry(
    f"""WITH {_AREAS}, t AS (SELECT id, unnest(range(1, 18)) AS i, r FROM areas)
    SELECT CAST(id AS BIGINT) AS id, CAST(i AS BIGINT) AS i, r[i].x AS x, r[i].y AS y FROM t"""
)
def flat_borders(spark: SparkSession, d: str) -> DataFrame:
    """Heights are dropped from the vertices."""
    high = map_vertices(
        F.col("geometry"),
        lambda v: F.struct(v["x"].alias("x"), v["y"].alias("y"), F.lit(430.5).alias("z")),
    )
    flat = _areas(spark, d).select("id", force_2d(high).alias("geometry"))
    v = flat.select("id", F.posexplode(F.flatten(F.flatten("geometry"))).alias("i", "v"))
    return v.select("id", (F.col("i") + 1).alias("i"), "v.*")


@entry()
def simplified_coverage(spark: SparkSession, d: str) -> DataFrame:
    """Borders simplified at 50, 100 and 500 m with shared borders kept shared.

    No SQL: the line simplification is a sequential elimination. The tests check
    that both sides of every border stay the same.
    """
    a = _areas(spark, d).withColumn("snapshot_code", F.lit("latest"))
    out = coverage_simplify(
        a, ["id"], "snapshot_code", "geometry", {"s50": 50.0, "s100": 100.0, "s500": 500.0}
    )
    n = lambda c: F.size(F.flatten(F.flatten(c)))
    return out.select(
        "id", n("geometry").alias("n"), n("s50").alias("n50"), n("s100").alias("n100"), n("s500").alias("n500"),
        to_wkt(F.col("s100"), 3).alias("wkt100"),
    )


def _with_enclaves(spark: SparkSession, d: str) -> DataFrame:
    """Every seventh area has an enclave right behind the middle of its eastern border, an area of its own.

    Cutting off that border's middle would leave the enclave on the other side of it.
    """
    a = _areas(spark, d)
    middle = F.get(F.get(F.get("geometry", F.lit(0)), F.lit(0)), F.lit(6))
    corners = ((-12, -4), (-4, -4), (-4, 4), (-12, 4), (-12, -4))
    ring = F.array(*[point(middle["x"] + dx, middle["y"] + dy) for dx, dy in corners])
    has = F.col("id") % 7 == 0
    hosts = a.withColumn("geometry", F.when(has, F.array(F.concat(F.get("geometry", F.lit(0)), F.array(F.reverse(ring))))).otherwise(F.col("geometry")))
    return hosts.unionByName(a.filter(has).select((-1 - F.col("id")).alias("id"), F.array(F.array(ring)).alias("geometry")))


_FAULTS = ("open_rings", "foreign_vertices", "crossings", "edges_used_too_often", "half_edges", "enclaves_outside", "areas_off")


@entry(
    f"""SELECT CAST(t.tolerance AS BIGINT) AS tolerance, count(*) + count(*) FILTER (WHERE c_custkey % 7 = 0) AS shapes,
               {", ".join(f"CAST(0 AS BIGINT) AS {name}" for name in _FAULTS)}
        FROM customer, (VALUES (50), (100), (500)) t(tolerance) GROUP BY t.tolerance"""
)
def valid_coverage(spark: SparkSession, d: str) -> DataFrame:
    """What is wrong with a coverage with enclaves after simplification at 50, 100 and 500 m: nothing.

    Counted are rings that do not close, vertices that were none, different edges that meet other
    than at a common end, edges of more than two rings, edges of enclaves that their host does not
    have, enclaves outside of their host, and areas that changed by more than the tolerance along
    their border.
    """
    levels = {"s50": 50.0, "s100": 100.0, "s500": 500.0}
    a = _with_enclaves(spark, d).withColumn("snapshot_code", F.lit("latest"))
    out = materialize(coverage_simplify(a, ["id"], "snapshot_code", "geometry", levels))
    shapes = out.select("id", F.col("geometry").alias("was"), F.inline(F.array(*[
        F.struct(F.lit(t).alias("tolerance"), F.col(n).alias("now")) for n, t in levels.items()
    ])))
    rings = shapes.select("tolerance", "id", F.explode(F.flatten("now")).alias("ring"))
    one = lambda df, name: df.groupBy("tolerance").agg(F.count(F.lit(1)).alias("n")).select("tolerance", F.lit(name).alias("fault"), "n")
    opened = rings.filter((F.get("ring", F.lit(0)) != F.element_at("ring", -1)) | (F.size("ring") < 4))
    foreign = shapes.filter(F.size(F.array_except(F.flatten(F.flatten("now")), F.flatten(F.flatten("was")))) > 0)
    pairs = F.arrays_zip(F.slice("ring", 1, F.size("ring") - 1).alias("p"), F.slice("ring", 2, F.size("ring") - 1).alias("q"))
    edges = rings.select("tolerance", "id", F.explode(pairs).alias("e")).select(
        "tolerance", "id", F.least("e.p", "e.q").alias("p"), F.greatest("e.p", "e.q").alias("q")
    )
    distinct = materialize(edges.groupBy("tolerance", "p", "q").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("least")))
    cells = lambda c: F.sequence(F.floor(F.least(f"p.{c}", f"q.{c}") / 500), F.floor(F.greatest(f"p.{c}", f"q.{c}") / 500))
    dealt = distinct.select("tolerance", "p", "q", F.explode(cells("x")).alias("cx"), cells("y").alias("cy")).withColumn("cy", F.explode("cy"))
    met = dealt.toDF("tolerance", "r", "s", "cx", "cy").join(dealt, ["tolerance", "cx", "cy"])
    met = met.filter(F.struct("p", "q") < F.struct("r", "s")).filter(segments_meet(F.col("p"), F.col("q"), F.col("r"), F.col("s")))
    enclave = shapes.filter("id < 0").select("tolerance", (-1 - F.col("id")).alias("id"), F.get(F.get(F.get("now", F.lit(0)), F.lit(0)), F.lit(0)).alias("v"))
    host = shapes.select("tolerance", "id", F.get(F.get("now", F.lit(0)), F.lit(0)).alias("shell"))
    outside = enclave.join(host, ["tolerance", "id"]).filter(~inside_loop(F.col("v"), F.col("shell")))
    border = F.aggregate(F.flatten("was"), F.lit(0.0), lambda n, r: n + F.aggregate(
        F.arrays_zip(F.slice(r, 1, F.size(r) - 1).alias("p"), F.slice(r, 2, F.size(r) - 1).alias("q")), F.lit(0.0),
        lambda m, e: m + F.hypot(e["p"]["x"] - e["q"]["x"], e["p"]["y"] - e["q"]["y"]),
    ))
    off = shapes.filter(F.abs(F.abs(area(F.col("now"))) - F.abs(area(F.col("was")))) > F.col("tolerance") * border)
    faults = reduce(DataFrame.unionAll, [
        one(opened, "open_rings"), one(foreign, "foreign_vertices"), one(met.select("tolerance", "p", "q", "r", "s").distinct(), "crossings"),
        one(distinct.filter("n > 2"), "edges_used_too_often"), one(distinct.filter("least < 0 and n <> 2"), "half_edges"),
        one(outside, "enclaves_outside"), one(off, "areas_off"),
    ])
    counted = one(shapes, "shapes").unionAll(faults).groupBy("tolerance").pivot("fault", ["shapes", *_FAULTS]).agg(F.sum("n"))
    return counted.fillna(0).withColumn("tolerance", F.col("tolerance").cast("bigint"))


# ---------------------------------------------------------------------------
# Yearly dimensions. The past source holds each customer from the first order to the
# last one before 2000, the present source the customers with orders in a later year.
# The nation is missing where that year has no finished order.


def boundary_sources(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    c, o = table(spark, d, "customer"), table(spark, d, "orders")
    n = table(spark, d, "nation")
    day = F.col("o_orderdate").cast("date")
    early = o.filter(F.year("o_orderdate") < 2000).groupBy("o_custkey").agg(
        F.min(day).alias("f"), F.max(day).alias("t")
    )
    late = o.filter(F.year("o_orderdate") >= 1999).groupBy(
        "o_custkey", F.year("o_orderdate").alias("_snapshot_year")
    ).agg(F.bool_or(F.col("o_orderstatus") == "F").alias("finished"))
    # together, so that a customer's border is made once for all years
    late = late.groupBy("o_custkey").agg(F.collect_list(F.struct("_snapshot_year", "finished")).alias("years"))
    placed = c.join(n, c.c_nationkey == n.n_nationkey)
    shape = cell(F.col("c_custkey"))
    past = placed.join(early, placed.c_custkey == early.o_custkey).select(
        F.col("c_custkey").alias("GDENR"), F.lit(0).alias("GDEHISTID"), F.col("c_name").alias("GDENAME"),
        F.col("c_nationkey").alias("BEZNR"), F.col("n_name").alias("BEZNAME"),
        F.col("n_regionkey").alias("KTNR"), F.lit("K").alias("KTKZ"), F.lit("CH").alias("CODE_ISO"),
        F.date_format("f", "yyyyMMdd").alias("VALID_FROM"), F.date_format("t", "yyyyMMdd").alias("VALID_UNTI"),
        to_wgs84(shape).alias("geometry"),
    )
    drawn = placed.join(late, placed.c_custkey == late.o_custkey).withColumn("shape", shape)
    present = drawn.select("*", F.inline("years")).select(
        "_snapshot_year", F.col("c_custkey").alias("bfs_nummer"), F.lit(1).alias("hist_nr"),
        F.col("c_name").alias("name"),
        F.when(F.col("finished"), F.col("c_nationkey")).alias("bezirksnummer"),
        F.col("n_regionkey").alias("kantonsnummer"), F.col("shape").alias("geometry"),
    )
    return past, present


_SNAPSHOTS = f"""early AS (
        SELECT o_custkey AS id, min(CAST(o_orderdate AS DATE)) AS f, max(CAST(o_orderdate AS DATE)) AS t
        FROM orders WHERE year(o_orderdate) < 2000 GROUP BY 1
    ), late AS (
        SELECT o_custkey AS id, CAST(year(o_orderdate) AS INTEGER) AS y, bool_or(o_orderstatus = 'F') AS fin
        FROM orders WHERE year(o_orderdate) >= 1999 GROUP BY 1, 2
    ), grid AS (SELECT CAST(unnest(generate_series(DATE '1850-01-01', DATE '{NOW}', INTERVAL 1 YEAR)) AS DATE) AS s),
    u AS (
        SELECT 1 AS src, s, c_custkey AS id, 0 AS hist, c_nationkey AS bez, n_regionkey AS kan
        FROM early JOIN grid ON s BETWEEN f AND t JOIN customer ON c_custkey = id JOIN nation ON n_nationkey = c_nationkey
        UNION ALL
        SELECT 2, make_date(y, 1, 1), c_custkey, 1, CASE WHEN fin THEN c_nationkey END, n_regionkey
        FROM late JOIN customer ON c_custkey = id JOIN nation ON n_nationkey = c_nationkey
    ), one AS (SELECT * FROM u QUALIFY row_number() OVER (PARTITION BY id, s ORDER BY src DESC) = 1),
    known AS (SELECT id, arg_max(bez, s) FILTER (WHERE bez IS NOT NULL) AS kb, max(s) AS newest FROM one GROUP BY id),
    filled AS (SELECT one.*, coalesce(bez, kb) AS b, newest FROM one JOIN known USING (id)),
    dim AS (
        SELECT strftime(s, '%Y-%m-%d') AS code, * FROM filled
        UNION ALL SELECT 'latest', * FROM filled WHERE s = newest
    )"""


@entry(
    f"""WITH {_SNAPSHOTS} SELECT code AS snapshot_code, CAST(s AS VARCHAR) AS snapshot_date, CAST(id AS BIGINT) AS gemeinde_bfs_id,
        CAST(hist AS BIGINT) AS gemeinde_hist_bfs_id, CAST(b AS BIGINT) AS bezirk_bfs_id, CAST(kan AS BIGINT) AS kanton_bfs_id FROM dim"""
)
def yearly_dimension(spark: SparkSession, d: str) -> DataFrame:
    """Historical and current areas as yearly snapshots with a latest row each."""
    past, present = boundary_sources(spark, d)
    snapshots = boundary_snapshots(past, present, "polg", NOW)
    return add_latest(snapshots, "gemeinde_bfs_id").select(
        "snapshot_code", "snapshot_date", "gemeinde_bfs_id", "gemeinde_hist_bfs_id",
        "bezirk_bfs_id", "kanton_bfs_id",
    )


_CENTRE_LON, _CENTRE_LAT = to_wgs84_sql("(ox + mx / (3 * a))", "(oy + my / (3 * a))")


# Districts and cantons: nations and regions from 1995 on, most of them still there in 1999 and 2000.
def _coarse_sources(spark: SparkSession, d: str, level: str) -> tuple[DataFrame, DataFrame]:
    district = level == "bezk"
    t = table(spark, d, "nation" if district else "region")
    key = F.col("n_nationkey" if district else "r_regionkey").cast("bigint")
    shape, name = cell(key, 8000 if district else 40000), F.col("n_name" if district else "r_name")
    past = t.select(
        key.alias("BEZNR" if district else "KTNR"), name.alias("BEZNAME" if district else "KTKZ"),
        *([F.col("n_regionkey").alias("KTNR")] if district else [F.lit("CH").alias("CODE_ISO")]),
        F.lit("19950101").alias("VALID_FROM"), F.lit("19980630").alias("VALID_UNTI"), reproject(shape, LV95, WGS84).alias("geometry"),
    )
    later = t.filter(key % 5 != 4).withColumn("_snapshot_year", F.explode(F.array(F.lit(1999), F.lit(2000))))
    present = later.select(
        "_snapshot_year", key.alias("bezirksnummer" if district else "kantonsnummer"), name.alias("name"),
        F.col("n_regionkey").alias("kantonsnummer") if district else F.lit("CH").alias("icc"), shape.alias("geometry"),
    )
    return past, present


_WRITTEN: dict[tuple[str, str], str] = {}


def dimensions(spark: SparkSession, d: str) -> str:
    """The folder of the dimensions of all levels, written once per session and data folder."""
    key = (spark.sparkContext.applicationId, d)
    if key not in _WRITTEN:
        path = new_path(spark, "areas")
        for level in ("polg", "bezk", "kant"):
            past, present = boundary_sources(spark, d) if level == "polg" else _coarse_sources(spark, d, level)
            store_geo_dim(past, present, level, NOW, path)
        _WRITTEN[key] = path
    return _WRITTEN[key]


_COARSE = """SELECT level, CAST(y AS VARCHAR) || '-01-01' AS snapshot_date, CAST(id AS BIGINT) AS id, name, CAST(kan AS BIGINT) AS kanton_bfs_id{more} FROM (
        SELECT 'bezk' AS level, n_nationkey AS id, n_name AS name, n_regionkey AS kan FROM nation
        UNION ALL SELECT 'kant', r_regionkey, r_name, r_regionkey FROM region
    ) a, (SELECT unnest(range(1995, 2001)) AS y) WHERE y < 1999 OR id % 5 <> 4"""


def _listed(spark: SparkSession, d: str, level: str, year: int, mode: str) -> DataFrame:
    rows = list_geo(read_geo_dim(spark, level, dimensions(spark, d), year), level, year, mode, include_latest=False)
    key, name = ("bezirk_bfs_id", "bezirk_name") if level == "bezk" else ("kanton_bfs_id", "kanton_name")
    return rows.select(F.lit(level).alias("level"), "snapshot_date", F.col(key).alias("id"), F.col(name).alias("name"), F.col("kanton_bfs_id").alias("kanton_bfs_id"), "geometry")


@entry(_COARSE.format(more=", CAST(17 AS BIGINT) AS n_vertices"))
def districts_and_cantons(spark: SparkSession, d: str) -> DataFrame:
    """Districts and cantons of all years with their borders."""
    parts = [_listed(spark, d, level, year, "border") for level in ("bezk", "kant") for year in range(1995, 2001)]
    rows = reduce(DataFrame.unionAll, parts)
    return rows.withColumn("n_vertices", F.size(F.flatten(F.flatten("geometry")))).drop("geometry")


_SIMPLE = ("border_simple_50_meter", "border_simple_100_meter", "border_simple_500_meter")


@entry(
    f"""SELECT a.*, m AS mode, CAST(1 AS BIGINT) AS closed, CAST(1 AS BIGINT) AS of_border, CAST(1 AS BIGINT) AS near
        FROM ({_COARSE.format(more="")}) a, (VALUES {", ".join(f"('{m}')" for m in _SIMPLE)}) t(m) WHERE snapshot_date = '2000-01-01'"""
)
def simplified_modes(spark: SparkSession, d: str) -> DataFrame:
    """The three simplified modes for one year: closed rings of the border's vertices, near its area."""
    parts = []
    for level in ("bezk", "kant"):
        border = _listed(spark, d, level, 2000, "border").select("id", F.col("geometry").alias("border"))
        parts += [_listed(spark, d, level, 2000, m).withColumn("mode", F.lit(m)).join(border, "id") for m in _SIMPLE]
    rows = reduce(DataFrame.unionByName, parts)
    ring, metres = F.get(F.get("geometry", F.lit(0)), F.lit(0)), lambda c: F.abs(area(reproject(F.col(c), WGS84, LV95)))
    flat = lambda c: F.flatten(F.flatten(c))
    return rows.select(
        "level", "snapshot_date", "id", "name", "kanton_bfs_id", "mode",
        ((F.get(ring, F.lit(0)) == F.element_at(ring, -1)) & (F.size(ring) > 3)).cast("int").alias("closed"),
        (F.size(F.array_except(flat("geometry"), flat("border"))) == 0).cast("int").alias("of_border"),
        (F.abs(metres("geometry") - metres("border")) < 0.1 * metres("border")).cast("int").alias("near"),
    )


@entry(
    f"""WITH {_SNAPSHOTS}, {_MOMENTS}
    SELECT CAST(s AS VARCHAR) AS snapshot_date, CAST(dim.id AS BIGINT) AS gemeinde_bfs_id, CAST(hist AS BIGINT) AS gemeinde_hist_bfs_id,
           c_name AS gemeinde_name, CAST(b AS BIGINT) AS bezirk_bfs_id, CAST(kan AS BIGINT) AS kanton_bfs_id,
           round({_CENTRE_LON}, 4) AS lon, round({_CENTRE_LAT}, 4) AS lat
    FROM dim JOIN m ON m.id = dim.id JOIN customer ON c_custkey = dim.id WHERE year(s) = 2000"""
)
def areas_of_year(spark: SparkSession, d: str) -> DataFrame:
    """The complete dimension as written, listed for one year with centres."""
    out = list_geo(read_geo_dim(spark, "polg", dimensions(spark, d), 2000), "polg", 2000, "point")
    return out.select("*", F.col("geometry.x").alias("lon"), F.col("geometry.y").alias("lat")).drop("geometry")
