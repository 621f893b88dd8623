"""Registry of queries, plain result types, and inputs shared by several queries."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from regiofact.functions.geometry import bound, point
from regiofact.session import many, spread
from regiofact.sources.releases import save_parquet

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def entry(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function name, with its SQL if there is one."""

    def add(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return plain(fn(spark, sf_dir))

        run.__doc__ = fn.__doc__
        QUERIES[fn.__name__] = run
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn

    return add


def plain(df: DataFrame) -> DataFrame:
    """Result columns as integers, doubles and text only, so any engine compares."""

    def one(c: Column, kind: T.DataType) -> Column:
        if isinstance(kind, (T.DateType, T.BooleanType)):
            return c.cast("string")
        if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
            return F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        if isinstance(kind, T.DecimalType):
            return F.round(c, 4).cast("double")
        if isinstance(kind, (T.DoubleType, T.FloatType)):
            return F.round(c.cast("double"), 4)
        if isinstance(kind, T.IntegralType):
            return c.cast("bigint")
        if isinstance(kind, T.ArrayType):
            return F.array_join(c.cast("array<string>"), ",", "NULL")
        return c

    return df.select(*[one(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in df.schema])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def money(name: str) -> Column:
    return F.col(name).cast("decimal(18,2)")


class Interrupted(Exception):
    """Ends a publication where a driver would have died."""


def ends_after(writes: int):
    """A way of writing that does ``writes`` tables, then part of the next one, and ends."""
    left = [writes]

    def save(writer, path):
        left[0] -= 1
        if left[0] < 0:
            raise Interrupted(path)
        save_parquet(writer, path)

    return save


# ---------------------------------------------------------------------------
# Order lines with their order: the raw material of most indicators.
LINES = """
lines AS (
    SELECT o_orderkey, o_custkey, l_suppkey, l_linenumber,
           CAST(year(o_orderdate) AS INTEGER) AS y, o_orderpriority, o_orderstatus,
           l_returnflag, l_linestatus, CAST(l_extendedprice AS DECIMAL(18,2)) AS v,
           CAST(l_quantity AS BIGINT) AS q, CAST(round(l_discount * 100) AS BIGINT) AS disc,
           CAST(round(l_tax * 100) AS BIGINT) AS tax,
           CAST(o_orderdate AS DATE) AS od, CAST(l_shipdate AS DATE) AS sd
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey
)"""


def line_count(spark: SparkSession, sf_dir: str) -> int:
    """How many lines there are, from the files' footers."""
    return table(spark, sf_dir, "lineitem").count()


#: Lines, which are narrow, that a task of their join takes.
LINES_PER_TASK = 1_000_000


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    li, o = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    li = spread(li, line_count(spark, sf_dir), "l_orderkey", per_task=LINES_PER_TASK, joined=True)
    joined = li.join(o, li.l_orderkey == o.o_orderkey)
    return joined.select(
        "o_orderkey", "o_custkey", "l_suppkey", "l_linenumber",
        F.year("o_orderdate").alias("y"), "o_orderpriority", "o_orderstatus",
        "l_returnflag", "l_linestatus", money("l_extendedprice").alias("v"),
        F.col("l_quantity").cast("bigint").alias("q"),
        F.round(F.col("l_discount") * 100).cast("bigint").alias("disc"),
        F.round(F.col("l_tax") * 100).cast("bigint").alias("tax"),
        F.col("o_orderdate").cast("date").alias("od"),
        F.col("l_shipdate").cast("date").alias("sd"),
    )


# ---------------------------------------------------------------------------
# The indicator fact of the mart queries: sales per customer, year, return flag and
# order status, first as provisional figure (lines shipped within the year), half a
# year later as revised figure (all lines).
SALES = f"""{LINES}, sums AS (
    SELECT CAST(100 + CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS INTEGER) AS indicator_id,
           o_custkey AS geo_value, y, l_returnflag AS g1, o_orderstatus AS g2,
           'Office of ' || o_orderpriority AS source,
           sum(v) FILTER (WHERE sd <= make_date(y, 12, 31)) AS v0, sum(v) AS v1
    FROM lines GROUP BY ALL
), sales AS (
    SELECT indicator_id, geo_value, y, g1, g2, source, v0 AS v,
           make_date(y + 1, 1, 1) AS kfrom, make_date(y + 1, 7, 1) AS kto
    FROM sums WHERE v0 IS NOT NULL
    UNION ALL
    SELECT indicator_id, geo_value, y, g1, g2, source, v1, make_date(y + 1, 7, 1), NULL
    FROM sums
)"""


def sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales as indicator rows before totals and measures."""
    year_end = F.make_date("y", F.lit(12), F.lit(31))
    # a customer's lines lie together, so neither the sums nor totals over groups shuffle again
    sums = (
        spread(lines(spark, sf_dir), line_count(spark, sf_dir), "o_custkey")
        .groupBy("o_orderpriority", "o_custkey", "y", "l_returnflag", "o_orderstatus")
        .agg(
            F.sum(F.when(F.col("sd") <= year_end, F.col("v"))).alias("v0"),
            F.sum("v").alias("v1"),
        )
    )
    mid = F.make_date(F.col("y") + 1, F.lit(7), F.lit(1))

    def figure(value: str, start: Column, end: Column) -> Column:
        return F.struct(
            F.col(value).alias("v"),
            start.cast("timestamp_ntz").alias("kfrom"),
            end.cast("timestamp_ntz").alias("kto"),
        )

    provisional = figure("v0", F.make_date(F.col("y") + 1, F.lit(1), F.lit(1)), mid)
    revised = figure("v1", mid, F.lit(None))
    rows = sums.select("*", F.explode(F.array(provisional, revised)).alias("f"))
    none = F.lit(None).cast("string")
    return rows.filter(F.col("f.v").isNotNull()).select(
        (F.substring("o_orderpriority", 1, 1).cast("int") + 100).alias("indicator_id"),
        F.lit("polg").alias("geo_code"),
        F.col("o_custkey").alias("geo_value"),
        F.col("f.kfrom").alias("knowledge_date_from"),
        F.col("f.kto").alias("knowledge_date_to"),
        F.lit("duedate").alias("period_type"),
        F.lit("year").alias("period_code"),
        F.lit(None).cast("date").alias("period_ref_from"),
        year_end.alias("period_ref"),
        F.lit("Return flag").alias("group_1_name"),
        F.col("l_returnflag").alias("group_1_value"),
        F.lit("Order status").alias("group_2_name"),
        F.col("o_orderstatus").alias("group_2_value"),
        none.alias("group_3_name"), none.alias("group_3_value"),
        none.alias("group_4_name"), none.alias("group_4_value"),
        F.col("f.v").cast("decimal(38,18)").alias("indicator_value_numeric"),
        none.alias("indicator_value_text"),
        F.concat(F.lit("Office of "), "o_orderpriority").alias("source"),
        F.lit(1).alias("_etl_version"),
    )


# Rows and totals over both groups, as SQL on top of SALES.
TOTALS = """totals AS (
    SELECT indicator_id, geo_value, y, source, kfrom, kto,
           CASE WHEN grouping(g1) = 1 THEN 'GROUP TOTAL' ELSE g1 END AS g1,
           CASE WHEN grouping(g2) = 1 THEN 'GROUP TOTAL' ELSE g2 END AS g2,
           sum(v) AS v
    FROM sales
    GROUP BY indicator_id, geo_value, y, source, kfrom, kto, ROLLUP (g1, g2)
)"""

# Persons per area and year: the finished orders of a customer.
PEOPLE = """people AS (
    SELECT o_custkey AS geo_value, CAST(year(o_orderdate) AS INTEGER) AS y, count(*) AS pop
    FROM orders WHERE o_orderstatus = 'F' GROUP BY ALL
)"""


def people(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    counted = o.filter("o_orderstatus = 'F'").groupBy("o_custkey", F.year("o_orderdate").alias("y")).count()
    if many(spark, o.count()):  # too many to broadcast: facts that meet them hashed need not be sorted
        counted = counted.hint("shuffle_hash")
    return counted.select(
        F.lit("polg").alias("geo_code"),
        F.col("o_custkey").alias("geo_value"),
        F.make_date("y", F.lit(12), F.lit(31)).alias("period_ref"),
        F.col("count").cast("decimal(38,18)").alias("indicator_value_numeric"),
    )


# ---------------------------------------------------------------------------
# Borders: area n is a cell of a grid in LV95 metres whose border vertices are shifted
# by a function of their place, so neighbours share them exactly.
GRID_WIDTH = 200


def cell(n: Column, size: int = 1000) -> Column:
    """Border of area ``n`` as polygon column."""
    i, j = F.pmod(n, F.lit(GRID_WIDTH)), F.floor(n / GRID_WIDTH)

    def vertex(k: Column) -> Column:
        a = 4 * i + F.when(k <= 4, k).when(k <= 8, 4).when(k <= 12, 12 - k).otherwise(0)
        b = 4 * j + F.when(k <= 4, 0).when(k <= 8, k - 4).when(k <= 12, 4).otherwise(16 - k)
        return bound(F.struct(a.alias("a"), b.alias("b")), placed)

    def placed(s: Column) -> Column:
        a, b = s["a"], s["b"]
        x = 2600000 + a * (size // 4) + F.pmod(a * 37 + b * 101, F.lit(61))
        y = 1100000 + b * (size // 4) + F.pmod(a * 53 + b * 29, F.lit(61))
        return point(x, y)

    ring = F.transform(F.sequence(F.lit(0), F.lit(16)), vertex)
    return F.array(F.array(ring))


def cell_sql(n: str, size: int = 1000) -> str:
    """The same ring as SQL: a list of structs."""
    a = (
        f"(4 * (({n}) % {GRID_WIDTH}) + CASE WHEN k <= 4 THEN k WHEN k <= 8 THEN 4 "
        "WHEN k <= 12 THEN 12 - k ELSE 0 END)"
    )
    b = (
        f"(4 * (({n}) // {GRID_WIDTH}) + CASE WHEN k <= 4 THEN 0 WHEN k <= 8 THEN k - 4 "
        "WHEN k <= 12 THEN 4 ELSE 16 - k END)"
    )
    return (
        f"list_transform(range(17), lambda k: {{"
        f"'x': CAST(2600000 + {a} * {size // 4} + ({a} * 37 + {b} * 101) % 61 AS DOUBLE), "
        f"'y': CAST(1100000 + {b} * {size // 4} + ({a} * 53 + {b} * 29) % 61 AS DOUBLE)}})"
    )


def to_wgs84_sql(x: str, y: str) -> tuple[str, str]:
    """(longitude, latitude) expressions for LV95 coordinates, by the published definition."""
    e2, axis = 0.006674372230614, 6377397.155
    lat0, lon0 = math.radians(46 + 57 / 60 + 8.66 / 3600), math.radians(7 + 26 / 60 + 22.50 / 3600)
    e, alpha = math.sqrt(e2), math.sqrt(1 + e2 / (1 - e2) * math.cos(lat0) ** 4)
    radius, b0 = axis * math.sqrt(1 - e2) / (1 - e2 * math.sin(lat0) ** 2), math.asin(math.sin(lat0) / alpha)
    k = math.log(math.tan(math.pi / 4 + b0 / 2)) - alpha * math.log(math.tan(math.pi / 4 + lat0 / 2))
    k += alpha * e / 2 * math.log((1 + e * math.sin(lat0)) / (1 - e * math.sin(lat0)))
    # sphere: b and l; ellipsoid: phi by rounds; then geocentric, shifted, and down to the other ellipsoid
    bar = f"{{'i': ({x} - 2600000.0) / {radius!r}, 'b': 2 * (atan(exp(({y} - 1200000.0) / {radius!r})) - pi() / 4)}}"
    sphere = (
        f"{{'b': asin({math.cos(b0)!r} * sin(geo_.b) + {math.sin(b0)!r} * cos(geo_.b) * cos(geo_.i)),"
        f" 'l': atan2(sin(geo_.i), {math.cos(b0)!r} * cos(geo_.i) - {math.sin(b0)!r} * tan(geo_.b))}}"
    )
    phi = "geo_.b"
    for _ in range(8):
        phi = f"(2 * atan(exp((ln(tan(pi() / 4 + geo_.b / 2)) - {k!r}) / {alpha!r} + {e!r} * ln(tan(pi() / 4 + asin({e!r} * sin({phi})) / 2)))) - pi() / 2)"
    ellipsoid = f"{{'phi': {phi}, 'l': {lon0!r} + geo_.l / {alpha!r}}}"
    normal = f"({axis!r} / sqrt(1 - {e2!r} * sin(geo_.phi) * sin(geo_.phi)))"
    centred = (
        f"{{'x': {normal} * cos(geo_.phi) * cos(geo_.l) + 674.374, 'y': {normal} * cos(geo_.phi) * sin(geo_.l) + 15.056,"
        f" 'z': {normal} * {1 - e2!r} * sin(geo_.phi) + 405.346}}"
    )
    f = 1 / 298.257223563
    w2, big = f * (2 - f), 6378137.0
    # the latitude under a point, by rounds from its direction
    lat = f"atan2(geo_.z, sqrt(geo_.x * geo_.x + geo_.y * geo_.y) * {1 - w2!r})"
    for _ in range(4):
        lat = f"list_transform([{lat}], lambda p: atan2(geo_.z + {w2 * big!r} / sqrt(1 - {w2!r} * sin(p) * sin(p)) * sin(p), sqrt(geo_.x * geo_.x + geo_.y * geo_.y)))[1]"

    def chain(last: str) -> str:
        value = bar
        for step in (sphere, ellipsoid, centred, last):
            value = f"list_transform([{value}], lambda geo_: {step})[1]"
        return value

    return chain("degrees(atan2(geo_.y, geo_.x))"), chain(f"degrees({lat})")
