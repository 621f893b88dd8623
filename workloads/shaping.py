"""Filters, joins, de-duplication, reshaping and paging."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from regiofact.config import FilterRule
from regiofact.functions.dates import period_bounds
from regiofact.operators.filters import any_pattern, known_level, publishable, rules_hold
from regiofact.operators.joins import expand_ancestors, map_code, resolve_by_name
from regiofact.operators.numbering import SortKey, page, page_after, place_of
from regiofact.operators.quality import qa_counts
from regiofact.operators.reshape import (
    distinct_on,
    fan_out,
    fill_last_known,
    keep_last,
    last_known,
    latest_per_entity,
    melt,
    snapshot_grid,
    union_tagged,
    unpivot_text,
)
from regiofact.plans.indicators import route_value
from regiofact.session import materialize
from workloads.base import LINES, entry, lines, money, table


@entry(
    """SELECT CAST(o_orderkey AS BIGINT) AS o_orderkey FROM orders
       WHERE regexp_matches(o_orderpriority, 'URG|HIGH|LOW') AND o_orderstatus = 'F'
         AND (regexp_matches(CAST(o_custkey AS VARCHAR), '^1\\d+$') OR regexp_matches(CAST(o_custkey AS VARCHAR), '7$'))"""
)
def rule_filter(spark: SparkSession, d: str) -> DataFrame:
    """All configured rules and at least one of several patterns."""
    rules = [
        FilterRule("o_orderpriority", regex="URG|HIGH|LOW"),
        FilterRule("o_orderstatus", exact_match="F"),
    ]
    paths = any_pattern(F.col("o_custkey").cast("string"), [r"^1\d+$", "7$"])
    return table(spark, d, "orders").filter(rules_hold(rules) & paths).select("o_orderkey")


@entry(
    """WITH t AS (SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'polg' WHEN 'O' THEN 'kant' ELSE 'lreg' END AS lv,
              year(o_orderdate) AS y FROM orders)
       SELECT CAST(o_orderkey AS BIGINT) AS o_orderkey, lv || y AS nivgeo FROM t WHERE lv IN ('polg', 'kant')"""
)
def level_filter(spark: SparkSession, d: str) -> DataFrame:
    """Supported levels, by value and by prefix."""
    level = F.when(F.col("o_orderstatus") == "F", "polg").when(
        F.col("o_orderstatus") == "O", "kant"
    ).otherwise("lreg")
    o = table(spark, d, "orders").withColumn("lv", level)
    o = o.withColumn("nivgeo", F.concat("lv", F.year("o_orderdate").cast("string")))
    kept = o.filter(known_level(F.col("lv")) & known_level(F.col("nivgeo"), prefix=True))
    return kept.select("o_orderkey", "nivgeo")


@entry(
    f"""WITH {LINES}
    SELECT CAST(o_orderkey AS BIGINT) AS o_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber FROM lines
    WHERE l_linestatus = 'O' AND tax > 0 AND (disc > 0 OR l_returnflag <> 'N')"""
)
def publishable_rows(spark: SparkSession, d: str) -> DataFrame:
    """Municipality rows with a number and a value."""
    rows = lines(spark, d).select(
        "o_orderkey", "l_linenumber",
        F.when(F.col("l_linestatus") == "O", "polg").otherwise("bezk").alias("geo_code"),
        F.when(F.col("tax") > 0, F.col("o_custkey")).alias("geo_value"),
        F.when(F.col("disc") > 0, F.col("v")).alias("indicator_value_numeric"),
        F.when(F.col("l_returnflag") != "N", F.col("l_returnflag")).alias("indicator_value_text"),
    )
    return rows.filter(publishable()).select("o_orderkey", "l_linenumber")


@entry(
    """SELECT CAST(o_orderkey AS BIGINT) AS o_orderkey,
       CAST(CASE o_orderpriority WHEN '1-URGENT' THEN 106 WHEN '3-MEDIUM' THEN 107 END AS BIGINT) AS indicator_id
       FROM orders WHERE o_orderpriority IN ('1-URGENT', '3-MEDIUM')"""
)
def coded_indicators(spark: SparkSession, d: str) -> DataFrame:
    """Codes become indicator ids; other codes are dropped."""
    o = table(spark, d, "orders")
    coded = map_code(o, "o_orderpriority", {"1-URGENT": 106, "3-MEDIUM": 107})
    return coded.select("o_orderkey", "indicator_id")


@entry(
    """SELECT CAST(o_orderkey AS BIGINT) AS o_orderkey, CAST(1 AS BIGINT) AS indicator_id,
              CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) AS indicator_value_numeric, NULL AS indicator_value_text
       FROM orders WHERE o_orderstatus <> 'P'
       UNION ALL
       SELECT CAST(o_orderkey AS BIGINT), 2, NULL, CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR)
       FROM orders WHERE o_orderstatus <> 'F'"""
)
def value_routes(spark: SparkSession, d: str) -> DataFrame:
    """Values as numbers for one indicator and as texts for another, in one pass."""
    value = money("o_totalprice")

    def rule(n: int, numeric: bool, without: str):
        return F.col("o_orderstatus") != without, {
            "o_orderkey": F.col("o_orderkey"),
            "indicator_id": F.lit(n),
            **route_value(value, numeric),
        }

    return fan_out(table(spark, d, "orders"), [rule(1, True, "P"), rule(2, False, "F")])


@entry(
    """WITH t AS (SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS a,
              CAST(year(o_orderdate) + CASE o_orderstatus WHEN 'F' THEN 0 ELSE 2 END AS INTEGER) AS b FROM orders)
       SELECT CAST(o_orderkey AS BIGINT) AS o_orderkey, CAST(make_date(b, 12, 31) AS VARCHAR) AS due_ref,
              CASE WHEN a <> b THEN CAST(make_date(a, 1, 1) AS VARCHAR) END AS due_from,
              CAST(make_date(a, 1, 1) AS VARCHAR) AS period_from FROM t"""
)
def period_ranges(spark: SparkSession, d: str) -> DataFrame:
    """Reference periods of due dates and of periods."""
    a = F.year("o_orderdate")
    b = a + F.when(F.col("o_orderstatus") == "F", 0).otherwise(2)
    due, period = period_bounds(a, b, "duedate"), period_bounds(a, b, "period")
    return table(spark, d, "orders").select(
        "o_orderkey",
        due["period_ref"].alias("due_ref"),
        due["period_ref_from"].alias("due_from"),
        period["period_ref_from"].alias("period_from"),
    )


@entry(
    """WITH b AS (SELECT o_custkey, min(CAST(o_orderdate AS DATE)) AS f, max(CAST(o_orderdate AS DATE)) AS t
              FROM orders GROUP BY o_custkey),
       g AS (SELECT CAST(unnest(generate_series(DATE '1996-01-01', DATE '2001-03-01', INTERVAL 1 YEAR)) AS DATE) AS s)
       SELECT CAST(o_custkey AS BIGINT) AS o_custkey, CAST(s AS VARCHAR) AS snapshot_date
       FROM b JOIN g ON s BETWEEN f AND t"""
)
def yearly_snapshots(spark: SparkSession, d: str) -> DataFrame:
    """One row per 1 January within the validity of each customer."""
    bounds = table(spark, d, "orders").groupBy("o_custkey").agg(
        F.min(F.col("o_orderdate").cast("date")).alias("f"),
        F.max(F.col("o_orderdate").cast("date")).alias("t"),
    )
    grid = snapshot_grid(bounds, "f", "t", "1996-01-01", "2001-03-01")
    return grid.select("o_custkey", "snapshot_date")


@entry(
    """WITH m AS (SELECT c_mktsegment AS n, max(c_custkey) AS k FROM customer GROUP BY 1),
       t AS (SELECT o_orderkey, CASE WHEN o_orderpriority = '5-LOW' THEN 'bezk' ELSE 'polg' END AS geo_code,
              CASE WHEN o_orderstatus = 'F' THEN o_custkey END AS geo_value, c_mktsegment AS geo_value_name
              FROM orders JOIN customer ON o_custkey = c_custkey)
       SELECT CAST(o_orderkey AS BIGINT) AS o_orderkey, geo_code,
              CAST(coalesce(geo_value, CASE WHEN geo_code = 'polg' THEN k END) AS BIGINT) AS geo_value
       FROM t LEFT JOIN m ON geo_value_name = n"""
)
def name_lookup(spark: SparkSession, d: str) -> DataFrame:
    """Missing numbers found by name, the highest number of a shared name."""
    o, c = table(spark, d, "orders"), table(spark, d, "customer")
    rows = o.join(c, o.o_custkey == c.c_custkey).select(
        "o_orderkey",
        F.when(F.col("o_orderpriority") == "5-LOW", "bezk").otherwise("polg").alias("geo_code"),
        F.when(F.col("o_orderstatus") == "F", F.col("o_custkey")).alias("geo_value"),
        F.col("c_mktsegment").alias("geo_value_name"),
    )
    return resolve_by_name(rows, c, name="c_mktsegment", number="c_custkey").drop("geo_value_name")


@entry(
    """SELECT CAST(o_orderkey AS BIGINT) AS o_orderkey, o_orderpriority FROM orders o
       WHERE year(o_orderdate) = (SELECT max(year(i.o_orderdate)) FROM orders i WHERE i.o_custkey = o.o_custkey)"""
)
def latest_rows(spark: SparkSession, d: str) -> DataFrame:
    """Orders of each customer's last year, all of them."""
    o = table(spark, d, "orders").select(
        "o_orderkey", "o_orderpriority", "o_custkey", F.year("o_orderdate").alias("y")
    )
    return latest_per_entity(o, "o_custkey", "y").select("o_orderkey", "o_orderpriority")


@entry(
    """SELECT CAST(l_orderkey AS BIGINT) AS l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber,
       's' || s_suppkey AS mother_0_id, s_name AS mother_0_name, 'n' || n_nationkey AS mother_1_id, n_name AS mother_1_name,
       'r' || r_regionkey AS mother_2_id, r_name AS mother_2_name
       FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
       JOIN region ON n_regionkey = r_regionkey"""
)
def ancestor_columns(spark: SparkSession, d: str) -> DataFrame:
    """Every line with the chain supplier, nation, region above it."""

    def node(prefix: str, c: str) -> F.Column:
        return F.concat(F.lit(prefix), F.col(c).cast("string"))

    s, n, r = (table(spark, d, t) for t in ("supplier", "nation", "region"))
    edges = (
        s.select(node("s", "s_suppkey").alias("child_id"), F.col("s_name").alias("child_name"),
                 node("n", "s_nationkey").alias("structure_id"))
        .union(n.select(node("n", "n_nationkey"), "n_name", node("r", "n_regionkey")))
        .union(r.select(node("r", "r_regionkey"), "r_name", F.lit("root")))
    )
    maps = table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", node("s", "l_suppkey").alias("structure_id")
    )
    return expand_ancestors(maps, edges)


_NULLABLE = """t AS (SELECT o_orderkey, o_custkey, CASE WHEN o_orderstatus <> 'F' THEN o_orderpriority END AS p,
    CASE WHEN o_orderpriority = '5-LOW' THEN o_orderstatus END AS s FROM orders)"""
_KNOWN = """k AS (SELECT o_custkey, arg_max(p, o_orderkey) FILTER (WHERE p IS NOT NULL) AS kp,
    arg_max(s, o_orderkey) FILTER (WHERE s IS NOT NULL) AS ks FROM t GROUP BY o_custkey)"""


def _nullable(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").select(
        "o_orderkey", "o_custkey",
        F.when(F.col("o_orderstatus") != "F", F.col("o_orderpriority")).alias("p"),
        F.when(F.col("o_orderpriority") == "5-LOW", F.col("o_orderstatus")).alias("s"),
    )


@entry(
    f"""WITH {_NULLABLE}, {_KNOWN} SELECT CAST(o_custkey AS BIGINT) AS o_custkey, kp AS p, ks AS s FROM k"""
)
def last_known_values(spark: SparkSession, d: str) -> DataFrame:
    """The newest non-NULL value of every customer and column."""
    return last_known(_nullable(spark, d), "o_custkey", "o_orderkey", ["p", "s"])


@entry(
    f"""WITH {_NULLABLE}, {_KNOWN} SELECT CAST(o_orderkey AS BIGINT) AS o_orderkey, coalesce(p, kp) AS p, coalesce(s, ks) AS s
    FROM t JOIN k USING (o_custkey)"""
)
def filled_last_known(spark: SparkSession, d: str) -> DataFrame:
    """NULLs replaced by the newest known value."""
    filled = fill_last_known(_nullable(spark, d), "o_custkey", "o_orderkey", ["p", "s"])
    return filled.drop("o_custkey")


@entry(
    """SELECT CAST(l_orderkey AS BIGINT) AS l_orderkey, l_returnflag, CAST(l_linenumber AS BIGINT) AS l_linenumber,
              CAST(l_partkey AS BIGINT) AS l_partkey
       FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_returnflag
           ORDER BY l_extendedprice DESC, l_linenumber, l_partkey, l_suppkey) = 1"""
)
def first_per_key(spark: SparkSession, d: str) -> DataFrame:
    """The dearest line of each order and flag."""
    order = [F.col("l_extendedprice").desc(), *[F.col(c).asc() for c in ("l_linenumber", "l_partkey", "l_suppkey")]]
    one = distinct_on(table(spark, d, "lineitem"), ["l_orderkey", "l_returnflag"], order)
    return one.select("l_orderkey", "l_returnflag", "l_linenumber", "l_partkey")


@entry(
    """SELECT CAST(o_custkey AS BIGINT) AS gem_no, CAST(year(o_orderdate) AS BIGINT) AS duedate, CAST(max(o_orderkey) AS BIGINT) AS seq,
       arg_max(o_orderstatus, o_orderkey) AS status FROM orders GROUP BY ALL"""
)
def duplicates_keep_last(spark: SparkSession, d: str) -> DataFrame:
    """Repeated (duedate, area) loads, the last one kept."""
    o = table(spark, d, "orders").select(
        F.col("o_custkey").alias("gem_no"), F.year("o_orderdate").alias("duedate"),
        F.col("o_orderkey").alias("seq"), F.col("o_orderstatus").alias("status"),
    )
    return keep_last(o, ["duedate", "gem_no"], ["seq"])


@entry(
    """SELECT CAST(1 AS BIGINT) AS src_order, CAST(c_nationkey AS BIGINT) AS nation, c_name AS name FROM customer
       UNION ALL SELECT 2, s_nationkey, s_name FROM supplier"""
)
def tagged_union(spark: SparkSession, d: str) -> DataFrame:
    """Customers and suppliers with their precedence."""
    c = table(spark, d, "customer").select(F.col("c_nationkey").alias("nation"), F.col("c_name").alias("name"))
    s = table(spark, d, "supplier").select(F.col("s_name").alias("name"), F.col("s_nationkey").alias("nation"))
    return union_tagged(c, s).select("src_order", "nation", "name")


@entry(
    """SELECT CAST(l_suppkey AS BIGINT) AS k, l_returnflag AS f FROM lineitem
       UNION SELECT CAST(o_custkey AS BIGINT), o_orderstatus FROM orders"""
)
def distinct_union(spark: SparkSession, d: str) -> DataFrame:
    """UNION of two tables without duplicates."""
    a = table(spark, d, "lineitem").select(F.col("l_suppkey").alias("k"), F.col("l_returnflag").alias("f"))
    b = table(spark, d, "orders").select(F.col("o_custkey").alias("k"), F.col("o_orderstatus").alias("f"))
    return a.union(b).distinct()


@entry(
    """SELECT CAST(l_orderkey AS BIGINT) AS l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber,
       CAST(unnest([101, 104, 105]) AS BIGINT) AS indicator_id,
       CAST(unnest([l_quantity, round(l_discount * 100), round(l_tax * 100)]) AS DOUBLE) AS indicator_value_numeric FROM lineitem"""
)
def melted_measures(spark: SparkSession, d: str) -> DataFrame:
    """Measure columns as indicator rows, in one scan."""
    li = table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity",
        F.round(F.col("l_discount") * 100).alias("disc"), F.round(F.col("l_tax") * 100).alias("tax"),
    )
    return melt(li, ["l_orderkey", "l_linenumber"], {"l_quantity": 101, "disc": 104, "tax": 105})


@entry(
    """SELECT CAST(o_orderkey AS BIGINT) AS "GemeindeID", CAST(year(o_orderdate) AS BIGINT) AS "Steuerperiode",
       unnest(['Anzahl', 'Klasse']) AS indicator, unnest([CAST(o_custkey AS VARCHAR), o_orderpriority]) AS indicator_value FROM orders"""
)
def unpivoted_text(spark: SparkSession, d: str) -> DataFrame:
    """All other columns as (name, text) rows."""
    o = table(spark, d, "orders").select(
        F.col("o_orderkey").alias("GemeindeID"), F.year("o_orderdate").alias("Steuerperiode"),
        F.col("o_orderstatus").alias("Kanton"), F.col("o_custkey").alias("Anzahl"),
        F.col("o_orderpriority").alias("Klasse"),
    )
    return unpivot_text(o, ["GemeindeID", "Steuerperiode"], ["Kanton"])


@entry(
    f"""WITH {LINES} SELECT l_returnflag, o_orderpriority, count(*) AS n_rows, count(DISTINCT o_custkey) AS n_entities
    FROM lines GROUP BY ALL"""
)
def row_counts(spark: SparkSession, d: str) -> DataFrame:
    """Rows and distinct areas per variable."""
    return qa_counts(lines(spark, d), ["l_returnflag", "o_orderpriority"], "o_custkey")


_PAGE = """SELECT CAST(o_orderkey AS BIGINT) AS o_orderkey, CAST(o_custkey AS BIGINT) AS o_custkey FROM orders
       ORDER BY o_custkey, o_orderkey"""


@entry(f"{_PAGE} LIMIT 250 OFFSET 1000")
def page_of_rows(spark: SparkSession, d: str) -> DataFrame:
    """A page near the start."""
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey")
    return page(o, [F.col("o_custkey"), F.col("o_orderkey")], 1000, 250)


@entry(f"{_PAGE} OFFSET 1200")
def page_to_end(spark: SparkSession, d: str) -> DataFrame:
    """Everything after the first rows, numbered without one sorting task."""
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey")
    return page(o, [F.col("o_custkey"), F.col("o_orderkey")], 1200)


@entry(
    """SELECT CAST(row_number() OVER w AS BIGINT) AS place, CAST((row_number() OVER w - 1) // 400 AS BIGINT) AS page, o_orderkey, priority FROM (
        SELECT o_orderkey, CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderpriority END AS priority FROM orders
    ) WINDOW w AS (ORDER BY priority DESC NULLS LAST, o_orderkey) QUALIFY place <= 2000"""
)
def pages_by_place(spark: SparkSession, d: str) -> DataFrame:
    """The first five pages of 400 rows, each from the place where the one before ended."""
    o = table(spark, d, "orders").select("o_orderkey", F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority")).alias("priority"))
    order, after, pages = [SortKey("priority", ascending=False), SortKey("o_orderkey")], None, []
    for n in range(5):
        rows = materialize(page_after(o, order, 400, after))
        pages.append(rows.withColumn("page", F.lit(n)))
        after = place_of(rows, order, after)
    given = reduce(DataFrame.unionAll, pages)
    # 2000 rows at most
    within = Window.orderBy("page", F.col("priority").desc_nulls_last(), "o_orderkey")
    return given.select(F.row_number().over(within).alias("place"), "page", "o_orderkey", "priority")
