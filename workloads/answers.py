"""The mart and the questions asked of it.

The warehouse is written once per session and data folder, as it would be in use;
the queries read the written tables.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regiofact.config import CubeFamily, MeasureSpec, atlas_indicator
from regiofact.operators.coverage import coverage_shapes, with_shapes
from regiofact.operators.filters import known_at
from regiofact.operators.history import VALID_FROM
from regiofact.operators.measures import expand_measures
from regiofact.operators.totals import build_totals
from regiofact.plans.geo_dims import TOLERANCES, in_wgs84, join_geo
from regiofact.plans.mart import available_indicators, decode, new_dictionaries
from regiofact.plans.queries import (
    Warehouse,
    get_indicator,
    get_indicators,
    get_portrait,
    get_values,
    topic_edges,
)
from regiofact.plans.staging import typecast
from regiofact.plans.warehouse import (
    atlas_family,
    cube_family,
    measured,
    publish,
    publish_to,
    released_warehouse,
)
from regiofact.schemas import INTM_MEASURED, MART, widened
from regiofact.session import drop_steps, materialize, new_path
from regiofact.sources.files import read_mart
from workloads.base import (
    LINES,
    ORACLES,
    PEOPLE,
    SALES,
    TOTALS,
    Interrupted,
    cell,
    cell_sql,
    ends_after,
    entry,
    line_count,
    money,
    people,
    sales,
    table,
    to_wgs84_sql,
)
from workloads.facts import CUBE_INDICATORS, WIDE, atlas_rows, atlas_v1, atlas_v2, cube_history
from workloads.geography import _MOMENTS

WIDE_FACT = widened(INTM_MEASURED, geo_value="bigint")
WIDE_MART = widened(MART, geo_value="bigint")
TODAY = dt.date(2025, 6, 30)

_STORES: dict[tuple[str, str], Warehouse] = {}
_COMPLETE: dict[tuple[str, str], Warehouse] = {}


def _coarse_facts(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Amounts per nation and year, and order counts per region and year as texts."""
    o, c, n = (table(spark, d, t) for t in ("orders", "customer", "nation"))
    placed = o.join(c, o.o_custkey == c.c_custkey).join(n, c.c_nationkey == n.n_nationkey)
    year = F.year("o_orderdate").alias("y")
    none = F.lit(None).cast("string")

    def shape(df: DataFrame, indicator: int, level: str, area: str, numeric: bool) -> DataFrame:
        value = F.col("value")
        return df.select(
            F.lit(indicator).alias("indicator_id"), F.lit(level).alias("geo_code"), F.col(area).alias("geo_value"),
            F.make_date(F.col("y") + 1, F.lit(1), F.lit(1)).cast("timestamp_ntz").alias("knowledge_date_from"),
            F.lit(None).cast("timestamp_ntz").alias("knowledge_date_to"),
            F.lit("period").alias("period_type"), F.lit("year").alias("period_code"),
            F.make_date("y", F.lit(1), F.lit(1)).alias("period_ref_from"),
            F.make_date("y", F.lit(12), F.lit(31)).alias("period_ref"),
            *[none.alias(f"group_{i}_{p}") for i in range(1, 5) for p in ("name", "value")],
            (value if numeric else F.lit(None)).cast("decimal(38,18)").alias("indicator_value_numeric"),
            (F.lit(None) if numeric else value).cast("string").alias("indicator_value_text"),
            F.lit("Nation office").alias("source"), F.lit(1).alias("_etl_version"),
        )

    amounts = placed.groupBy("c_nationkey", year).agg(F.sum(money("o_totalprice")).alias("value"))
    counts = placed.groupBy("n_regionkey", year).agg(F.count(F.lit(1)).alias("value"))
    return (
        shape(amounts, 110, "bezk", "c_nationkey", True),
        shape(counts, 120, "kant", "n_regionkey", False),
    )


def catalogue(spark: SparkSession, d: str) -> DataFrame:
    """Indicator catalogue from the order priorities."""
    none = F.lit(None).cast("string")
    digit = F.substring("o_orderpriority", 1, 1).cast("int")
    named = table(spark, d, "orders").select("o_orderpriority").distinct().select(
        (digit + 100).alias("indicator_id"),
        F.col("o_orderpriority").alias("indicator_name"),
        F.lit("01 Orders").alias("topic_1"),
        F.when(digit <= 2, "01.01 Fast").otherwise("01.02 Slow").alias("topic_2"),
        F.when(digit <= 1, "Immediate").alias("topic_3"), none.alias("topic_4"),
        F.lit("CHF").alias("indicator_unit"), F.lit("Sales").alias("indicator_description"),
    )
    coarse = named.agg(F.count(F.lit(1)).alias("n")).select(
        F.explode(F.array(F.lit(110), F.lit(120))).alias("indicator_id")
    ).select(
        "indicator_id", F.lit("Volume").alias("indicator_name"), F.lit("02 Volume").alias("topic_1"),
        none.alias("topic_2"), none.alias("topic_3"), none.alias("topic_4"),
        F.lit("CHF").alias("indicator_unit"), F.lit("Volume").alias("indicator_description"),
    )
    return named.unionByName(coarse)


_SEED = """seed AS (
    SELECT DISTINCT 100 + CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS indicator_id, o_orderpriority AS indicator_name,
           '01 Orders' AS topic_1, CASE WHEN substr(o_orderpriority, 1, 1) <= '2' THEN '01.01 Fast' ELSE '01.02 Slow' END AS topic_2,
           CASE WHEN substr(o_orderpriority, 1, 1) <= '1' THEN 'Immediate' END AS topic_3, CAST(NULL AS VARCHAR) AS topic_4,
           'CHF' AS indicator_unit, 'Sales' AS indicator_description FROM orders
    UNION ALL SELECT i, 'Volume', '02 Volume', NULL, NULL, NULL, 'CHF', 'Volume' FROM (VALUES (110), (120)) t(i)
)"""


def _areas(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    """Latest areas of the three levels; customers in debt have no district."""
    c, n, r = (table(spark, d, t) for t in ("customer", "nation", "region"))

    placed = c.join(n, c.c_nationkey == n.n_nationkey)
    polg = placed.select(
        F.col("c_custkey").alias("gemeinde_bfs_id"), F.col("c_name").alias("gemeinde_name"),
        F.when(F.col("c_acctbal") >= 0, F.col("c_nationkey")).alias("bezirk_bfs_id"),
        F.col("n_regionkey").alias("kanton_bfs_id"),
    )
    bezk = n.select(
        F.col("n_nationkey").alias("bezirk_bfs_id"), F.col("n_name").alias("bezirk_name"),
        F.col("n_regionkey").alias("kanton_bfs_id"),
    )
    kant = r.select(F.col("r_regionkey").alias("kanton_bfs_id"), F.col("r_name").alias("kanton_name"))
    levels = {
        "polg": (polg, "gemeinde_bfs_id", 1000),
        "bezk": (bezk, "bezirk_bfs_id", 8000),
        "kant": (kant, "kanton_bfs_id", 40000),
    }
    borders = [
        df.select(F.lit(level).alias("level"), F.col(key).cast("bigint").alias("id"),
                  cell(F.col(key).cast("bigint"), size).alias("geometry"))
        for level, (df, key, size) in levels.items()
    ]
    # the levels are separate coverages, simplified together
    shaped = materialize(reduce(DataFrame.union, borders))
    rows, shapes = coverage_shapes(shaped, ["id"], "level", "geometry", TOLERANCES, lambda simple: materialize(in_wgs84(simple).drop("geometry")))
    areas = {
        level: materialize(
            df.join(with_shapes(rows.filter(F.col("level") == level), shapes).select("id", "geom_border", *TOLERANCES, "geom_center"), F.col(key) == F.col("id")).drop("id")
        )
        for level, (df, key, _) in levels.items()
    }
    drop_steps(shaped, rows, shapes)
    return areas


def fact_parts(spark: SparkSession, d: str) -> list[DataFrame]:
    """Measured indicator rows of all levels."""
    totals = build_totals(sales(spark, d), 2, "sum(indicator_value_numeric)")
    expanded = expand_measures(totals, people(spark, d), MeasureSpec("zahl", ["pro1000"]))
    amounts, counts = _coarse_facts(spark, d)
    return [
        typecast(expanded, WIDE_FACT),
        measured(amounts, people(spark, d), MeasureSpec("zahl"), WIDE_FACT),
        measured(counts, people(spark, d), None, WIDE_FACT),
    ]


def store(spark: SparkSession, d: str) -> Warehouse:
    """The written mart with its dictionaries, without areas."""
    key = (spark.sparkContext.applicationId, d)
    if key not in _STORES:
        path = new_path(spark, "mart")
        dims = publish(fact_parts(spark, d), new_dictionaries(spark), path, WIDE_MART)
        seed = materialize(catalogue(spark, d))
        _STORES[key] = Warehouse(read_mart(spark, path, WIDE_MART), dims, {}, seed)
    return _STORES[key]


def warehouse(spark: SparkSession, d: str) -> Warehouse:
    """The same with the areas of the three levels."""
    key = (spark.sparkContext.applicationId, d)
    if key not in _COMPLETE:
        _COMPLETE[key] = replace(store(spark, d), areas=_areas(spark, d))
    return _COMPLETE[key]


# ---------------------------------------------------------------------------
# The same as SQL. ``fact`` is the measured fact, ``area`` the areas with a full chain.
_FACT = f"""{SALES}, {TOTALS}, {PEOPLE}, coarse AS (
        SELECT c_nationkey AS nat, n_regionkey AS reg, CAST(year(o_orderdate) AS INTEGER) AS y, CAST(o_totalprice AS DECIMAL(18,2)) AS p
        FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
    ), fact AS (
        SELECT indicator_id, 'polg' AS geo_code, geo_value, y, source, kfrom, kto, g1, g2, 'duedate' AS period_type,
               unnest(['zahl', 'pro1000']) AS measure_code,
               unnest([CAST(v AS DOUBLE), CAST(v AS DOUBLE) * 1000 / pop]) AS num, CAST(NULL AS VARCHAR) AS txt
        FROM totals LEFT JOIN people USING (geo_value, y)
        UNION ALL
        SELECT 110, 'bezk', nat, y, 'Nation office', make_date(y + 1, 1, 1), NULL, NULL, NULL, 'period', 'zahl', CAST(sum(p) AS DOUBLE), NULL
        FROM coarse GROUP BY nat, y
        UNION ALL
        SELECT 120, 'kant', reg, y, 'Nation office', make_date(y + 1, 1, 1), NULL, NULL, NULL, 'period', NULL, NULL, CAST(count(*) AS VARCHAR)
        FROM coarse GROUP BY reg, y
    ), sources AS (SELECT source, row_number() OVER (ORDER BY source) AS source_id FROM (SELECT DISTINCT source FROM fact)),
    area AS (
        SELECT 'polg' AS geo_code, c_custkey AS geo_value, c_name AS geo_name, n_nationkey AS bez, n_name AS bez_name, r_regionkey AS kan, r_name AS kan_name
        FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey WHERE c_acctbal >= 0
        UNION ALL SELECT 'bezk', n_nationkey, n_name, NULL, NULL, r_regionkey, r_name FROM nation JOIN region ON n_regionkey = r_regionkey
        UNION ALL SELECT 'kant', r_regionkey, r_name, NULL, NULL, NULL, NULL FROM region
    ), full_fact AS (
        SELECT fact.*, source_id, geo_name, bez, bez_name, kan, kan_name
        FROM fact JOIN sources USING (source) JOIN area USING (geo_code, geo_value)
    ), {_SEED}"""
_TOTAL_1, _TOTAL_2 = "coalesce(g1, 'GROUP TOTAL') = 'GROUP TOTAL'", "coalesce(g2, 'GROUP TOTAL') = 'GROUP TOTAL'"
_OPEN = "kto IS NULL"


def _answer_sql(where: str, day: str = "2025-06-30", extra: str = "", joins: str = "", tail: str = "") -> str:
    return f"""WITH {_FACT}{', ' + _MOMENTS if 'FROM m' in joins or 'JOIN m' in joins else ''}
    SELECT CAST(f.indicator_id AS BIGINT) AS indicator_id, f.geo_code, CAST(f.geo_value AS BIGINT) AS geo_value, period_type,
           'year' AS period_code, CASE WHEN period_type = 'period' THEN y || '-01-01' END AS period_ref_from, y || '-12-31' AS period_ref,
           CASE WHEN g1 IS NOT NULL THEN 'Return flag' END AS group_1_name, g1 AS group_1_value,
           CASE WHEN g2 IS NOT NULL THEN 'Order status' END AS group_2_name, g2 AS group_2_value,
           measure_code, round(num, 4) AS indicator_value_numeric, txt AS indicator_value_text,
           CAST(source_id AS BIGINT) AS source_id, source, '{day}' AS knowledge_date{extra}
    FROM full_fact f {joins} WHERE {where} {tail}"""


def _shown(df: DataFrame) -> DataFrame:
    """Answers without the never used groups and with the border left to its own query."""
    return df.drop("geometry", *[f"group_{n}_{p}" for n in (3, 4) for p in ("name", "value")])


_GEO = ", geo_name, CAST(bez AS BIGINT) AS bezirk_bfs_id, bez_name AS bezirk_name, CAST(kan AS BIGINT) AS kanton_bfs_id, kan_name AS kanton_name"
_INFO = ", indicator_name, topic_1, topic_2, topic_3, topic_4, indicator_unit, indicator_description"
_LON, _LAT = to_wgs84_sql("(ox + mx / (3 * a))", "(oy + my / (3 * a))")


@entry(
    _answer_sql(
        f"f.indicator_id = 101 AND f.geo_code = 'polg' AND {_TOTAL_1} AND {_TOTAL_2} AND kfrom <= DATE '1999-03-01' AND (kto > DATE '1999-03-01' OR kto IS NULL)",
        "1999-03-01", f"{_GEO}{_INFO}, round({_LON}, 4) AS lon, round({_LAT}, 4) AS lat",
        "JOIN seed USING (indicator_id) JOIN m ON m.id = f.geo_value",
    )
)
def indicator_as_of(spark: SparkSession, d: str) -> DataFrame:
    """One indicator as known on a day, with area, catalogue and centre columns."""
    out = get_indicator(
        warehouse(spark, d), "polg", 101, knowledge_date="1999-03-01", with_indicator=True,
        with_geo=True, geometry_mode="point",
    )
    return _shown(out.withColumns({"lon": F.col("geometry.x"), "lat": F.col("geometry.y")}))


@entry(_answer_sql(f"f.indicator_id = 102 AND f.geo_code = 'polg' AND {_OPEN}"))
def indicator_expanded(spark: SparkSession, d: str) -> DataFrame:
    """All groups of one indicator, as known today."""
    return _shown(get_indicator(warehouse(spark, d), "polg", 102, expand_all_groups=True, today=TODAY))


@entry(_answer_sql(f"f.indicator_id = 103 AND f.geo_code = 'polg' AND {_OPEN} AND {_TOTAL_2}"))
def indicator_one_group(spark: SparkSession, d: str) -> DataFrame:
    """Only the first group expanded."""
    return _shown(get_indicator(warehouse(spark, d), "polg", 103, expand=(1,), today=TODAY))


@entry(
    _answer_sql(
        f"f.indicator_id = 104 AND f.geo_code = 'polg' AND {_OPEN} AND {_TOTAL_1} AND {_TOTAL_2} AND measure_code = 'pro1000' AND y = 1997",
        tail="ORDER BY f.geo_value LIMIT 100 OFFSET 5",
    )
)
def indicator_page(spark: SparkSession, d: str) -> DataFrame:
    """A page of one measure and period."""
    return _shown(
        get_indicator(
            warehouse(spark, d), "polg", 104, measure="pro1000", period_ref="1997-12-31",
            skip=5, limit=100, today=TODAY,
        )
    )


@entry(_answer_sql(f"f.indicator_id = 110 AND f.geo_code = 'bezk' AND {_OPEN}", extra=", geo_name, CAST(kan AS BIGINT) AS kanton_bfs_id, kan_name AS kanton_name"))
def district_indicator(spark: SparkSession, d: str) -> DataFrame:
    """A district indicator with its canton."""
    return _shown(get_indicator(warehouse(spark, d), "bezk", 110, with_geo=True, today=TODAY))


@entry(_answer_sql(f"f.indicator_id = 120 AND f.geo_code = 'kant' AND {_OPEN}", extra=", geo_name"))
def canton_text_indicator(spark: SparkSession, d: str) -> DataFrame:
    """A text indicator of cantons."""
    return _shown(get_indicator(warehouse(spark, d), "kant", 120, with_geo=True, today=TODAY))


_CORNER_LON, _CORNER_LAT = to_wgs84_sql("v.x", "v.y")


@entry(
    f"""WITH {_FACT}, shape AS (SELECT c_custkey AS geo_value, unnest({cell_sql('c_custkey')}) AS v, unnest(range(1, 18)) AS i FROM customer)
    SELECT CAST(f.geo_value AS BIGINT) AS geo_value, y || '-12-31' AS period_ref, measure_code, i,
           round(1000 * {_CORNER_LON}, 4) AS lon, round(1000 * {_CORNER_LAT}, 4) AS lat
    FROM full_fact f JOIN shape ON shape.geo_value = f.geo_value
    WHERE f.indicator_id = 105 AND f.geo_code = 'polg' AND {_OPEN} AND {_TOTAL_1} AND {_TOTAL_2}"""
)
def indicator_borders(spark: SparkSession, d: str) -> DataFrame:
    """One indicator with the full borders of its areas."""
    out = get_indicator(warehouse(spark, d), "polg", 105, geometry_mode="border", today=TODAY)
    v = F.posexplode(F.flatten(F.flatten("geometry"))).alias("i", "v")
    each = out.select("geo_value", "period_ref", "measure_code", v)
    return each.select(
        "geo_value", "period_ref", "measure_code", (F.col("i") + 1).alias("i"),
        (1000 * F.col("v.x")).alias("lon"), (1000 * F.col("v.y")).alias("lat"),
    )


@entry(_answer_sql(f"f.geo_code = 'bezk' AND f.geo_value = 11 AND {_OPEN} AND {_TOTAL_1} AND {_TOTAL_2}", extra=_INFO, joins="JOIN seed USING (indicator_id)"))
def district_portrait(spark: SparkSession, d: str) -> DataFrame:
    """All indicators of one district with their catalogue entries."""
    return _shown(get_portrait(warehouse(spark, d), "bezk", 11, with_indicator=True, today=TODAY))


@entry(_answer_sql(f"f.geo_code = 'polg' AND f.geo_value = 42 AND {_OPEN}"))
def area_portrait(spark: SparkSession, d: str) -> DataFrame:
    """All indicators and groups of one municipality."""
    return _shown(get_portrait(warehouse(spark, d), "polg", 42, expand_all_groups=True, today=TODAY))


def _values_sql(where: str) -> str:
    return f"""WITH {_FACT}
    SELECT CAST(indicator_id AS BIGINT) AS indicator_id, CAST(geo_value AS BIGINT) AS geo_value, measure_code,
           round(num, 4) AS indicator_value_numeric, CAST(source_id AS BIGINT) AS source_id
    FROM fact JOIN sources USING (source) WHERE geo_code = 'polg' AND {_TOTAL_1} AND {_TOTAL_2} AND {where}
    QUALIFY row_number() OVER (PARTITION BY indicator_id, geo_value ORDER BY y DESC, measure_code NULLS LAST, kfrom DESC) = 1"""


@entry(_values_sql(_OPEN))
def latest_values(spark: SparkSession, d: str) -> DataFrame:
    """The latest number of every indicator and municipality."""
    return get_values(store(spark, d), "polg")


@entry(_values_sql("measure_code = 'zahl' AND kfrom <= DATE '1998-01-01' AND (kto > DATE '1998-01-01' OR kto IS NULL)"))
def latest_values_as_of(spark: SparkSession, d: str) -> DataFrame:
    """The latest counts as known on a day that starts and ends knowledge periods."""
    return get_values(store(spark, d), "polg", measure="zahl", knowledge_date="1998-01-01")


_HELD = f"""WITH {_FACT}, held AS (
        SELECT geo_code, indicator_id, coalesce(string_agg(DISTINCT measure_code, ',' ORDER BY measure_code), 'NULL') AS measure_codes
        FROM fact GROUP BY ALL
    )"""


@entry(
    f"""{_HELD} SELECT geo_code, CAST(indicator_id AS BIGINT) AS indicator_id{_INFO}, measure_codes FROM held JOIN seed USING (indicator_id)"""
)
def available_measures(spark: SparkSession, d: str) -> DataFrame:
    """Measures held per indicator and level, from the whole mart."""
    w = store(spark, d)
    return available_indicators(w.mart, w.catalogue)


@entry(f"""{_HELD} SELECT CAST(indicator_id AS BIGINT) AS indicator_id{_INFO}, measure_codes FROM held JOIN seed USING (indicator_id) WHERE geo_code = 'polg'""")
def indicator_catalogue(spark: SparkSession, d: str) -> DataFrame:
    """The catalogue of municipalities."""
    w = store(spark, d)
    return get_indicators(available_indicators(w.mart, w.catalogue), "polg")


@entry(
    f"""{_HELD}, c AS (SELECT * FROM held JOIN seed USING (indicator_id) WHERE geo_code = 'polg')
    SELECT DISTINCT topic_1 AS parent, topic_2 AS child FROM c WHERE topic_2 IS NOT NULL
    UNION SELECT topic_2, topic_3 FROM c WHERE topic_3 IS NOT NULL
    UNION SELECT coalesce(topic_3, topic_2), '[#0' || indicator_id || '] ' || indicator_name || ' (CHF) [''' || replace(measure_codes, ',', ''', ''') || ''']' FROM c"""
)
def topic_tree(spark: SparkSession, d: str) -> DataFrame:
    """The topic tree as edges."""
    w = store(spark, d)
    return topic_edges(get_indicators(available_indicators(w.mart, w.catalogue), "polg"))


@entry(
    f"""WITH {_FACT}, gv AS (
        SELECT g, 1 + row_number() OVER (ORDER BY g) AS id FROM (SELECT g1 AS g FROM fact UNION SELECT g2 FROM fact) WHERE g <> 'GROUP TOTAL'
        UNION ALL SELECT 'GROUP TOTAL', 1
    )
    SELECT CAST(indicator_id AS BIGINT) AS indicator_id, geo_code, CAST(geo_value AS BIGINT) AS geo_value,
           strftime(kfrom, '%Y-%m-%d %H:%M:%S') AS knowledge_date_from, strftime(kto, '%Y-%m-%d %H:%M:%S') AS knowledge_date_to,
           y || '-12-31' AS period_ref, CAST(CASE WHEN g1 IS NOT NULL THEN 2 END AS BIGINT) AS group_1_id, CAST(a.id AS BIGINT) AS group_value_1_id,
           CASE WHEN coalesce(a.id, 1) = 1 THEN 'true' ELSE 'false' END AS _group_value_1_is_total,
           CAST(b.id AS BIGINT) AS group_value_2_id, CASE WHEN coalesce(b.id, 1) = 1 THEN 'true' ELSE 'false' END AS _group_value_2_is_total,
           measure_code, round(num, 4) AS indicator_value_numeric, txt AS indicator_value_text, CAST(source_id AS BIGINT) AS source_id
    FROM fact JOIN sources USING (source) LEFT JOIN gv a ON g1 = a.g LEFT JOIN gv b ON g2 = b.g"""
)
def encoded_mart(spark: SparkSession, d: str) -> DataFrame:
    """The dictionary-encoded fact as written, one partition per indicator."""
    return store(spark, d).mart.select(
        "indicator_id", "geo_code", "geo_value", "knowledge_date_from", "knowledge_date_to", "period_ref",
        "group_1_id", "group_value_1_id", "_group_value_1_is_total", "group_value_2_id", "_group_value_2_is_total",
        "measure_code", "indicator_value_numeric", "indicator_value_text", "source_id",
    )


@entry(
    f"""WITH {_FACT} SELECT CAST(indicator_id AS BIGINT) AS indicator_id, CAST(geo_value AS BIGINT) AS geo_value, y || '-12-31' AS period_ref,
       g1 AS group_1_value, g2 AS group_2_value, source, measure_code, geo_name, CAST(bez AS BIGINT) AS bezirk_bfs_id, CAST(kan AS BIGINT) AS kanton_bfs_id
       FROM full_fact WHERE geo_code = 'polg' AND kfrom <= DATE '1999-01-01' AND (kto > DATE '1999-01-01' OR kto IS NULL)"""
)
def decoded_with_hierarchy(spark: SparkSession, d: str) -> DataFrame:
    """All facts known on a day, with their texts and area hierarchy."""
    w = warehouse(spark, d)
    rows = known_at(w.mart.filter("geo_code = 'polg'"), "1999-01-01")
    out = join_geo(decode(rows, w.dictionaries), w.chain("polg"))
    return out.select(
        "indicator_id", "geo_value", "period_ref", "group_1_value", "group_2_value", "source", "measure_code",
        "geo_name", "bezirk_bfs_id", "kanton_bfs_id",
    )


# ---------------------------------------------------------------------------
# A warehouse that is published twice from storage.
def _facts(spark: SparkSession, d: str) -> DataFrame:
    return materialize(measured(sales(spark, d), people(spark, d), None, WIDE_FACT))


def _twice(spark: SparkSession, d: str, first: str, second: str, indicators=None) -> str:
    root, facts = new_path(spark, "warehouse"), _facts(spark, d)
    publish_to(spark, [facts.filter(first)], root, WIDE_MART, written=True)
    publish_to(spark, [facts.filter(second)], root, WIDE_MART, indicators, written=True)
    return root


@entry(
    f"""WITH {SALES}, texts AS (
        SELECT source AS text, min(CASE WHEN indicator_id >= 103 THEN 1 ELSE 2 END) AS load FROM sales GROUP BY source
    ) SELECT row_number() OVER (ORDER BY load, text) AS id, text AS source FROM texts"""
)
def dictionary_published_twice(spark: SparkSession, d: str) -> DataFrame:
    """Sources keep their ids when a second publication brings earlier ones in the alphabet."""
    root = _twice(spark, d, "indicator_id >= 103", "true")
    return released_warehouse(spark, root, WIDE_MART)[1].source


@entry(
    f"""WITH {SALES} SELECT CAST(indicator_id AS BIGINT) AS indicator_id, count(*) AS n FROM sales
        WHERE indicator_id <> 103 GROUP BY 1"""
)
def emptied_indicator(spark: SparkSession, d: str) -> DataFrame:
    """An indicator without rows in the second publication has none in the mart."""
    root = _twice(spark, d, "true", "indicator_id <> 103", range(101, 106))
    mart, _ = released_warehouse(spark, root, WIDE_MART)
    return mart.groupBy("indicator_id").agg(F.count("*").alias("n"))


@entry(
    f"""WITH {SALES}, seen AS (
        SELECT * FROM (VALUES (0), (1), (2), (3)) w(after_writes)
    ) SELECT CAST(after_writes AS BIGINT) AS after_writes, CAST(indicator_id AS BIGINT) AS indicator_id, source, count(*) AS n,
             round(sum(CAST(v AS DOUBLE)), 2) AS total
      FROM sales, seen WHERE CASE WHEN after_writes < 3 THEN indicator_id >= 103 ELSE indicator_id <> 104 END GROUP BY 1, 2, 3"""
)
def publication_interrupted(spark: SparkSession, d: str) -> DataFrame:
    """What readers see while a second publication ends after each of its writes, and when it succeeds.

    The second load has other sources, which come first in the alphabet, and none of one indicator.
    Its writes are the dictionary of sources, the facts, and the record of the release.
    """
    root, facts = new_path(spark, "warehouse"), _facts(spark, d)
    publish_to(spark, [facts.filter("indicator_id >= 103")], root, WIDE_MART, written=True)
    states = []
    for writes in range(4):
        try:
            publish_to(
                spark, [facts.filter("indicator_id <> 104")], root, WIDE_MART, range(101, 106), ends_after(writes), written=True
            )
        except Interrupted:
            pass
        mart, dictionaries = released_warehouse(spark, root, WIDE_MART)
        rows = decode(mart, dictionaries).groupBy("indicator_id", "source")
        states.append(rows.agg(F.count("*").alias("n"), F.sum("indicator_value_numeric").alias("total")).select(
            F.lit(writes).alias("after_writes"), "indicator_id", "source", "n", F.round("total", 2).alias("total")
        ))
    return reduce(DataFrame.unionAll, states)


# ---------------------------------------------------------------------------
# A configuration of 93 atlas indicators, from settings to the published mart and back.
def _settings() -> list[dict]:
    """1 to 60 by priority and month in the first generation, 28 to 93 by lot in the second."""
    last = r"regexp_extract(period_ref, '[0-9]{4}-[0-9]{2}-[0-9]{2}$', 0)::date"
    end = "make_date(period_ref::int, 12, 31)"
    out = []
    for i in range(1, 94):
        priority, month = divmod(i - 1, 12)
        raw: dict = {"indicator_id": i, "period_type": "duedate", "period_code": "year"}
        if i <= 60:
            raw["v1"] = {
                "indicator_regex": f"^Orders of {month + 1:02d}$", "path_regex": [f"^_?{priority + 1}_72_70$", "^never$"], "period_ref": last,
            }
        if i >= 28:
            raw["v2"] = {"indicateur_id": f"lot{i}", "period_ref": end}
        if i % 2:
            raw["measure"] = {"base": "zahl"}
        out.append(raw)
    return out


@entry(
    f"""WITH {LINES}, m AS (SELECT min(od) AS begin FROM lines), d2 AS (
        SELECT 28 + l_suppkey % 66 AS i, o_custkey AS geo_value, y, od AS kfrom, v, CASE l_linestatus WHEN 'O' THEN 'polg' ELSE 'bezk' END || y AS niv
        FROM lines QUALIFY row_number() OVER (PARTITION BY i, o_custkey, l_returnflag, y, od ORDER BY niv DESC, 'map' || l_linenumber DESC, v DESC) = 1
    ), u AS (
        SELECT 12 * (ascii(substr(o_orderpriority, 1, 1)) - 49) + month(o_orderdate) AS i, CASE o_orderstatus WHEN 'F' THEN 'polg' ELSE 'bezk' END AS geo_code,
               o_custkey AS geo_value, CAST(o_orderdate AS DATE) AS kfrom, year(o_orderdate) AS y, CAST(o_totalprice AS DECIMAL(18,2)) AS v, 'v1' AS source, 1 AS e
        FROM orders WHERE o_orderstatus IN ('F', 'O')
        UNION ALL SELECT i, left(niv, 4), geo_value, kfrom, y, v, 'v2', 2 FROM d2
    ), one AS (
        SELECT *, CASE WHEN e = 1 AND i >= 28 THEN (SELECT begin FROM m) END AS kto FROM u
        QUALIFY row_number() OVER (PARTITION BY i, geo_code, geo_value, y, kfrom ORDER BY e DESC, v DESC) = 1
    )
    SELECT CAST(i AS BIGINT) AS indicator_id, geo_code, CAST(geo_value AS BIGINT) AS geo_value, strftime(kfrom, '%Y-%m-%d') AS kfrom, strftime(kto, '%Y-%m-%d') AS kto,
           y || '-12-31' AS period_ref, CASE WHEN i % 2 = 1 THEN 'zahl' END AS measure_code, CAST(v AS DOUBLE) AS indicator_value_numeric, source FROM one"""
)
def configured_atlas(spark: SparkSession, d: str) -> DataFrame:
    """93 indicators configured by patterns and source ids, published as a release and read back."""
    v1 = atlas_v1(spark, d).withColumn("variable", F.concat(F.lit("Orders of "), F.date_format(VALID_FROM, "MM")))
    v2 = atlas_v2(spark, d, F.concat(F.lit("lot"), (28 + F.col("l_suppkey") % 66).cast("string")))
    indicators = [atlas_indicator(raw) for raw in _settings()]
    facts = atlas_family(v1, v2, indicators, people(spark, d), WIDE, atlas_rows(spark, d))
    root = new_path(spark, "warehouse")
    publish_to(spark, [facts], root, WIDE_MART, [c.indicator_id for c in indicators])
    rows = decode(*released_warehouse(spark, root, WIDE_MART))
    return rows.select(
        "indicator_id", "geo_code", "geo_value", F.col("knowledge_date_from").cast("date").alias("kfrom"),
        F.col("knowledge_date_to").cast("date").alias("kto"), "period_ref", "measure_code", "indicator_value_numeric", "source",
    )


@entry(ORACLES["cube_indicators"])
def published_cubes(spark: SparkSession, d: str) -> DataFrame:
    """The indicators of a cube family, published as a release and read back with their texts."""
    family = CubeFamily(CUBE_INDICATORS)
    facts = cube_family(cube_history(spark, d), family, people(spark, d), WIDE, line_count(spark, d))
    root = new_path(spark, "warehouse")
    publish_to(spark, [facts], root, WIDE_MART, [c.indicator_id for c in family.indicators])
    rows = decode(*released_warehouse(spark, root, WIDE_MART))
    return rows.select(
        "indicator_id", "geo_value", F.col("knowledge_date_from").cast("date").alias("kfrom"),
        F.col("knowledge_date_to").cast("date").alias("kto"), "period_ref_from", "period_ref", "group_1_name", "group_1_value",
        "group_2_name", "group_2_value", "indicator_value_numeric", "indicator_value_text",
    )
