"""Indicator builders, totals, measures, history and dictionaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from regiofact.config import (
    AtlasIndicator,
    AtlasV1,
    AtlasV2,
    CubeIndicator,
    FilterRule,
    GroupSpec,
    MeasureSpec,
    PortraitIndicator,
    WideIndicators,
)
from regiofact.functions.keys import is_total
from regiofact.operators.dictionaries import (
    collect_group_values,
    collect_values,
    extend_dictionary,
    group_value_seed,
)
from regiofact.operators.history import (
    HistoryTable,
    VALID_FROM,
    VALID_TO,
    close_at_start_of,
    current_rows,
    open_history,
    scd2_apply,
)
from regiofact.operators.measures import expand_measures
from regiofact.operators.reshape import distinct_on, union_tagged
from regiofact.operators.totals import build_totals, group_columns
from regiofact.plans.indicators import (
    ALL_TAXPAYERS,
    build_atlas_indicators,
    build_cube_indicators,
    build_portrait_indicators,
    build_tax_legal,
    build_tax_natural,
    build_wide_indicators,
)
from regiofact.plans.staging import stage_tax_legal, stage_tax_natural, typecast
from regiofact.schemas import INTM, widened
from regiofact.session import materialize, new_path
from workloads.base import (
    LINES,
    PEOPLE,
    SALES,
    TOTALS,
    entry,
    line_count,
    lines,
    money,
    people,
    sales,
    table,
)

#: Customer numbers outgrow SMALLINT.
WIDE = widened(INTM, geo_value="bigint")


def _timestamp(c: Column) -> Column:
    return c.cast("timestamp_ntz")


# ---------------------------------------------------------------------------
# Totals and measures


@entry(
    f"""WITH {SALES}, {TOTALS}
    SELECT CAST(indicator_id AS BIGINT) AS indicator_id, CAST(geo_value AS BIGINT) AS geo_value, CAST(y AS BIGINT) AS y,
           strftime(kfrom, '%Y-%m-%d') AS kfrom, g1, g2, round(CAST(v AS DOUBLE), 4) AS v FROM totals"""
)
def group_totals(spark: SparkSession, d: str) -> DataFrame:
    """Totals over the last and over both groups."""
    out = build_totals(sales(spark, d), 2, "sum(indicator_value_numeric)")
    return out.select(
        "indicator_id", "geo_value", F.year("period_ref").alias("y"),
        F.col("knowledge_date_from").cast("date").alias("kfrom"),
        F.col("group_1_value").alias("g1"), F.col("group_2_value").alias("g2"),
        F.col("indicator_value_numeric").alias("v"),
    )


@entry(
    f"""WITH {LINES}, g AS (SELECT o_custkey, CASE WHEN l_returnflag = 'N' THEN NULL ELSE l_returnflag END AS a, l_linestatus AS b,
        o_orderstatus AS c, v FROM lines)
    SELECT CAST(o_custkey AS BIGINT) AS o_custkey, CASE WHEN grouping(a) = 1 THEN 'GROUP TOTAL' ELSE a END AS group_1_value,
           CASE WHEN grouping(b) = 1 THEN 'GROUP TOTAL' ELSE b END AS group_2_value,
           CASE WHEN grouping(c) = 1 THEN 'GROUP TOTAL' ELSE c END AS group_3_value,
           round(CAST(max(v) AS DOUBLE), 4) AS indicator_value_numeric
    FROM g GROUP BY o_custkey, ROLLUP (a, b, c)"""
)
def group_totals_with_nulls(spark: SparkSession, d: str) -> DataFrame:
    """A group that is really NULL stays apart from its total."""
    df = lines(spark, d).select(
        "o_custkey",
        F.when(F.col("l_returnflag") != "N", F.col("l_returnflag")).alias("group_1_value"),
        F.col("l_linestatus").alias("group_2_value"),
        F.col("o_orderstatus").alias("group_3_value"),
        F.col("v").alias("indicator_value_numeric"),
    )
    return build_totals(df, 3, "max(indicator_value_numeric)", line_count(spark, d))


@entry(
    f"""WITH {LINES}
    SELECT CAST(o_orderkey AS BIGINT) AS o_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, 'Flag' AS group_1_name,
           CASE l_returnflag WHEN 'N' THEN 'GROUP TOTAL' ELSE l_returnflag END AS group_1_value,
           CAST(NULL AS VARCHAR) AS group_2_name, CAST(NULL AS VARCHAR) AS group_2_value FROM lines"""
)
def source_totals(spark: SparkSession, d: str) -> DataFrame:
    """A source's own total label; a group without totals is dropped."""
    spec = [GroupSpec("l_returnflag", "Flag", "N"), GroupSpec("l_linestatus", "Status")]
    made = group_columns(spec, None)
    return lines(spark, d).select(
        "o_orderkey", "l_linenumber",
        *[made[c].alias(c) for c in list(made)[:4]],
    )


def _measured(spark: SparkSession, d: str, spec: MeasureSpec) -> DataFrame:
    out = expand_measures(sales(spark, d), people(spark, d), spec)
    return out.select(
        "indicator_id", "geo_value", F.year("period_ref").alias("y"),
        F.col("knowledge_date_from").cast("date").alias("kfrom"),
        F.col("group_1_value").alias("g1"), F.col("group_2_value").alias("g2"),
        "measure_code", F.col("indicator_value_numeric").alias("v"),
    )


def _measured_sql(cases: dict[str, str]) -> str:
    names = ", ".join(f"'{m}'" for m in cases)
    values = ", ".join(cases.values())
    return f"""WITH {SALES}, {PEOPLE}
    SELECT CAST(indicator_id AS BIGINT) AS indicator_id, CAST(geo_value AS BIGINT) AS geo_value, CAST(y AS BIGINT) AS y,
           strftime(kfrom, '%Y-%m-%d') AS kfrom, g1, g2, unnest([{names}]) AS measure_code, unnest([{values}]) AS v
    FROM sales LEFT JOIN people USING (geo_value, y)"""


@entry(
    _measured_sql(
        {
            "zahl": "CAST(v AS DOUBLE)",
            "pro100": "round(CAST(v AS DOUBLE) * 100 / pop, 4)",
            "pro1000": "round(CAST(v AS DOUBLE) * 1000 / pop, 4)",
        }
    )
)
def per_capita(spark: SparkSession, d: str) -> DataFrame:
    """Counts with two ratios per inhabitants, from one population join."""
    return _measured(spark, d, MeasureSpec("zahl", ["pro100", "pro1000"]))


@entry(
    _measured_sql(
        {
            "zahl": "CAST(round(CAST(v * pop AS DECIMAL(28,2)) * 0.001, 4) AS DOUBLE)",
            "pro100": "CASE WHEN pop <> 0 THEN round(CAST(v AS DOUBLE) / 10, 4) END",
            "pro1000": "CASE WHEN pop <> 0 THEN CAST(v AS DOUBLE) END",
        }
    )
)
def per_capita_base(spark: SparkSession, d: str) -> DataFrame:
    """Values given per 1000 inhabitants turned into counts and ratios."""
    return _measured(spark, d, MeasureSpec("pro1000", ["pro100", "zahl"]))


@entry(_measured_sql({"pro100": "round(CAST(v AS DOUBLE) * pop / 100, 4)"}))
def per_capita_label(spark: SparkSession, d: str) -> DataFrame:
    """A base measure without further ratios."""
    return _measured(spark, d, MeasureSpec("pro100"))


# ---------------------------------------------------------------------------
# Builders


def cube_history(spark: SparkSession, d: str) -> DataFrame:
    li = lines(spark, d)
    return li.select(
        F.when(F.col("o_orderpriority") == "5-LOW", "bezk").otherwise("polg").alias("geo_code"),
        F.when(F.col("disc") > 0, F.col("o_custkey")).alias("geo_value"),
        F.col("y").alias("year_from"),
        (F.col("y") + F.when(F.col("l_linestatus") == "O", 0).otherwise(1)).alias("year_to"),
        "l_returnflag", "l_linestatus", "o_orderstatus",
        F.when(F.col("tax") > 0, F.col("v")).alias("indicator_value"),
        F.lit("Lines").alias("source"),
        _timestamp(F.make_date("y", F.lit(6), F.lit(1))).alias(VALID_FROM),
        _timestamp(F.when(F.col("o_orderstatus") == "P", F.make_date(F.col("y") + 1, F.lit(6), F.lit(1)))).alias(VALID_TO),
    )


_FLAG, _STATUS = GroupSpec("l_returnflag", "Flag"), GroupSpec("l_linestatus", "Status")
CUBE_INDICATORS = [
    CubeIndicator(142, True, build_total_value="sum(indicator_value_numeric)", grouping=(_FLAG, _STATUS)),
    CubeIndicator(
        143, True, grouping=(GroupSpec("l_returnflag", "Flag", "N"), _STATUS),
        filter_and=(FilterRule("o_orderstatus", regex="F|O"), FilterRule("l_linestatus", exact_match="F")),
    ),
    CubeIndicator(144, False, period_type="period", filter_and=(FilterRule("o_orderstatus", exact_match="P"),)),
]


@entry(
    f"""WITH {LINES}, h AS (
        SELECT CASE o_orderpriority WHEN '5-LOW' THEN 'bezk' ELSE 'polg' END AS geo_code,
               CASE WHEN disc > 0 THEN o_custkey END AS geo_value, y AS a, y + CASE l_linestatus WHEN 'O' THEN 0 ELSE 1 END AS b,
               l_returnflag, l_linestatus, o_orderstatus, CASE WHEN tax > 0 THEN v END AS v,
               CASE WHEN o_orderstatus = 'P' THEN CAST(make_date(y + 1, 6, 1) AS VARCHAR) END AS kto FROM lines
    ), parts AS (
        SELECT 142 AS indicator_id, geo_code, geo_value, kto, y0, a, b,
               CASE WHEN grouping(l_returnflag) = 1 THEN 'GROUP TOTAL' ELSE l_returnflag END AS g1,
               CASE WHEN grouping(l_linestatus) = 1 THEN 'GROUP TOTAL' ELSE l_linestatus END AS g2,
               CAST(sum(v) AS DOUBLE) AS num, NULL AS txt
        FROM (SELECT *, a AS y0 FROM h)
        GROUP BY geo_code, geo_value, kto, y0, a, b, ROLLUP (l_returnflag, l_linestatus)
        UNION ALL
        SELECT 143, geo_code, geo_value, kto, a, a, b, CASE l_returnflag WHEN 'N' THEN 'GROUP TOTAL' ELSE l_returnflag END, NULL,
               CAST(v AS DOUBLE), NULL FROM h WHERE regexp_matches(o_orderstatus, 'F|O') AND l_linestatus = 'F'
        UNION ALL
        SELECT 144, geo_code, geo_value, kto, a, a, b, NULL, NULL, NULL, CAST(v AS VARCHAR) FROM h WHERE o_orderstatus = 'P'
    )
    SELECT CAST(indicator_id AS BIGINT) AS indicator_id, CAST(geo_value AS BIGINT) AS geo_value,
           CAST(y0 AS VARCHAR) || '-06-01' AS kfrom, kto,
           CASE WHEN indicator_id = 144 OR a <> b THEN a || '-01-01' END AS period_ref_from, b || '-12-31' AS period_ref,
           CASE WHEN indicator_id = 144 THEN NULL ELSE 'Flag' END AS group_1_name, g1 AS group_1_value,
           CASE WHEN indicator_id = 142 THEN 'Status' END AS group_2_name, g2 AS group_2_value,
           round(num, 4) AS indicator_value_numeric, txt AS indicator_value_text
    FROM parts WHERE geo_code = 'polg' AND geo_value IS NOT NULL AND (num IS NOT NULL OR txt IS NOT NULL)"""
)
def cube_indicators(spark: SparkSession, d: str) -> DataFrame:
    """Three cube indicators: built totals, source totals with filters, and texts."""
    out = build_cube_indicators(cube_history(spark, d), CUBE_INDICATORS, WIDE, line_count(spark, d))
    return out.select(
        "indicator_id", "geo_value",
        F.col("knowledge_date_from").cast("date").alias("kfrom"), F.col("knowledge_date_to").cast("date").alias("kto"),
        "period_ref_from", "period_ref", "group_1_name", "group_1_value", "group_2_name", "group_2_value",
        "indicator_value_numeric", "indicator_value_text",
    )


def atlas_v1(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders")
    year = F.year("o_orderdate")
    level = F.when(F.col("o_orderstatus") == "F", "polg").when(F.col("o_orderstatus") == "O", "bezk").otherwise("lreg")
    return o.select(
        F.col("o_custkey").cast("string").alias("geo_id"),
        level.alias("geom_code"),
        F.concat(F.lit("Orders "), "o_orderpriority").alias("variable"),
        F.format_string("_%s_72_70", F.substring("o_orderpriority", 1, 1)).alias("mother_path"),
        F.format_string("%d-01-01/%d-12-31", year, year).alias("period_ref"),
        money("o_totalprice").cast("string").alias("value"),
        F.lit("v1").alias("source"),
        F.col("o_orderdate").alias(VALID_FROM),
        F.lit(None).cast("timestamp_ntz").alias(VALID_TO),
    )


def atlas_rows(spark: SparkSession, d: str) -> int:
    """How many rows both generations have."""
    return table(spark, d, "orders").count() + line_count(spark, d)


def atlas_v2(spark: SparkSession, d: str, ids: Column | None = None) -> DataFrame:
    li = lines(spark, d)
    by_priority = F.concat(F.lit("prio"), F.substring("o_orderpriority", 1, 1))
    level = F.when(F.col("l_linestatus") == "O", "polg").otherwise("bezk")
    return li.select(
        (by_priority if ids is None else ids).alias("bfs_indicateur_id"),
        F.concat(level, F.col("y").cast("string")).alias("bfs_nivgeo"),
        F.col("o_custkey").alias("geo_value"),
        F.col("l_returnflag").alias("group_name"),
        F.col("y").cast("string").alias("period_ref"),
        F.concat(F.lit("map"), F.col("l_linenumber").cast("string")).alias("map_id"),
        F.col("v").cast("decimal(38,18)").alias("indicator_value"),
        F.lit("v2").alias("source"),
        _timestamp(F.col("od")).alias(VALID_FROM),
        F.lit(None).cast("timestamp_ntz").alias(VALID_TO),
    )


@entry(
    f"""WITH {LINES}, m AS (SELECT min(od) AS begin FROM lines), v1 AS (
        SELECT CAST(ascii(substr(o_orderpriority, 1, 1)) - 48 AS INTEGER) AS p,
               CASE o_orderstatus WHEN 'F' THEN 'polg' ELSE 'bezk' END AS geo_code, o_custkey AS geo_value,
               CAST(o_orderdate AS DATE) AS kfrom, year(o_orderdate) AS y, CAST(o_totalprice AS DECIMAL(18,2)) AS v
        FROM orders WHERE o_orderstatus IN ('F', 'O')
    ), d2 AS (
        SELECT CAST(ascii(substr(o_orderpriority, 1, 1)) - 48 AS INTEGER) AS p, o_custkey AS geo_value, y, od AS kfrom, l_returnflag AS g, v,
               CASE l_linestatus WHEN 'O' THEN 'polg' ELSE 'bezk' END || y AS niv
        FROM lines WHERE o_orderpriority IN ('1-URGENT', '3-MEDIUM')
        QUALIFY row_number() OVER (PARTITION BY p, o_custkey, l_returnflag, y, od
            ORDER BY niv DESC, 'map' || l_linenumber DESC, v DESC) = 1
    ), u AS (
        SELECT 5 AS indicator_id, geo_code, geo_value, kfrom, (SELECT begin FROM m) AS kto, y, NULL AS g1,
               CAST(v AS DOUBLE) AS num, NULL AS txt, 1 AS e FROM v1 WHERE p = 1
        UNION ALL SELECT 6, geo_code, geo_value, kfrom, NULL, y, NULL, NULL, CAST(v AS VARCHAR), 1 FROM v1 WHERE p IN (2, 3)
        UNION ALL SELECT CASE p WHEN 1 THEN 5 ELSE 7 END, left(niv, 4), geo_value, kfrom, NULL, y,
               CASE WHEN p = 1 THEN NULL WHEN g = 'N' THEN 'GROUP TOTAL' ELSE g END, CAST(v AS DOUBLE), NULL, 2 FROM d2
    ), one AS (
        SELECT * FROM u QUALIFY row_number() OVER (PARTITION BY indicator_id, geo_code, geo_value, y, kfrom
            ORDER BY e DESC, CASE WHEN coalesce(g1, 'GROUP TOTAL') = 'GROUP TOTAL' THEN 0 ELSE 1 END, g1 NULLS FIRST,
                     kto DESC NULLS FIRST, num DESC NULLS LAST, txt DESC NULLS LAST) = 1
    )
    SELECT CAST(indicator_id AS BIGINT) AS indicator_id, geo_code, CAST(geo_value AS BIGINT) AS geo_value,
           strftime(kfrom, '%Y-%m-%d') AS kfrom, strftime(kto, '%Y-%m-%d') AS kto, CASE WHEN indicator_id = 6 THEN y || '-01-01' END AS period_ref_from,
           y || '-12-31' AS period_ref, g1 AS group_1_value, round(num, 4) AS indicator_value_numeric,
           txt AS indicator_value_text, CAST(e AS BIGINT) AS _etl_version FROM one"""
)
def atlas_indicators(spark: SparkSession, d: str) -> DataFrame:
    """Indicators over two atlas generations: merged, first only, second with groups."""
    first = r"substring(period_ref, 1, 10)::date"
    last = r"regexp_extract(period_ref, '[0-9]{4}-[0-9]{2}-[0-9]{2}$', 0)::date"
    end = "make_date(period_ref::int, 12, 31)"
    cfg = [
        AtlasIndicator(5, "duedate", "year", AtlasV1("URGENT$", period_ref=last), AtlasV2("prio1", period_ref=end)),
        AtlasIndicator(
            6, "period", "year",
            AtlasV1("^Orders", ["^_?2_72_70$", "_3_"], first, last, value_is_text=True),
        ),
        AtlasIndicator(7, "duedate", "year", v2=AtlasV2("prio3", period_ref=end, grouping=GroupSpec("group_name", "Flag", "N"))),
    ]
    out = build_atlas_indicators(atlas_v1(spark, d), atlas_v2(spark, d), cfg, contract=WIDE, rows=atlas_rows(spark, d))
    return out.select(
        "indicator_id", "geo_code", "geo_value",
        F.col("knowledge_date_from").cast("date").alias("kfrom"), F.col("knowledge_date_to").cast("date").alias("kto"),
        "period_ref_from", "period_ref", "group_1_value", "indicator_value_numeric", "indicator_value_text", "_etl_version",
    )


@entry(
    """SELECT CAST(CASE o_orderpriority WHEN '1-URGENT' THEN 1 ELSE 2 END AS BIGINT) AS indicator_id, CAST(o_custkey AS BIGINT) AS geo_value,
       strftime(o_orderdate, '%Y-%m-%d') AS kfrom, year(o_orderdate) || '-12-31' AS period_ref, CAST(o_orderkey AS DOUBLE) AS indicator_value_numeric
       FROM orders WHERE o_orderstatus <> 'P' AND o_orderpriority IN ('1-URGENT', '2-HIGH')"""
)
def portrait_indicators(spark: SparkSession, d: str) -> DataFrame:
    """Portrait indicators from the rows still open."""
    o = table(spark, d, "orders")
    history = o.select(
        F.col("o_custkey").alias("bfs_nr"),
        F.substring("o_orderpriority", 1, 1).cast("int").alias("indikator_id"),
        F.year("o_orderdate").alias("indikator_jahr"),
        F.col("o_orderkey").alias("indikator_value"),
        F.col("o_orderdate").alias(VALID_FROM),
        F.when(F.col("o_orderstatus") == "P", F.col("o_orderdate")).alias(VALID_TO),
    )
    out = build_portrait_indicators(history, {1: PortraitIndicator(1), 2: PortraitIndicator(2)}, contract=WIDE)
    return out.select(
        "indicator_id", "geo_value", F.col("knowledge_date_from").cast("date").alias("kfrom"),
        "period_ref", "indicator_value_numeric",
    )


@entry(
    f"""WITH {LINES}
    SELECT CAST(unnest([95, 96, 97]) AS BIGINT) AS indicator_id, CAST(o_custkey AS BIGINT) AS geo_value, strftime(od, '%Y-%m-%d') AS period_ref,
           strftime(sd, '%Y-%m-%d') AS kto, CAST(unnest([q, disc, tax]) AS DOUBLE) AS indicator_value_numeric FROM lines"""
)
def wide_indicators(spark: SparkSession, d: str) -> DataFrame:
    """One indicator per measure column of a history."""
    history = lines(spark, d).select(
        "o_custkey", "q", "disc", "tax",
        _timestamp(F.col("od")).alias(VALID_FROM), _timestamp(F.col("sd")).alias(VALID_TO),
    )
    cfg = WideIndicators({"q": 95, "disc": 96, "tax": 97}, "o_custkey", VALID_FROM, "Label office")
    out = build_wide_indicators(history, cfg, WIDE)
    return out.select(
        "indicator_id", "geo_value", "period_ref", F.col("knowledge_date_to").cast("date").alias("kto"),
        "indicator_value_numeric",
    )


@entry(
    f"""WITH {LINES}
    SELECT CAST(unnest([106, 107, 109]) AS BIGINT) AS indicator_id, CASE WHEN l_linestatus = 'O' THEN 'polg' END AS geo_code,
           CAST(o_custkey AS BIGINT) AS geo_value, '2025-01-23' AS kfrom, y || '-12-31' AS period_ref,
           CAST(unnest([q, CASE WHEN disc > 0 THEN disc END, tax]) AS DOUBLE) AS indicator_value_numeric
    FROM lines WHERE l_returnflag = 'N'"""
)
def tax_legal(spark: SparkSession, d: str) -> DataFrame:
    """Tax measures of legal persons over all quartiles."""
    raw = lines(spark, d).select(
        F.when(F.col("l_linestatus") == "O", "Gemeinde").otherwise("Kanton").alias("Typ"),
        F.col("o_custkey").alias("GemeindeID"), F.lit("x").alias("Gemeinde"), F.lit("x").alias("Kanton"),
        F.lit(1).alias("KantonID"), F.col("y").alias("Steuerperiode"),
        F.when(F.col("l_returnflag") != "N", F.col("l_returnflag")).alias("Quartil"),
        F.col("q").alias("Anzahl"),
        F.when(F.col("disc") > 0, F.col("disc").cast("string")).otherwise("NA").alias("Eigenkapital"),
        F.col("tax").alias("Steuer"), F.col("v").alias("Unbekannt"),
    )
    out = build_tax_legal(stage_tax_legal(raw), WIDE)
    return out.select(
        "indicator_id", "geo_code", "geo_value", F.col("knowledge_date_from").cast("date").alias("kfrom"),
        "period_ref", "indicator_value_numeric",
    )


@entry(
    f"""WITH {LINES}
    SELECT CAST(unnest([111, 118]) AS BIGINT) AS indicator_id, CAST(o_custkey AS BIGINT) AS geo_value, y || '-12-31' AS period_ref,
           CAST(unnest([q, CASE WHEN disc > 0 THEN disc END]) AS DOUBLE) AS indicator_value_numeric
    FROM lines WHERE l_returnflag = 'N' AND tax > 0 AND l_linestatus = 'O'"""
)
def tax_natural(spark: SparkSession, d: str) -> DataFrame:
    """Tax measures of natural persons by municipality."""
    raw = lines(spark, d).select(
        F.when(F.col("l_linestatus") == "O", ALL_TAXPAYERS).otherwise("x").alias("BelastungDBST"),
        F.when(F.col("tax") > 0, F.col("o_custkey").cast("string")).otherwise("NA").alias("GemeindeID"),
        F.lit("x").alias("Gemeindename"), F.lit("x").alias("Kanton"), F.lit(1).alias("KantonID"),
        F.col("y").alias("Steuerperiode"),
        F.when(F.col("l_returnflag") == "N", "T").otherwise("L").alias("Zivilstand"), F.lit("x").alias("ZivilstandBez"),
        F.col("q").alias("AnzahlSteuerpflichtige"),
        F.when(F.col("disc") > 0, F.col("disc").cast("string")).otherwise("NA").alias("EinnahmenDBST"),
    )
    out = build_tax_natural(stage_tax_natural(raw), WIDE)
    return out.select("indicator_id", "geo_value", "period_ref", "indicator_value_numeric")


# ---------------------------------------------------------------------------
# History: the open order book on three days. An order enters when placed, changes as
# its lines ship and leaves when it is finished and all shipped.

DAYS = ("1999-06-30", "2000-06-30", "2001-06-30", "2001-12-31", "2002-06-30")


def _book_sql(n: int) -> str:
    day = DAYS[n]
    return f"""b{n} AS (
        SELECT o_orderkey AS k, o_orderstatus AS status, count(*) FILTER (WHERE sd <= DATE '{day}') AS shipped,
               CAST(sum(v) FILTER (WHERE sd <= DATE '{day}') AS DOUBLE) AS amount
        FROM lines WHERE od <= DATE '{day}' GROUP BY ALL
        HAVING NOT (o_orderstatus = 'F' AND count(*) FILTER (WHERE sd <= DATE '{day}') = count(*)))"""


def _shipments(spark: SparkSession, d: str) -> DataFrame:
    """What order books are made of, joined and written once for all days."""
    return materialize(lines(spark, d).select("o_orderkey", "o_orderstatus", "od", "sd", "v"))


def _book(shipments: DataFrame, n: int) -> DataFrame:
    day = F.lit(DAYS[n]).cast("date")
    out = F.col("sd") <= day
    counted = (
        shipments.filter(F.col("od") <= day)
        .groupBy(F.col("o_orderkey").alias("k"), F.col("o_orderstatus").alias("status"))
        .agg(
            F.count_if(out).alias("shipped"),
            F.sum(F.when(out, F.col("v"))).alias("amount"),
            F.count(F.lit(1)).alias("n"),
        )
    )
    finished = (F.col("status") == "F") & (F.col("shipped") == F.col("n"))
    return counted.filter(~finished).drop("n")


def _next_sql(before: str, load: str, day: str, name: str, hard: bool = True) -> str:
    gone = f"TIMESTAMP '{day}'" if hard else "NULL"
    return f"""{name} AS (
        SELECT * FROM {before} WHERE valid_to IS NOT NULL
        UNION ALL
        SELECT h.k, h.status, h.shipped, h.amount, h.valid_from,
               CASE WHEN n.k IS NULL THEN {gone}
                    WHEN h.shipped IS DISTINCT FROM n.shipped OR h.amount IS DISTINCT FROM n.amount THEN TIMESTAMP '{day}' END
        FROM {before} h LEFT JOIN {load} n ON h.k = n.k WHERE h.valid_to IS NULL
        UNION ALL
        SELECT n.k, n.status, n.shipped, n.amount, TIMESTAMP '{day}', NULL
        FROM {load} n LEFT JOIN (SELECT * FROM {before} WHERE valid_to IS NULL) h ON h.k = n.k
        WHERE h.k IS NULL OR h.shipped IS DISTINCT FROM n.shipped OR h.amount IS DISTINCT FROM n.amount)"""


_FIRST = f"h0 AS (SELECT *, TIMESTAMP '{DAYS[0]}' AS valid_from, CAST(NULL AS TIMESTAMP) AS valid_to FROM b0)"


def _shown(name: str, where: str = "true") -> str:
    return f"""SELECT CAST(k AS BIGINT) AS k, status, CAST(shipped AS BIGINT) AS shipped, round(amount, 4) AS amount,
        strftime(valid_from, '%Y-%m-%d %H:%M:%S') AS valid_from, strftime(valid_to, '%Y-%m-%d %H:%M:%S') AS valid_to FROM {name} WHERE {where}"""


def _history(spark: SparkSession, d: str, loads: int, hard: bool = True) -> DataFrame:
    shipments = _shipments(spark, d)
    history = open_history(_book(shipments, 0), DAYS[0])
    for n in range(1, loads):
        history = scd2_apply(history, _book(shipments, n), "k", ["shipped", "amount"], DAYS[n], hard)
    return history


@entry(
    f"WITH {LINES}, {_book_sql(0)}, {_book_sql(1)}, {_book_sql(2)}, {_FIRST}, {_next_sql('h0', 'b1', DAYS[1], 'h1')}, "
    f"{_next_sql('h1', 'b2', DAYS[2], 'h2')} {_shown('h2')}"
)
def history_three_loads(spark: SparkSession, d: str) -> DataFrame:
    """The order book as type-2 history over three loads."""
    return _history(spark, d, 3)


@entry(
    f"WITH {LINES}, {', '.join(_book_sql(n) for n in range(5))}, {_FIRST}, "
    + ", ".join(_next_sql(f"h{n - 1}", f"b{n}", DAYS[n], f"h{n}") for n in range(1, 5))
    + " "
    + _shown("h4")
)
def history_five_loads(spark: SparkSession, d: str) -> DataFrame:
    """The order book over five loads, each written as a version of one table."""
    history = HistoryTable(spark, new_path(spark, "history"), "k", ("shipped", "amount"))
    shipments = _shipments(spark, d)
    for n, day in enumerate(DAYS):
        history.load(_book(shipments, n), day)
    return history.read()


_FIVE = f"WITH {LINES}, {', '.join(_book_sql(n) for n in range(5))}, {_FIRST}, " + ", ".join(
    _next_sql(f"h{n - 1}", f"b{n}", DAYS[n], f"h{n}") for n in range(1, 5)
)


def _written(spark: SparkSession, d: str, folds: tuple[int, ...] = ()) -> HistoryTable:
    history = HistoryTable(spark, new_path(spark, "history"), "k", ("shipped", "amount"))
    shipments = _shipments(spark, d)
    for n, day in enumerate(DAYS):
        history.load(_book(shipments, n), day)
        if n in folds:
            history.fold()
    return history


@entry(f"{_FIVE} {_shown('h4')}")
def history_folded(spark: SparkSession, d: str) -> DataFrame:
    """The order book over five loads, folded into one version after the third and the last."""
    return _written(spark, d, (2, 4)).read()


@entry(f"{_FIVE} {_shown('h4', 'valid_to IS NULL')}")
def history_open_after_fold(spark: SparkSession, d: str) -> DataFrame:
    """The rows still open after five loads, with a fold in between."""
    return _written(spark, d, (2,)).current()


@entry(
    f"""{_FIVE} SELECT CAST(version AS BIGINT) AS version, part, count(*) AS n FROM (
        SELECT v.version, 'opened' AS part FROM h4 JOIN days v ON h4.valid_from = v.day
        UNION ALL SELECT v.version, 'marks' FROM h4 JOIN days v ON h4.valid_to = v.day
    ) GROUP BY ALL""".replace(
        "WITH ", "WITH days AS (SELECT * FROM (VALUES " + ", ".join(f"({n}, TIMESTAMP '{day}')" for n, day in enumerate(DAYS, 1)) + ") t(version, day)), ", 1
    )
)
def history_changes(spark: SparkSession, d: str) -> DataFrame:
    """Rows that each of five loads has written: those it opened, and marks of those it closed."""
    return _written(spark, d).written()


@entry(
    f"WITH {LINES}, {_book_sql(0)}, {_book_sql(1)}, {_FIRST}, {_next_sql('h0', 'b1', DAYS[1], 'h1', False)} {_shown('h1')}"
)
def history_keeping_vanished(spark: SparkSession, d: str) -> DataFrame:
    """Rows that vanish from a load stay open."""
    return _history(spark, d, 2, hard=False)


@entry(
    f"WITH {LINES}, {_book_sql(0)}, {_book_sql(1)}, {_FIRST}, {_next_sql('h0', 'b1', DAYS[1], 'h1')} {_shown('h1', 'valid_to IS NULL')}"
)
def history_current(spark: SparkSession, d: str) -> DataFrame:
    """The rows still open after two loads."""
    return current_rows(_history(spark, d, 2))


@entry(
    f"""WITH {LINES}, {_book_sql(0)}, {_book_sql(1)}, {_book_sql(2)}, {_FIRST}, {_next_sql('h0', 'b1', DAYS[1], 'h1')},
    h2 AS (SELECT *, TIMESTAMP '{DAYS[2]}' AS valid_from, CAST(NULL AS TIMESTAMP) AS valid_to FROM b2),
    u AS (SELECT * REPLACE (coalesce(valid_to, (SELECT min(valid_from) FROM h2)) AS valid_to), 1 AS src FROM h1
          UNION ALL SELECT *, 2 FROM h2),
    one AS (SELECT * FROM u QUALIFY row_number() OVER (PARTITION BY k, valid_from ORDER BY src DESC) = 1) {_shown('one')}"""
)
def histories_merged(spark: SparkSession, d: str) -> DataFrame:
    """Two histories joined: the open rows of the first end where the second begins."""
    first = _history(spark, d, 2)
    second = open_history(_book(_shipments(spark, d), 2), DAYS[2])
    both = union_tagged(close_at_start_of(first, second), second)
    return distinct_on(both, ["k", VALID_FROM], [F.col("src_order").desc()]).drop("src_order")


# ---------------------------------------------------------------------------
# Dictionaries


@entry(
    f"""WITH {LINES}, t AS (SELECT y, unnest([l_returnflag, 'Supplier ' || l_suppkey, o_orderpriority]) AS g FROM lines),
    e AS (SELECT DISTINCT g FROM t WHERE y <= 1997), n1 AS (SELECT g, 1 + row_number() OVER (ORDER BY g) AS id FROM e),
    f AS (SELECT DISTINCT g FROM t WHERE g NOT IN (SELECT g FROM e)),
    n2 AS (SELECT g, (SELECT max(id) FROM n1) + row_number() OVER (ORDER BY g) AS id FROM f)
    SELECT CAST(1 AS BIGINT) AS group_value_id, 'GROUP TOTAL' AS group_value_name
    UNION ALL SELECT id, g FROM n1 UNION ALL SELECT id, g FROM n2"""
)
def dictionary_growth(spark: SparkSession, d: str) -> DataFrame:
    """A dictionary filled from early years, then extended by all; old ids stay."""
    none = F.lit(None).cast("string")
    facts = lines(spark, d).select(
        "y",
        F.col("l_returnflag").alias("group_1_value"),
        F.concat(F.lit("Supplier "), F.col("l_suppkey").cast("string")).alias("group_2_value"),
        F.col("o_orderpriority").alias("group_3_value"),
        none.alias("group_4_value"),
    )
    seed = group_value_seed(spark, "int")
    early = extend_dictionary(seed, collect_group_values(facts.filter("y <= 1997")))
    return extend_dictionary(materialize(early), collect_group_values(facts))


@entry(
    """SELECT o_orderstatus AS value FROM orders WHERE o_orderstatus <> 'P' UNION SELECT o_orderpriority FROM orders"""
)
def collected_values(spark: SparkSession, d: str) -> DataFrame:
    """Distinct values over several columns in one pass."""
    o = table(spark, d, "orders").select(
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).alias("a"),
        F.col("o_orderpriority").alias("b"),
    )
    return collect_values(o, ["a", "b"], "value")


@entry(
    """SELECT CAST(l_orderkey AS BIGINT) AS l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber,
       CASE WHEN l_returnflag = 'N' OR l_linenumber = 1 THEN 'true' ELSE 'false' END AS total FROM lineitem"""
)
def total_flags(spark: SparkSession, d: str) -> DataFrame:
    """Unused groups and the reserved id count as totals."""
    number = F.when(F.col("l_returnflag") != "N", F.col("l_linenumber"))
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", is_total(number).alias("total"))


@entry(
    f"""WITH {SALES} SELECT CAST(indicator_id AS BIGINT) AS indicator_id, 'polg' AS geo_code, CAST(geo_value AS BIGINT) AS geo_value,
       strftime(kfrom, '%Y-%m-%d %H:%M:%S') AS knowledge_date_from, y || '-12-31' AS period_ref, g1 AS group_1_value,
       CAST(v AS DOUBLE) AS indicator_value_numeric, CAST(1 AS BIGINT) AS _etl_version FROM sales"""
)
def typed_contract(spark: SparkSession, d: str) -> DataFrame:
    """Indicator rows cast to the fixed contract."""
    return typecast(sales(spark, d), WIDE).select(
        "indicator_id", "geo_code", "geo_value", "knowledge_date_from", "period_ref", "group_1_value",
        "indicator_value_numeric", "_etl_version",
    )
