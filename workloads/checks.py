"""Data-quality checks over whole tables."""

from __future__ import annotations

from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regiofact.operators.quality import (
    check_columns,
    check_contract,
    check_figures,
    check_min_rows,
    check_unique,
)
from regiofact.plans.audit import Contract, ContractBroken, both_sides, publish_audited, quarantine, sound_rows
from regiofact.session import new_path
from workloads.base import LINES, SALES, entry, lines, sales, table


@entry(
    """SELECT CAST(l_orderkey AS BIGINT) AS l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, count(*) AS n_records
       FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1"""
)
def repeated_keys(spark: SparkSession, d: str) -> DataFrame:
    """Keys that should be unique and are not."""
    return check_unique(table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


@entry(
    f"""WITH {LINES} SELECT CAST(o_custkey AS BIGINT) AS o_custkey, CAST(y AS BIGINT) AS y, count(*) AS n_records FROM lines
    WHERE l_returnflag = 'N' GROUP BY 1, 2 HAVING count(*) < 3"""
)
def thin_groups(spark: SparkSession, d: str) -> DataFrame:
    """Groups with too few rows under a condition."""
    return check_min_rows(lines(spark, d), 3, ["o_custkey", "y"], F.col("l_returnflag") == "N")


@entry(
    f"""WITH {SALES}
    SELECT 'columns' AS check_name, 'geo_value' AS detail, CAST(1 AS BIGINT) AS n UNION ALL SELECT 'columns', 'y', 1
    UNION ALL SELECT 'rows', 'sales', count(*) FROM sales HAVING count(*) NOT BETWEEN 1 AND 2000
    UNION ALL SELECT 'between', 'v', count(*) FROM sales WHERE CAST(v AS DOUBLE) > 50000 HAVING count(*) > 0
    UNION ALL SELECT 'not_null', 'kto', count(*) FROM sales WHERE kto IS NULL
    UNION ALL SELECT 'unique', 'geo_value', count(*) FROM (SELECT 1 FROM sales GROUP BY geo_value HAVING count(*) > 1) t"""
)
def quality_report(spark: SparkSession, d: str) -> DataFrame:
    """Column order, row count, value range, nulls and uniqueness of the sales fact."""
    facts = sales(spark, d).select(
        "indicator_id", "geo_value", F.year("period_ref").alias("y"),
        F.col("indicator_value_numeric").cast("double").alias("v"), F.col("knowledge_date_to").alias("kto"),
    )
    count = F.col("n_records")
    parts = [
        check_columns(facts, ["indicator_id", "y", "geo_value", "v", "kto"]).select(
            F.lit("columns").alias("check_name"), F.lower("actual").alias("detail"), F.lit(1).alias("n")
        ),
        check_figures(facts, (1, 2000), {"v": (0, 50000)}, ["indicator_id", "kto"]).select(
            "rule", F.when(F.col("rule") == "rows", "sales").otherwise(F.col("column")), count
        ),
        check_contract(facts, [], ["geo_value"], {"geo_value": "bigint"}).select("rule", "column", count),
    ]
    return reduce(DataFrame.union, parts)


_CONTRACT_SQL = """p AS (SELECT o_orderkey, CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderpriority END AS priority, o_custkey, CAST(o_orderdate AS DATE) AS day,
           round(CAST(o_totalprice AS DOUBLE), 2) AS price FROM orders),
    r AS (SELECT o_custkey, day FROM p GROUP BY ALL HAVING count(*) > 1)
    SELECT CAST(o_orderkey AS BIGINT) AS o_orderkey, concat_ws(';', CASE WHEN priority IS NULL THEN 'not_null priority' END,
               CASE WHEN price < 1000 OR price > 300000 THEN 'between price' END,
               CASE WHEN (o_custkey, day) IN (SELECT (o_custkey, day) FROM r) THEN 'unique o_custkey,day' END) AS broken FROM p"""


@entry(f"WITH {_CONTRACT_SQL}")
def audited_orders(spark: SparkSession, d: str) -> DataFrame:
    """Orders published under a contract: sound rows as published, and the quarantine with its rules.

    A second load, which breaks the contract more often than it allows, is written but not published.
    """
    o = table(spark, d, "orders").select(
        "o_orderkey", F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority")).alias("priority"), "o_custkey",
        F.col("o_orderdate").cast("date").alias("day"), F.round(F.col("o_totalprice").cast("double"), 2).alias("price"),
    )
    root = new_path(spark, "audited")
    contract = Contract(not_null=["priority"], unique=[["o_custkey", "day"]], between={"price": (1000.0, 300000.0)}, allowed=None)
    first = publish_audited(o, contract, root, "orders")
    try:
        publish_audited(o.unionAll(o), replace(contract, allowed=10), root, "orders")
        raise AssertionError("a table that breaks its contract was published")
    except ContractBroken:
        pass
    rows = both_sides(sound_rows(spark, root, "orders"), quarantine(spark, root, "orders", first.number))
    return rows.select("o_orderkey", F.array_join("_broken", ";").alias("broken"))
