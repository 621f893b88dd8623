"""Steps that are dealt to as many tasks as the number of rows asks for."""

from pyspark.sql import functions as F

from regiofact.operators.totals import build_totals
from regiofact.session import ROWS_PER_TASK, spread
from workloads import facts

MANY = 40 * ROWS_PER_TASK


def _grouped(spark):
    df = spark.createDataFrame(
        [(1, "a", "x", 1), (1, "a", "x", 4), (1, None, "y", 2), (None, "b", None, 8), (None, "b", None, 16)],
        "geo_value int, group_1_value string, group_2_value string, indicator_value_numeric int",
    )
    return df.withColumn("group_1_name", F.lit("A")).withColumn("indicator_value_text", F.lit(None).cast("string"))


def _shuffles(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.count("Exchange hashpartitioning")


def test_rows_are_spread_by_their_number(spark):
    df = spark.range(10)
    assert spread(df, MANY, "id").rdd.getNumPartitions() == 40
    assert spread(df, 10, "id") is df


def test_totals_of_many_rows_are_dealt_by_their_number(spark, rows):
    df = _grouped(spark)
    out = build_totals(df, 2, "sum(indicator_value_numeric)", MANY)
    assert _shuffles(out) == 1
    assert out.rdd.getNumPartitions() == 40
    got = rows(out.select("geo_value", "group_1_value", "group_2_value", "indicator_value_numeric"))
    t = "GROUP TOTAL"
    expected = [
        (1, "a", "x", 5), (1, None, "y", 2), (1, "a", t, 5), (1, None, t, 2), (1, t, t, 7),
        (None, "b", None, 24), (None, "b", t, 24), (None, t, t, 24),
    ]
    assert got == sorted(expected, key=lambda r: tuple(map(str, r)))
    assert out.columns == df.columns
    assert rows(build_totals(df, 2, "sum(indicator_value_numeric)")) == rows(out)


def test_totals_of_rows_that_lie_together_are_not_shuffled_again(spark):
    df = _grouped(spark).repartition(40, "geo_value")
    assert _shuffles(build_totals(df, 2, "sum(indicator_value_numeric)")) == 1


def test_lines_are_joined_once_for_all_loads_of_a_history(spark, monkeypatch):
    asked = []

    def lines(spark, d):
        asked.append(d)
        return spark.sql(
            "select 1L o_orderkey, 'O' o_orderstatus, date '1999-01-01' od, date '2000-01-01' sd, cast(5 as decimal(18,2)) v"
        )

    monkeypatch.setattr(facts, "lines", lines)
    written = {tuple(r) for r in facts._written(spark, "here").written().collect()}
    assert written == {(1, "opened", 1), (2, "opened", 1), (2, "marks", 1)}
    assert asked == ["here"]
