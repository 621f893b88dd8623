"""Large facts are dealt to tasks by their number, and texts are looked for once."""

from pyspark.sql import functions as F

from regiofact.operators.reshape import distinct_on
from regiofact.plans.warehouse import publish_to, released_warehouse, rows_by_indicator, held_texts
from regiofact.schemas import INTM_MEASURED, MART, widened
from regiofact.session import ROWS_PER_TASK
from regiofact.sources import files

FACT = widened(INTM_MEASURED, geo_value="bigint")
MART_OF = widened(MART, geo_value="bigint")


def _facts(spark, n):
    given = {
        "indicator_id": F.when(F.col("id") % 4 == 0, 2).otherwise(1), "geo_code": F.lit("polg"), "geo_value": F.lit(7),
        "period_ref": F.date_add(F.lit("2000-12-31").cast("date"), F.col("id").cast("int")),
        "source": F.lit("s"), "indicator_value_numeric": F.col("id"),
    }
    return spark.range(n).select(*[given.get(c, F.lit(None)).cast(kind).alias(c) for c, kind in FACT.items()])


def test_many_facts_of_one_area_are_dealt_evenly(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(files, "ROWS_PER_FILE", 50)
    df = _facts(spark, 4000)
    files.write_mart(df, str(tmp_path / "mart"), {1: 3000, 2: 1000})
    back = spark.read.parquet(str(tmp_path / "mart"))
    sizes = [r[0] for r in back.groupBy(F.input_file_name()).count().select("count").collect()]
    assert len(sizes) == 80 and max(sizes) < 100
    assert back.groupBy("indicator_id").count().collect() == df.groupBy("indicator_id").count().collect()
    assert back.agg(F.sum("indicator_value_numeric")).first()[0] == 4000 * 3999 // 2


def test_few_facts_and_an_unknown_number_are_written_as_before(spark, tmp_path):
    df = _facts(spark, 8)
    for name, rows in (("few", {1: 6, 2: 2}), ("unknown", None)):
        files.write_mart(df, str(tmp_path / name), rows)
        assert spark.read.parquet(str(tmp_path / name)).count() == 8


def test_rows_of_indicators_are_counted_once_for_all_texts(spark):
    held = held_texts(_facts(spark, 8).withColumn("source", F.when(F.col("indicator_value_numeric") < 4, "a")))
    assert held.count() == 4
    assert rows_by_indicator(held) == {1: 6, 2: 2}


def test_written_parts_are_published_without_a_copy(spark, tmp_path, monkeypatch):
    from regiofact.plans import warehouse

    steps, kept = [], warehouse.materialize
    monkeypatch.setattr(warehouse, "materialize", lambda df: steps.append(df.columns) or kept(df))
    facts, root = kept(_facts(spark, 8)), str(tmp_path / "w")
    publish_to(spark, [facts.filter("indicator_id = 2")], root, written=True)
    assert "geo_value" not in {c for columns in steps for c in columns}
    mart, _ = released_warehouse(spark, root)
    assert sorted(r[0] for r in mart.select("indicator_value_numeric").collect()) == [0, 4]


def test_first_rows_of_many_are_dealt_by_key(spark):
    df = spark.createDataFrame([(1, 2), (1, 3), (None, 5), (None, 4), (2, None)], "k int, v int")
    out = distinct_on(df, ["k"], [F.col("v").asc_nulls_last()], 40 * ROWS_PER_TASK)
    assert out._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
    assert out.rdd.getNumPartitions() == 40
    assert {tuple(r) for r in out.collect()} == {(1, 2), (None, 4), (2, None)}


def test_very_many_facts_are_written_some_indicators_after_the_others(spark, tmp_path, monkeypatch):
    writes, kept = [], files.save_step
    monkeypatch.setattr(files, "ROWS_PER_WRITE", 50)
    monkeypatch.setattr(files, "save_step", lambda *a: writes.append(a[1]) or kept(*a))
    df = _facts(spark, 80)
    files.write_mart(df, str(tmp_path / "mart"), {1: 60, 2: 20})
    assert len(writes) == 2
    back = spark.read.parquet(str(tmp_path / "mart"))
    assert {tuple(r) for r in back.groupBy("indicator_id").count().collect()} == {(1, 60), (2, 20)}


def test_facts_go_when_the_mart_is_written(spark, tmp_path):
    from pathlib import Path

    from regiofact.plans.mart import new_dictionaries
    from regiofact.plans.warehouse import publish

    steps = lambda: {p.name for p in Path(spark.sparkContext.getCheckpointDir().removeprefix("file:")).glob("step-*")}
    before = steps()
    dims = publish([_facts(spark, 8)], new_dictionaries(spark), str(tmp_path / "mart"), MART_OF)
    left = [spark.read.parquet(f"{spark.sparkContext.getCheckpointDir()}/{n}").columns for n in steps() - before]
    assert "geo_value" not in {c for columns in left for c in columns}
    assert dims.source.count() == 1 and spark.read.parquet(str(tmp_path / "mart")).count() == 8
