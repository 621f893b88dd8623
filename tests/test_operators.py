import datetime as dt
import glob
import os
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from regiofact.config import CubeIndicator, GroupSpec, MeasureSpec, atlas_indicator, cube_indicator
from regiofact.operators.dictionaries import (
    collect_texts,
    extend_dictionary,
    group_value_seed,
)
from regiofact.operators.filters import known_at, where_set
from regiofact.operators.history import HistoryTable, open_history, scd2_apply
from regiofact.operators.joins import expand_ancestors, lookup_join, resolve_by_name
from regiofact.operators.measures import expand_measures
from regiofact.operators.numbering import Place, SortKey, number_rows, page, page_after, place_of
from regiofact.operators.quality import (
    check_between,
    check_columns,
    check_contract,
    check_min_rows,
    check_row_count,
    check_unique,
)
from regiofact.operators.reshape import (
    distinct_on,
    fan_out,
    fill_last_known,
    last_known,
    latest_per_entity,
    melt,
    snapshot_grid,
    union_tagged,
)
from regiofact.operators.totals import build_totals, check_aggregate, group_columns


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_lookup_join_plans_without_running(spark, rows, how):
    facts = spark.createDataFrame([("a", 1), ("a", 1), ("b", 2), (None, 3)], "k string, v int")
    lookup = spark.createDataFrame([("a", "x"), ("b", None), ("d", "z")], "k string, w string")
    tracker = spark.sparkContext.statusTracker()
    before = len(tracker.getJobIdsForGroup())
    joined = lookup_join(facts, lookup, ["k"], how)
    assert len(tracker.getJobIdsForGroup()) == before
    assert rows(joined) == rows(facts.join(lookup, "k", how))


@pytest.fixture
def skewed(spark):
    """Settings under which a hot key of a small table counts as skewed."""
    changed = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {k: spark.conf.get(k) for k in changed}
    for k, v in changed.items():
        spark.conf.set(k, v)
    yield lambda df: "skew=true" in df._jdf.queryExecution().executedPlan().toString()
    for k, v in before.items():
        spark.conf.set(k, v)


def test_skewed_lookup_is_split(spark, skewed):
    """Adaptive execution splits a hot key of the row side; no code of ours does."""
    facts = spark.range(0, 200_000, numPartitions=4).select(F.lit(1).alias("k"), F.col("id").alias("v"))
    facts = facts.union(spark.range(5000).select("id", "id"))
    lookup = spark.range(5000).select(F.col("id").alias("k"), F.lit(2).alias("w"))
    joined = lookup_join(facts, lookup, ["k"], "inner")
    assert joined.count() == 205_000
    joined.collect()
    assert skewed(joined)


def test_skewed_entities_and_names_are_split(spark, skewed):
    """The same where the other side is an aggregate, which is written first."""
    rows = spark.range(0, 200_000, numPartitions=4).select(F.lit(1).alias("k"), F.col("id").alias("o"), F.when(F.col("id") % 3 == 0, F.col("id")).alias("v"))
    rows = rows.union(spark.range(5000).select("id", "id", F.lit(None).cast("long")))
    filled = fill_last_known(rows, "k", "o", ["v"])
    assert len(filled.collect()) == 205_000 and skewed(filled)
    assert filled.filter("k = 1 and v is null").count() == 0
    places = spark.range(5000).select(F.concat(F.lit("n"), "id").alias("gemeinde_name"), F.col("id").alias("gemeinde_bfs_id"))
    named = rows.select(F.lit("polg").alias("geo_code"), F.lit(None).cast("long").alias("geo_value"), F.concat(F.lit("n"), "k").alias("geo_value_name"))
    found = resolve_by_name(named, places)
    assert len(found.collect()) == 205_000 and skewed(found)


def test_snapshot_grid_includes_both_ends(spark, rows):
    df = spark.createDataFrame(
        [(1, dt.date(2000, 1, 1), dt.date(2002, 1, 1)), (2, dt.date(2000, 1, 2), dt.date(2000, 12, 31)),
         (3, dt.date(2001, 6, 1), dt.date(2099, 1, 1)), (4, None, dt.date(2001, 1, 1)),
         (5, dt.date(1700, 1, 1), dt.date(1851, 3, 1))],
        "id int, f date, t date",
    )
    got = rows(snapshot_grid(df, "f", "t", "1850-01-01", "2003-05-05").select("id", F.year("snapshot_date")))
    assert got == [(1, 2000), (1, 2001), (1, 2002), (3, 2002), (3, 2003), (5, 1850), (5, 1851)]


def test_distinct_on_follows_null_order(spark, rows):
    df = spark.createDataFrame([(1, None, "a"), (1, 5, "b"), (2, 1, "c"), (2, 3, "d")], "k int, o int, v string")
    got = distinct_on(df, ["k"], [F.col("o").desc_nulls_first()])
    assert rows(got.select("k", "v")) == [(1, "a"), (2, "d")]


def test_distinct_on_limits_before_the_shuffle(spark):
    df = spark.range(10).withColumn("k", F.col("id") % 2)
    plan = distinct_on(df, ["k"], [F.col("id")])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_latest_per_entity_keeps_ties(spark, rows):
    df = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (1, 2, "c"), (2, 1, "d")], "e int, s int, v string")
    assert rows(latest_per_entity(df, "e", "s")) == [(1, 2, "b"), (1, 2, "c"), (2, 1, "d")]


def test_last_known_of_all_null(spark, rows):
    df = spark.createDataFrame([(1, 1, None), (1, 2, "b"), (1, 3, None), (2, 1, None)], "e int, s int, v string")
    assert rows(last_known(df, "e", "s", ["v"])) == [(1, "b"), (2, None)]


def test_fan_out_emits_every_match(spark, rows):
    df = spark.range(4)
    rules = [(F.col("id") < 2, {"r": F.lit("a"), "id": F.col("id")}), (F.col("id") > 0, {"r": F.lit("b"), "id": F.col("id")})]
    assert rows(fan_out(df, rules)) == [("a", 0), ("a", 1), ("b", 1), ("b", 2), ("b", 3)]


def test_melt_and_union_by_name(spark, rows):
    df = spark.createDataFrame([(1, 2, 3)], "k int, a int, b int")
    got = melt(df, ["k"], {"a": 101, "b": 102}).select("k", "indicator_id", F.col("indicator_value_numeric").cast("int"))
    assert rows(got) == [(1, 101, 2), (1, 102, 3)]
    other = spark.createDataFrame([(9, 8)], "a int, k int")
    assert rows(union_tagged(df, other).select("src_order", "k", "a", "b")) == [(1, 1, 2, 3), (2, 8, 9, None)]


def test_name_lookup_takes_highest_number(spark, rows):
    dim = spark.createDataFrame([(1, "Buchs"), (7, "Buchs"), (3, "Wil")], "gemeinde_bfs_id int, gemeinde_name string")
    df = spark.createDataFrame(
        [("polg", None, "Buchs"), ("polg", 5, "Wil"), ("bezk", None, "Wil"), ("polg", None, None)],
        "geo_code string, geo_value int, geo_value_name string",
    )
    got = rows(resolve_by_name(df, dim))
    assert got == [("bezk", None, "Wil"), ("polg", 5, "Wil"), ("polg", 7, "Buchs"), ("polg", None, None)]


def test_ancestors_stop_at_the_top(spark, rows):
    maps = spark.createDataFrame([(10, 3), (11, 2), (12, 99)], "map_id int, structure_id int")
    edges = spark.createDataFrame([(3, "c", 2), (2, "b", 1), (3, "c", 2)], "child_id int, child_name string, structure_id int")
    got = expand_ancestors(maps, edges)
    assert got.columns == ["map_id", "mother_0_id", "mother_0_name", "mother_1_id", "mother_1_name"]
    assert rows(got) == [(10, 3, "c", 2, "b"), (11, 2, "b", None, None), (12, None, None, None, None)]


def test_ancestors_of_any_depth(spark, rows):
    maps = spark.createDataFrame([(1, 20)], "map_id int, structure_id int")
    edges = spark.createDataFrame([(i, str(i), i - 1) for i in range(20, 9, -1)], "child_id int, child_name string, structure_id int")
    row = expand_ancestors(maps, edges).first()
    assert [row[f"mother_{i}_id"] for i in range(11)] == list(range(20, 9, -1)) and len(row) == 23
    circle = spark.createDataFrame([(20, "a", 21), (21, "b", 20)], "child_id int, child_name string, structure_id int")
    with pytest.raises(ValueError):
        expand_ancestors(maps, circle)


# -- totals -------------------------------------------------------------------


def test_null_group_is_not_a_total(spark, rows):
    df = spark.createDataFrame(
        [("k", "a", Decimal(1)), ("k", None, Decimal(2))],
        "key string, group_1_value string, indicator_value_numeric decimal(38,18)",
    )
    got = build_totals(df, 1, "sum(indicator_value_numeric)").select(
        "group_1_value", F.col("indicator_value_numeric").cast("int")
    )
    assert rows(got) == [("GROUP TOTAL", 3), (None, 2), ("a", 1)]


def test_totals_are_prefix_only(spark):
    df = spark.createDataFrame(
        [("a", "x", Decimal(1)), ("b", "x", Decimal(2))],
        "group_1_value string, group_2_value string, indicator_value_numeric decimal(38,18)",
    ).withColumn("key", F.lit(1))
    got = {(r.group_1_value, r.group_2_value) for r in build_totals(df, 2, "sum(indicator_value_numeric)").collect()}
    assert ("GROUP TOTAL", "x") not in got and ("a", "GROUP TOTAL") in got and ("GROUP TOTAL",) * 2 in got


def test_totals_need_an_aggregate(spark):
    df = spark.createDataFrame([(Decimal(1),)], "indicator_value_numeric decimal(38,18)")
    with pytest.raises(ValueError, match="not an aggregate"):
        check_aggregate(df, "indicator_value_numeric + 1")


def test_group_without_total_is_dropped(spark):
    made = group_columns([GroupSpec("c", "C"), GroupSpec("d", "D", "all")], None)
    df = spark.createDataFrame([("x", "all")], "c string, d string").select(*[v.alias(k) for k, v in made.items()])
    assert tuple(df.first())[:4] == (None, None, "D", "GROUP TOTAL")


# -- measures -----------------------------------------------------------------

FACT = "geo_code string, geo_value int, period_ref date, indicator_value_numeric decimal(38,18)"


@pytest.fixture
def measured(spark):
    facts = spark.createDataFrame(
        [("polg", i, dt.date(2020, 12, 31), Decimal(50)) for i in (1, 2, 3)], FACT
    )
    population = spark.createDataFrame(
        [("polg", 1, dt.date(2020, 6, 1), Decimal(200)), ("polg", 2, dt.date(2020, 12, 31), Decimal(0))], FACT
    )

    def run(spec):
        out = expand_measures(facts, population, spec)
        return {(r.geo_value, r.measure_code): r.indicator_value_numeric for r in out.collect()}

    return run


def test_measures_from_counts(measured):
    got = measured(MeasureSpec("zahl", ["pro100", "pro1000"]))
    assert got[1, "zahl"] == 50 and got[1, "pro100"] == 25 and got[1, "pro1000"] == 250
    assert got[2, "pro100"] is None and got[3, "pro100"] is None and got[3, "zahl"] == 50
    assert len(got) == 9


def test_measures_round_once(spark):
    def one(value, persons, spec, area=1):
        facts = spark.createDataFrame([("polg", area, dt.date(2020, 12, 31), Decimal(value))], FACT)
        people = spark.createDataFrame([("polg", area, dt.date(2020, 6, 1), Decimal(persons))], FACT)
        return {r.measure_code: r.indicator_value_numeric for r in expand_measures(facts, people, spec).collect()}

    nine = Decimal("0.000000001")
    got = one("0.0000000004", "10.5", MeasureSpec("zahl", ["pro100000"]))
    assert got["pro100000"].quantize(nine) == Decimal("0.000003810")
    assert one("20", "10.5", MeasureSpec("zahl", ["pro100"]))["pro100"].quantize(nine) == Decimal("190.476190476")
    got = one("20", "10.5", MeasureSpec("pro100", ["zahl"]))
    assert got["zahl"] == Decimal("2.1") and got["pro100"] == 20
    large = one("123456789012345678.5", "4", MeasureSpec("zahl", ["pro100"]))
    assert large["pro100"] == Decimal("3086419725308641962.5")


def test_measures_from_ratio_round_trip(measured):
    got = measured(MeasureSpec("pro1000", ["pro100", "zahl"]))
    assert got[1, "zahl"] == 10 and got[1, "pro1000"] == 50 and got[1, "pro100"] == 5
    assert got[3, "zahl"] is None and got[3, "pro1000"] is None
    assert {m for _, m in got} == {"zahl", "pro100", "pro1000"}


def test_measure_labels(measured):
    assert set(m for _, m in measured(MeasureSpec("zahl"))) == {"zahl"}
    assert set(m for _, m in measured(None)) == {None}
    assert measured(MeasureSpec("pro100"))[1, "pro100"] == 100
    with pytest.raises(ValueError):
        measured(MeasureSpec("pro7"))


def test_measures_of_many_indicators_in_one_pass(spark, rows):
    facts = spark.createDataFrame(
        [(i, "polg", 1, dt.date(2020, 12, 31), Decimal(50)) for i in (1, 2, 3, 4)], "indicator_id int, " + FACT
    )
    population = spark.createDataFrame([("polg", 1, dt.date(2020, 6, 1), Decimal(200))], FACT)
    specs = {1: MeasureSpec("zahl", ["pro100"]), 2: MeasureSpec("pro1000", ["zahl"]), 3: None}
    together = expand_measures(facts, population, specs)
    apart = [
        expand_measures(facts.filter(F.col("indicator_id") == i), population, specs.get(i))
        for i in (1, 2, 3, 4)
    ]
    assert rows(together) == sorted((r for df in apart for r in rows(df)), key=lambda r: tuple(map(str, r)))
    assert together.count() == 6


# -- history ------------------------------------------------------------------

STATE = "k string, v string, w int"


def load(spark, *items):
    return spark.createDataFrame(list(items), STATE)


def versions(df):
    return sorted(
        ((r.k, r.v, str(r.valid_from)[:10], str(r.valid_to)[:10]) for r in df.collect()), key=str
    )


def test_history_of_changes(spark):
    h = open_history(load(spark, ("same", "a", 1), ("changed", "a", 1), ("gone", "a", 1), ("null", None, 1), ("set", "a", 1)), "2020-01-01")
    new = load(spark, ("same", "a", 2), ("changed", "b", 1), ("new", "a", 1), ("null", "a", 1), ("set", None, 1))
    got = versions(scd2_apply(h, new, "k", ["v"], "2021-01-01"))
    assert got == sorted([
        ("same", "a", "2020-01-01", "None"),
        ("changed", "a", "2020-01-01", "2021-01-01"), ("changed", "b", "2021-01-01", "None"),
        ("gone", "a", "2020-01-01", "2021-01-01"), ("new", "a", "2021-01-01", "None"),
        ("null", None, "2020-01-01", "2021-01-01"), ("null", "a", "2021-01-01", "None"),
        ("set", "a", "2020-01-01", "2021-01-01"), ("set", None, "2021-01-01", "None"),
    ], key=str)


def test_history_is_idempotent_and_reopens(spark):
    first, second = load(spark, ("a", "x", 1), ("b", "x", 1)), load(spark, ("b", "y", 1))
    h = scd2_apply(open_history(first, "2020-01-01"), second, "k", ["v"], "2021-01-01")
    assert versions(scd2_apply(h, second, "k", ["v"], "2022-01-01")) == versions(h)
    again = versions(scd2_apply(h, first, "k", ["v"], "2022-01-01"))
    assert ("a", "x", "2020-01-01", "2021-01-01") in again and ("a", "x", "2022-01-01", "None") in again
    opened = [v for v in again if v[3] == "None"]
    assert len({v[0] for v in opened}) == len(opened)


def test_history_can_keep_vanished_rows(spark):
    h = open_history(load(spark, ("a", "x", 1)), "2020-01-01")
    got = versions(scd2_apply(h, load(spark, ("b", "x", 1)), "k", ["v"], "2021-01-01", hard_deletes=False))
    assert ("a", "x", "2020-01-01", "None") in got


def test_history_takes_new_columns(spark, rows):
    h = open_history(load(spark, ("a", "x", 1)), "2020-01-01")
    wider = load(spark, ("a", "y", 1)).withColumn("extra", F.lit("e"))
    got = scd2_apply(h, wider, "k", ["v"], "2021-01-01")
    assert rows(got.select("v", "extra")) == [("x", None), ("y", "e")]


def test_knowledge_interval_is_half_open(spark):
    df = spark.createDataFrame(
        [(1, "2020-01-01", "2021-01-01"), (2, "2021-01-01", None)], "id int, f string, t string"
    ).select("id", F.col("f").cast("timestamp_ntz").alias("knowledge_date_from"), F.col("t").cast("timestamp_ntz").alias("knowledge_date_to"))
    at = lambda day: sorted(r.id for r in known_at(df, day).collect())
    assert (at("2019-12-31"), at("2020-01-01"), at("2020-12-31"), at("2021-01-01"), at(None)) == ([], [1], [1], [2], [2])


def test_empty_filters_count_as_unset(spark):
    df = spark.createDataFrame([(0, "a"), (1, "b")], "n int, s string")
    assert where_set(df, n=0, s="").count() == 2 and where_set(df, n=1).count() == 1


def test_history_table_plan_does_not_grow(spark, rows, tmp_path):
    table = HistoryTable(spark, str(tmp_path / "h"), "k", ("v",))
    loads = [[("a", "1"), ("b", "1")], [("a", "2"), ("b", "1")], [("a", "2")], [("a", "2"), ("b", "9")], [("a", "3")]]
    plans, history = [], None
    for n, items in enumerate(loads):
        df = spark.createDataFrame(items, "k string, v string")
        day = f"2020-01-0{n + 1}"
        table.load(df, day)
        history = open_history(df, day) if history is None else scd2_apply(history, df, "k", ["v"], day)
        plans.append(table.read()._jdf.queryExecution().optimizedPlan().toString().count("Relation"))
    assert plans == [plans[0]] * 5
    assert rows(table.read().select(*history.columns)) == rows(history)
    assert table.read(1).count() == 2
    assert rows(table.current().select(*history.columns)) == rows(history.filter("valid_to is null"))


def folder_bytes(path):
    return sum(os.path.getsize(f) for f in glob.glob(f"{path}/**/*.parquet", recursive=True))


def test_a_load_writes_its_changes_only(spark, rows, tmp_path):
    table = HistoryTable(spark, str(tmp_path / "h"), "k", ("v", "w"))
    base = spark.range(40_000).select(F.col("id").alias("k"), F.md5(F.col("id").cast("string")).alias("v"), F.lit(1).alias("w"))
    one_percent = base.withColumn("v", F.when(F.col("k") % 100 == 7, F.lit("new")).otherwise(F.col("v"))).filter("k <> 5")
    table.load(base, "2020-01-01")
    table.load(one_percent.unionAll(base.limit(1).select(F.lit(-1).cast("long"), "v", "w")), "2020-01-02")
    written = {(r.version, r.part): r.n for r in table.written().collect()}
    assert written == {(1, "opened"): 40_000, (2, "opened"): 401, (2, "marks"): 401}
    assert folder_bytes(tmp_path / "h/rows/_version=2") < 0.05 * folder_bytes(tmp_path / "h/rows/_version=1")
    table.load(table.current().select("k", "v", "w"), "2020-01-03")
    assert (3, "opened") not in {(r.version, r.part) for r in table.written().collect()}
    before = rows(table.read())
    table.fold()
    assert rows(table.read()) == before and table.state().base == 4
    assert rows(table.read(3)) == before
    plan = table.current()._jdf.queryExecution().executedPlan().toString()
    assert "_part" in plan.split("PartitionFilters: ")[1].split("PushedFilters")[0]
    table.load(base, "2020-01-04")
    again = table.read()
    assert again.count() == 40_000 + 401 + 401 and again.filter("valid_to is null").count() == 40_000


def test_a_load_that_ends_early_changes_nothing(spark, rows, tmp_path):
    table = HistoryTable(spark, str(tmp_path / "h"), "k", ("v",))
    table.load(load(spark, ("a", "x", 1)), "2020-01-01")
    # what a load without its record leaves behind, with other columns
    load(spark, ("b", "y", 1)).withColumn("_part", F.lit("opened")).write.partitionBy("_part").parquet(str(tmp_path / "h/rows/_version=2"))
    assert [r.v for r in table.read().collect()] == ["x"]
    wider = load(spark, ("a", "y", 1), (None, "n", 1)).withColumn("extra", F.lit("e"))
    table.load(wider, "2021-01-01")
    assert rows(table.read().select("k", "v", "extra", F.year("valid_to"))) == [(None, "n", "e", None), ("a", "x", None, 2021), ("a", "y", "e", None)]
    table.load(load(spark, ("a", "y", 1)), "2022-01-01")
    assert rows(table.current().select("k", "v", "extra")) == [("a", "y", "e")]


# -- dictionaries and numbering -------------------------------------------------


def test_dictionary_ids_are_stable_and_unique(spark):
    values = lambda *v: spark.createDataFrame([(x,) for x in v], "group_value_name string")
    first = extend_dictionary(group_value_seed(spark), values("m", "z", "GROUP TOTAL", None, "m"))
    before = {r.group_value_name: r.group_value_id for r in first.collect()}
    assert before == {"GROUP TOTAL": 1, "m": 2, "z": 3}
    after = {r.group_value_name: r.group_value_id for r in extend_dictionary(first, values("a", "z", "b")).collect()}
    assert {k: after[k] for k in before} == before and sorted(after.values()) == [1, 2, 3, 4, 5]


def test_texts_in_one_pass(spark, rows):
    df = spark.createDataFrame(
        [("s", "g", "v", None, "w")], "source string, group_1_name string, group_1_value string, group_2_name string, group_2_value string"
    ).select("*", *[F.lit(None).cast("string").alias(f"group_{n}_{p}") for n in (3, 4) for p in ("name", "value")])
    assert rows(collect_texts(df)) == [("group", "g"), ("group_value", "v"), ("group_value", "w"), ("source", "s")]


def test_pages_by_place_are_the_pages_by_skip(spark):
    rnd = random.Random(5)
    data = [(rnd.choice([None, 1, 2, 3]), rnd.choice([None, "x", "y"]), rnd.choice([0.5, None])) for _ in range(90)] + [(2, "x", 0.5)] * 40
    df = spark.createDataFrame(data, "a int, b string, c double").repartition(5)
    order = [SortKey("a"), SortKey("b", ascending=False)]
    whole = [tuple(r) for r in page(df, [k.column for k in order], 0, 200).collect()]
    got, after = [], None
    while True:
        rows = page_after(df.repartition(3), order, 17, after)
        found = [tuple(r) for r in rows.collect()]
        if not found:
            break
        got += found
        after = place_of(rows, order, after)
    assert got == whole and sorted(map(str, got)) == sorted(map(str, data))
    assert place_of(df.filter("a > 5"), order) is None


def test_a_page_by_place_reads_behind_it(spark, tmp_path):
    spark.range(10_000).select("id", (F.col("id") % 7).alias("v")).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    plan = page_after(df, [SortKey("id")], 10, Place((9_000,), 0, 0))._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(id,9000)" in plan.split("PushedFilters: ")[1].split("ReadSchema")[0]


def test_row_numbers_with_many_copies(spark):
    data = [(1,)] * 500 + [(i,) for i in range(2, 200)] + [(300,)] * 300
    df = spark.createDataFrame(data, "v int").repartition(7)
    got = sorted((r.n, r.v) for r in number_rows(df, [F.col("v")], "n").collect())
    assert got == list(enumerate(sorted(v for v, in data), start=1))


@pytest.mark.parametrize("skip, limit", [(0, 10), (5, 7), (95, 50), (30, None), (None, None), (200, 5)])
def test_pages_agree_with_a_sort(spark, skip, limit):
    df = spark.range(100).repartition(5)
    expected = list(range(100))[(skip or 0): (skip or 0) + limit if limit else None]
    got = [r.id for r in page(df, [F.col("id")], skip, limit).collect()]
    assert (sorted(got) if not skip and not limit else got) == expected


def test_pages_of_ties_do_not_overlap(spark):
    df = spark.range(60).select("id", F.lit(1).alias("same"))
    order = [F.col("same")]
    first = [r.id for r in page(df.repartition(4), order, 0, 20).collect()]
    second = [r.id for r in page(df.repartition(7), order, 20, 25).collect()]
    rest = [r.id for r in page(df.repartition(2), order, 45).collect()]
    assert sorted(first + second + rest) == list(range(60))
    assert first == [r.id for r in page(df.repartition(9), order, None, 20).collect()]


# -- checks ---------------------------------------------------------------------


def test_checks(spark, rows):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (None, "c")], "id int, v string")
    assert rows(check_columns(df, ["ID", "V"])) == []
    assert rows(check_columns(df, ["v", "id", "x"])) == [(1, "V", "ID"), (2, "ID", "V"), (3, "X", None)]
    assert rows(check_unique(df, ["id"])) == [(1, 2)]
    assert rows(check_min_rows(df, 2, ["id"])) == [(None, 1)]
    assert rows(check_min_rows(df, 2, ["id"], F.col("id").isNotNull())) == []
    assert rows(check_row_count(df, 1, 2)) == [(3,)] and rows(check_row_count(df, 1)) == []
    assert rows(check_between(df, "id", 2, 9)) == [(2,)] and rows(check_between(df, "id", 1, 9)) == []
    assert rows(check_contract(df, ["id", "v"], ["id", "v"], {"id": "smallint"})) == [
        ("not_null", "id", 1), ("type", "id", 1), ("unique", "id", 1),
    ]


# -- configuration ------------------------------------------------------------------


def test_configuration_from_mappings():
    cfg = cube_indicator({"indicator_id": 1, "grouping": [{"column": "c", "total_value": "all"}], "filter_and": [{"column": "x", "regex": "^a"}]})
    assert isinstance(cfg, CubeIndicator) and cfg.grouping[0].total_value == "all" and cfg.filter_and[0].regex == "^a"
    atlas = atlas_indicator({"indicator_id": 2, "v2": {"indicateur_id": "x", "grouping": {"column": "group_name"}}, "measure": {"base": "zahl"}})
    assert atlas.v2.grouping.column == "group_name" and atlas.measure.calc is None
    with pytest.raises(KeyError):
        cube_indicator({"indicator_id": 1, "typo": 2})
