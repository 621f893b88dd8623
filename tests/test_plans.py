import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from regiofact.config import (
    AtlasIndicator,
    AtlasV1,
    AtlasV2,
    CubeFamily,
    CubeIndicator,
    FilterRule,
    GroupSpec,
    MeasureSpec,
)
from regiofact.functions.geometry import GEOMETRY_TYPE
from regiofact.operators.history import VALID_FROM, VALID_TO
from regiofact.operators.quality import check_columns, check_unique
from regiofact.plans.geo_dims import boundary_snapshots, build_geo_dim, latest_only, list_geo
from regiofact.plans.indicators import build_atlas_indicators, build_cube_indicators
from regiofact.plans.mart import available_indicators, new_dictionaries
from regiofact.plans.queries import (
    ANSWER,
    Warehouse,
    get_indicator,
    get_indicators,
    get_portrait,
    get_values,
    topic_edges,
)
from regiofact.plans.warehouse import cube_family, publish
from regiofact.schemas import INTM, KEY_GROUPS, MART
from regiofact.sources.files import read_mart


def square(x, y, size=1000.0):
    ring = [(x, y), (x + size, y), (x + size, y + size), (x, y + size), (x, y)]
    return [[ring]]


@pytest.fixture(scope="module")
def cube(spark):
    data = [
        ("polg", 1, 2020, "m", "10", "2021-01-01", None), ("polg", 1, 2020, "w", "20", "2021-01-01", None),
        ("polg", 2, 2020, "m", "5", "2021-01-01", "2022-01-01"), ("polg", 2, 2020, "m", "6", "2022-01-01", None),
        ("polg", 3, 2020, "m", "7", "2021-01-01", None), ("bezk", 9, 2020, "m", "1", "2021-01-01", None),
        ("polg", 1, 2021, "m", "11", "2022-01-01", None),
    ]
    df = spark.createDataFrame(data, "geo_code string, geo_value int, y int, sex string, v string, f string, t string")
    return df.select(
        "geo_code", "geo_value", F.col("y").alias("year_from"), F.col("y").alias("year_to"), "sex",
        F.col("v").cast("decimal(38,18)").alias("indicator_value"), F.lit("Office").alias("source"),
        F.col("f").cast("timestamp_ntz").alias(VALID_FROM), F.col("t").cast("timestamp_ntz").alias(VALID_TO),
    )


@pytest.fixture(scope="module")
def areas(spark):
    """Municipalities 1 and 2 in a full hierarchy; 3 has no district."""
    past = spark.createDataFrame(
        [(1, 1, "One", 10, "Ten", 100, "KT", "CH-K", "20180101", "20191231", square(7.0, 47.0, 0.01)),
         (4, 4, "Gone", 10, "Ten", 100, "KT", "CH-K", "20170601", "20181231", square(7.1, 47.0, 0.01))],
        "GDENR int, GDEHISTID int, GDENAME string, BEZNR int, BEZNAME string, KTNR int, KTKZ string, CODE_ISO string,"
        f" VALID_FROM string, VALID_UNTI string, geometry {GEOMETRY_TYPE}",
    )
    gem = [(2019, 1, 11, "One", 10, 100), (2020, 1, 11, "Uno", None, 100), (2020, 2, 12, "Two", 10, 100), (2020, 3, 13, "Three", None, 100)]
    present = spark.createDataFrame(
        [(*g, square(2600000.0 + g[1] * 1000, 1200000.0)) for g in gem],
        f"_snapshot_year int, bfs_nummer int, hist_nr int, name string, bezirksnummer int, kantonsnummer int, geometry {GEOMETRY_TYPE}",
    )
    bez = spark.createDataFrame([(2020, 10, "Ten", 100, square(2600000.0, 1200000.0))], f"_snapshot_year int, bezirksnummer int, name string, kantonsnummer int, geometry {GEOMETRY_TYPE}")
    kan = spark.createDataFrame([(2020, 100, "K", "CHK", square(2600000.0, 1200000.0))], f"_snapshot_year int, kantonsnummer int, name string, icc string, geometry {GEOMETRY_TYPE}")
    dims = {level: build_geo_dim(past, now, level, "2020-06-01") for level, now in (("polg", present), ("bezk", bez), ("kant", kan))}
    return {level: d.checkpoint() for level, d in dims.items()}


@pytest.fixture(scope="module")
def warehouse(spark, cube, areas, tmp_path_factory):
    population = spark.createDataFrame([("polg", 1, dt.date(2020, 12, 31), Decimal(100))], "geo_code string, geo_value int, period_ref date, indicator_value_numeric decimal(38,18)")
    family = CubeFamily(
        [CubeIndicator(7, True, build_total_value="sum(indicator_value_numeric)", grouping=(GroupSpec("sex", "Sex"),)), CubeIndicator(8, False)],
        MeasureSpec("zahl", ["pro100"]),
    )
    facts = cube_family(cube.filter("sex = 'm' or geo_value = 1"), family, population)
    path = str(tmp_path_factory.mktemp("mart") / "mart")
    dims = publish([facts.filter("indicator_id = 7")], new_dictionaries(spark), path)
    seed = spark.createDataFrame(
        [(7, "Seven", "A", "B", None, None, "Persons", "d"), (8, "Eight", "A", None, None, None, "Persons", "d")],
        "indicator_id int, indicator_name string, topic_1 string, topic_2 string, topic_3 string, topic_4 string, indicator_unit string, indicator_description string",
    )
    return Warehouse(read_mart(spark, path, MART), dims, {k: latest_only(d) for k, d in areas.items()}, seed)


def test_cube_rows_follow_the_contract(cube):
    cfg = CubeIndicator(7, True, build_total_value="sum(indicator_value_numeric)", grouping=(GroupSpec("sex", "Sex"),))
    facts = build_cube_indicators(cube, [cfg])
    assert check_columns(facts, list(INTM)).count() == 0
    assert [f.dataType.simpleString() for f in facts.schema] == list(INTM.values())
    assert check_unique(facts, KEY_GROUPS).count() == 0
    assert {r.geo_code for r in facts.collect()} == {"polg"}
    total = facts.filter("group_1_value = 'GROUP TOTAL' and geo_value = 1 and year(period_ref) = 2020").first()
    assert total.indicator_value_numeric == 30


def test_contract_overflow_raises(cube):
    wide = cube.withColumn("geo_value", F.lit(70000))
    with pytest.raises(Exception, match="CAST_OVERFLOW"):
        build_cube_indicators(wide, [CubeIndicator(7, True)]).collect()


def test_atlas_groups_collapse_unless_keyed(spark):
    v2 = spark.createDataFrame(
        [("i", "polg2020", 1, g, "2020", "m1", Decimal(v)) for g, v in (("totvars", 9), ("a", 4), ("b", 5))],
        "bfs_indicateur_id string, bfs_nivgeo string, geo_value int, group_name string, period_ref string, map_id string, indicator_value decimal(38,18)",
    ).select("*", F.lit("s").alias("source"), F.lit("2021-01-01").cast("timestamp_ntz").alias(VALID_FROM), F.lit(None).cast("timestamp_ntz").alias(VALID_TO))
    cfg = AtlasIndicator(170, "duedate", "year", v2=AtlasV2("i", period_ref="make_date(period_ref::int, 12, 31)", grouping=GroupSpec("group_name", "G")))
    one = build_atlas_indicators(None, v2, [cfg]).collect()
    assert [(r.group_1_value, int(r.indicator_value_numeric)) for r in one] == [("GROUP TOTAL", 9)]
    assert build_atlas_indicators(None, v2, [cfg], keys=KEY_GROUPS).count() == 3


def test_plans_do_not_grow_with_the_rules(spark, cube):
    v1 = spark.createDataFrame(
        [(f"Orders {i}", p, "polg", "7", "2020-12-31", str(i), "s") for i in range(6) for p in ("_1_", None)],
        "variable string, mother_path string, geom_code string, geo_id string, period_ref string, value string, source string",
    ).select("*", F.lit("2021-01-01").cast("timestamp_ntz").alias(VALID_FROM), F.lit(None).cast("timestamp_ntz").alias(VALID_TO))
    size = lambda df: df._jdf.queryExecution().optimizedPlan().toString().count("\n")
    atlas = lambda n: build_atlas_indicators(
        v1, None, [AtlasIndicator(i, "duedate", "year", AtlasV1(f"^Orders {i}$", ["_1_", "_2_"] if i % 2 else [])) for i in range(n)]
    )
    assert size(atlas(2)) == size(atlas(300))
    got = {r.indicator_id: int(r.indicator_value_numeric) for r in atlas(300).collect()}
    assert got == {i: i for i in range(6)}
    cubes = lambda n: build_cube_indicators(cube, [
        CubeIndicator(i, True, filter_and=(FilterRule("sex", regex=f"^[mw]{{{i}}}$"), FilterRule("geo_code", exact_match="polg"))) for i in range(1, n)
    ])
    assert size(cubes(3)) == size(cubes(200))
    assert {r.indicator_id for r in cubes(200).collect()} == {1}
    both = build_atlas_indicators(v1, None, [AtlasIndicator(1, v1=AtlasV1("Orders 3")), AtlasIndicator(2, v1=AtlasV1("Orders", ["_1_"]))])
    assert sorted((r.indicator_id, r.period_ref.year) for r in both.collect()) == [(1, 2020), (2, 2020)]


def test_atlas_family_has_own_measures(spark):
    from regiofact.plans.warehouse import atlas_family

    v2 = spark.createDataFrame(
        [(i, "polg2020", 1, "totvars", "2020", "m1", Decimal(30)) for i in ("a", "b", "pop")],
        "bfs_indicateur_id string, bfs_nivgeo string, geo_value int, group_name string, period_ref string, map_id string, indicator_value decimal(38,18)",
    ).select("*", F.lit("s").alias("source"), F.lit("2021-01-01").cast("timestamp_ntz").alias(VALID_FROM), F.lit(None).cast("timestamp_ntz").alias(VALID_TO))
    end = "make_date(period_ref::int, 12, 31)"
    cfg = [
        AtlasIndicator(1, "duedate", "year", v2=AtlasV2("a", period_ref=end), measure=MeasureSpec("zahl", ["pro100"])),
        AtlasIndicator(2, "duedate", "year", v2=AtlasV2("b", period_ref=end)),
    ]
    people = spark.createDataFrame([("polg", 1, dt.date(2020, 12, 31), Decimal(60))], "geo_code string, geo_value int, period_ref date, indicator_value_numeric decimal(38,18)")
    got = {(r.indicator_id, r.measure_code): int(r.indicator_value_numeric) for r in atlas_family(None, v2, cfg, people).collect()}
    assert got == {(1, "zahl"): 30, (1, "pro100"): 50, (2, None): 30}


def test_yearly_dimension(areas):
    dim = areas["polg"]
    got = sorted((r.snapshot_code, r.gemeinde_bfs_id, r.gemeinde_name, r.bezirk_bfs_id) for r in dim.collect())
    assert got == [
        ("2018-01-01", 1, "One", 10), ("2018-01-01", 4, "Gone", 10), ("2019-01-01", 1, "One", 10),
        ("2020-01-01", 1, "Uno", 10), ("2020-01-01", 2, "Two", 10), ("2020-01-01", 3, "Three", None),
        ("latest", 1, "Uno", 10), ("latest", 2, "Two", 10), ("latest", 3, "Three", None), ("latest", 4, "Gone", 10),
    ]
    # in 2019 both sources have area 1: the present one wins
    assert dim.filter("snapshot_code = '2019-01-01'").first().gemeinde_hist_bfs_id == 11


def test_a_border_is_reprojected_once_for_all_its_years(spark):
    past = spark.createDataFrame(
        [(10, "Ten", 100, "20170101", "20191231", square(7.0, 47.0, 0.01))],
        f"BEZNR int, BEZNAME string, KTNR int, VALID_FROM string, VALID_UNTI string, geometry {GEOMETRY_TYPE}",
    )
    present = spark.createDataFrame([], f"_snapshot_year int, bezirksnummer int, name string, kantonsnummer int, geometry {GEOMETRY_TYPE}")
    snapshots = boundary_snapshots(past, present, "bezk", "2020-06-01")
    plan = snapshots._jdf.queryExecution().optimizedPlan().toString().splitlines()
    repeated = next(i for i, line in enumerate(plan) if "Generate explode" in line)
    reprojected = [i for i, line in enumerate(plan) if "ATANH" in line]
    assert reprojected and min(reprojected) > repeated  # below it in the plan
    assert snapshots.count() == 3


def test_listing_of_a_year(areas):
    assert list_geo(areas["polg"], "polg", 2020).count() == 6
    rows = list_geo(areas["polg"], "polg", 2020, "point", include_latest=False)
    assert rows.count() == 3 and rows.columns[-1] == "geometry"
    assert abs(rows.first().geometry.x - 7.46) < 0.05
    assert list_geo(areas["bezk"], "bezk", 2020, "point").first().geometry is not None
    assert list_geo(areas["polg"], "polg", 2020, skip=1, limit=2).count() == 2
    with pytest.raises(ValueError):
        list_geo(areas["polg"], "polg", 2020, "everything")


def test_answer_columns_and_defaults(warehouse):
    out = get_indicator(warehouse, "polg", 7, today=dt.date(2025, 6, 30))
    assert out.columns == [*ANSWER, "knowledge_date", "geometry"]
    got = sorted((r.geo_value, r.period_ref.year, r.measure_code, r.group_1_value, r.knowledge_date) for r in out.collect())
    day = "2025-06-30"
    assert got == [
        (1, 2020, "pro100", "GROUP TOTAL", day), (1, 2020, "zahl", "GROUP TOTAL", day),
        (1, 2021, "pro100", "GROUP TOTAL", day), (1, 2021, "zahl", "GROUP TOTAL", day),
        (2, 2020, "pro100", "GROUP TOTAL", day), (2, 2020, "zahl", "GROUP TOTAL", day),
    ]  # area 3 lacks a district and drops out


def test_answer_options(warehouse):
    def values(**options):
        out = get_indicator(warehouse, "polg", 7, measure="zahl", **options)
        return sorted((r.geo_value, r.group_1_value, int(r.indicator_value_numeric)) for r in out.collect())

    assert values(geo_value=2) == [(2, "GROUP TOTAL", 6)]
    assert values(geo_value=2, knowledge_date="2021-12-31") == [(2, "GROUP TOTAL", 5)]
    assert values(geo_value=2, knowledge_date="2022-01-01") == [(2, "GROUP TOTAL", 6)]
    assert values(geo_value=1, period_ref="2020-12-31", expand=(1,)) == [(1, "GROUP TOTAL", 30), (1, "m", 10), (1, "w", 20)]
    assert len(values(expand_all_groups=True)) == 7
    assert len(values(skip=1, limit=1)) == 1
    out = get_indicator(warehouse, "polg", 7, with_geo=True, with_indicator=True, geometry_mode="border")
    row = out.orderBy("geo_value").first()
    assert (row.geo_name, row.bezirk_name, row.kanton_name, row.indicator_name) == ("Uno", "Ten", "K", "Seven")
    assert len(row.geometry[0][0]) == 5


def test_unknown_indicator_is_empty(warehouse):
    assert get_indicator(warehouse, "polg", 999).count() == 0
    with pytest.raises(ValueError):
        get_indicator(warehouse, "land", 7)


def test_portrait_and_values(warehouse):
    out = get_portrait(warehouse, "polg", 1, period_ref="2021-12-31", measure="zahl")
    assert [int(r.indicator_value_numeric) for r in out.collect()] == [11]
    got = {(r.indicator_id, r.geo_value, r.measure_code): int(r.indicator_value_numeric) for r in get_values(warehouse, "polg", "zahl").collect()}
    assert got == {(7, 1, "zahl"): 11, (7, 2, "zahl"): 6, (7, 3, "zahl"): 7}


def test_catalogue_and_tree(warehouse, rows):
    held = available_indicators(warehouse.mart, warehouse.catalogue)
    polg = get_indicators(held, "polg")
    assert [(r.indicator_id, r.measure_codes) for r in polg.collect()] == [(7, ["pro100", "zahl"])]
    assert rows(topic_edges(polg)) == [("A", "B"), ("B", "[#0007] Seven (Persons) ['pro100', 'zahl']")]


def test_unnamed_measure_is_kept(spark):
    mart = spark.createDataFrame([(8, "polg", None), (8, "polg", "zahl"), (7, "polg", None)], "indicator_id int, geo_code string, measure_code string")
    seed = spark.createDataFrame([(7,), (8,)], "indicator_id int").select("*", *[F.lit("x").alias(c) for c in ("indicator_name", "topic_1", "topic_2", "topic_3", "topic_4", "indicator_unit", "indicator_description")])
    assert [r.measure_codes for r in available_indicators(mart, seed).collect()] == [[None], ["zahl", None]]


def test_ids_survive_another_publication(spark, warehouse, cube, tmp_path):
    from regiofact.plans.mart import extend_dictionaries

    more = build_cube_indicators(cube.withColumn("sex", F.lit("aaa")).withColumn("source", F.lit("Another")), [CubeIndicator(7, True, build_total_value="sum(indicator_value_numeric)", grouping=(GroupSpec("sex", "Sex"),))])
    grown = extend_dictionaries(warehouse.dictionaries, more)
    before = {tuple(r) for r in warehouse.dictionaries.group_value.collect()}
    assert before < {tuple(r) for r in grown.group_value.collect()}
    assert {tuple(r) for r in warehouse.dictionaries.source.collect()} < {tuple(r) for r in grown.source.collect()}
