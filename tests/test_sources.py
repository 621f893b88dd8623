import datetime as dt

import pytest
from pyspark.sql import functions as F

from regiofact.schemas import MART, widened
from regiofact.sources import files, nested
from regiofact.sources.pickup import modified_resources, oldest_unloaded, record_execution
from regiofact.streaming.pickup import load_new_files


def test_extract_is_never_replaced(spark, tmp_path):
    df = spark.range(3)
    files.write_extract(df, str(tmp_path), "x", "2025-01-01T00:00:00")
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        files.write_extract(df, str(tmp_path), "x", "2025-01-01T00:00:00")
    assert files.read_extract(spark, str(tmp_path), "x", "2025-01-01T00:00:00").count() == 3


def test_yearly_partitions_are_replaced_one_by_one(spark, tmp_path, rows):
    path = str(tmp_path / "years")
    files.write_snapshot_year(spark.createDataFrame([(1,), (2,)], "a int"), path, 2020)
    files.write_snapshot_year(spark.createDataFrame([(3,)], "a int"), path, 2021)
    files.write_snapshot_year(spark.createDataFrame([(9,)], "a int"), path, 2020)
    assert rows(spark.read.parquet(path)) == [(3, 2021), (9, 2020)]


def test_mart_prunes_and_spreads(spark, tmp_path):
    contract = {c: MART[c] for c in ("indicator_id", "geo_code", "geo_value", "period_ref", "knowledge_date_from", "indicator_value_numeric")}
    contract = widened(contract, geo_value="bigint")
    df = spark.range(4000).select(
        F.when(F.col("id") < 3000, 1).otherwise(2).alias("indicator_id"), F.lit("polg").alias("geo_code"),
        F.col("id").alias("geo_value"), F.lit(dt.date(2020, 12, 31)).alias("period_ref"),
        F.lit(None).cast("timestamp_ntz").alias("knowledge_date_from"), F.col("id").cast("decimal(32,9)").alias("indicator_value_numeric"),
    )
    path = str(tmp_path / "mart")
    files.write_mart(df, path)
    back = files.read_mart(spark, path, contract)
    assert back.count() == 4000 and back.columns == list(contract)
    one = back.filter("indicator_id = 1")
    scanned = one.inputFiles()
    assert one.count() == 3000 and len(scanned) >= 1
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(indicator_id" in plan.replace("cast(indicator_id", "indicator_id") or "PartitionFilters" in plan
    files.write_mart(df.filter("indicator_id = 2").limit(10), path)
    assert files.read_mart(spark, path, contract).groupBy("indicator_id").count().orderBy("indicator_id").collect() == [(1, 3000), (2, 10)]


def test_map_files_drop_exact_duplicates(spark, tmp_path, rows):
    (tmp_path / "7_131.csv").write_text("GEO_ID;VALUE\n0230;1\n0230;1\n")
    (tmp_path / "8_131.csv").write_text("GEO_ID;VALUE\n0230;1\n0001;2\n")
    df = files.read_map_files(spark, str(tmp_path / "*.csv"), "GEO_ID string, VALUE string", map_id_pattern=r"/(\d+)_131\.csv$")
    assert rows(df) == [("0001", "2", "8"), ("0230", "1", "7"), ("0230", "1", "8")]


def test_seeds(spark, tmp_path):
    (tmp_path / "seed_indicator.csv").write_text(
        "indicator_id,indicator_name,topic_1,topic_2,topic_3,topic_4,indicator_unit,indicator_description\n"
        '1,"Name, with comma",A,B,,,Unit,"over\ntwo lines"\n'
    )
    (tmp_path / "seed_measure.csv").write_text("measure_code,measure,measure_short\nzahl,Zahl,Zahl\n")
    (tmp_path / "seed_geocode.csv").write_text("geo_code,geo_name\npolg,Politische Gemeinde\n")
    seeds = files.read_seeds(spark, str(tmp_path))
    row = seeds["seed_indicator"].first()
    assert row.indicator_name == "Name, with comma" and row.topic_3 is None and "two" in row.indicator_description
    assert seeds["seed_measure"].count() == seeds["seed_geocode"].count() == 1


def test_feature_collection_over_several_lines(spark, tmp_path):
    (tmp_path / "a.json").write_text(
        '{"type": "FeatureCollection",\n "features": [{"type": "Feature", "properties": {"GDENR": 1},'
        ' "geometry": {"type": "MultiPolygon", "coordinates": [[[[1, 2], [3, 4], [1, 2]]]]}},'
        ' {"properties": {"GDENR": 2}, "geometry": null}]}'
    )
    df = files.read_features(spark, [str(tmp_path / "a.json")], "GDENR: int", multi_line=True)
    got = {r.gdenr: r.geometry for r in df.collect()}
    assert got[1][0][0][1] == (3.0, 4.0) and got[2] is None


def test_many_feature_files_are_one_scan(spark, tmp_path):
    paths, days = [], []
    for i in range(40):
        path = tmp_path / f"part {i}+.json"
        path.write_text('{"properties": {"GDENR": %d}, "geometry": null}' % i)
        paths.append(str(path))
        days.append(f"20{i + 10}-03-31")
    df = files.read_features(spark, paths, "GDENR: int", days)
    assert {r.gdenr: r.duedate.year for r in df.collect()} == {i: 2010 + i for i in range(40)}
    assert df._jdf.queryExecution().optimizedPlan().toString().count(" json") == 1


def test_wkb_round_trip(spark):
    from regiofact.functions.geometry import GEOMETRY_TYPE, from_wkb, to_wkb

    shapes = [[[[(0.1, 2.5), (1e7, -3.25), (0.1, 2.5)], [(5.0, 6.0)]], [[(7.0, 8.0), (9.0, 1 / 3)]]], [], None]
    df = spark.createDataFrame([(i, s) for i, s in enumerate(shapes)], f"i int, g {GEOMETRY_TYPE}")
    for r in df.select("g", from_wkb(to_wkb(F.col("g"))).alias("back")).collect():
        assert r.g == r.back


def test_export_formats(spark, tmp_path):
    import json

    shape = [[[(0.0, 0.0), (1.0, 0.0), (1.0, 1.5), (0.0, 0.0)]]]
    df = spark.createDataFrame(
        [(1, dt.date(2020, 12, 31), None, shape)],
        f"id int, period_ref date, note string, geometry {files.GEOMETRY_TYPE}",
    )
    for fmt in ("parquet", "csv", "json", "geojson"):
        files.export(df, str(tmp_path / fmt), fmt)
    feature = json.loads(spark.read.text(str(tmp_path / "geojson")).first().value)
    assert feature["properties"] == {"id": 1, "period_ref": "2020-12-31", "note": None}
    assert feature["geometry"]["coordinates"][0][0][2] == [1, 1.5]
    assert spark.read.parquet(str(tmp_path / "parquet")).schema["geometry"].dataType.typeName() == "binary"
    assert spark.read.csv(str(tmp_path / "csv"), header=True).first().geometry.startswith("MULTIPOLYGON (((0 0")
    assert spark.read.json(str(tmp_path / "json")).first().period_ref == "2020-12-31"
    with pytest.raises(ValueError):
        files.export(df, str(tmp_path / "x"), "xlsx")


@pytest.mark.parametrize("n", [0, 1, 50])
def test_feature_collection_is_one_document(spark, tmp_path, n):
    import json

    shape = [[[(0.0, 0.0), (1.0, 0.0), (1.0, 1.5), (0.0, 0.0)]]]
    df = spark.createDataFrame([(i, shape) for i in range(n)], f"id int, geometry {files.GEOMETRY_TYPE}").repartition(5)
    files.export(df, str(tmp_path / "fc"), "featurecollection")
    parts = sorted(p for p in (tmp_path / "fc").iterdir() if p.name.startswith("part-"))
    document = json.loads("".join(p.read_text() for p in parts))
    assert document["type"] == "FeatureCollection" and len(document["features"]) == n
    assert {f["properties"]["id"] for f in document["features"]} == set(range(n))


def test_profile_with_ratio(spark):
    row = files.load_profile(spark.range(6), {"n": "id"}, before=4).first()
    assert (row.num_records, float(row.size_ratio), row.n) == (6, 1.5, 6)
    assert files.load_profile(spark.range(6), {}, before=0).first().size_ratio is None


def test_cube_positions(spark):
    dims = [["a", "b"], ["x", "y", "z"], ["m", "f"]]
    values = [f"{i}{j}{k}" for i in dims[0] for j in dims[1] for k in dims[2]]
    df = spark.createDataFrame([(1, dims, values)], "cube int, dims array<array<string>>, values array<string>")
    got = nested.explode_cube(df, ["d1", "d2", "d3"]).collect()
    assert len(got) == 12 and all(r.d1 + r.d2 + r.d3 == r.indicator_value for r in got)


def test_distribution_edge_cases(spark, rows):
    def body(values):
        return '{"content":{"distribution":{"values":%s},"nivgeo":"polg2020","indic":{"c_id_indicateur":"i"}}}' % values

    df = spark.createDataFrame(
        [(body("[1, -9999]"),), (body("[1]"),), (body('{"g": [3, 4], "short": [1]}'),), ('{"content":{"distribution":{}}}',)],
        "response string",
    ).select(
        "response", F.array(F.lit(10), F.lit(20)).alias("codgeo"), F.array(F.lit("A"), F.lit("B")).alias("libgeo"),
        F.lit("2020").alias("period_ref"),
    )
    got = nested.unnest_distribution(df).select("geo_value", "indicator_value", "group_name")
    assert rows(got) == [(10, 1.0, "total"), (10, 3.0, "g"), (20, 4.0, "g"), (20, None, "total")]


def test_pickup_state(spark, rows):
    stamp = lambda df, c: df.withColumn(c, F.col(c).cast("timestamp_ntz"))
    res = stamp(spark.createDataFrame([("a", "2020-01-02"), ("b", "2020-01-01"), ("c", "1999-01-01")], "resource_id string, last_modified string"), "last_modified")
    state = stamp(spark.createDataFrame([("a", "2020-01-01"), ("b", "2020-01-01")], "resource_id string, last_execution string"), "last_execution")
    due = modified_resources(res, state)
    assert sorted(r.resource_id for r in due.collect()) == ["a", "c"]
    later = record_execution(state, due, "2021-01-01")
    assert modified_resources(res, later).count() == 0 and later.count() == 3


def test_oldest_unloaded(spark):
    listed = spark.createDataFrame([("f_2020-02-01.zip",), ("f_2020-01-01.zip",), ("none.zip",)], "identifier string")
    stored = spark.createDataFrame([("f_2020-01-01.zip",)], "identifier string")
    got = oldest_unloaded(listed, stored, r"(\d{4}-\d{2}-\d{2})").collect()
    assert [r.identifier for r in got] == ["f_2020-02-01.zip"]
    assert oldest_unloaded(listed, listed, r"(\d{4})").count() == 0


def test_stream_takes_each_file_once(spark, tmp_path):
    source, target, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    run = lambda: load_new_files(spark, source, "id bigint", target, state)
    spark.range(3).write.mode("append").parquet(source)
    run()
    run()
    assert spark.read.parquet(target).count() == 3
    spark.range(2).write.mode("append").parquet(source)
    run()
    assert spark.read.parquet(target).count() == 5
