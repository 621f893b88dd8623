"""Dimensions are written as rows and shapes, each shape once."""

from pyspark.sql import functions as F

from regiofact.functions.geometry import GEOMETRY_TYPE, LV95, WGS84, centre_in_wgs84, centroid, reproject, reproject_point, to_wgs84
from regiofact.plans.geo_dims import build_geo_dim, read_geo_dim, store_geo_dim, write_geo_dim


def square(x, y, side=1000.0):
    return [[[(x, y), (x + side, y), (x + side, y + side), (x, y + side), (x, y)]]]


def sources(spark, years, name="Ten"):
    past = spark.createDataFrame([], f"BEZNR int, BEZNAME string, KTNR int, VALID_FROM string, VALID_UNTI string, geometry {GEOMETRY_TYPE}")
    rows = [(y, k, f"{name}{k}", 1, square(2600000.0 + 1000 * k, 1200000.0)) for y in years for k in (0, 1)]
    return past, spark.createDataFrame(rows, f"_snapshot_year int, bezirksnummer int, name string, kantonsnummer int, geometry {GEOMETRY_TYPE}")


def test_written_dimension_is_the_built_one(spark, rows, tmp_path):
    given = sources(spark, (1999, 2000, 2001))
    built, path = build_geo_dim(*given, "bezk", "2002-01-01"), str(tmp_path / "dims")
    store_geo_dim(*given, "bezk", "2002-01-01", path)
    back = read_geo_dim(spark, "bezk", path)
    assert back.columns == built.columns and rows(back) == rows(built) and back.count() == 8
    assert spark.read.parquet(f"{path}/shapes/level=bezk").count() == 2  # not one a snapshot
    write_geo_dim(built, "bezk", str(tmp_path / "again"))
    assert rows(read_geo_dim(spark, "bezk", str(tmp_path / "again"))) == rows(built)


def test_years_that_are_not_written_keep_their_shapes(spark, tmp_path):
    path = str(tmp_path / "dims")
    store_geo_dim(*sources(spark, (1999, 2000)), "bezk", "2002-01-01", path)
    store_geo_dim(*sources(spark, (2000,), "New"), "bezk", "2002-01-01", path)
    old, new = (read_geo_dim(spark, "bezk", path, y).filter("snapshot_code <> 'latest'").orderBy("bezirk_bfs_id").collect() for y in (1999, 2000))
    assert [r.bezirk_name for r in old] == ["Ten0", "Ten1"] and [r.bezirk_name for r in new] == ["New0", "New1"]
    assert all(len(r.geom_border[0][0]) == 5 for r in [*old, *new])


def test_borders_and_centres_at_once(spark):
    two = square(2600000.0, 1200000.0)[0] + [ring[::-1] for ring in square(2600100.0, 1200100.0, 300.0)[0]]
    shapes = [(1, [two, *square(2700000.0, 1100000.0)]), (2, None), (3, []), (4, [[[(2600000.0, 1200000.0)]]])]
    df = spark.createDataFrame(shapes, f"id int, g {GEOMETRY_TYPE}")
    got = df.select("g", to_wgs84("g").alias("a"), reproject(F.col("g"), LV95, WGS84).alias("b"), centre_in_wgs84("g").alias("c"), reproject_point(centroid(F.col("g")), LV95, WGS84).alias("d"))
    flat = lambda v: [] if v is None else [c for x in v for c in flat(x)] if isinstance(v, (list, tuple)) else [v]
    for r in got.collect():
        assert (r.a is None) == (r.b is None) and len(flat(r.a)) == len(flat(r.b))
        for one, other in ((r.a, r.b), (r.c, r.d)):
            assert all(abs(p - q) < 1e-9 for p, q in zip(flat(one), flat(other)))
