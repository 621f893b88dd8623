import math
import datetime as dt
import struct

import pytest
from pyspark.sql import functions as F

from regiofact.functions import dates, geometry as g, keys, text
from regiofact.operators.quality import detect_format
from regiofact.plans.staging import last_quarter, restructure_cube


def one(spark, value, kind="string"):
    return spark.createDataFrame([(value,)], f"c {kind}")


def evaluate(spark, column, value=None, kind="string"):
    return one(spark, value, kind).select(column.alias("r")).first().r


@pytest.mark.parametrize(
    "label, expected",
    [
        ("- Zürich", ("kant", None, "Zürich")),
        (">> Bezirk X", ("bezk", None, "Bezirk X")),
        ("......0230 Winterthur", ("polg", "0230", "Winterthur")),
        ("......0230", ("polg", "0230", "")),
        ("Schweiz", ("", None, None)),
    ],
)
def test_dot_notation(spark, label, expected):
    df = one(spark, label).withColumns(text.dot_notation(F.col("c")))
    assert tuple(df.first())[1:] == expected


@pytest.mark.parametrize(
    "label, expected",
    [
        ("230 Winterthur", ("polg", "230", "Winterthur")),
        ("9 Ägeri", ("polg", "9", "Ägeri")),
        ("Schweiz", ("polg", None, None)),
    ],
)
def test_leading_number(spark, label, expected):
    df = one(spark, label).withColumns(text.leading_number(F.col("c")))
    assert tuple(df.first())[1:] == expected


@pytest.mark.parametrize(
    "label, expected",
    [
        ("2024", ("2024", "2024")),
        ("2017/18", ("2017", "2018")),
        ("1979-1985", ("1979", "1985")),
        ("2024Q4", ("2024Q4", None)),
    ],
)
def test_year_range(spark, label, expected):
    df = one(spark, label).withColumns(text.year_range(F.col("c")))
    assert tuple(df.first())[1:] == expected


def test_single_years(spark):
    df = spark.createDataFrame([(" 2022 ",), ("2020-2022",), ("2024",)], "c string")
    assert [r.c for r in df.filter(text.is_year(F.col("c"))).collect()] == [" 2022 ", "2024"]


@pytest.mark.parametrize("mark", ['"..."', '"...."', '"....."', '"......"', ""])
def test_missing_marks(spark, mark):
    assert evaluate(spark, text.clean_numeric(F.col("c")), mark) is None


def test_numbers_stay_strict(spark):
    assert float(evaluate(spark, text.clean_numeric(F.col("c")), "12.5")) == 12.5
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        evaluate(spark, text.clean_numeric(F.col("c")), "abc")


def test_ja_nein(spark):
    found = [evaluate(spark, text.ja_nein(F.col("c")), v) for v in ("Ja", "Nein", "ja", None)]
    assert found == [True, False, None, None]


def test_indicator_label(spark):
    label = text.indicator_label(
        F.lit(7), F.lit("Name"), F.lit("CHF"), F.array(F.lit("zahl"), F.lit(None).cast("string"))
    )
    assert evaluate(spark, label) == "[#0007] Name (CHF) ['zahl', None]"
    long = text.indicator_label(F.lit(123456), F.lit("N"), F.lit("u"), F.array(F.lit("zahl")))
    assert evaluate(spark, long).startswith("[#123456]")


def test_mother_path_skips_missing_ids(spark):
    path = text.mother_path(F.lit("72"), F.lit(None).cast("string"), F.lit("70"))
    assert evaluate(spark, path) == "_72__70"


def test_period_text_dates(spark):
    value = "2014-01-01/2018-12-31"
    assert evaluate(spark, dates.text_date(F.col("c"), dates.FIRST_ISO_DATE), value) == dt.date(2014, 1, 1)
    assert evaluate(spark, dates.text_date(F.col("c"), dates.LAST_ISO_DATE), value) == dt.date(2018, 12, 31)
    assert evaluate(spark, dates.text_date(F.col("c"), dates.LAST_ISO_DATE), "2018") is None


def test_period_bounds(spark):
    df = spark.createDataFrame([(2020, 2020), (2019, 2021)], "a int, b int")
    due = dates.period_bounds(F.col("a"), F.col("b"), "duedate")
    got = [tuple(r) for r in df.select(due["period_ref_from"], due["period_ref"]).collect()]
    assert got == [(None, dt.date(2020, 12, 31)), (dt.date(2019, 1, 1), dt.date(2021, 12, 31))]
    period = dates.period_bounds(F.col("a"), F.col("b"), "period")["period_ref_from"]
    assert df.select(period).first()[0] == dt.date(2020, 1, 1)


def test_surrogate_key_marks_null(spark):
    import hashlib

    got = evaluate(spark, keys.surrogate_key(F.lit(1), F.lit(None).cast("string")))
    assert got == hashlib.md5(b"1-_dbt_utils_surrogate_key_null_").hexdigest()


def test_format_detection(spark):
    dotted = spark.createDataFrame([("- A",), (">> B",), ("......1 C",)], "c string")
    assert detect_format(dotted, "c", text.GEO_PATTERNS) == "dot_notation"
    numbered = spark.createDataFrame([("1 A",), ("2 B",), ("Schweiz",)], "c string")
    assert detect_format(numbered, "c", text.GEO_PATTERNS) == "leading_number"
    mixed = spark.createDataFrame([("1 A",), ("- B",), ("??",)], "c string")
    with pytest.raises(ValueError, match=r"no format explains.*\?\?"):
        detect_format(mixed, "c", text.GEO_PATTERNS)


def test_restructure_cube_with_transform(spark):
    df = spark.createDataFrame(
        [("2023Q4", "......1 A", ["x", "y"]), ("2023Q3", "......1 A", None), ("2024Q4", "- B", None)],
        "year string, geo_value_unstructured string, src array<string>",
    )
    out = restructure_cube(df, sources="src", transform=last_quarter, drop=["geo_value_unstructured"])
    got = sorted((r.year_from, r.geo_code, r.geo_value, r.source) for r in out.collect())
    assert got == [("2023", "polg", "1", "x, y"), ("2024", "kant", None, "unknown")]
    assert "geo_value_unstructured" not in out.columns


SQUARE = [[[(0.0, 0.0), (4.0, 0.0), (4.0, 4.0), (0.0, 4.0), (0.0, 0.0)]]]
HOLED = [[SQUARE[0][0], [(1.0, 1.0), (1.0, 2.0), (2.0, 2.0), (2.0, 1.0), (1.0, 1.0)]]]
LINE = [[[(0.0, 0.0), (2.0, 0.0), (0.0, 0.0)]]]


def shape(spark, geom):
    return spark.createDataFrame([(geom,)], f"geom {g.GEOMETRY_TYPE}")


def test_centroid_and_area(spark):
    def centre(geom):
        r = shape(spark, geom).select(g.area(F.col("geom")).alias("a"), g.centroid(F.col("geom")).alias("c")).first()
        return r.a, round(r.c.x, 9), round(r.c.y, 9)

    assert centre(SQUARE) == (16.0, 2.0, 2.0)
    area, x, y = centre(HOLED)
    assert (area, x, y) == (15.0, round((32 - 1.5) / 15, 9), round((32 - 1.5) / 15, 9))
    two = SQUARE + [[[(10.0, 0.0), (12.0, 0.0), (12.0, 2.0), (10.0, 2.0), (10.0, 0.0)]]]
    assert centre(two) == (20.0, round((16 * 2 + 4 * 11) / 20, 9), round((16 * 2 + 4 * 1) / 20, 9))
    assert centre(LINE)[0] == 0.0 and centre(LINE)[2] == 0.0


def test_centroid_of_nothing(spark):
    assert shape(spark, None).select(g.centroid(F.col("geom"))).first()[0] is None


def test_known_point_reprojects(spark):
    # the worked example of the published approximation, which is good to a metre
    p = F.struct(F.lit(8.730497222).alias("x"), F.lit(46.044130556).alias("y"))
    r = evaluate(spark, g.reproject_point(p, g.WGS84, g.LV95))
    assert abs(r.x - 2700000) < 1.5 and abs(r.y - 1100000) < 1.5
    back = F.struct(F.lit(2700000.0).alias("x"), F.lit(1100000.0).alias("y"))
    r = evaluate(spark, g.reproject_point(back, g.LV95, g.WGS84))
    assert abs(r.x - 8.730497) < 2e-5 and abs(r.y - 46.044131) < 2e-5
    with pytest.raises(ValueError):
        g.reproject(F.col("geom"), 1, 2)


def rigorous_lv95(lat, lon):
    """East and north of a place on the Bessel ellipsoid, by the published formulas as they are printed."""
    e2, lat0, lon0 = 0.006674372230614, math.radians(46 + 57 / 60 + 8.66 / 3600), math.radians(7 + 26 / 60 + 22.5 / 3600)
    e, r, alpha, k = math.sqrt(e2), 6378815.90365, 1.00072913843038, 0.0030667323772751
    b0 = math.radians(46 + 54 / 60 + 27.83324844 / 3600)
    s = alpha * math.log(math.tan(math.pi / 4 + lat / 2)) - alpha * e / 2 * math.log((1 + e * math.sin(lat)) / (1 - e * math.sin(lat))) + k
    b, i = 2 * (math.atan(math.exp(s)) - math.pi / 4), alpha * (lon - lon0)
    i_bar = math.atan(math.sin(i) / (math.sin(b0) * math.tan(b) + math.cos(b0) * math.cos(i)))
    b_bar = math.asin(math.cos(b0) * math.sin(b) - math.sin(b0) * math.cos(b) * math.cos(i))
    return 2600000 + r * i_bar, 1200000 + r / 2 * math.log((1 + math.sin(b_bar)) / (1 - math.sin(b_bar)))


def geocentric(lat, lon, axis, e2):
    n = axis / math.sqrt(1 - e2 * math.sin(lat) ** 2)
    return n * math.cos(lat) * math.cos(lon), n * math.cos(lat) * math.sin(lon), n * (1 - e2) * math.sin(lat)


def test_published_projection_example():
    # fixed values: the published example of the projection
    lat, lon = math.radians(47 + 3 / 60 + 28.95659233 / 3600), math.radians(8 + 29 / 60 + 11.11127154 / 3600)
    east, north = rigorous_lv95(lat, lon)
    assert abs(east - 2679520.05) < 1e-3 and abs(north - 1212273.44) < 1e-3


def test_reprojection_follows_the_definition(spark):
    """Places given on the national ellipsoid: their metres, and their degrees after the shift."""
    w2 = (2 - 1 / 298.257223563) / 298.257223563
    places, expected = [], []
    for k in range(40):
        lat, lon = math.radians(45.82 + 0.05 * k), math.radians(6.0 + 0.113 * ((k * 17) % 40))
        x, y, z = (c + d for c, d in zip(geocentric(lat, lon, 6377397.155, 0.006674372230614), (674.374, 15.056, 405.346)))
        p, up = math.hypot(x, y), math.atan2(z, math.hypot(x, y) * (1 - w2))
        for _ in range(12):
            up = math.atan2(z + w2 * 6378137.0 / math.sqrt(1 - w2 * math.sin(up) ** 2) * math.sin(up), p)
        places.append(rigorous_lv95(lat, lon))
        expected.append((math.degrees(math.atan2(y, x)), math.degrees(up)))
    df = spark.createDataFrame([(i, *p, *w) for i, (p, w) in enumerate(zip(places, expected))], "i int, e double, n double, lon double, lat double")
    there = g.reproject_point(F.struct(F.col("e").alias("x"), F.col("n").alias("y")), g.LV95, g.WGS84)
    back = g.reproject_point(F.struct(F.col("lon").alias("x"), F.col("lat").alias("y")), g.WGS84, g.LV95)
    for r in df.select("*", there.alias("w"), back.alias("p")).collect():
        assert abs(r.w.x - r.lon) < 1e-9 and abs(r.w.y - r.lat) < 1e-9  # a tenth of a millimetre
        assert abs(r.p.x - r.e) < 2e-3 and abs(r.p.y - r.n) < 2e-3  # the height is left out twice


def test_serialisation(spark):
    r = shape(spark, HOLED).select(
        g.to_wkt(F.col("geom"), 2).alias("wkt"), g.to_geojson(F.col("geom")).alias("json"), g.to_wkb(F.col("geom")).alias("wkb")
    ).first()
    assert r.wkt == (
        "MULTIPOLYGON (((0 0, 4 0, 4 4, 0 4, 0 0), (1 1, 1 2, 2 2, 2 1, 1 1)))"
    )
    import json

    assert json.loads(r.json)["coordinates"][0][1][2] == [2, 2]
    order, kind, n = struct.unpack_from("<BII", r.wkb)
    assert (order, kind, n) == (1, 6, 1)
    order, kind, n_rings, n_points = struct.unpack_from("<BIII", r.wkb, 9)
    assert (kind, n_rings, n_points) == (3, 2, 5)
    assert struct.unpack_from("<dd", r.wkb, 22 + 16) == (4.0, 0.0)
