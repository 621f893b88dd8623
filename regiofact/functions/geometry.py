"""Column functions for polygons and points.

A polygon column is ``array<array<array<struct<x, y>>>>``: polygon > ring > vertex,
the first ring of a polygon being its shell. A point is ``struct<x, y>``. The
reference system travels beside it as an integer SRID.
"""

from __future__ import annotations

import math
import struct
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

GEOMETRY_TYPE = "array<array<array<struct<x:double,y:double>>>>"
WGS84 = 4326
LV95 = 2056


def map_vertices(geom: Column, fn: Callable[[Column], Column]) -> Column:
    return F.transform(
        geom, lambda polygon: F.transform(polygon, lambda ring: F.transform(ring, fn))
    )


def bound(value: Column, fn: Callable[[Column], Column]) -> Column:
    """``fn(value)`` with the value computed once, however often ``fn`` uses it."""
    return F.get(F.transform(F.array(value), fn), F.lit(0))


def point(x: Column, y: Column) -> Column:
    return F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))


def force_2d(geom: Column) -> Column:
    """Keep x and y of every vertex only."""
    return map_vertices(geom, lambda v: point(v["x"], v["y"]))


# The published definition of LV95: the ellipsoids' axes and squared eccentricities, the shift
# between their centres in metres, and the origin of the oblique conformal projection. These
# are fixed values.
_BESSEL_AXIS, _BESSEL_E2 = 6377397.155, 0.006674372230614
_WGS84_AXIS, _WGS84_E2 = 6378137.0, (2 - 1 / 298.257223563) / 298.257223563
_SHIFT = (674.374, 15.056, 405.346)
_LAT0 = math.radians(46 + 57 / 60 + 8.66 / 3600)
_LON0 = math.radians(7 + 26 / 60 + 22.50 / 3600)
_EAST0, _NORTH0 = 2600000.0, 1200000.0

# What follows from them: the eccentricity, the sphere that the ellipsoid is mapped to, the ratio
# of longitudes, and the latitude of the origin and the constant of latitudes on the sphere.
_E = math.sqrt(_BESSEL_E2)
_RADIUS = _BESSEL_AXIS * math.sqrt(1 - _BESSEL_E2) / (1 - _BESSEL_E2 * math.sin(_LAT0) ** 2)
_RATIO = math.sqrt(1 + _BESSEL_E2 / (1 - _BESSEL_E2) * math.cos(_LAT0) ** 4)
_SIN0 = math.sin(_LAT0) / _RATIO
_COS0 = math.sqrt(1 - _SIN0 * _SIN0)
_CONSTANT = math.atanh(_SIN0) - _RATIO * (math.atanh(math.sin(_LAT0)) - _E * math.atanh(_E * math.sin(_LAT0)))
#: Each round of the latitude divides its error by 150, so six are below a double's last digit.
_ROUNDS = 6


def _chained(value: Column, *steps: Callable[[Column], dict[str, Column]]) -> Column:
    """Named intermediate results, each step from the fields of the one before, computed once."""

    def fields(step: Callable[[Column], dict[str, Column]]) -> Callable[[Column], Column]:
        return lambda v: F.struct(*[c.alias(n) for n, c in step(v).items()])

    for step in steps:
        value = bound(value, fields(step))
    return value


def _centred(lon: Column, sin: Column, axis: float, e2: float, sign: float) -> dict[str, Column]:
    """Geocentric metres of a point on an ellipsoid, moved to the other one's centre."""
    normal = axis / F.sqrt(1 - e2 * sin * sin)
    across = normal * F.sqrt(1 - sin * sin)
    dx, dy, dz = (sign * d for d in _SHIFT)
    return {"x": across * F.cos(lon) + dx, "y": across * F.sin(lon) + dy, "z": normal * (1 - e2) * sin + dz}


def _grounded(v: Column, axis: float, e2: float) -> dict[str, Column]:
    """Longitude, and rise and run of the latitude, on an ellipsoid for geocentric metres."""
    short = axis * math.sqrt(1 - e2)
    run = F.hypot(v["x"], v["y"])
    turned = F.atan2(v["z"] * axis, run * short)  # the closed form is exact to a nanometre at the ground
    return {
        "lon": F.atan2(v["y"], v["x"]),
        "rise": v["z"] + e2 / (1 - e2) * short * F.pow(F.sin(turned), F.lit(3.0)),
        "run": run - e2 * axis * F.pow(F.cos(turned), F.lit(3.0)),
    }


def _to_lv95(v: Column) -> Column:
    """Ellipsoid to ellipsoid, to the sphere, and to the oblique cylinder around its origin."""

    def on_sphere(g: Column) -> dict[str, Column]:
        sin = g["rise"] / F.hypot(g["rise"], g["run"])
        return {"i": _RATIO * (g["lon"] - _LON0), "s": _RATIO * (F.atanh(sin) - _E * F.atanh(_E * sin)) + _CONSTANT}

    return _chained(
        v,
        lambda v: _centred(F.radians(v["x"]), F.sin(F.radians(v["y"])), _WGS84_AXIS, _WGS84_E2, -1.0),
        lambda c: _grounded(c, _BESSEL_AXIS, _BESSEL_E2),
        on_sphere,
        lambda p: {
            "x": _EAST0 + _RADIUS * F.atan2(F.sin(p["i"]), _SIN0 * F.sinh(p["s"]) + _COS0 * F.cos(p["i"])),
            "y": _NORTH0 + _RADIUS * F.atanh(_COS0 * F.tanh(p["s"]) - _SIN0 * F.cos(p["i"]) / F.cosh(p["s"])),
        },
    )


def _to_wgs84(v: Column) -> Column:
    """The way back; the latitude on the ellipsoid comes from the one on the sphere in rounds."""

    def on_sphere(p: Column) -> dict[str, Column]:
        sin = _COS0 * F.tanh(p["u"]) + _SIN0 * F.cos(p["i"]) / F.cosh(p["u"])
        turn = F.atan2(F.sin(p["i"]), _COS0 * F.cos(p["i"]) - _SIN0 * F.sinh(p["u"]))
        return {"lon": _LON0 + turn / _RATIO, "b": sin, "q": (F.atanh(sin) - _CONSTANT) / _RATIO}

    def on_ellipsoid(p: Column) -> dict[str, Column]:
        sin = p["b"]
        for _ in range(_ROUNDS):
            sin = F.tanh(p["q"] + _E * F.atanh(_E * sin))
        return {"lon": p["lon"], "sin": sin}

    return _chained(
        v,
        lambda v: {"i": (v["x"] - _EAST0) / _RADIUS, "u": (v["y"] - _NORTH0) / _RADIUS},
        on_sphere,
        on_ellipsoid,
        lambda p: _centred(p["lon"], p["sin"], _BESSEL_AXIS, _BESSEL_E2, 1.0),
        lambda c: _grounded(c, _WGS84_AXIS, _WGS84_E2),
        lambda g: {"x": F.degrees(g["lon"]), "y": F.degrees(F.atan2(g["rise"], g["run"]))},
    )


_CONVERSIONS = {(WGS84, LV95): _to_lv95, (LV95, WGS84): _to_wgs84}


def reproject_point(p: Column, src: int, dst: int) -> Column:
    """A place in the other system, at height zero: there and back again differs by 1.3 mm."""
    if src == dst:
        return p
    if (src, dst) not in _CONVERSIONS:
        raise ValueError(f"no conversion from {src} to {dst}")
    return bound(p, _CONVERSIONS[src, dst])


def reproject(geom: Column, src: int, dst: int) -> Column:
    if src == dst:
        return geom
    if (src, dst) not in _CONVERSIONS:
        raise ValueError(f"no conversion from {src} to {dst}")
    return map_vertices(geom, _CONVERSIONS[src, dst])


def _at_once_to_wgs84(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``_to_wgs84`` of many places."""
    i, u = (x - _EAST0) / _RADIUS, (y - _NORTH0) / _RADIUS
    sin = on_sphere = _COS0 * np.tanh(u) + _SIN0 * np.cos(i) / np.cosh(u)
    lon = _LON0 + np.arctan2(np.sin(i), _COS0 * np.cos(i) - _SIN0 * np.sinh(u)) / _RATIO
    q = (np.arctanh(on_sphere) - _CONSTANT) / _RATIO
    for _ in range(_ROUNDS):
        sin = np.tanh(q + _E * np.arctanh(_E * sin))
    normal = _BESSEL_AXIS / np.sqrt(1 - _BESSEL_E2 * sin * sin)
    across = normal * np.sqrt(1 - sin * sin)
    x, y = across * np.cos(lon) + _SHIFT[0], across * np.sin(lon) + _SHIFT[1]
    z = normal * (1 - _BESSEL_E2) * sin + _SHIFT[2]
    short, run = _WGS84_AXIS * math.sqrt(1 - _WGS84_E2), np.hypot(x, y)
    turned = np.arctan2(z * _WGS84_AXIS, run * short)
    rise = z + _WGS84_E2 / (1 - _WGS84_E2) * short * np.sin(turned) ** 3
    return np.degrees(np.arctan2(y, x)), np.degrees(np.arctan2(rise, run - _WGS84_E2 * _WGS84_AXIS * np.cos(turned) ** 3))


_POINT = T.StructType([T.StructField("x", T.DoubleType()), T.StructField("y", T.DoubleType())])


@F.arrow_udf(T.ArrayType(T.ArrayType(T.ArrayType(_POINT))))
def to_wgs84(geom: pa.Array) -> pa.Array:
    """LV95 borders in WGS84, as by ``reproject``, for very many of them; not inside of other functions of arrays."""
    lists = [geom]
    for _ in range(2):
        lists.append(lists[-1].flatten())
    vertices = lists[-1].flatten()
    x, y = (c.to_numpy(zero_copy_only=False) for c in vertices.flatten())
    out: pa.Array = pa.StructArray.from_arrays([pa.array(c) for c in _at_once_to_wgs84(x, y)], fields=list(vertices.type))
    for each in reversed(lists):
        sizes = each.value_lengths().fill_null(0).to_numpy()
        offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32), mask=np.append(each.is_null().to_numpy(zero_copy_only=False), False))
        out = pa.ListArray.from_arrays(offsets, out, type=each.type)
    return out


@F.arrow_udf(_POINT)
def centre_in_wgs84(geom: pa.Array) -> pa.Array:
    """``centroid`` of LV95 borders in WGS84, for very many of them; not inside of other functions of arrays."""
    polygons = geom.flatten()
    rings = polygons.flatten()
    x, y = (c.to_numpy(zero_copy_only=False) for c in rings.flatten().flatten())
    count, per_polygon, size = (a.value_lengths().fill_null(0).to_numpy().astype(np.int64) for a in (geom, polygons, rings))
    n, first_polygon, first_ring, first = len(geom), np.cumsum(count) - count, np.cumsum(per_polygon) - per_polygon, np.cumsum(size) - size
    of_ring = np.repeat(np.repeat(np.arange(n), count), per_polygon)
    shell = np.zeros(len(size), bool)
    shell[first_ring[per_polygon > 0]] = True
    known = count > 0
    known[known] = per_polygon[first_polygon[known]] > 0
    known[known] = size[first_ring[first_polygon[known]]] > 0
    origin = np.zeros(n, np.int64)
    origin[known] = first[first_ring[first_polygon[known]]]
    ox, oy = (np.where(known, c[origin], 0.0) if len(c) else np.zeros(n) for c in (x, y))
    ring, of = np.repeat(np.arange(len(size)), size), np.repeat(of_ring, size)
    dx, dy = x - ox[of], y - oy[of]
    p = np.flatnonzero(ring[1:] == ring[:-1])
    cross = dx[p] * dy[p + 1] - dx[p + 1] * dy[p]
    a, mx, my = (np.bincount(ring[p], w, len(size)) for w in (cross, (dx[p] + dx[p + 1]) * cross, (dy[p] + dy[p + 1]) * cross))
    sign = np.where(shell, 1.0, -1.0) * np.sign(a)
    a, mx, my = (np.bincount(of_ring, sign * m, n) for m in (a, mx, my))
    vertices = np.bincount(of, minlength=n)
    with np.errstate(all="ignore"):
        cx, cy = (np.where(a != 0, m / (3.0 * a), np.bincount(of, d, n) / vertices) for m, d in ((mx, dx), (my, dy)))
        lon, lat = _at_once_to_wgs84(ox + cx, oy + cy)
    return pa.StructArray.from_arrays([pa.array(c, mask=~known) for c in (lon, lat)], names=["x", "y"])


def _ring_moments(ring: Column, origin: Column) -> Column:
    """Twice the signed area and six times the first moments of a ring.

    Coordinates are taken relative to ``origin`` so that the products stay small
    and keep their digits.
    """
    zero = F.struct(
        F.lit(0.0).alias("a"), F.lit(0.0).alias("mx"), F.lit(0.0).alias("my")
    )

    def shifted(v: Column) -> Column:
        return F.struct((v["x"] - origin["x"]).alias("x"), (v["y"] - origin["y"]).alias("y"))

    def add(acc: Column, pair: Column) -> Column:
        p, q = pair["p"], pair["q"]
        cross = p["x"] * q["y"] - q["x"] * p["y"]
        return F.struct(
            (acc["a"] + cross).alias("a"),
            (acc["mx"] + (p["x"] + q["x"]) * cross).alias("mx"),
            (acc["my"] + (p["y"] + q["y"]) * cross).alias("my"),
        )

    def segments(vertices: Column) -> Column:
        n = F.greatest(F.size(vertices) - 1, F.lit(0))
        return F.arrays_zip(
            F.slice(vertices, F.lit(1), n).alias("p"), F.slice(vertices, F.lit(2), n).alias("q")
        )

    return F.aggregate(bound(F.transform(ring, shifted), segments), zero, add)


def _total_moments(geom: Column, origin: Column) -> Column:
    """Moments over all rings: shells count positive, holes negative."""
    rings = F.flatten(
        F.transform(
            geom,
            lambda polygon: F.transform(
                polygon,
                lambda ring, i: F.struct(
                    F.when(i == 0, 1.0).otherwise(-1.0).alias("role"),
                    _ring_moments(ring, origin).alias("m"),
                ),
            ),
        )
    )
    zero = F.struct(
        F.lit(0.0).alias("a"), F.lit(0.0).alias("mx"), F.lit(0.0).alias("my")
    )

    def add(acc: Column, r: Column) -> Column:
        sign = r["role"] * F.signum(r["m"]["a"])
        return F.struct(
            (acc["a"] + sign * r["m"]["a"]).alias("a"),
            (acc["mx"] + sign * r["m"]["mx"]).alias("mx"),
            (acc["my"] + sign * r["m"]["my"]).alias("my"),
        )

    return F.aggregate(rings, zero, add)


def _first_vertex(geom: Column) -> Column:
    return F.get(F.get(F.get(geom, F.lit(0)), F.lit(0)), F.lit(0))


def area(geom: Column) -> Column:
    return bound(_first_vertex(geom), lambda origin: _total_moments(geom, origin)["a"] / 2.0)


def centroid(geom: Column) -> Column:
    """Area-weighted centre; the mean vertex where there is no area."""

    def around(origin: Column) -> Column:
        def mean(vertices: Column) -> Column:
            def axis(name: str) -> Column:
                shifted = F.transform(vertices, lambda v: v[name] - origin[name])
                total = F.aggregate(shifted, F.lit(0.0), lambda acc, x: acc + x)
                return origin[name] + F.try_divide(total, F.size(vertices).cast("double"))

            return point(axis("x"), axis("y"))

        def centre(m: Column) -> Column:
            weighted = point(
                origin["x"] + F.try_divide(m["mx"], 3.0 * m["a"]),
                origin["y"] + F.try_divide(m["my"], 3.0 * m["a"]),
            )
            flat = bound(F.flatten(F.flatten(geom)), mean)
            return F.when(m["a"] != 0, weighted).otherwise(flat)

        return bound(_total_moments(geom, origin), centre)

    return F.when(_first_vertex(geom).isNotNull(), bound(_first_vertex(geom), around))


def _number(c: Column, digits: int | None) -> Column:
    """Decimal text without trailing zeros; without ``digits`` the shortest exact one."""
    if digits is None:
        return F.regexp_replace(c.cast("string"), r"\.0(?=$|E)", "")
    fixed = F.format_string(f"%.{digits}f", c)
    return F.regexp_replace(fixed, r"\.?0+$", "") if digits else fixed


def _pair(v: Column, digits: int | None, separator: str) -> Column:
    return F.concat(_number(v["x"], digits), F.lit(separator), _number(v["y"], digits))


def point_to_wkt(p: Column, digits: int | None = None) -> Column:
    return F.concat(F.lit("POINT ("), _pair(p, digits, " "), F.lit(")"))


def _nested_text(
    geom: Column, vertex: Callable[[Column], Column], l: str, r: str, sep: str
) -> Column:
    def group(items: Column) -> Column:
        return F.concat(F.lit(l), F.array_join(items, sep), F.lit(r))

    return group(
        F.transform(
            geom,
            lambda polygon: group(
                F.transform(polygon, lambda ring: group(F.transform(ring, vertex)))
            ),
        )
    )


def to_wkt(geom: Column, digits: int | None = None) -> Column:
    text = _nested_text(geom, lambda v: _pair(v, digits, " "), "(", ")", ", ")
    return F.concat(F.lit("MULTIPOLYGON "), text)


def to_geojson(geom: Column, digits: int | None = None) -> Column:
    """Geometry object text, coordinates as nested arrays."""
    coordinates = _nested_text(
        geom,
        lambda v: F.concat(F.lit("["), _pair(v, digits, ","), F.lit("]")),
        "[", "]", ",",
    )
    return F.concat(
        F.lit('{"type":"MultiPolygon","coordinates":'), coordinates, F.lit("}")
    )


def point_to_geojson(p: Column, digits: int | None = None) -> Column:
    return F.concat(
        F.lit('{"type":"Point","coordinates":['), _pair(p, digits, ","), F.lit("]}")
    )


def to_wkb(geom: Column) -> Column:
    """Little-endian WKB; bytes of doubles have no built-in, so this is an Arrow UDF."""
    rings = F.transform(
        geom,
        lambda polygon: F.transform(
            polygon,
            lambda ring: F.flatten(F.transform(ring, lambda v: F.array(v["x"], v["y"]))),
        ),
    )
    return _multipolygon_bytes(rings)


def from_wkb(data: Column) -> Column:
    """Multipolygon of little-endian WKB as written by ``to_wkb``."""
    return F.transform(
        _multipolygon_rings(data),
        lambda polygon: F.transform(
            polygon,
            lambda ring: F.transform(
                F.sequence(F.lit(0), F.size(ring) - 2, F.lit(2)),
                lambda i: F.struct(F.get(ring, i).alias("x"), F.get(ring, i + 1).alias("y")),
            ),
        ),
    ).cast(GEOMETRY_TYPE)


@F.arrow_udf(T.ArrayType(T.ArrayType(T.ArrayType(T.DoubleType()))))
def _multipolygon_rings(shapes: pa.Array) -> pa.Array:
    def decode(data) -> list | None:
        if data is None:
            return None
        n_polygons, at, out = struct.unpack_from("<I", data, 5)[0], 9, []
        for _ in range(n_polygons):
            n_rings, at, rings = struct.unpack_from("<I", data, at + 5)[0], at + 9, []
            for _ in range(n_rings):
                n = struct.unpack_from("<I", data, at)[0]
                rings.append(np.frombuffer(data, "<f8", 2 * n, at + 4).tolist())
                at += 4 + 16 * n
            out.append(rings)
        return out

    rings = pa.list_(pa.list_(pa.list_(pa.float64())))
    return pa.array([decode(s) for s in shapes.to_pylist()], rings)


@F.arrow_udf(T.BinaryType())
def _multipolygon_bytes(shapes: pa.Array) -> pa.Array:
    def encode(polygons) -> bytes | None:
        if polygons is None:
            return None
        out = [struct.pack("<BII", 1, 6, len(polygons))]
        for polygon in polygons:
            out.append(struct.pack("<BII", 1, 3, len(polygon)))
            for ring in polygon:
                flat = np.asarray(ring, dtype="<f8")
                out.append(struct.pack("<I", len(flat) // 2))
                out.append(flat.tobytes())
        return b"".join(out)

    return pa.array([encode(s) for s in shapes.to_pylist()], pa.binary())
