import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from regiofact.functions.geometry import GEOMETRY_TYPE
from regiofact.operators import coverage
from regiofact.operators.coverage import coverage_simplify, segments_meet, simplify_arc


def noisy_line(seed, n=60):
    rnd = random.Random(seed)
    return [(float(i * 10), float(rnd.randint(-30, 30))) for i in range(n)]


def triangle(a, b, c):
    return abs((b[0] - a[0]) * (c[1] - a[1]) - (b[1] - a[1]) * (c[0] - a[0])) / 2


def slow_arc(points, tolerance):
    """The same elimination by plain search, without any index."""
    points = list(points)
    blocked = set()
    while True:
        corners = [
            (triangle(points[i - 1], points[i], points[i + 1]), points[i], i)
            for i in range(1, len(points) - 1)
        ]
        corners = [c for c in corners if (c[1], points[c[2] - 1], points[c[2] + 1]) not in blocked]
        if not corners or min(corners)[0] >= tolerance**2:
            return points
        _, p, i = min(corners, key=lambda c: (c[0], c[2]))
        a, c = points[i - 1], points[i + 1]
        inside = [
            q for q in points
            if q not in (a, p, c)
            and min(a[0], p[0], c[0]) <= q[0] <= max(a[0], p[0], c[0])
            and abs(triangle(a, p, q) + triangle(p, c, q) + triangle(a, c, q) - triangle(a, p, c)) < 1e-9
        ]
        if inside:
            blocked.add((p, a, c))
        else:
            del points[i]


@pytest.mark.parametrize("seed", range(8))
def test_arc_agrees_with_plain_search(seed):
    line = noisy_line(seed)
    fast, slow = simplify_arc(line, 15.0), slow_arc(line, 15.0)
    assert fast == slow
    assert 2 <= len(fast) < len(line) and fast[0] == line[0] and fast[-1] == line[-1]


@pytest.mark.parametrize("seed", range(8))
def test_arc_is_the_same_from_both_ends(seed):
    line = noisy_line(seed)
    assert simplify_arc(line[::-1], 20.0) == simplify_arc(line, 20.0)[::-1]


def test_flat_arc_becomes_its_chord():
    assert simplify_arc([(0.0, 0.0), (1.0, 0.1), (2.0, 0.0)], 10.0) == [(0.0, 0.0), (2.0, 0.0)]


def grid(width, height, seed=1, parts=6):
    """Cells whose borders are noisy lines shared by both neighbours."""
    rnd = random.Random(seed)
    noise = {}

    def vertex(a, b):
        corner = a % parts == 0 and b % parts == 0
        if (a, b) not in noise:
            noise[a, b] = (0, 0) if corner else (rnd.randint(-20, 20), rnd.randint(-20, 20))
        dx, dy = noise[a, b]
        return (a * 100.0 + dx, b * 100.0 + dy)

    cells = {}
    for i in range(width):
        for j in range(height):
            a, b, p = i * parts, j * parts, parts
            ring = [vertex(a + k, b) for k in range(p)] + [vertex(a + p, b + k) for k in range(p)]
            ring += [vertex(a + p - k, b + p) for k in range(p)] + [vertex(a, b + p - k) for k in range(p)]
            cells[i * height + j] = [[ring + [ring[0]]]]
    return cells


def edges(geom):
    return [
        tuple(sorted((a, b)))
        for polygon in geom
        for ring in polygon
        for a, b in zip(ring, ring[1:])
    ]


def simplified(spark, shapes, tolerances):
    data = [(part, key, geom) for part, cells in shapes.items() for key, geom in cells.items()]
    df = spark.createDataFrame(data, f"part string, id int, geometry {GEOMETRY_TYPE}")
    out = coverage_simplify(df, ["id"], "part", "geometry", tolerances)
    return {
        (r.part, r.id): {
            name: [[[(v.x, v.y) for v in ring] for ring in polygon] for polygon in r[name]]
            for name in ("geometry", *tolerances)
        }
        for r in out.collect()
    }


def test_shared_borders_stay_shared(spark):
    cells = grid(4, 3)
    got = simplified(spark, {"a": cells}, {"t60": 60.0, "t300": 300.0})
    for name, fewer in (("t60", 24), ("t300", 12)):
        counts = {}
        for shapes in got.values():
            for ring in shapes[name][0]:
                assert ring[0] == ring[-1] and len(set(ring)) >= 3
                assert len(set(ring)) < fewer
            for e in edges(shapes[name]):
                counts[e] = counts.get(e, 0) + 1
        # inner borders are on two sides, the outline on one: nothing overlaps or gapes
        outline = [e for e, n in counts.items() if n == 1]
        assert max(counts.values()) == 2
        for (x0, y0), (x1, y1) in outline:
            assert any(
                all(abs(c - side) <= 20 for c in pair)
                for pair, sides in (((x0, x1), (0, 2400)), ((y0, y1), (0, 1800)))
                for side in sides
            )


def test_parts_are_separate_coverages(spark):
    cells = grid(2, 2)
    alone = simplified(spark, {"a": {0: cells[0]}}, {"t": 100.0})
    both = simplified(spark, {"a": {0: cells[0]}, "b": cells}, {"t": 100.0})
    assert both["a", 0] == alone["a", 0]
    assert both["b", 0]["t"] != alone["a", 0]["t"]


def test_island_and_its_hole_match(spark):
    rnd = random.Random(5)
    hole = [(500.0 + 20 * i + rnd.randint(-5, 5), 500.0 + rnd.randint(-5, 5)) for i in range(10)]
    hole += [(700.0 - 20 * i, 700.0 + rnd.randint(-5, 5)) for i in range(10)]
    hole = hole + [hole[0]]
    outer = [(0.0, 0.0), (1000.0, 0.0), (1000.0, 1000.0), (0.0, 1000.0), (0.0, 0.0)]
    start = 7  # the island's ring starts elsewhere and runs the other way
    island = (hole[start:-1] + hole[:start])[::-1]
    shapes = {"a": {1: [[outer, hole]], 2: [[island + [island[0]]]]}}
    got = simplified(spark, shapes, {"t": 40.0})
    inner = sorted(edges([[got["a", 1]["t"][0][1]]]))
    assert inner == sorted(edges(got["a", 2]["t"])) and 3 <= len(inner) < 19


def test_ring_between_two_nodes_keeps_an_area(spark):
    lens = [(0.0, 0.0), (50.0, -5.0), (100.0, 0.0), (50.0, 5.0), (0.0, 0.0)]
    upper = [(0.0, 0.0), (50.0, 5.0), (100.0, 0.0), (100.0, 300.0), (0.0, 300.0), (0.0, 0.0)]
    lower = [(0.0, 0.0), (0.0, -300.0), (100.0, -300.0), (100.0, 0.0), (50.0, -5.0), (0.0, 0.0)]
    got = simplified(spark, {"a": {1: [[lens]], 2: [[upper]], 3: [[lower]]}}, {"t": 100.0})
    assert len(set(got["a", 1]["t"][0][0])) >= 3
    all_edges = [e for s in got.values() for e in edges(s["t"])]
    for e in edges(got["a", 1]["t"]):
        assert all_edges.count(e) == 2


def test_copies_of_a_coverage_do_not_change_it(spark):
    cells = grid(2, 1)
    got = simplified(spark, {f"p{i}": cells for i in range(5)}, {"t": 80.0})
    assert all(got[f"p{i}", k] == got["p0", k] for i in range(5) for k in cells)


def test_missing_geometry_passes(spark):
    df = spark.createDataFrame([("a", 1, None)], f"part string, id int, geometry {GEOMETRY_TYPE}")
    out = coverage_simplify(df.withColumn("x", F.lit(1)), ["id"], "part", "geometry", {"t": 1.0})
    assert out.first().t is None


def exact_meeting(a, b, c, d):
    """Whether two segments have more in common than one common end, in fractions."""
    a, b, c, d = (tuple(map(Fraction, p)) for p in (a, b, c, d))
    turn = lambda p, q, r: (q[0] - p[0]) * (r[1] - p[1]) - (q[1] - p[1]) * (r[0] - p[0])
    sign = lambda v: (v > 0) - (v < 0)

    def on(p, s, e):
        return turn(s, e, p) == 0 and all(min(s[k], e[k]) <= p[k] <= max(s[k], e[k]) for k in (0, 1))

    if {a, b} == {c, d}:
        return True
    shared = {a, b} & {c, d}
    touches = {p for p, s in ((a, (c, d)), (b, (c, d)), (c, (a, b)), (d, (a, b))) if on(p, *s)}
    if touches - shared:
        return True
    return sign(turn(a, b, c)) * sign(turn(a, b, d)) < 0 and sign(turn(c, d, a)) * sign(turn(c, d, b)) < 0


def test_segments_meet(spark):
    rnd = random.Random(3)
    data = [tuple((float(rnd.randint(0, 4)), float(rnd.randint(0, 4))) for _ in range(4)) for _ in range(400)]
    data = [q for q in data if q[0] != q[1] and q[2] != q[3]]
    point = "struct<x:double,y:double>"
    df = spark.createDataFrame([(i, *q) for i, q in enumerate(data)], f"i int, a {point}, b {point}, c {point}, d {point}")
    got = {r.i: r.m for r in df.select("i", segments_meet(*map(F.col, "abcd")).alias("m")).collect()}
    assert got == {i: exact_meeting(*q) for i, q in enumerate(data)}
    assert 50 < sum(got.values()) < len(data) - 50


def spiked(shift):
    """Two areas whose border runs around an enclave of the left one, and has a spike beside a second border."""
    border = [(100.0, 0.0), (101.0, 40.0), (130.0, 50.0), (101.0, 60.0), (100.0, 100.0)]
    enclave = [(112.0, 48.0), (118.0, 48.0), (118.0, 52.0), (112.0, 52.0), (112.0, 48.0)]
    left = [*border, (0.0, 100.0), (0.0, 0.0), border[0]]
    # the far border of the right area comes near, and has a notch that the spike stands in
    far = [(140.0 + shift, 100.0), (139.0 + shift, 70.0), (104.0 + shift, 66.0), (139.0 + shift, 62.0), (139.0 + shift, 30.0), (140.0 + shift, 0.0)]
    right = [(100.0, 0.0), *border[1:-1], (100.0, 100.0), *far, (100.0, 0.0)]
    return {1: [[left, enclave[::-1]]], 2: [[right]], 3: [[enclave]]}


@pytest.mark.parametrize("tolerance", [5.0, 25.0, 40.0, 200.0])
def test_lines_neither_meet_nor_change_sides(spark, tolerance):
    got = simplified(spark, {"a": spiked(0.0), "b": spiked(30.0)}, {"t": tolerance})
    for part in "ab":
        shapes = {k: got[part, k]["t"] for k in (1, 2, 3)}
        used = [e for s in shapes.values() for e in edges(s)]
        assert max(used.count(e) for e in used) == 2
        assert all(used.count(e) == 2 for e in edges(shapes[3]))
        for e in set(used):
            for f in set(used):
                assert e == f or not exact_meeting(*e, *f)
        (shell, *_), (x, y) = shapes[1][0], shapes[3][0][0][0]
        crossings = sum(
            (p[1] > y) != (q[1] > y) and x < (q[0] - p[0]) * (y - p[1]) / (q[1] - p[1]) + p[0]
            for p, q in zip(shell, shell[1:])
        )
        assert crossings % 2 == 1  # the enclave stays inside of its host
        old = {v for k in (1, 2, 3) for ring in got[part, k]["geometry"][0] for v in ring}
        assert {v for s in shapes.values() for ring in s[0] for v in ring} <= old


def test_a_round_deals_only_the_lines_that_have_changed(spark, monkeypatch):
    dealt, asked = coverage._dealt, []

    def counted(segments, *rest):
        asked.append(segments.select("arc", "level").distinct().count())
        return dealt(segments, *rest)

    monkeypatch.setattr(coverage, "_dealt", counted)
    simplified(spark, {"a": spiked(0.0), "b": spiked(30.0)}, {"t": 200.0})
    assert len(asked) > 1 and max(asked[1:]) < asked[0]


@pytest.mark.parametrize("closed", [False, True])
def test_short_arcs_are_simplified_together_like_alone(closed):
    rnd = random.Random(11)
    arcs = [[(float(rnd.randint(0, 60)), float(rnd.randint(0, 60))) for _ in range(3 + i % 20)] for i in range(200)]
    arcs = [[*a, a[0]] if closed else a for a in arcs]
    limits = [30.0, 4.0, 0.0, 12.0]
    got = coverage._kept_many([coverage.np.array(a) for a in arcs], limits)
    for arc, kept in zip(arcs, got):
        assert [k.tolist() for k in kept] == [coverage.kept_places(arc, t) if t > 0 else list(range(len(arc))) for t in limits]


def test_a_shape_is_made_once_for_all_parts_that_cut_it_alike(spark):
    cells = grid(2, 2)
    parts = {f"p{i:02}": cells for i in range(70)} | {"alone": {0: cells[0]}}  # more parts than a mask has bits
    data = [(part, key, geom) for part, shapes in parts.items() for key, geom in shapes.items()]
    df = spark.createDataFrame(data, f"part string, id int, geometry {GEOMETRY_TYPE}")
    rows, shapes = coverage.coverage_shapes(df, ["id"], "part", "geometry", {"t": 100.0})
    assert rows.count() == len(data) and "geometry" not in rows.columns
    assert shapes.count() == 4 * 2 + 1  # 62 and 8 parts, and one cell that is cut otherwise
    got = {(r.part, r.id): r.t for r in coverage.with_shapes(rows, shapes).collect()}
    assert len(got) == len(data) and got["alone", 0] != got["p00", 0]
    assert all(got[f"p{i:02}", k] == got["p00", k] for i in range(70) for k in cells)


def test_shapes_of_the_same_vertices_in_other_rings_are_different(spark):
    a, b = [(0.0, 0.0), (9.0, 0.0), (9.0, 9.0), (0.0, 0.0)], [(30.0, 0.0), (39.0, 0.0), (39.0, 9.0), (30.0, 0.0)]
    shapes = {"a": {1: [[a], [b]], 2: []}, "b": {1: [[a, b]]}, "c": {1: None}}
    data = [(part, key, geom) for part, cells in shapes.items() for key, geom in cells.items()]
    df = spark.createDataFrame(data, f"part string, id int, geometry {GEOMETRY_TYPE}")
    got = {(r.part, r.id): r.t for r in coverage_simplify(df, ["id"], "part", "geometry", {"t": 1.0}).collect()}
    assert [len(p) for p in got["a", 1]] == [1, 1] and [len(p) for p in got["b", 1]] == [2]
    assert got["a", 2] == [] and got["c", 1] is None
