"""Simplification of a polygon coverage that stays a coverage.

A shape that many parts (snapshots) have is one row with a mask of its parts. The coverage is cut
into arcs at its nodes, the vertices where other than two border pieces
meet. An arc is one row of a global table, in one canonical direction, whichever polygons of
whichever snapshots use it, and is simplified for all tolerances at once. The lines are then compared
by tiles, in each through a grid of cells: where two of them meet other than in a common end, or one has moved
over another, they are simplified again with half the tolerance, until no two are left. At
worst an arc keeps all its vertices, so the result is valid wherever the input is. A ring is put
together once for all parts that cut it at the same vertices.
"""

from __future__ import annotations

import hashlib
import heapq
import math
from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from regiofact.functions.geometry import GEOMETRY_TYPE
from regiofact.session import drop_steps, materialize

Point = tuple[float, float]


def _area2(a: Point, b: Point, c: Point) -> float:
    return (b[0] - a[0]) * (c[1] - a[1]) - (b[1] - a[1]) * (c[0] - a[0])


class _Vertices:
    """The vertices an arc still has, found by place through a grid of cells."""

    def __init__(self, points: Sequence[Point]) -> None:
        xs, ys = [p[0] for p in points], [p[1] for p in points]
        self.points = points
        self.x0, self.y0 = min(xs), min(ys)
        extent = max(max(xs) - self.x0, max(ys) - self.y0)
        self.step = extent / math.sqrt(len(points)) or 1.0
        self.cells: dict[tuple[int, int], set[int]] = {}
        for i, p in enumerate(points):
            self.cells.setdefault(self._cell(*p), set()).add(i)

    def _cell(self, x: float, y: float) -> tuple[int, int]:
        return int((x - self.x0) / self.step), int((y - self.y0) / self.step)

    def remove(self, i: int) -> None:
        self.cells[self._cell(*self.points[i])].discard(i)

    def in_corner(self, a: Point, b: Point, c: Point) -> bool:
        """Whether a vertex other than its own lies in the corner to be cut off."""
        x0, x1 = min(a[0], b[0], c[0]), max(a[0], b[0], c[0])
        y0, y1 = min(a[1], b[1], c[1]), max(a[1], b[1], c[1])
        (i0, j0), (i1, j1) = self._cell(x0, y0), self._cell(x1, y1)
        for i in range(i0, i1 + 1):
            for j in range(j0, j1 + 1):
                for k in self.cells.get((i, j), ()):
                    p = self.points[k]
                    if not (x0 <= p[0] <= x1 and y0 <= p[1] <= y1) or p in (a, b, c):
                        continue
                    sides = _area2(a, b, p), _area2(b, c, p), _area2(c, a, p)
                    if min(sides) >= 0 or max(sides) <= 0:
                        return True
        return False


def simplify_arc(arc: Sequence[Point], tolerance: float) -> list[Point]:
    """The arc with the vertices that ``kept_places`` keeps, the same from both ends."""
    closed = arc[0] == arc[-1]
    backwards = (arc[1] > arc[-2]) if closed else (arc[0] > arc[-1])
    points = list(reversed(arc)) if backwards else list(arc)
    kept = [points[i] for i in kept_places(points, tolerance)]
    return kept[::-1] if backwards else kept


def kept_places(points: Sequence[Point], tolerance: float) -> list[int]:
    """Visvalingam simplification with fixed ends, area limit ``tolerance ** 2``."""
    n, closed = len(points), points[0] == points[-1]
    before, after = list(range(-1, n - 1)), list(range(1, n + 1))
    alive = [True] * n
    version = [0] * n
    limit = tolerance * tolerance

    def corner(i: int) -> tuple[Point, Point, Point]:
        return points[before[i]], points[i], points[after[i]]

    heap = [(abs(_area2(*corner(i))) / 2.0, i, 0) for i in range(1, n - 1)]
    if not heap or min(heap)[0] >= limit:
        return list(range(n))
    heapq.heapify(heap)
    vertices = _Vertices(points)
    left, fewest = n, 4 if closed else 2
    while heap and left > fewest:
        size, i, seen = heapq.heappop(heap)
        if not alive[i] or seen != version[i]:
            continue
        if size >= limit:
            break
        if vertices.in_corner(*corner(i)):
            continue
        alive[i] = False
        vertices.remove(i)
        left -= 1
        a, c = before[i], after[i]
        after[a], before[c] = c, a
        for j in (a, c):
            if 0 < j < n - 1:
                version[j] += 1
                heapq.heappush(heap, (abs(_area2(*corner(j))) / 2.0, j, version[j]))
    return [i for i, keep in enumerate(alive) if keep]


#: Arcs of so many vertices are simplified many at a time.
SHORT = 24


def _kept_of_short(x: np.ndarray, y: np.ndarray, limits: Sequence[float]) -> list[np.ndarray]:
    """Which vertices stay of arcs (rows) with as many vertices each, as by ``kept_places``, for area limits that rise."""
    m, n = x.shape
    every, places = np.arange(m), np.arange(n)
    before, after = np.tile(places - 1, (m, 1)), np.tile(places + 1, (m, 1))
    alive, left, sizes = np.ones((m, n), bool), np.full(m, n), np.full((m, n), np.inf)
    fewest = np.where((x[:, 0] == x[:, -1]) & (y[:, 0] == y[:, -1]), 4, 2)

    def corner(r: np.ndarray, i: np.ndarray) -> list[Place]:
        return [(x[r, j], y[r, j]) for j in (before[r, i], i, after[r, i])]

    def measure(r: np.ndarray, i: np.ndarray) -> None:
        sizes[r, i] = np.abs(_turn(*corner(r, i))) / 2.0

    for i in range(1, n - 1):
        measure(every, np.full(m, i))
    out = []
    for limit in limits:
        while True:
            best = sizes.argmin(axis=1)
            r = np.flatnonzero((sizes[every, best] < limit) & (left > fewest))
            if not len(r):
                break
            i, p = best[r], (x[r], y[r])
            a, b, c = ((vx[:, None], vy[:, None]) for vx, vy in corner(r, i))
            within = alive[r] & ~(_same(p, a) | _same(p, b) | _same(p, c))
            for k in (0, 1):
                within &= (p[k] >= np.minimum(np.minimum(a[k], b[k]), c[k])) & (p[k] <= np.maximum(np.maximum(a[k], b[k]), c[k]))
            sides = np.stack([_turn(a, b, p), _turn(b, c, p), _turn(c, a, p)])
            within &= (sides.min(axis=0) >= 0) | (sides.max(axis=0) <= 0)
            sizes[r, i] = np.inf
            free = ~within.any(axis=1)
            r, i = r[free], i[free]
            alive[r, i] = False
            left[r] -= 1
            p, q = before[r, i], after[r, i]
            after[r, p], before[r, q] = q, p
            for j in (p, q):
                inner = (j > 0) & (j < n - 1)
                measure(r[inner], j[inner])
        out.append(alive.copy())
    return out


def _kept_many(arcs: Sequence[np.ndarray], tolerances: Sequence[float]) -> list[list[np.ndarray]]:
    """Places of the vertices that stay, by arc and tolerance."""
    order = sorted(range(len(tolerances)), key=lambda i: tolerances[i])
    limits = [max(tolerances[i], 0.0) * max(tolerances[i], 0.0) for i in order]
    out: list[list[np.ndarray]] = [[np.empty(0, int)] * len(order) for _ in arcs]
    by_length: dict[int, list[int]] = {}
    for at, points in enumerate(arcs):
        by_length.setdefault(len(points), []).append(at)
    for n, members in by_length.items():
        for some in (members[i : i + 20_000] for i in range(0, len(members), 20_000)):
            if n <= SHORT:
                points = np.stack([arcs[at] for at in some])
                for i, alive in zip(order, _kept_of_short(points[..., 0], points[..., 1], limits)):
                    for at, row in zip(some, alive):
                        out[at][i] = np.flatnonzero(row)
                continue
            for at in some:
                line = list(map(tuple, arcs[at].tolist()))
                out[at] = [np.array(kept_places(line, t) if t > 0 else range(n)) for t in tolerances]
    return out


Place = tuple[np.ndarray, np.ndarray]


def _turn(p: Place, q: Place, r: Place) -> np.ndarray:
    return (q[0] - p[0]) * (r[1] - p[1]) - (q[1] - p[1]) * (r[0] - p[0])


def _same(p: Place, q: Place) -> np.ndarray:
    return (p[0] == q[0]) & (p[1] == q[1])


def _met(a: Place, b: Place, c: Place, d: Place) -> np.ndarray:
    def inside(p: Place, s: Place, e: Place, turn: np.ndarray) -> np.ndarray:
        within = (p[0] >= np.minimum(s[0], e[0])) & (p[0] <= np.maximum(s[0], e[0]))
        within &= (p[1] >= np.minimum(s[1], e[1])) & (p[1] <= np.maximum(s[1], e[1]))
        return within & (turn == 0) & ~_same(p, s) & ~_same(p, e)

    abc, abd, cda, cdb = _turn(a, b, c), _turn(a, b, d), _turn(c, d, a), _turn(c, d, b)
    across = (np.sign(abc) * np.sign(abd) < 0) & (np.sign(cda) * np.sign(cdb) < 0)
    equal = (_same(a, c) & _same(b, d)) | (_same(a, d) & _same(b, c))
    return across | equal | inside(c, a, b, abc) | inside(d, a, b, abd) | inside(a, c, d, cda) | inside(b, c, d, cdb)


@F.pandas_udf(T.BooleanType())
def _meet(
    ax: pd.Series, ay: pd.Series, bx: pd.Series, by: pd.Series, cx: pd.Series, cy: pd.Series, dx: pd.Series, dy: pd.Series
) -> pd.Series:
    flat = [v.to_numpy(dtype=float) for v in (ax, ay, bx, by, cx, cy, dx, dy)]
    return pd.Series(_met(*zip(flat[::2], flat[1::2])))


def segments_meet(a: Column, b: Column, c: Column, d: Column) -> Column:
    """Whether the segments ab and cd have a point in common other than one common end."""
    return _meet(*[v[axis] for v in (a, b, c, d) for axis in ("x", "y")])


def inside_loop(p: Column, loop: Column) -> Column:
    """Whether a point lies in the loop that an array of vertices closes, by crossings of a ray."""
    n = F.size(loop)
    return F.aggregate(
        F.sequence(F.lit(0), n - 1),
        F.lit(False),
        lambda odd, i: odd != _ray(p, F.get(loop, i), F.get(loop, (i + 1) % n)),
    )


def _ray(p: Column, s: Column, e: Column) -> Column:
    spans = (s["y"] > p["y"]) != (e["y"] > p["y"])
    return spans & (p["x"] < (e["x"] - s["x"]) * (p["y"] - s["y"]) / (e["y"] - s["y"]) + s["x"])


#: A line that meets others is simplified again with half the tolerance so many times, then not at all.
HALVINGS = 6
#: Parts that a mask of 64 bits has room for.
PARTS = 62
#: Vertices that a task gathers, and pairs that it compares at a time.
VERTICES, PAIRS = 400_000, 1_000_000
#: Cells are twice as wide as lines are long on average; the side of a tile is as long as so many of the widest.
TILE = 8
#: So many arcs are broadcast.
FEW = 200_000
SHAPE = ["_g", "_h1", "_h2", "_times"]
_CORNERS = "g int, x double, y double, bx double, by double, ax double, ay double, shape bigint, ring_no int, place int, mask bigint"
_USES = "shape bigint, g int, ring_no int, mask bigint, loose boolean, k int, arc binary, backwards boolean, points array<double>"
_LINES = "arc binary, points array<double>, gs array<int>, masks array<bigint>, tolerances array<double>, kept array<array<int>>, lengths array<double>"
_CELLS = "g int, tx bigint, ty bigint, arc binary, mask bigint, fresh int, points array<double>, kept array<array<int>>"
Batches = Iterable[pa.RecordBatch]


def coverage_simplify(
    df: DataFrame,
    keys: Sequence[str],
    part: str,
    geom: str,
    tolerances: Mapping[str, float],
) -> DataFrame:
    """Add one simplified geometry per (new column -> tolerance).

    ``keys`` identify a polygon inside its ``part`` (one coverage per part). Of a valid coverage
    the results are valid: borders stay shared, no lines cross or touch but at nodes, and nothing
    changes sides. A missing or empty geometry stays as it is.
    """
    return with_shapes(*coverage_shapes(df, keys, part, geom, tolerances)).select(*df.columns, *tolerances)


def coverage_shapes(
    df: DataFrame,
    keys: Sequence[str],
    part: str,
    geom: str,
    tolerances: Mapping[str, float],
    save: Callable[[DataFrame], DataFrame] = materialize,
) -> tuple[DataFrame, DataFrame]:
    """The rows, with the columns that name their shape instead of it, and the shapes with the simplified ones, each once.

    Both are written, the shapes by ``save``, which returns how they are read.
    """
    ident = [part, *keys]
    numbered = materialize(df.select(part).dropna().distinct().select(part, (F.row_number().over(Window.orderBy(part)) - 1).alias("_no")))
    coded = numbered.select(part, F.expr(f"int(_no div {PARTS})").alias("_g"), F.expr(f"shiftleft(1L, int(_no % {PARTS}))").alias("_bit"))
    repeated = materialize(df.groupBy(*ident).agg(F.count(F.lit(1)).alias("_times")).filter("_times > 1"))
    rows = df.join(F.broadcast(coded), part, "left")
    rows = rows.withColumn("_times", F.lit(1).cast("bigint")) if repeated.isEmpty() else rows.join(repeated, ident, "left").fillna(1, ["_times"])
    known = reduce(Column.__and__, [F.col(c).isNotNull() for c in ident])
    # arrays are hashed as what is in them, one after the other
    form = F.to_json(F.transform(geom, lambda polygon: F.transform(polygon, F.size)))
    rows = rows.withColumns({
        "_g": F.coalesce("_g", F.lit(-1)), "_bit": F.when(known, F.col("_bit")).otherwise(0), "_loose": F.when(~known, F.coalesce("_bit", F.lit(0))).otherwise(0),
        "_h1": F.xxhash64(form, geom), "_h2": F.xxhash64(F.lit(1), form, geom),
    })
    rows = materialize(rows)
    shapes = rows.groupBy(*SHAPE).agg(
        F.bit_or("_bit").alias("mask"), F.bit_or("_loose").alias("loose"), F.bool_or(~known).alias("plain"), F.first(geom).alias(geom)
    )
    shapes = materialize(shapes.select(F.monotonically_increasing_id().alias("shape"), "*"))
    simple, steps = _simplified(shapes, geom, tolerances)
    out = save(simple)
    drop_steps(numbered, repeated, shapes, *steps)
    return rows.drop("_loose", geom), out


def with_shapes(rows: DataFrame, simple: DataFrame, also: Sequence[str] = ()) -> DataFrame:
    """The rows with the columns of their shape; each has one, ``also`` with the same of these columns."""
    fits = (F.col("_mask").bitwiseAND(F.col("_bit")) != 0) | (F.col("_mask") == F.col("_bit"))
    on = [*SHAPE, *also]
    same = [F.col(f"_r.{c}") == F.col(f"_s.{c}") for c in on]
    return rows.alias("_r").join(simple.alias("_s"), reduce(Column.__and__, [*same, fits])).drop(*[F.col(f"_s.{c}") for c in on])


def _simplified(shapes: DataFrame, geom: str, tolerances: Mapping[str, float]) -> tuple[DataFrame, list[DataFrame]]:
    """The columns of SHAPE, _mask (the parts of it), the geometry and the simplified ones; and the written steps that this reads."""
    spark = shapes.sparkSession
    vertices = shapes.agg(F.sum(F.size(F.flatten(F.flatten(geom))))).first()[0] or 0
    tasks = max(1, min(spark.sparkContext.defaultParallelism, vertices // 5_000), -(-vertices // VERTICES))
    steps: list[DataFrame] = []

    def step(df: DataFrame) -> DataFrame:
        steps.append(materialize(df))
        return steps[-1]

    rings = F.flatten(geom).alias("rings")
    corners = shapes.select(F.col("_g").alias("g"), "shape", F.col("mask").bitwiseOR(F.col("loose")), rings).mapInArrow(_corners_of, _CORNERS)
    cut = F.collect_list(F.struct("ring_no", "place", "mask"))
    cuts = corners.repartition(tasks, "g", "x", "y").mapInArrow(_at_nodes, "shape bigint, ring_no int, place int, mask bigint").groupBy("shape").agg(cut.alias("cuts"))
    wanted = shapes.select("shape", F.col("_g").alias("g"), F.col("_times").alias("times"), "mask", "loose", rings)
    placed = step(wanted.join(cuts, "shape", "left"))
    # A ring cut at two nodes only could collapse to a line: pin its far vertex too,
    # for every polygon that shares it.
    pins = step(placed.mapInArrow(_pins, "g int, x double, y double, mask bigint").groupBy("g", "x", "y").agg(F.bit_or("mask").alias("pin")))
    if not pins.isEmpty():
        more = corners.join(pins, ["g", "x", "y"]).withColumn("mask", F.col("mask").bitwiseAND(F.col("pin"))).filter("mask != 0")
        more = more.groupBy("shape").agg(cut.alias("more"))
        both = F.concat(F.coalesce("cuts", F.array()), F.coalesce("more", F.array()))
        placed = step(placed.join(more, "shape", "left").withColumn("cuts", both).drop("more"))
    uses = step(placed.mapInArrow(_arc_uses, _USES))
    limits = [float(t) for t in tolerances.values()]
    lines = step(uses.select("arc", "g", "mask", "points").repartition(tasks, "arc").mapInArrow(_lines_of(limits), _LINES))
    sums = lines.agg(*[F.sum(F.get("lengths", F.lit(i))) for i in range(len(limits))], *[F.sum(F.size(F.get("kept", F.lit(i))) - 1) for i in range(len(limits))]).first()
    widths = [2 * (s or 0.0) / (n or 1) + 1e-9 for s, n in zip(sums[: len(limits)], sums[len(limits) :])]
    tile = TILE * max(widths, default=1.0)
    cells = step(_dealt(lines.withColumn("level", F.array(*map(F.lit, range(len(limits)))).cast("array<int>")), tile))
    meeting, halvings = step(_meeting(cells, widths, tile, tasks)), 0
    changed = new = None
    while True:
        now = lines if changed is None else lines.join(_few(changed.select("arc")), "arc", "left_anti").unionByName(changed)
        redo = now.join(_few(meeting.groupBy("arc").agg(F.collect_set("level").alias("level")), meeting), "arc")
        redo = step(redo.withColumn("level", F.filter("level", lambda i: F.get("tolerances", i) > 0)).filter(F.size("level") > 0))
        if redo.isEmpty():
            break
        halvings += 1
        again = step(redo.mapInArrow(_again(halvings <= HALVINGS), f"{_LINES}, level array<int>"))
        # only what is new is dealt again, and compared with itself and all the rest of its tiles
        dealt = step(_dealt(again, tile))
        rest = cells if new is None else cells.join(_few(changed.select("arc")), "arc", "left_anti").unionByName(new)
        # tiles are far fewer than lines
        touched = F.broadcast(dealt.select("g", "tx", "ty").distinct())
        rest = rest.join(touched, ["g", "tx", "ty"], "left_semi").join(_few(again.select("arc")), "arc", "left_anti")
        meeting = step(_meeting(rest.withColumn("fresh", F.lit(0)).unionByName(dealt), widths, tile, tasks))
        new = dealt if new is None else step(new.join(_few(again.select("arc")), "arc", "left_anti").unionByName(dealt))
        again = again.drop("level")
        changed = again if changed is None else step(changed.join(_few(again.select("arc")), "arc", "left_anti").unionByName(again))
    pieces = uses.filter("not loose").drop("points", "g", "loose").join(now.select("arc", "points", "kept"), "arc")
    gathered = pieces.groupBy("shape").agg(F.collect_list(F.struct("ring_no", "mask", "k", "backwards", "points", "kept")).alias("pieces"))
    whole = shapes.join(gathered, "shape", "left").select(*SHAPE, "mask", "plain", F.col(geom).alias("geometry"), "pieces")
    schema = f"_g int, _h1 bigint, _h2 bigint, _times bigint, _mask bigint, `{geom}` {GEOMETRY_TYPE}"
    schema += "".join(f", `{name}` {GEOMETRY_TYPE}" for name in tolerances)
    return whole.mapInArrow(_assembled(len(limits)), schema), steps


def _few(arcs: DataFrame, written: DataFrame | None = None) -> DataFrame:
    """Arcs to be joined, broadcast if there are but few, so that not all lines are shuffled for them."""
    return F.broadcast(arcs) if (written or arcs).count() <= FEW else arcs


def _batch(schema: Sequence[str], *columns: object) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns], names=list(schema))


def _gathered(batches: Batches) -> pa.Table | None:
    found = list(batches)
    return pa.Table.from_batches(found).combine_chunks() if sum(b.num_rows for b in found) else None


def _column(table: pa.Table, name: str) -> pa.Array:
    return table.column(name).combine_chunks() if table.column(name).num_chunks != 1 else table.column(name).chunk(0)


def _sizes(lists: pa.Array) -> np.ndarray:
    return pc.fill_null(pc.list_value_length(lists), 0).to_numpy().astype(np.int64)


def _firsts(sizes: np.ndarray) -> np.ndarray:
    return np.cumsum(sizes) - sizes


def _within(sizes: np.ndarray) -> np.ndarray:
    """0, 1, ... for each size in turn."""
    return np.arange(sizes.sum()) - np.repeat(_firsts(sizes), sizes)


def _lists(sizes: Iterable[int], values: pa.Array, kind: pa.DataType | None = None) -> pa.Array:
    offsets = pa.array(np.concatenate([[0], np.cumsum(np.fromiter(sizes, np.int64))]).astype(np.int32))
    return pa.ListArray.from_arrays(offsets, values, type=kind) if kind else pa.ListArray.from_arrays(offsets, values)


def _rings(rings: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """How many rings each shape has, how many vertices each ring, and their coordinates."""
    flat = rings.flatten()
    x, y = flat.flatten().flatten()
    return _sizes(rings), _sizes(flat), x.to_numpy(zero_copy_only=False), y.to_numpy(zero_copy_only=False)


def _corners_of(batches: Batches) -> Iterator[pa.RecordBatch]:
    """Every vertex of a closed ring with the vertices before and after it."""
    for batch in batches:
        count, size, x, y = _rings(batch.column(3))
        owner, ring_no = np.repeat(np.arange(len(count)), count), _within(count)
        keep = size > 1
        n, first = size[keep] - 1, _firsts(size)[keep]
        place, first, last = _within(n), np.repeat(first, n), np.repeat(n - 1, n)
        at, before = first + place, first + np.where(place == 0, last, place - 1)
        who = np.repeat(owner[keep], n)
        g, shape, mask = (batch.column(i).to_numpy()[who] for i in range(3))
        yield _batch(
            ["g", "x", "y", "bx", "by", "ax", "ay", "shape", "ring_no", "place", "mask"], g, x[at], y[at], x[before], y[before],
            x[at + 1], y[at + 1], shape, np.repeat(ring_no[keep], n).astype(np.int32), place.astype(np.int32), mask,
        )


def _starts(*columns: np.ndarray) -> np.ndarray:
    """Where a run of equal rows begins."""
    new = np.ones(len(columns[0]), bool)
    new[1:] = reduce(np.logical_or, [c[1:] != c[:-1] for c in columns])
    return np.flatnonzero(new)


def _at_nodes(batches: Batches) -> Iterator[pa.RecordBatch]:
    """The places of a ring's nodes, with the parts in which they are some."""
    table = _gathered(batches)
    if table is None:
        return
    g, x, y, bx, by, ax, ay, shape, ring_no, place, mask = (c.to_numpy() for c in table.columns)
    order = np.lexsort((y, x, g))
    vertex = np.zeros(len(order), np.int64)
    starts = _starts(g[order], x[order], y[order])
    vertex[order] = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(order))))
    v, ex, ey, parts = np.tile(vertex, 2), np.concatenate([bx, ax]), np.concatenate([by, ay]), np.tile(mask, 2)
    order = np.lexsort((ey, ex, v))
    v, ex, ey, parts = v[order], ex[order], ey[order], parts[order]
    first = _starts(v, ex, ey)
    v, parts = v[first], np.bitwise_or.reduceat(parts, first)
    degree = np.diff(np.append(_starts(v), len(v)))
    # the parts in which one, two and three border pieces or more meet at a vertex
    one, two, three = (np.zeros(len(starts), np.int64) for _ in range(3))
    rank = _within(degree)
    turns = np.argsort(rank, kind="stable")
    for some in np.split(turns, np.flatnonzero(np.diff(rank[turns])) + 1):
        at, m = v[some], parts[some]
        three[at] |= two[at] & m
        two[at] |= one[at] & m
        one[at] |= m
    cut = mask & (one & ~(two & ~three))[vertex]
    keep = cut != 0
    yield _batch(["shape", "ring_no", "place", "mask"], shape[keep], ring_no[keep], place[keep], cut[keep])


def _variants(mask: int, cuts: Mapping[int, int]) -> list[tuple[int, list[int]]]:
    """The parts that cut a ring at the same places, and these."""
    blocks: list[tuple[int, list[int]]] = [(mask, [])] if mask else []
    for place in sorted(cuts):
        m = cuts[place]
        blocks = [(b & m, [*at, place]) for b, at in blocks if b & m] + [(b & ~m, at) for b, at in blocks if b & ~m]
    return blocks


def _shaped(batches: Batches) -> Iterator[tuple[dict, list[tuple[int, list[Point], dict[int, int]]]]]:
    """Each shape with its closed rings: number, vertices, and the parts that cut it by place."""
    for batch in batches:
        count, size, x, y = _rings(batch.column("rings"))
        points, ends = list(zip(x.tolist(), y.tolist())), np.cumsum(size).tolist()
        cuts = batch.column("cuts")
        cut_ends = np.cumsum(_sizes(cuts)).tolist()
        cuts = list(zip(*[c.to_pylist() for c in cuts.flatten().flatten()]))
        ring = cut = 0
        for i, row in enumerate(batch.select(["shape", "g", "times", "mask", "loose"]).to_pylist()):
            by_ring: dict[int, dict[int, int]] = {}
            for no, place, mask in cuts[cut : cut_ends[i]]:
                found = by_ring.setdefault(no, {})
                found[place] = found.get(place, 0) | mask
            cut = cut_ends[i]
            rings = []
            for no in range(count[i]):
                vertices = points[ends[ring + no] - size[ring + no] : ends[ring + no]]
                if len(vertices) > 1:
                    rings.append((no, vertices, by_ring.get(no, {})))
            ring += count[i]
            yield row, rings


def _pins(batches: Batches) -> Iterator[pa.RecordBatch]:
    out = []
    for row, rings in _shaped(batches):
        for _, ring, cuts in rings:
            for mask, at in _variants(row["mask"], cuts):
                if len(at) * row["times"] == 2:
                    p, q = ring[at[0]], ring[at[-1]]
                    far = max((abs((q[0] - p[0]) * (v[1] - p[1]) - (q[1] - p[1]) * (v[0] - p[0])), *v) for v in ring)
                    out.append((row["g"], far[1], far[2], mask))
    if out:
        g, x, y, mask = zip(*out)
        yield _batch(["g", "x", "y", "mask"], pa.array(g, pa.int32()), x, y, mask)


def _arc_uses(batches: Batches) -> Iterator[pa.RecordBatch]:
    """The arcs of each ring in turn, for all parts that cut it at the same places.

    A ring without nodes is one arc that starts at its smallest vertex. ``arc`` is a digest of
    the points, which are in the arc's own direction; ``backwards`` if the ring runs against it.
    A polygon without a key is ``loose``: it is in the way of lines, but stays as it is.
    """
    names, out = ["shape", "g", "ring_no", "mask", "loose", "k", "arc", "backwards"], []
    flat: list[np.ndarray] = []

    def told() -> pa.RecordBatch:
        columns = [pa.array(c, kind) for c, kind in zip(zip(*out), (pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.bool_(), pa.int32(), pa.binary(), pa.bool_()))]
        return _batch([*names, "points"], *columns, _lists(map(len, flat), pa.array(np.concatenate(flat))))

    for row, rings in _shaped(batches):
        for no, ring, cuts in rings:
            n = len(ring) - 1
            twice = ring[:n] + ring[:n] + ring[:1]
            for mask, at, loose in [*((*v, False) for v in _variants(row["mask"], cuts)), *([(row["loose"], [], True)] if row["loose"] else [])]:
                at = at or [ring.index(min(ring[:n]))]
                for k, start in enumerate(at):
                    points = twice[start : (at[k + 1] if k + 1 < len(at) else at[0] + n) + 1]
                    backwards = points[1] > points[-2] if points[0] == points[-1] else points[0] > points[-1]
                    line = np.array(points[::-1] if backwards else points).ravel() + 0.0  # no negative zero
                    flat.append(line)
                    out.append((row["shape"], row["g"], no, mask, loose, k, hashlib.md5(line.tobytes()).digest(), backwards))
        if len(out) >= 20_000:
            yield told()
            out.clear()
            flat.clear()
    if out:
        yield told()


def _line_batch(arcs: Sequence[bytes], points: Sequence[np.ndarray], uses: Sequence[Mapping[int, int]], tolerances: Sequence[Sequence[float]], kept: Sequence[Sequence[np.ndarray]]) -> list:
    """The columns of lines; points are coordinates in turn."""
    many = len(kept[0])
    flat = np.concatenate(points)
    sizes = np.fromiter((len(k) for each in kept for k in each), np.int64)
    places = np.concatenate([k for each in kept for k in each])
    at = np.repeat(np.repeat(_firsts(np.fromiter(map(len, points), np.int64)), many), sizes) + 2 * places
    long = np.zeros(len(at) + 1)
    long[1:-1] = np.hypot(np.diff(flat[at]), np.diff(flat[at + 1]))
    long[_firsts(sizes)] = 0.0
    total = np.cumsum(long)
    lengths = total[np.cumsum(sizes) - 1] - total[_firsts(sizes)]
    three = [many] * len(arcs)
    return [
        pa.array(arcs, pa.binary()), _lists(map(len, points), pa.array(flat)), pa.array([list(u) for u in uses], pa.list_(pa.int32())),
        pa.array([list(u.values()) for u in uses], pa.list_(pa.int64())), pa.array([list(t) for t in tolerances], pa.list_(pa.float64())),
        _lists(three, _lists(sizes, pa.array(places.astype(np.int32)))), _lists(three, pa.array(lengths)),
    ]


_LINE_NAMES = ["arc", "points", "gs", "masks", "tolerances", "kept", "lengths"]


def _lines_of(tolerances: Sequence[float]) -> Callable[[Batches], Iterator[pa.RecordBatch]]:
    """Each arc once with the places that stay at each tolerance; equal arcs lie in one task."""

    def run(batches: Batches) -> Iterator[pa.RecordBatch]:
        found: dict[bytes, tuple[np.ndarray, dict[int, int]]] = {}
        for batch in batches:
            points = batch.column("points")
            ends, values, sizes = np.cumsum(_sizes(points)).tolist(), points.flatten().to_numpy(), _sizes(points).tolist()
            for i, (arc, g, mask) in enumerate(zip(*[batch.column(c).to_pylist() for c in ("arc", "g", "mask")])):
                if arc not in found:
                    found[arc] = (values[ends[i] - sizes[i] : ends[i]], {})
                uses = found[arc][1]
                uses[g] = uses.get(g, 0) | mask
        arcs = list(found)
        for some in (arcs[i : i + 20_000] for i in range(0, len(arcs), 20_000)):
            points, uses = [found[a][0] for a in some], [found[a][1] for a in some]
            kept = _kept_many([p.reshape(-1, 2) for p in points], tolerances)
            yield _batch(_LINE_NAMES, *_line_batch(some, points, uses, [tolerances] * len(some), kept))

    return run


def _again(halved: bool) -> Callable[[Batches], Iterator[pa.RecordBatch]]:
    """The lines of the levels named, with half the tolerance or none."""

    def run(batches: Batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            rows, tolerances, kept = batch.to_pylist(), [], []
            points = [np.array(r["points"]) for r in rows]
            for r, line in zip(rows, points):
                less = [(t / 2 if halved else 0.0) if i in r["level"] else t for i, t in enumerate(r["tolerances"])]
                line = list(map(tuple, line.reshape(-1, 2).tolist()))
                tolerances.append(less)
                kept.append([
                    np.array(r["kept"][i] if i not in r["level"] else kept_places(line, t) if t > 0 else range(len(line))) for i, t in enumerate(less)
                ])
            uses = [dict(zip(r["gs"], r["masks"])) for r in rows]
            columns = _line_batch([r["arc"] for r in rows], points, uses, tolerances, kept)
            yield _batch([*_LINE_NAMES, "level"], *columns, pa.array([r["level"] for r in rows], pa.list_(pa.int32())))

    return run


def _dealt(lines: DataFrame, tile: float) -> DataFrame:
    """The lines by the tiles that they, or the vertices that they stand for, may pass; ``fresh`` has a bit for each of their ``level``."""
    fresh = F.expr("aggregate(level, 0, (a, i) -> a | shiftleft(1, i))")
    each = lines.select("arc", F.explode(F.arrays_zip("gs", "masks")).alias("u"), fresh.alias("fresh"), "points", "kept")
    each = each.select(F.col("u.gs").alias("g"), "arc", F.col("u.masks").alias("mask"), "fresh", "points", "kept")
    margin = 1e-6 * tile

    def run(batches: Batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            points = batch.column("points")
            sizes, flat = _sizes(points), points.flatten().to_numpy()
            first = _firsts(sizes)
            box = []
            for axis in (0, 1):
                at = first // 2
                box += [np.floor((np.minimum.reduceat(flat[axis::2], at) - margin) / tile).astype(np.int64)]
                box += [np.floor((np.maximum.reduceat(flat[axis::2], at) + margin) / tile).astype(np.int64)]
            x0, x1, y0, y1 = box
            count = (x1 - x0 + 1) * (y1 - y0 + 1)
            plain = np.flatnonzero(count <= 4)
            who, k = np.repeat(plain, count[plain]), _within(count[plain])
            high = (y1 - y0 + 1)[who]
            tx, ty = x0[who] + k // high, y0[who] + k % high
            for i in np.flatnonzero(count > 4).tolist():  # by the vertices that each segment stands for
                line = flat[first[i] : first[i] + sizes[i]].reshape(-1, 2)
                over = set()
                for kept in batch.column("kept")[i].as_py():
                    for s, e in zip(kept, kept[1:]):
                        low = np.floor((line[s : e + 1].min(axis=0) - margin) / tile).astype(int)
                        top = np.floor((line[s : e + 1].max(axis=0) + margin) / tile).astype(int)
                        over |= {(a, b) for a in range(low[0], top[0] + 1) for b in range(low[1], top[1] + 1)}
                who = np.append(who, np.full(len(over), i))
                tx, ty = (np.append(t, [o[axis] for o in over]) for axis, t in ((0, tx), (1, ty)))
            taken = batch.take(pa.array(who))
            yield _batch(["g", "tx", "ty", "arc", "mask", "fresh", "points", "kept"], taken.column("g"), tx, ty, *[taken.column(c) for c in ("arc", "mask", "fresh", "points", "kept")])

    return each.mapInArrow(run, _CELLS)


def _meeting(cells: DataFrame, widths: Sequence[float], tile: float, tasks: int) -> DataFrame:
    """arc and level of lines that meet others of their part.

    Lines that are fresh are compared with each other and with all others of their tile, in cells of it that are
    about as wide as ``widths`` says. The boxes are compared first, and so many pairs at a time that memory is bounded.
    """
    side = [max(1, int(tile / w)) for w in widths]  # cells in a row of a tile

    def run(batches: Batches) -> Iterator[pa.RecordBatch]:
        table = _gathered(batches)
        if table is None:
            return
        met = _met_lines(table, side, tile)
        rows, level = np.nonzero(met)
        yield _batch(["arc", "level"], _column(table, "arc").take(pa.array(rows)), level.astype(np.int32))

    return cells.repartition(tasks, "g", "tx", "ty").mapInArrow(run, "arc binary, level int").distinct()


def _pairs(counts: np.ndarray, first: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(i, first[i]), (i, first[i] + 1), ... for each i and its count, some at a time."""
    ends, start = np.cumsum(counts), 0
    while start < len(counts):
        done = ends[start] - counts[start]
        stop = max(start + 1, int(np.searchsorted(ends, done + PAIRS, "right")))
        some = counts[start:stop]
        i = np.repeat(np.arange(start, stop), some)
        yield i, first[i] + _within(some)
        start = stop


def _met_lines(table: pa.Table, side: Sequence[int], tile: float) -> np.ndarray:
    """Whether the line of a row and level meets another one of its tile or has moved over the start of an arc."""
    g, tx, ty, mask, fresh = (table.column(c).to_numpy() for c in ("g", "tx", "ty", "mask", "fresh"))
    points, kept = _column(table, "points"), _column(table, "kept")
    flat, start = points.flatten().to_numpy(), _firsts(_sizes(points)) // 2
    x, y = flat[::2], flat[1::2]
    order = np.lexsort((ty, tx, g))
    first = _starts(g[order], tx[order], ty[order])
    group = np.zeros(len(order), np.int64)
    group[order] = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(order))))
    lists = kept.flatten()
    places, sizes = lists.flatten().to_numpy(), _sizes(lists)
    at, levels = _firsts(sizes), len(side)
    met = np.zeros((len(g), levels), bool)
    # starts of arcs by tile and x
    extent = x.max() - x.min() + 1.0
    by_x = np.argsort(group * (2 * extent) + (x[start] - x.min()), kind="stable")
    found = (group * (2 * extent) + (x[start] - x.min()))[by_x]
    for level in range(levels):
        mine = np.arange(len(g)) * levels + level
        n, bit = sizes[mine], (fresh >> level & 1).astype(bool)
        if not bit.any():
            continue
        place = places[np.repeat(at[mine], n) + _within(n)]
        row = np.repeat(np.arange(len(g)), n)
        inner = np.flatnonzero(row[1:] == row[:-1])
        row, i, j = row[inner], place[inner], place[inner + 1]
        p, q = start[row] + i, start[row] + j
        width = tile / side[level]
        # longer ones are cut, so no more cells are named than they pass
        pieces = np.maximum(1, np.ceil(np.hypot(x[q] - x[p], y[q] - y[p]) / width)).astype(np.int64)
        seg, k = np.repeat(np.arange(len(p)), pieces), _within(pieces)
        ends = []
        for c in (x, y):
            a, d = c[p][seg], (c[q] - c[p])[seg]
            s, e = a + d * k / pieces[seg], a + d * (k + 1) / pieces[seg]
            ends += [np.floor(np.minimum(s, e) / width).astype(np.int64), np.floor(np.maximum(s, e) / width).astype(np.int64)]
        x0, x1, y0, y1 = ends
        count = (x1 - x0 + 1) * (y1 - y0 + 1)
        who, k = np.repeat(np.arange(len(seg)), count), _within(count)
        high = (y1 - y0 + 1)[who]
        cx, cy, seg = x0[who] + k // high, y0[who] + k % high, seg[who]
        own = (cx // side[level] == tx[row[seg]]) & (cy // side[level] == ty[row[seg]])
        cx, cy, seg = cx[own], cy[own], seg[own]
        order = np.lexsort((cy, cx, group[row[seg]]))
        cx, cy, seg = cx[order], cy[order], seg[order]
        if len(seg):
            first = _starts(group[row[seg]], cx, cy)
            stop = np.repeat(np.append(first[1:], len(seg)), np.diff(np.append(first, len(seg))))
            here = np.arange(len(seg))
            for a, b in _pairs(stop - here - 1, here + 1):
                a, b = seg[a], seg[b]
                r, s = row[a], row[b]
                near = (r != s) & (mask[r] & mask[s] != 0) & (bit[r] | bit[s])
                for c in (x, y):
                    near &= np.maximum(c[p[a]], c[q[a]]) >= np.minimum(c[p[b]], c[q[b]])
                    near &= np.minimum(c[p[a]], c[q[a]]) <= np.maximum(c[p[b]], c[q[b]])
                a, b = a[near], b[near]
                hit = _met((x[p[a]], y[p[a]]), (x[q[a]], y[q[a]]), (x[p[b]], y[p[b]]), (x[q[b]], y[q[b]]))
                met[row[a[hit]], level] = met[row[b[hit]], level] = True
        # a line has moved over another arc if that arc starts between it and what it was
        chain = np.flatnonzero((j > i + 1) & bit[row])
        if not len(chain):
            continue
        cuts = np.stack([p[chain], q[chain] + 1], axis=1).ravel()
        box = [of.reduceat(np.append(c, 0.0), cuts)[::2] for c in (x, y) for of in (np.minimum, np.maximum)]
        base = group[row[chain]] * (2 * extent) - x.min()
        low, top = np.searchsorted(found, base + box[0] - 1e-3, "left"), np.searchsorted(found, base + box[1] + 1e-3, "right")
        for a, b in _pairs(top - low, low):
            c, s = chain[a], by_x[b]
            v = (x[start[s]], y[start[s]])
            near = (s != row[c]) & (group[s] == group[row[c]]) & (mask[s] & mask[row[c]] != 0)
            near &= (v[0] >= box[0][a]) & (v[0] <= box[1][a]) & (v[1] >= box[2][a]) & (v[1] <= box[3][a])
            near &= ~_same(v, (x[p[c]], y[p[c]])) & ~_same(v, (x[q[c]], y[q[c]]))
            c, v = c[near], (v[0][near], v[1][near])
            if len(c):
                n = q[c] - p[c] + 1
                k = _within(n)
                f, t = np.repeat(p[c], n) + k, np.repeat(p[c], n) + (k + 1) % np.repeat(n, n)
                vx, vy = np.repeat(v[0], n), np.repeat(v[1], n)
                with np.errstate(all="ignore"):
                    crossed = ((y[f] > vy) != (y[t] > vy)) & (vx < (x[t] - x[f]) * (vy - y[f]) / (y[t] - y[f]) + x[f])
                inside = np.add.reduceat(crossed.astype(np.int64), _firsts(n)) % 2 == 1
                met[row[c[inside]], level] = True
    return met


def _assembled(levels: int) -> Callable[[Batches], Iterator[pa.RecordBatch]]:
    """The shapes with their rings put together from lines, once for all parts that cut them at the same places."""

    def shape_of(found: list[tuple[list[list[np.ndarray]], list[int]]], level: int, kind: pa.DataType) -> pa.Array:
        coordinates = np.concatenate([c for f in found for c in f[0][level]] or [np.empty((0, 2))])
        vertex = kind.value_type.value_type.value_type
        flat = pa.StructArray.from_arrays([pa.array(np.ascontiguousarray(coordinates[:, i])) for i in (0, 1)], fields=[vertex.field(0), vertex.field(1)])
        rings = _lists((len(c) for f in found for c in f[0][level]), flat, kind.value_type.value_type)
        return _lists((len(f[1]) for f in found), _lists((n for f in found for n in f[1]), rings, kind.value_type), kind)

    def run(batches: Batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            geometry, pieces = batch.column("geometry"), batch.column("pieces")
            polygons = geometry.flatten()
            count = _sizes(geometry)  # polygons of a shape
            rings, size, x, y = _rings(polygons)
            own = np.stack([x, y], axis=1)
            ends, ring_ends = np.cumsum(size), np.cumsum(rings)
            piece_ends, per_shape = np.cumsum(_sizes(pieces)), _sizes(pieces)
            no, parts, k, backwards, points, kept = pieces.flatten().flatten()
            no, parts, k, backwards = (c.to_pylist() for c in (no, parts, k, backwards))
            flat, last = points.flatten().to_numpy(), np.cumsum(_sizes(points))
            sizes = _sizes(points)
            lists = kept.flatten()
            places, list_ends, list_sizes = lists.flatten().to_numpy(), np.cumsum(_sizes(lists)), _sizes(lists)
            made, rows, masks, source, polygon = [], [], [], [], 0
            for i, (mask, plain, times) in enumerate(zip(*[batch.column(c).to_pylist() for c in ("mask", "plain", "_times")])):
                mine = sorted(range(piece_ends[i] - per_shape[i], piece_ends[i]), key=lambda e: (no[e], parts[e], k[e]))
                of: dict[tuple[int, int], list[int]] = {}
                for e in mine:
                    of.setdefault((no[e], parts[e]), []).append(e)
                blocks = [mask] if mask else []
                for _, m in of:
                    if m != mask:
                        blocks = [b & w for b in blocks for w in (m, ~m) if b & w]
                sides = rings[polygon : polygon + count[i]].tolist()
                ring = int(ring_ends[polygon] - rings[polygon]) if count[i] else 0
                polygon += count[i]
                for block in blocks:
                    rows.append(i)
                    masks.append(block)
                    if not mine:
                        source.append(None)
                        continue
                    by_no = {n: each for (n, m), each in of.items() if m & block}
                    lines: list[list[np.ndarray]] = [[] for _ in range(levels)]
                    for n in range(sum(sides)):
                        for level in range(levels):
                            body = []
                            for e in by_no.get(n, ()):
                                f = e * levels + level
                                line = flat[last[e] - sizes[e] : last[e]].reshape(-1, 2)[places[list_ends[f] - list_sizes[f] : list_ends[f]]]
                                body += [line[:0:-1] if backwards[e] else line[:-1]] * times
                            if body:
                                lines[level].append(np.concatenate([*body, body[0][:1]]))
                            else:
                                lines[level].append(own[ends[ring + n] - size[ring + n] : ends[ring + n]])
                    source.append(len(made))
                    made.append((lines, sides))
                if plain:
                    rows.append(i)
                    masks.append(0)
                    source.append(None)
            taken = pa.array([len(made) + r if s is None else s for r, s in zip(rows, source)], pa.int64())
            out = [batch.column(c).take(pa.array(rows, pa.int64())) for c in ("_g", "_h1", "_h2", "_times")]
            out += [pa.array(masks, pa.int64()), geometry.take(pa.array(rows, pa.int64()))]
            for level in range(levels):
                out.append(pa.concat_arrays([shape_of(made, level, geometry.type), geometry]).take(taken))
            yield pa.RecordBatch.from_arrays(out, names=["_g", "_h1", "_h2", "_times", "_mask", "geometry", *[f"l{i}" for i in range(levels)]])

    return run
