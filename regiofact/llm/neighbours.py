"""Approximate nearest neighbours by learned partitions.

On a bounded sample the graph of nearest neighbours is cut into balanced parts, and a small
classifier learns the part of a vector. Every row is indexed under its most probable part; a
query visits as many of its most probable parts as a calibration on held-out rows of the sample
asks for, and what it finds there is ranked by exact cosine.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from regiofact.llm.base import query, stored, table
from regiofact.llm.vectors import units, usable


@dataclass(frozen=True)
class Settings:
    """sample: rows fitted on, those of smallest hash; rows: rows of a part, while there are at
    most ``parts``; wanted: the share of neighbours that the visited parts hold in calibration."""

    sample: int = 6000
    rows: int = 1024
    parts: int = 64
    neighbours: int = 10
    wanted: float = 0.97
    epochs: int = 30
    seed: int = 3


#: Rows and queries that one task compares at a time.
BLOCK, QUERIES = 4096, 2048


def nearest_in(x: np.ndarray, among: np.ndarray, k: int) -> np.ndarray:
    """Numbers of each row's k nearest rows of ``among``, itself excluded where it is the same row."""
    out = np.zeros((len(x), k), dtype=np.int64)
    for start in range(0, len(x), 512):
        scores = x[start : start + 512] @ among.T
        if x is among:
            at = np.arange(start, min(len(x), start + 512))
            scores[at - start, at] = -np.inf
        out[start : start + 512] = np.argpartition(-scores, k - 1, axis=1)[:, :k]
    return out


def balanced_parts(near: np.ndarray, parts: int, rng: np.random.Generator) -> np.ndarray:
    """Parts of about equal size that keep neighbours together.

    Regions grow from random rows, the smallest first; then rows move to the part of most of
    their neighbours while it has room.
    """
    n = len(near)
    both: list[list[int]] = [[] for _ in range(n)]
    for i, row in enumerate(near.tolist()):
        for j in row:
            both[i].append(j)
            both[j].append(i)
    room = -(-n // parts) + max(1, n // parts // 20)
    part = np.full(n, -1)
    order = rng.permutation(n).tolist()
    fronts: list[list[int]] = [[order[p]] for p in range(parts)]
    sizes, rest, done = [0] * parts, iter(order), 0
    while done < n:
        p = min(range(parts), key=sizes.__getitem__)
        while fronts[p] and part[fronts[p][-1]] >= 0:
            fronts[p].pop()
        i = fronts[p].pop() if fronts[p] else next(i for i in rest if part[i] < 0)
        part[i] = p
        sizes[p] += 1
        done += 1
        fronts[p] = [j for j in both[i] if part[j] < 0] + fronts[p]
    for _ in range(10):
        moved = 0
        for i in rng.permutation(n).tolist():
            votes = np.bincount(part[both[i]], minlength=parts)
            best = int(votes.argmax())
            if best != part[i] and votes[best] > votes[part[i]] and sizes[best] < room:
                sizes[part[i]] -= 1
                sizes[best] += 1
                part[i] = best
                moved += 1
        if moved < n // 100:
            break
    return part


@dataclass
class Router:
    """A softmax classifier of parts; ``visits`` parts are searched for a query."""

    dims: int
    weights: np.ndarray
    bias: np.ndarray
    visits: int

    def logits(self, x: np.ndarray) -> np.ndarray:
        return x @ self.weights + self.bias


def train(x: np.ndarray, part: np.ndarray, parts: int, settings: Settings, rng: np.random.Generator) -> Router:
    weights, bias = np.zeros((x.shape[1], parts)), np.zeros(parts)
    for epoch in range(settings.epochs):
        rate = 4.0 * (1 - epoch / settings.epochs)
        for at in np.array_split(rng.permutation(len(x)), max(1, len(x) // 64)):
            z = x[at] @ weights + bias
            p = np.exp(z - z.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(len(at)), part[at]] -= 1
            weights -= rate * x[at].T @ p / len(at) * 8
            bias -= rate * p.mean(axis=0)
    return Router(x.shape[1], weights, bias, parts)


def fit(rows: DataFrame, settings: Settings = Settings()) -> Router:
    """A router for usable rows (id, vector), from a sample of bounded size."""
    total = rows.count()
    sample = rows.orderBy(F.xxhash64("id"), "id").limit(settings.sample).select("vector").toPandas()["vector"]
    sizes = sample.map(len)
    dims = int(sizes.mode().iloc[0]) if len(sample) else 0
    parts = max(1, min(settings.parts, total // settings.rows))
    if parts == 1:
        return Router(dims, np.zeros((dims, 1)), np.zeros(1), 1)
    x = units(sample[sizes == dims])
    rng = np.random.default_rng(settings.seed)
    held = np.zeros(len(x), dtype=bool)
    held[: len(x) // 8] = True
    held = rng.permutation(held)
    known = x[~held]
    part = balanced_parts(nearest_in(known, known, settings.neighbours), parts, rng)
    router = train(known, part, parts, settings, rng)
    # where the parts of held-out rows' neighbours stand in the order of their own parts
    near = nearest_in(x[held], known, 5)
    home = router.logits(known).argmax(axis=1)
    order = np.argsort(-router.logits(x[held]), axis=1)
    place = np.empty_like(order)
    np.put_along_axis(place, order, np.arange(parts)[None, :].repeat(len(order), 0), axis=1)
    ranks = np.sort(np.take_along_axis(place, home[near], axis=1).ravel())
    router.visits = int(ranks[min(len(ranks) - 1, int(np.ceil(settings.wanted * len(ranks))) - 1)]) + 1
    return router


def _routed(router: Router, visits: int):
    """Add the most probable parts; vectors of another length have a part of their own length."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = batch.column("vector").to_pylist()
            usual = [i for i, v in enumerate(vectors) if len(v) == router.dims]
            parts = [[-len(v)] for v in vectors]
            if usual:
                z = router.logits(units([vectors[i] for i in usual]))
                best = np.argsort(-z, axis=1, kind="stable")[:, :visits]
                for i, p in zip(usual, best.tolist(), strict=True):
                    parts[i] = p
            arrays = [*batch.columns, pa.array(parts, pa.list_(pa.int32()))]
            yield pa.record_batch(arrays, [*batch.schema.names, "parts"])

    return run


def _cosines(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Cosine of each pair of rows, every pair summed in the same order."""
    dot, q2, x2 = (q * x).sum(axis=1), (q * q).sum(axis=1), (x * x).sum(axis=1)
    return dot / (np.sqrt(q2) * np.sqrt(x2))


def _best(k: int):
    def run(queries: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        empty = pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype(
            {"query_id": "int64", "vec_id": "int64"}
        )
        if queries.empty or rows.empty:
            return empty
        q, x = np.stack(queries["vector"]).astype(float), np.stack(rows["vector"]).astype(float)
        q /= np.abs(q).max(axis=1, keepdims=True)  # a power of cosine: no overflow below
        x /= np.abs(x).max(axis=1, keepdims=True)
        qid, xid = queries["id"].to_numpy(), rows["id"].to_numpy()
        norms = np.sqrt((x * x).sum(axis=1))
        out = []
        for i in range(len(q)):
            scores = x @ q[i] / norms / np.sqrt(q[i] @ q[i])
            scores[xid == qid[i]] = -np.inf
            least = np.partition(scores, -k)[-k] if len(scores) > k else -2.0
            at = np.nonzero(scores >= max(least - 1e-9, -2.0))[0]
            exact = _cosines(np.broadcast_to(q[i], (len(at), q.shape[1])), x[at])
            first = np.lexsort((xid[at], -exact))[:k]
            out.append(pd.DataFrame({"query_id": qid[i], "vec_id": xid[at][first], "score": exact[first]}))
        return pd.concat(out) if out else empty

    return run


def nearest(embeddings: DataFrame, queries: DataFrame, k: int, settings: Settings = Settings()) -> DataFrame:
    """query_id, rank, vec_id and score: the k nearest rows found for each query, by cosine.

    ``embeddings`` and ``queries`` have vec_id and embedding. A row is no neighbour of a query
    of its id. Vectors that are null, zero, or hold null or non-finite components, and rows
    without id, take no part; vectors of different lengths are never neighbours. Equal scores
    go to the smaller id. Other columns are not carried. Parts are searched in blocks of rows,
    so a part that holds most rows is no single task.
    """

    def rows_of(df: DataFrame) -> DataFrame:
        rows = df.select(F.col("vec_id").cast("long").alias("id"), F.col("embedding").alias("vector"))
        return rows.filter(usable(F.col("vector")) & F.col("id").isNotNull())

    rows = rows_of(embeddings)
    router = fit(rows, settings)
    vector = rows.schema["vector"].dataType.simpleString()
    kept = f"id long, vector {vector}, parts array<int>"
    indexed = rows.mapInArrow(_routed(router, 1), kept).withColumn("part", F.col("parts")[0])
    indexed = stored(indexed.drop("parts"), "index")
    asked = rows_of(queries).mapInArrow(_routed(router, router.visits), kept)
    asked = stored(asked.select("id", "vector", F.explode("parts").alias("part")), "asked")
    # one row per part: how many blocks of rows and of queries it has
    many = indexed.groupBy("part").agg(F.ceil(F.count("*") / BLOCK).alias("blocks"))
    asking = asked.groupBy("part").agg(F.ceil(F.count("*") / QUERIES).alias("groups"))
    sizes = many.join(asking, "part")

    def dealt(df: DataFrame, own: str, own_count: str, other: str, other_count: str) -> DataFrame:
        both = df.join(F.broadcast(sizes), "part")  # no more rows than there are parts
        both = both.withColumn(own, F.pmod(F.xxhash64("id"), own_count))
        return both.withColumn(other, F.explode(F.sequence(F.lit(0), F.col(other_count) - 1))).select(
            "part", "block", "batch", "id", "vector"
        )

    left = dealt(asked, "batch", "groups", "block", "blocks")
    right = dealt(indexed, "block", "blocks", "batch", "groups")
    key = ("part", "block", "batch")
    found = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInPandas(
        _best(k), "query_id long, vec_id long, score double"
    )
    by_score = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.dropDuplicates(["query_id", "vec_id"]).withColumn("rank", F.row_number().over(by_score))
    return ranked.filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


@query()
def op6_nearest_neighbours(spark, sf_dir):
    """The five nearest rows of every fiftieth embedding."""
    rows = table(spark, sf_dir, "embeddings")
    return nearest(rows, rows.filter(F.col("vec_id") % 50 == 0), 5)
