"""Near duplicates of embeddings by random-hyperplane sign hashing in several tables.

Two vectors at the threshold's angle fall on the same side of a random hyperplane with
probability p = 1 - angle / pi, so in one of T tables of k planes with 1 - (1 - p^k)^T. The
number of planes follows the size of the largest label, the number of tables the wanted miss.
Candidates are verified by their exact cosine. Identical vectors of a label are one
representative with a multiplicity, and a bucket is compared in blocks: no pairs are listed,
each block returns link counts and a spanning forest of its links. A pair is counted only in
the first table in which it meets.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from regiofact.llm.base import query, stored, table
from regiofact.llm.components import components
from regiofact.llm.vectors import units, usable

#: Rows of a bucket that one task compares with as many others.
BLOCK = 1024
#: Mean size of a bucket of unrelated vectors, and the share of threshold pairs that may be missed.
BUCKET, MISSED = 256, 1e-5


def shape(largest: int, threshold: float) -> tuple[int, int]:
    """(planes of a table, tables) for a label of ``largest`` vectors."""
    planes = max(1, math.ceil(math.log2(max(2, largest) / BUCKET)))
    meet = (1 - math.acos(threshold) / math.pi) ** planes
    return planes, math.ceil(math.log(MISSED) / math.log(1 - meet))


def _signatures(planes: int, tables: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = [np.asarray(v, dtype=np.float64) for v in batch.column("vector").to_pylist()]
            codes = np.zeros((len(vectors), tables), dtype=np.int32)
            sizes = np.array([len(v) for v in vectors])
            for dims in np.unique(sizes):
                at = np.nonzero(sizes == dims)[0]
                normals = np.random.default_rng(11).normal(size=(tables * planes, dims))
                sides = units([vectors[i] for i in at]) @ normals.T >= 0
                powers = 1 << np.arange(planes, dtype=np.int32)
                codes[at] = sides.reshape(len(at), tables, planes) @ powers
            signed = pa.array(list(codes), pa.list_(pa.int32()))
            yield pa.record_batch([*batch.columns, signed], [*batch.schema.names, "codes"])

    return run


def _with_codes(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField("codes", T.ArrayType(T.IntegerType()))])


def _roots(linked: np.ndarray) -> np.ndarray:
    """Smallest index of each row's component in a symmetric matrix with a true diagonal."""
    root = np.arange(len(linked))
    while True:
        lower = np.where(linked, root[None, :], len(linked)).min(axis=1)
        lower = np.minimum(lower, lower[lower])
        if (lower == root).all():
            return root
        root = lower


def _compare(threshold: float):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("rep", kind="stable")
        rep, times = pdf["rep"].to_numpy(), pdf["times"].to_numpy()
        block, now = pdf["block"].to_numpy(), int(pdf["t"].iloc[0])
        x = units(pdf["vector"])
        codes = np.stack(pdf["codes"].to_numpy())
        linked = x @ x.T >= threshold
        if len(np.unique(block)) > 1:  # two blocks: only what lies between them
            linked &= block[:, None] != block[None, :]
        np.fill_diagonal(linked, False)
        a, b = np.nonzero(linked)
        first = np.ones(len(a), dtype=bool)
        for start in range(0, len(a), 1 << 18):
            s = slice(start, start + (1 << 18))
            first[s] = ~(codes[a[s], :now] == codes[b[s], :now]).any(axis=1)
        n = np.bincount(a[first], times[b[first]], len(rep)).astype(np.int64)
        np.fill_diagonal(linked, True)
        root = rep[_roots(linked)]
        some = (n > 0) | (root != rep)
        return pd.DataFrame({"rep": rep[some], "n": n[some], "root": root[some]})

    return run


def near_duplicates(embeddings: DataFrame, threshold: float) -> DataFrame:
    """vec_id, n_links, component_id and kept, one row per vector.

    Vectors are linked when their labels are equal and their cosine is at least ``threshold``.
    Null labels or ids and vectors that are null, zero, or hold null or non-finite components
    link with nothing: no links, component their own id. Vectors of different lengths are not
    compared. Repeated rows count as vectors of their own; other columns are not carried.
    """
    rows = embeddings.select(
        F.col("vec_id").cast("long"), F.col("label"), F.col("embedding").alias("vector")
    )
    takes_part = usable(F.col("vector")) & F.col("label").isNotNull() & F.col("vec_id").isNotNull()
    reps = rows.filter(takes_part).groupBy("label", "vector").agg(
        F.min("vec_id").alias("rep"), F.count("*").alias("times")
    )
    reps = stored(reps.withColumn("dims", F.size("vector")), "vectors")
    largest = reps.groupBy("label").count().agg(F.max("count")).first()[0] or 0
    planes, tables = shape(largest, threshold)
    signed = reps.mapInArrow(_signatures(planes, tables), _with_codes(reps.schema))
    signed = stored(signed, "signatures")
    keyed = signed.select("label", "dims", "rep", F.posexplode("codes").alias("t", "key"))
    sizes = keyed.groupBy("label", "dims", "t", "key").count().filter("count > 1")
    blocks = F.ceil(F.col("count") / BLOCK).cast("int")
    sizes = sizes.select("label", "dims", "t", "key", blocks.alias("blocks"))
    members = signed.select("*", F.posexplode("codes").alias("t", "key"))
    members = members.join(sizes, ["label", "dims", "t", "key"])
    members = members.withColumn("block", F.pmod(F.xxhash64("rep", "t"), F.col("blocks")).cast("int"))
    members = members.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    ends = {"low": F.least("block", "other"), "high": F.greatest("block", "other")}
    compared = members.withColumns(ends).select(
        "label", "dims", "t", "key", "low", "high", "block", "rep", "times", "vector", "codes"
    ).groupBy("label", "dims", "t", "key", "low", "high").applyInPandas(
        _compare(threshold), "rep long, n long, root long"
    )
    compared = stored(compared, "links")
    counts = compared.groupBy("rep").agg(F.sum("n").alias("others"))
    found = components(compared.filter("rep <> root").select("rep", "root"))
    known = reps.select("label", "vector", "rep", "times").join(counts, "rep", "left").join(
        found.withColumnRenamed("node", "rep"), "rep", "left"
    ).select(
        "label", "vector", (F.col("times") - 1 + F.coalesce("others", F.lit(0))).alias("linked"),
        F.coalesce("component", "rep").alias("found"),
    )
    part = rows.filter(takes_part).join(known, ["label", "vector"])
    rest = rows.filter(~takes_part).withColumns({"linked": F.lit(0).cast("long"), "found": F.col("vec_id")})
    both = part.select("vec_id", "linked", "found").unionAll(rest.select("vec_id", "linked", "found"))
    return both.select(
        "vec_id", F.col("linked").alias("n_links"), F.col("found").alias("component_id"),
        F.coalesce(F.col("vec_id") == F.col("found"), F.lit(False)).alias("kept"),
    )


#: The exact join as SQL.
ORACLE = """
WITH RECURSIVE v AS (
    SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
), links AS (
    SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
    WHERE list_cosine_similarity(a.e, b.e) >= 0.93
), reach AS (
    SELECT a AS vec_id, b AS other FROM links
    UNION SELECT reach.vec_id, links.b FROM reach JOIN links ON reach.other = links.a
), c AS (SELECT vec_id, min(other) AS low FROM reach GROUP BY vec_id),
n AS (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, COALESCE(n, 0) AS n_links, least(vec_id, COALESCE(low, vec_id)) AS component_id,
       vec_id = least(vec_id, COALESCE(low, vec_id)) AS kept
FROM v LEFT JOIN n USING (vec_id) LEFT JOIN c USING (vec_id)
"""


@query(ORACLE)
def op10_embedding_dedup(spark, sf_dir):
    """Near duplicates among all embeddings of a label, at a cosine of 0.93."""
    return near_duplicates(table(spark, sf_dir, "embeddings"), 0.93)
