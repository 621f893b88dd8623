"""Near duplicates by SimHash fingerprints under covering locality-sensitive hashing.

A covering family has 2^(r+1) - 1 bit masks for radius r: position i of the fingerprint gets a
vector m(i) of r+1 bits, and mask v, a nonzero vector of r+1 bits, holds the positions whose
m(i) has an odd product with v. Any r positions leave some v whose product with all of theirs
is even, so every pair that differs in at most r bits agrees on some mask: no pair is missed.

Fingerprints that agree on a mask are candidates. Inside such a bucket no pairs are listed:
each fingerprint states itself and its neighbours at one flipped bit outside of the mask, and
fingerprints that state a common value differ in at most two bits. A value is stated by at most
one more than the free bits, whatever the bucket's size, so buckets need no cap.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regiofact.llm.base import picked, query, stored, table
from regiofact.llm.components import components

#: Bits of a fingerprint, bits in which linked ones may differ, words of a shingle.
BITS, RADIUS, SIZE = 64, 2, 3
WORD = re.compile(rb"[^\x20\x09-\x0D]+")
UPPER = bytes(range(65, 91))
LOWERED = bytes.maketrans(UPPER, UPPER.lower())


def masks(bits: int = BITS, radius: int = RADIUS) -> list[int]:
    """The covering masks; positions take the nonzero vectors in turn."""
    vectors = [1 + i % ((1 << (radius + 1)) - 1) for i in range(bits)]
    return [
        sum(1 << i for i, m in enumerate(vectors) if (m & v).bit_count() % 2)
        for v in range(1, 1 << (radius + 1))
    ]


def shingle_hashes(text: str, size: int = SIZE) -> np.ndarray:
    """XXH64 (seed 42) of each shingle, repeats included; no words give no hashes."""
    words = WORD.findall(text.encode("utf-8", "replace").translate(LOWERED))
    digest = xxhash.xxh64_intdigest
    if len(words) <= size:
        return np.array([digest(b" ".join(words), 42)] if words else [], dtype=np.uint64)
    runs = zip(*(words[i:] for i in range(size)), strict=False)
    return np.array([digest(b" ".join(r), 42) for r in runs], dtype=np.uint64)


def fingerprint(text: str, size: int = SIZE) -> int:
    """Bit i is set if it is set in over half of the hashes; 0 without words."""
    hashes = shingle_hashes(text, size)
    if not len(hashes):
        return 0
    total = np.zeros(BITS, dtype=np.int64)
    for start in range(0, len(hashes), 1 << 16):
        part = hashes[start : start + (1 << 16)].astype("<u8").view(np.uint8)
        total += np.unpackbits(part.reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * total > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, size: int = SIZE) -> DataFrame:
    """doc_id, k (a key of the row) and f, the fingerprint as signed long, of whole texts; null is empty."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            values = np.array([fingerprint(t or "", size) for t in texts], dtype=np.uint64).view(np.int64)
            yield pa.record_batch([batch.column("doc_id"), batch.column("k"), pa.array(values)], ["doc_id", "k", "f"])

    keyed = picked(docs, doc_id="long", text="string").select("doc_id", _row_key(), "text")
    return keyed.mapInArrow(run, "doc_id long, k long, f long")


def _row_key() -> Column:
    return F.xxhash64("doc_id", "text").alias("k")


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def links(distinct: DataFrame) -> DataFrame:
    """a, b: links between distinct fingerprints f at two or fewer bits, enough to connect them.

    All members that state a common value are linked to the smallest of them.
    """
    all_masks = masks()
    keys = F.explode(F.array(*[
        F.struct(F.lit(v).alias("t"), F.col("f").bitwiseAND(F.lit(_signed(m))).alias("key"))
        for v, m in enumerate(all_masks)
    ]))
    keyed = distinct.select("f", keys.alias("k")).select("f", "k.t", "k.key")
    # written first: a join with a table is split where a key is hot, one with an aggregate is not
    shared = stored(keyed.groupBy("t", "key").count().filter("count > 1").select("t", "key"), "shared")
    members = keyed.join(shared, ["t", "key"])

    def stated(mask: int) -> Column:
        free = [i for i in range(BITS) if not mask >> i & 1]
        return F.array(F.col("f"), *[F.col("f").bitwiseXOR(F.lit(_signed(1 << i))) for i in free])

    choice = None
    for v, m in enumerate(all_masks):
        choice = F.when(F.col("t") == v, stated(m)) if choice is None else choice.when(F.col("t") == v, stated(m))
    values = members.select("t", "f", F.explode(choice).alias("value"))
    # at most 1 + free bits members for each value: the list is bounded by the method
    meeting = values.groupBy("t", "value").agg(F.collect_set("f").alias("fs")).filter(F.size("fs") > 1)
    pairs = meeting.select(F.array_min("fs").alias("b"), F.explode("fs").alias("a")).filter("a <> b")
    return pairs.select("a", "b").distinct()


def grouped(marked: DataFrame) -> DataFrame:
    """f, c (the component of the fingerprint) and component_id (its smallest doc_id), written."""
    classes = stored(marked.groupBy("f").agg(F.min("doc_id").alias("least")), "classes")
    found = components(links(classes.select("f"))).withColumnRenamed("node", "f")
    groups = stored(classes.join(found, "f", "left").withColumn("c", F.coalesce("component", "f")), "groups")
    smallest = stored(groups.groupBy("c").agg(F.min("least").alias("component_id")), "smallest")
    return stored(groups.join(smallest, "c").select("f", "c", "component_id"), "named")


def near_duplicates(docs: DataFrame, size: int = SIZE) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id (smallest doc_id reachable).

    Fingerprints of shingles of ``size`` words are linked at RADIUS or fewer differing bits.
    Texts without words (null and empty ones too) share the fingerprint zero and are linked
    like any other. A row with a null doc_id has a fingerprint and takes part in the links; a
    component of nothing else has a null id. Repeated rows return once each.
    """
    # texts are read once; what follows works on some bytes a document
    marked = stored(fingerprints(docs, size), "fingerprints")
    return marked.join(grouped(marked), "f").select(
        "doc_id", F.lower(F.lpad(F.hex("f"), 16, "0")).alias("fingerprint"), "component_id"
    )


def representatives(docs: DataFrame, size: int = SIZE) -> DataFrame:
    """The document of the smallest doc_id of each component, with the columns of documents.

    Documents without doc_id have no smallest and are all kept. Of rows of one component that
    repeat its doc_id one stays; different texts of one doc_id that are not linked all stay, where
    it is the smallest of their components.
    """
    marked = stored(fingerprints(docs, size), "fingerprints")
    stay = marked.join(grouped(marked), "f").filter("doc_id = component_id")
    stay = stored(stay.groupBy("doc_id", "c").agg(F.min("k").alias("k")).select("doc_id", "k").distinct(), "stay")
    kept = picked(docs, doc_id="long", text="string", lang="string", source="string", n_chars="long")
    keyed = kept.select("*", _row_key()).join(stay, ["doc_id", "k"]).dropDuplicates(["doc_id", "k"])
    return keyed.select(*kept.columns).unionAll(kept.filter("doc_id is null"))


@query()
def op4_simhash(spark, sf_dir):
    """Groups of near copies among all documents."""
    return near_duplicates(table(spark, sf_dir, "documents"))
