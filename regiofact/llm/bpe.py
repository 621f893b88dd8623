"""Encoding and decoding with byte-pair vocabularies through a table of distinct words.

Texts are split into words in blocks. A block keeps its distinct words once and each document as
positions in that list. The words of all blocks meet by hash, where each distinct word is
encoded once; its ids go back to the blocks that hold it, and documents are joined by position.
Decoding looks every id up in the table of pieces, which is as large as the vocabulary.
Neither texts nor positions are shuffled: what travels is each block's distinct words.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regiofact.llm.base import picked, query, table, texts_of, tokenizer
from regiofact.llm.word_pieces import word_pieces
from regiofact.session import new_path

#: Characters of a block; words of one row; most groups of words; most buckets of blocks.
BLOCK, ROW, GROUPS, BUCKETS = 16 << 20, 512, 1 << 16, 50_000


def packed(numbers: np.ndarray) -> bytes:
    """Small numbers in few bytes: the bytes of each rank together, then deflated."""
    planes = np.ascontiguousarray(numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T)
    return zlib.compress(planes.tobytes(), 1)


def unpacked(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zlib.decompress(data), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel().astype(np.int64)


def _batch(schema: str, rows: list[tuple]) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    fields = [f.split() for f in schema.split(", ")]
    columns = zip(*rows, strict=True) if rows else [[]] * len(fields)
    arrays = [pa.array(c, kinds[k]) for c, (_, k) in zip(columns, fields, strict=True)]
    return pa.record_batch(arrays, [n for n, _ in fields])


#: A row is a document (doc_id, codes) or some of the block's words (grp, at, words).
BLOCKS = "block long, doc_id long, codes binary, grp int, at binary, words binary"


def blocks(docs: DataFrame, path: str, groups: int) -> DataFrame:
    """Documents as positions in their block's list of distinct words, and these lists."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split = word_pieces(path).split
        first = TaskContext.get().partitionId() << 32
        for number, (ids, texts) in enumerate(texts_of(batches, BLOCK)):
            block, known, codes = first + number, {}, []
            for text in texts:
                words = split(text)
                for w in words:
                    known.setdefault(w, len(known))
                codes.append(np.fromiter(map(known.__getitem__, words), np.int64, len(words)))
            # frequent words get small numbers
            counts = np.bincount(np.concatenate(codes), minlength=len(known))
            rank = np.empty(len(known), dtype=np.int64)
            rank[np.argsort(-counts, kind="stable")] = np.arange(len(known))
            yield _batch(BLOCKS, [
                (block, i, packed(rank[c]), None, None, None) for i, c in zip(ids, codes, strict=True)
            ])
            by_group: dict[int, list[tuple[int, str]]] = {}
            for w, i in zip(known, rank.tolist(), strict=True):
                by_group.setdefault(zlib.crc32(w.encode()) % groups, []).append((i, w))
            rows = []
            for group, pairs in by_group.items():
                pairs.sort()
                for k in range(0, len(pairs), ROW):
                    some = pairs[k : k + ROW]
                    steps = np.diff([i for i, _ in some], prepend=0)
                    words = zlib.compress("\n".join([w for _, w in some]).encode(), 1)
                    rows.append((block, None, None, group, packed(steps), words))
            yield _batch(BLOCKS, rows)

    return picked(docs, doc_id="long", text="string").mapInArrow(run, BLOCKS)


ENCODED = "block long, at binary, sizes binary, ids binary"


def _encode_words(path: str):
    """Ids of the words of each row; rows come by group, and a group's words are encoded once."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, np.ndarray] = {}
        now, encode = None, word_pieces(path).encode
        for batch in batches:
            out = []
            columns = (batch.column(n).to_pylist() for n in ("block", "grp", "at", "words"))
            for block, group, at, data in zip(*columns, strict=True):
                if group != now:
                    known, now = {}, group
                words = zlib.decompress(data).decode().split("\n")
                new = [w for w in words if w not in known]
                ids, sizes = encode(new)
                known.update(zip(new, np.split(ids, np.cumsum(sizes)[:-1]), strict=True) if new else ())
                found = [known[w] for w in words]
                sizes = np.array([len(f) for f in found])
                out.append((block, at, packed(sizes), packed(np.concatenate(found))))
            yield _batch(ENCODED, out)

    return run


JOINED = "doc_id long, ids array<int>, decoded string"


def _join_back(path: str):
    """Ids and decoded texts of a block's documents, from the ids of its words."""

    def run(docs: pa.Table, words: pa.Table) -> pa.Table:
        pieces = word_pieces(path).pieces
        rows = zip(*(words.column(n).to_pylist() for n in ("at", "sizes", "ids")), strict=True)
        rows = [(np.cumsum(unpacked(a)), unpacked(s), unpacked(i)) for a, s, i in rows]
        none = [np.zeros(0, dtype=np.int64)]
        at, sizes, flat = (np.concatenate(none + [r[k] for r in rows]) for k in range(3))
        start = np.zeros(len(at), dtype=np.int64)
        size = np.zeros(len(at), dtype=np.int64)
        start[at], size[at] = np.cumsum(sizes) - sizes, sizes
        ids, decoded = [], []
        for data in docs.column("codes").to_pylist():
            codes = unpacked(data)
            n = size[codes]
            inside = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            found = flat[np.repeat(start[codes], n) + inside].astype(np.int32)
            ids.append(found)
            decoded.append(" ".join(map(pieces.__getitem__, found.tolist())))
        return pa.table({
            "doc_id": docs.column("doc_id"),
            "ids": pa.array(ids, pa.list_(pa.int32())),
            "decoded": pa.array(decoded, pa.string()),
        })

    return run


def encode_decode(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, ids and decoded (the pieces of the ids, joined as the vocabulary's library does).

    Encoding adds no special ids; special strings inside a text are their special id. A null
    text is empty: no ids, empty decoded text. Repeated rows return once each, a null doc_id
    stays null, other columns are not carried.

    The blocks are kept as a table in buckets, in the shared folder, so that only the words'
    ids are shuffled to them.
    """
    spark = docs.sparkSession
    splits = max(4, docs.rdd.getNumPartitions())
    groups = min(GROUPS, 4 * splits)
    buckets = min(BUCKETS, max(4 * splits, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    name = f"word_blocks_{uuid.uuid4().hex}"
    writer = blocks(docs, path, groups).write.bucketBy(buckets, "block")
    writer.option("path", new_path(spark, "blocks")).saveAsTable(name)
    cut = spark.table(name)
    words = cut.filter("grp is not null").select("block", "grp", "at", "words")
    encoded = words.repartition("grp").sortWithinPartitions("grp").mapInArrow(_encode_words(path), ENCODED)
    texts = cut.filter("codes is not null").select("block", "doc_id", "codes")
    return texts.groupBy("block").cogroup(encoded.groupBy("block")).applyInArrow(_join_back(path), JOINED)


@query()
def op9_bpe(spark, sf_dir):
    """Digests of all documents' ids and decoded texts."""
    found = encode_decode(table(spark, sf_dir, "documents"), tokenizer("word_bpe_49k.json"))
    return found.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
