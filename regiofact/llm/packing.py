"""Packing of documents into training sequences with lexically related neighbours.

Document frequencies and the mean length are those of all documents. Documents are shuffled by
their heaviest terms that others have too, so that related ones meet in a shard wherever they
come from; a frequent term's documents are parted by their second term, then by hash. A shard has
an inverted index of BM25 weights over token ids; the document that opens a sequence is the query
with all of its terms, and the shard's unused documents fill the window in the order of their
scores. Documents are cut where a window ends, and the rest opens the next one, so sequences are
full but for a shard's tail; the tail is cut into sequences of powers of two, which need no
padding.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regiofact.llm.base import picked, query, stored, table, texts_of, tokenizer
from regiofact.llm.word_pieces import CODE, MEMORY, parted, usual, word_pieces

#: Tokens of a shard.
SHARD = 4 << 20
#: BM25's saturation and length parameters.
K1, B = 1.2, 0.75
#: Cells of a shard's table of weights of its most frequent terms.
CELLS = 16 << 20


def width(path: str, end: int) -> str:
    """Two bytes for each id where the vocabulary has no more, else four."""
    return "<u2" if max(len(word_pieces(path).pieces) - 1, end) < 1 << 16 else "<u4"


class Ids:
    """Ids of texts, with a worker's memory of words."""

    def __init__(self, path: str):
        self.pieces = word_pieces(path)
        self.known: dict[bytes, bytes] = {}
        self.kind = width(path, 0)

    def of(self, texts: list[str], end: int, kind: str) -> list[bytes]:
        """The ids of texts, each with the id that ends every document."""
        if len(self.known) > MEMORY:
            self.known.clear()
        plain = [usual(t) for t in texts]
        quick = self.of_usual([t for t, p in zip(texts, plain, strict=True) if p])
        slow = self.of_others([t for t, p in zip(texts, plain, strict=True) if not p])
        joined = [next(quick if p else slow) for p in plain]
        last = np.array([end], kind).tobytes()
        if kind != self.kind:
            joined = [np.frombuffer(j, self.kind).astype(kind).tobytes() for j in joined]
        return [j + last for j in joined]

    def of_usual(self, texts: list[str]) -> Iterator[bytes]:
        """The same for usual texts: the batch's distinct words are looked up, and taken for each place."""
        if not texts:
            return
        words, ends = parted(texts)
        distinct = words.dictionary.to_numpy(zero_copy_only=False).tolist()
        found = list(map(self.known.get, distinct))
        new = [w for w, f in zip(distinct, found, strict=True) if f is None]
        if new:  # usual words have no such character
            self.learn(new, b"\x01\0".join(new).decode(CODE).split("\x01"))
            found = list(map(self.known.__getitem__, distinct))
        _, offsets, data = pa.array(found, pa.large_binary()).take(words.indices).buffers()
        stops = np.frombuffer(offsets, np.int64)[ends].tolist()
        data = memoryview(data) if data is not None else b""
        for start, stop in zip([0, *stops], stops, strict=False):
            yield bytes(data[start:stop])

    def of_others(self, texts: list[str]) -> Iterator[bytes]:
        """The same for texts that the library splits."""
        rows = [[(w.encode(CODE), w) for w in self.pieces.tokens(t)] for t in texts]
        new = {key: w for words in rows for key, w in words if key not in self.known}
        self.learn(list(new), list(new.values()))
        for words in rows:
            yield b"".join([self.known[key] for key, _ in words])

    def learn(self, keys: list[bytes], words: list[str]) -> None:
        """Remember words; all of them are encoded in one call."""
        if not keys:
            return
        ids, sizes = self.pieces.encode_many(words)
        kind = np.dtype(self.kind)
        data, start = ids.astype(kind).tobytes(), 0
        for key, stop in zip(keys, (kind.itemsize * np.cumsum(sizes)).tolist(), strict=True):
            self.known[key] = data[start:stop]
            start = stop


@lru_cache(maxsize=1)
def ids_of(path: str) -> Ids:
    """The worker's memory for a vocabulary file; it outlives a task."""
    return Ids(path)


class Corpus:
    """Inverse document frequencies by term, whether others have the term, and the mean length."""

    def __init__(self, held: np.ndarray, docs: int, tokens: int):
        self.idf = np.log(1 + (docs - held + 0.5) / (held + 0.5))
        self.shared = held > 1
        self.mean = tokens / max(docs, 1)
        self.docs, self.tokens = docs, tokens

    def weights(self, terms: np.ndarray, times: np.ndarray, size: np.ndarray) -> np.ndarray:
        """BM25 weights of terms that occur ``times`` in documents of ``size``."""
        norm = K1 * (1 - B + B * size / self.mean)
        return self.idf[terms] * times * (K1 + 1) / (times + norm)


def terms_of(docs: list[np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Documents, their distinct ids and how often each occurs there, both ascending, some documents at a time.

    Documents are sorted together, about 2^16 ids at once: the id behind the document's number.
    """
    kind, bits = docs[0].dtype, 8 * docs[0].dtype.itemsize
    wide = np.dtype(f"<u{2 * kind.itemsize}")
    sizes = np.fromiter(map(len, docs), np.int64, len(docs))
    blocks = np.cumsum(sizes + 1) - 1 >> 16
    for first, stop in pairwise([0, *(np.flatnonzero(np.diff(blocks)) + 1).tolist(), len(docs)]):
        keys = np.repeat(np.arange(stop - first, dtype=wide) << bits, sizes[first:stop])
        if not len(keys):
            continue
        keys |= np.concatenate(docs[first:stop])
        keys.sort()
        at = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        found = keys[at]
        yield first + (found >> bits).astype(np.int64), found.astype(kind), np.diff(at, append=len(keys))


def held_by(docs: list[np.ndarray]) -> np.ndarray:
    """The number of documents that have each id."""
    held = np.zeros(0, dtype=np.int64)
    for _, terms, _ in terms_of(docs):
        held = added(held, np.bincount(terms))
    return held


def added(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The sum of two lists, the shorter one continued with zeros."""
    if len(a) < len(b):
        a, b = b, a
    total = a.copy()
    total[: len(b)] += b
    return total


def corpus_of(docs: list[np.ndarray]) -> Corpus:
    """The figures of a list of documents."""
    return Corpus(held_by(docs), len(docs), sum(map(len, docs)))


class Index:
    """An inverted index of BM25 weights over the documents of a shard."""

    def __init__(self, docs: list[np.ndarray], corpus: Corpus):
        n = len(docs)
        sizes = np.array([len(d) for d in docs], dtype=np.float64)
        # terms of two bytes as a rule, which sort fastest
        owners, terms, times = map(np.concatenate, zip(*terms_of(docs), strict=True))
        weights = corpus.weights(terms, times.astype(np.float64), sizes[owners]).astype(np.float32)
        self.starts, self.terms = np.concatenate([[0], np.cumsum(np.bincount(owners, minlength=n))]), terms
        order = np.argsort(terms, kind="stable")
        self.posted, self.posted_weights = owners[order].astype(np.int32), weights[order]
        held = np.bincount(terms)
        self.first = np.concatenate([[0], np.cumsum(held)])
        # adding a row of all documents is faster than adding at a frequent term's documents
        often = np.nonzero(held > n / 16)[0]
        often = often[np.argsort(-held[often], kind="stable")][: CELLS // n]
        self.row_of = np.full(len(held), -1, dtype=np.int32)
        self.row_of[often] = np.arange(len(often))
        self.rows = np.zeros((len(often), n), dtype=np.float32)
        for row, t in enumerate(often):
            at = slice(self.first[t], self.first[t + 1])
            self.rows[row, self.posted[at]] = self.posted_weights[at]
        self.n = n

    def ranked(self, seed: int, unused: np.ndarray) -> np.ndarray:
        """Unused documents that share a term with the seed, best first, ties by number."""
        terms = self.terms[self.starts[seed] : self.starts[seed + 1]]
        rows = self.row_of[terms]
        scores = np.zeros(self.n, dtype=np.float32)
        for row in rows[rows >= 0].tolist():
            scores += self.rows[row]
        rare = terms[rows < 0].astype(np.int64)
        first, counts = self.first[rare], self.first[rare + 1] - self.first[rare]
        at = np.arange(counts.sum()) + np.repeat(first - np.cumsum(counts) + counts, counts)
        np.add.at(scores, self.posted[at], self.posted_weights[at])
        found = np.flatnonzero((scores > 0) & unused)
        # bits of positive numbers ascend as they do: one sort by score, then number
        keys = (~scores[found].view("<u4")).astype("<u8") << 32 | found.astype("<u8")
        keys.sort()
        return (keys & 0xFFFFFFFF).astype(np.int64)


def pack(docs: list[np.ndarray], window: int, corpus: Corpus | None = None) -> list[tuple[int, int, int, int, int]]:
    """(document, start, length, sequence, offset) of every piece of a shard.

    Without a corpus the shard is all there is.
    """
    index = Index(docs, corpus or corpus_of(docs))
    unused = np.ones(len(docs), dtype=bool)
    pieces: list[tuple[int, int, int, int, int]] = []
    total = sum(map(len, docs))
    full = total // window * window
    ends = [*range(window, full + 1, window)]
    left, at = total - full, full
    for power in reversed(range(window.bit_length())):  # the tail as powers of two
        if left >> power & 1:
            at += 1 << power
            ends.append(at)
    place = sequence = 0
    start_of = 0  # the place where the open sequence starts
    seed, ranking, rank, cursor = None, np.array([], dtype=np.int64), 0, 0
    for _ in range(len(docs)):
        while rank < len(ranking) and not unused[ranking[rank]]:
            rank += 1
        if rank < len(ranking):
            doc = int(ranking[rank])
        else:
            while not unused[cursor]:
                cursor += 1
            doc = cursor
            seed = None
        unused[doc] = False
        start = 0
        while start < len(docs[doc]):
            if place == ends[sequence]:
                start_of, sequence, seed = place, sequence + 1, None
            length = min(len(docs[doc]) - start, ends[sequence] - place)
            pieces.append((doc, start, length, sequence, place - start_of))
            place += length
            start += length
        if seed is None:  # the document that opened this sequence is the query for it
            seed = doc
            ranking, rank = index.ranked(seed, unused), 0
    return pieces


PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
)


#: A row is a document or, without ids, the number of documents of the task's that have a term.
ENCODED = "doc_id long, ids binary, term long, held long"
#: In place of a term: the task's documents and their tokens.
DOCS, TOKENS = -1, -2


def _encoded(path: str, end: int, kind: str):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = ids_of(path)
        held, docs, tokens = np.zeros(0, dtype=np.int64), 0, 0
        names = [f.split()[0] for f in ENCODED.split(", ")]
        for ids, texts in texts_of(batches, 4 << 20):
            data = known.of(texts, end, kind)
            rows = [np.frombuffer(d, kind) for d in data]
            held, docs, tokens = added(held, held_by(rows)), docs + len(rows), tokens + sum(map(len, rows))
            none = pa.nulls(len(ids), pa.int64())
            yield pa.record_batch([pa.array(ids, pa.int64()), pa.array(data, pa.binary()), none, none], names)
        terms = np.flatnonzero(held)
        counts = [np.concatenate([[DOCS, TOKENS], terms]), np.concatenate([[docs, tokens], held[terms]])]
        none = [pa.nulls(len(terms) + 2, k) for k in (pa.int64(), pa.binary())]
        yield pa.record_batch([*none, *(pa.array(c.astype(np.int64)) for c in counts)], names)
        pa.default_memory_pool().release_unused()  # the worker goes on to other tasks

    return run


def _corpus(encoded: DataFrame) -> Corpus:
    """The figures of all documents; what reaches the driver is bounded by the vocabulary."""
    counts = encoded.filter("term is not null").groupBy("term").agg(F.sum("held").alias("held"))
    found = {r["term"]: r["held"] for r in counts.collect()}
    docs, tokens = found.pop(DOCS, 0), found.pop(TOKENS, 0)
    held = np.zeros(max(found, default=-1) + 1, dtype=np.int64)
    held[list(found)] = list(found.values())
    return Corpus(held, docs, tokens)


def heaviest(docs: list[np.ndarray], corpus: Corpus) -> np.ndarray:
    """The two heaviest terms of each document that others have too, ties to the smaller; -1 for none."""
    tops = np.full((2, len(docs)), -1, dtype=np.int64)
    sizes = np.fromiter(map(len, docs), np.float64, len(docs))
    for owners, terms, times in terms_of(docs):
        some = corpus.shared[terms]
        owners, terms, times = owners[some], terms[some], times[some]
        weights = corpus.weights(terms, times, sizes[owners])
        for top in tops:
            if not len(owners):
                break
            starts = np.flatnonzero(np.diff(owners, prepend=-1))
            most = np.repeat(np.maximum.reduceat(weights, starts), np.diff(starts, append=len(owners)))
            best = np.flatnonzero(weights == most)
            best = best[np.diff(owners[best], prepend=-1) > 0]
            top[owners[best]] = terms[best]
            owners, terms, weights = (np.delete(a, best) for a in (owners, terms, weights))
    return tops


def _placed(shared, kind: str):
    """Documents with their two heaviest terms among those that other documents have."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs = [np.frombuffer(d.as_buffer(), kind) for d in batch.column("ids")]
            tops = heaviest(docs, shared.value) if docs else np.zeros((2, 0), dtype=np.int64)
            yield pa.record_batch(
                [batch.column("doc_id"), batch.column("ids"), *map(pa.array, tops)], ["doc_id", "ids", "top", "second"]
            )

    return run


def _shards(window: int, shared, most: int, kind: str):
    names = [f.split()[0] for f in PIECES.split(", ")]

    def groups(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[list, list[np.ndarray]]]:
        ids, docs, size = [], [], 0
        for batch in batches:
            for i, d in zip(batch.column("doc_id").to_pylist(), batch.column("ids"), strict=True):
                ids.append(i)
                docs.append(np.frombuffer(d.as_py(), kind))
                size += len(docs[-1])
                if size >= most:
                    yield ids, docs
                    ids, docs, size = [], [], 0
        if ids:
            yield ids, docs

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sequences = TaskContext.get().partitionId() << 36
        for ids, docs in groups(batches):
            rows = [
                (
                    ids[d], start, length, zlib.crc32(docs[d][start : start + length].astype("<u4")), len(docs[d]),
                    sequences + sequence, offset,
                )
                for d, start, length, sequence, offset in pack(docs, window, shared.value)
            ]
            sequences = rows[-1][5] + 1
            columns = [pa.array(c, pa.int64()) for c in zip(*rows, strict=True)]
            yield pa.record_batch(columns, names)

    return run


def packed(docs: DataFrame, path: str, window: int = 4096, end: int = 2, shard: int = SHARD) -> DataFrame:
    """Pieces of all documents, packed into sequences of at most ``window`` ids.

    Every id of a document, with ``end`` after its last, lies in exactly one piece. A null text
    is empty, so it is the one id ``end``. Repeated rows are packed each; a null doc_id stays
    null. Numbers of sequences are unique over all shards, of about ``shard`` ids each.
    """
    kind = width(path, end)
    texts = picked(docs, doc_id="long", text="string")
    encoded = stored(texts.mapInArrow(_encoded(path, end, kind), ENCODED), "ids")
    corpus = _corpus(encoded)
    shared = docs.sparkSession.sparkContext.broadcast(corpus)
    terms = encoded.filter("ids is not null").select("doc_id", "ids")
    terms = terms.mapInArrow(_placed(shared, kind), "doc_id long, ids binary, top long, second long")
    terms = stored(terms, "placed")  # the bounds of ranges are sampled from them before they are dealt
    order = ("top", "second", F.xxhash64("ids"), "doc_id")
    dealt = terms.repartitionByRange(-(-corpus.tokens // shard) or 1, *order).sortWithinPartitions(*order)
    return dealt.select("doc_id", "ids").mapInArrow(_shards(window, shared, shard * 3 // 2, kind), PIECES)


@query()
def op3_packing(spark, sf_dir):
    """All documents in sequences of at most 4096 tokens."""
    return packed(table(spark, sf_dir, "documents"), tokenizer("word_bpe_49k.json"))
