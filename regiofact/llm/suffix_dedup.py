"""Exact removal of long repeated byte strings, after the idea of prefix-free parsing.

A rolling hash sets triggers: the trigger of a window is the smallest rolling hash in it, so it
depends on nothing outside the window, and every window has one, also in text of one letter. A
phrase is a run of windows with the same trigger. The distinct phrases, with the bytes around
their trigger, are the dictionary; the documents' sequences of phrases are the parse. Equal
suffixes, to the depth of one window, can only meet under equal triggers, so:

1. phrases are grouped by trigger, and those under a trigger that occurs once are done;
2. a phrase whose whole context occurs again is done too: all of its windows repeat;
3. what is left lies at the ends of matches. The distinct contexts are cut into pieces of a few
   windows at fixed distances from the trigger and grouped again, the undecided pieces once more
   window by window.

Copies of a passage thus cost one comparison of their common phrases and a few windows at their
two ends, and no group is ever gathered: each step counts distinct contexts and joins back.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regiofact.llm.base import picked, query, stored, table

#: Bytes of a window (the string that may not repeat), of the rolling hash, windows of a piece.
WINDOW, ROLL, PIECE = 200, 32, 12
#: Bytes that are hashed at a time; longer documents are cut into overlapping stretches.
STRETCH = 1 << 20

_LETTERS = np.random.default_rng(20).integers(1, 1 << 64, 256, dtype=np.uint64)
_BASE = 0x9E3779B97F4A7C15
_PLACES = np.uint64((1 << 24) - 1)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xA0761D6478BD642F)
    return h ^ (h >> np.uint64(32))


class Hashed:
    """Hashes of the substrings of a buffer, from sums of its letters times powers of a base."""

    powers = inverses = np.ones(1, dtype=np.uint64)

    def __init__(self, data: bytes | np.ndarray):
        x = np.frombuffer(data, np.uint8) if isinstance(data, bytes) else data
        n = len(x)
        if len(Hashed.powers) < n + 1:
            Hashed.powers = _geometric(_BASE, max(n + 1, 1 << 16))
            Hashed.inverses = _geometric(pow(_BASE, -1, 1 << 64), max(n + 1, 1 << 16))
        self.sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(_LETTERS[x] * Hashed.powers[:n], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return _mixed((self.sums[end] - self.sums[start]) * Hashed.inverses[start])

    def rolling(self, size: int) -> np.ndarray:
        n = len(self.sums) - size
        return _mixed((self.sums[size:] - self.sums[:n]) * Hashed.inverses[:n])


def _geometric(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[0] = 1
    return np.cumprod(out)


def _with_extent(h: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """A context's hash together with how far it reaches to both sides of the trigger."""
    return _mixed(h + left.astype(np.uint64) * np.uint64(0x9FB21C651E98DF25) + right.astype(np.uint64))


def phrases(data: bytes, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, ...]:
    """(document, trigger hash, context hash, trigger, first and last window) of all phrases.

    ``data`` holds documents at [start, end); windows do not cross them.
    """
    none = tuple(np.zeros(0, t) for t in (np.int64, np.uint64, np.uint64, np.int64, np.int64, np.int64))
    n = len(data)
    if n < WINDOW:
        return none
    hashed = Hashed(data)
    rolled = hashed.rolling(ROLL)
    least = (rolled & ~_PLACES) | np.arange(len(rolled), dtype=np.uint64)
    width, size = WINDOW - ROLL + 1, 1
    while 2 * size <= width:  # minima of ever longer stretches
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    count = n - WINDOW + 1
    least = np.minimum(least[:count], least[width - size : width - size + count])
    trigger = (least & _PLACES).astype(np.int64)
    inside = np.zeros(count + 1, dtype=np.int8)
    long = ends - starts >= WINDOW
    np.add.at(inside, starts[long], 1)
    np.add.at(inside, ends[long] - WINDOW + 1, -1)
    inside = np.cumsum(inside[:count], dtype=np.int8).astype(bool)
    new = np.ones(count, dtype=bool)
    new[1:] = (trigger[1:] != trigger[:-1]) | ~inside[:-1]
    first = np.nonzero(new & inside)[0]
    last_of = np.ones(count, dtype=bool)
    last_of[:-1] = (trigger[1:] != trigger[:-1]) | ~inside[1:]
    last = np.nonzero(last_of & inside)[0]
    at = trigger[first]
    context = _with_extent(hashed.of(first, last + WINDOW), at - first, last - at + WINDOW)
    doc = np.searchsorted(starts, first, side="right") - 1
    return doc, rolled[at], context, at, first, last


def _stretches(texts: list[bytes], stretch: int | None = None) -> Iterator[tuple[bytes, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(data, starts, ends, documents, offsets): buffers of whole documents or of parts of long ones."""
    stretch = stretch or STRETCH
    data, starts, docs, offsets, size = [], [], [], [], 0

    def out():
        begin = np.array(starts, dtype=np.int64)
        sizes = np.array([len(d) for d in data], dtype=np.int64)
        return b"".join(data), begin, begin + sizes, np.array(docs), np.array(offsets, dtype=np.int64)

    for number, text in enumerate(texts):
        for offset in range(0, max(1, len(text) - WINDOW + 1), stretch):
            part = text[offset : offset + stretch + WINDOW - 1]
            if size and size + len(part) > stretch + WINDOW:
                yield out()
                data, starts, docs, offsets, size = [], [], [], [], 0
            starts.append(size)
            data.append(part)
            docs.append(number)
            offsets.append(offset)
            size += len(part)
    if data:
        yield out()


RUNS = "inner long, outer long, k1 long, k2 int, at int, near int, far int"


def _runs(stretch: int):
    """A row per phrase; its windows start ``near`` to ``far`` bytes before the trigger ``at``.

    The phrase at the end of a stretch and the one at the start of the next can have one trigger;
    only ``near`` and ``far`` tell them apart.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            k1, k2 = batch.column("k1").to_numpy(), batch.column("k2").to_numpy()
            texts = [t.as_buffer().to_pybytes() if t.is_valid else b"" for t in batch.column("data")]
            for data, starts, ends, docs, offsets in _stretches(texts, stretch):
                doc, inner, outer, at, first, last = phrases(data, starts, ends)
                moved = offsets[doc] - starts[doc]
                yield pa.record_batch(
                    [
                        pa.array(inner.view(np.int64)), pa.array(outer.view(np.int64)),
                        pa.array(k1[docs[doc]]), pa.array(k2[docs[doc]]),
                        pa.array((at + moved).astype(np.int32)),
                        pa.array((at - last).astype(np.int32)), pa.array((at - first).astype(np.int32)),
                    ],
                    [f.split()[0] for f in RUNS.split(", ")],
                )

    return run


def _settled(rows: DataFrame, *more: str) -> tuple[DataFrame, DataFrame]:
    """(contexts that occur again, contexts to look into) of rows with inner, outer, n and mine.

    Rows with equal (inner, outer) have equal windows; rows with different inner have none in
    common. ``n`` is how often a row's context occurs, ``mine`` whether the answer is wanted for
    it. To look into are single contexts that share their inner with others, and one of each
    of these others. ``more`` are further columns of the rows to look into.
    """
    row = F.min(F.struct("k1", "k2", "at", "near", "far", *more)).alias("row")
    contexts = rows.groupBy("inner", "outer").agg(F.sum("n").alias("n"), F.max("mine").alias("mine"), row)
    contexts = stored(contexts, "contexts")
    classes = contexts.groupBy("inner").agg(
        F.count("*").alias("kinds"), F.max(F.col("mine") & (F.col("n") == 1)).alias("wanted")
    )
    classes = classes.filter("kinds > 1 and wanted").select("inner")
    again = contexts.filter("n > 1 and mine").select("inner", "outer")
    into = contexts.join(classes, "inner").select(
        "inner", "outer", "row.*", "n", (F.col("mine") & (F.col("n") == 1)).alias("mine")
    )
    return again, into


def _keyed(docs: DataFrame) -> DataFrame:
    kept = picked(docs, doc_id="long", text="string")
    return kept.select(
        F.xxhash64("doc_id", "text").alias("k1"), F.hash("text", "doc_id").alias("k2"), "doc_id", "text"
    )


CUTS = (
    "inner long, k1 long, k2 int, at int, near int, far int, n long, mine boolean, from int, to int, data binary"
)


def _contexts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes around the triggers that are to be looked into."""
    names = [f.split()[0] for f in CUTS.split(", ")]
    for batch in batches:
        rows: list[tuple] = []
        columns = (batch.column(n) for n in ("k1", "k2", "data", "into"))
        for k1, k2, data, into in zip(*columns, strict=True):
            text = data.as_buffer()
            for r in into.as_py():
                at = r["at"]
                part = text[at - r["far"] : at - r["near"] + WINDOW].to_pybytes()
                rows.append((
                    r["inner"], k1.as_py(), k2.as_py(), at, r["near"], r["far"], r["n"], r["mine"],
                    r["near"], r["far"], part,
                ))
        small, large = pa.int32(), pa.int64()
        kinds = [large, large, small, small, small, small, large, pa.bool_(), small, small, pa.binary()]
        columns = zip(*rows, strict=True) if rows else [[]] * len(names)
        yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names)


PIECES = (
    "inner long, outer long, k1 long, k2 int, at int, near int, far int, n long, mine boolean, from int, to int"
)


def _pieces(size: int):
    """Cut contexts into pieces of ``size`` windows at fixed distances from the trigger.

    ``from`` and ``to`` are the phrase's own ``near`` and ``far``, so a piece knows its context.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for k in range(0, whole.num_rows, 1 << 12):
                batch = whole.slice(k, 1 << 12)
                near, far = (batch.column(n).to_numpy().astype(np.int64) for n in ("near", "far"))
                parts = [d.as_py() for d in batch.column("data")]
                begin = np.concatenate([[0], np.cumsum([len(p) for p in parts])[:-1]]).astype(np.int64)
                hashed = Hashed(b"".join(parts))
                low, high = near // size, far // size
                owner = np.repeat(np.arange(len(parts)), high - low + 1)
                step = np.arange(len(owner)) - np.repeat(np.cumsum(high - low + 1) - (high - low + 1), high - low + 1)
                j = (low[owner] + step) * size
                reach = batch.column("to").to_numpy().astype(np.int64)
                at = begin[owner] + reach[owner]  # the trigger's place in the buffer
                # what all windows of the piece hold, and what they hold together here
                inner = hashed.of(at - j, at - j - size + 1 + WINDOW)
                inner = _with_extent(inner, j, j * 0 + size)
                first, last = np.maximum(j, near[owner]), np.minimum(j + size - 1, far[owner])
                outer = hashed.of(at - last, at - first + WINDOW)
                outer = _with_extent(outer, last, WINDOW - first)
                trigger = batch.column("inner").to_numpy()[owner].view(np.uint64)
                arrays = [
                    pa.array(_mixed(inner ^ trigger).view(np.int64)), pa.array(outer.view(np.int64)),
                    *(batch.column(n).take(pa.array(owner)) for n in ("k1", "k2", "at")),
                    pa.array(first.astype(np.int32)), pa.array(last.astype(np.int32)),
                    *(batch.column(n).take(pa.array(owner)) for n in ("n", "mine", "from", "to")),
                ]
                yield pa.record_batch(arrays, [f.split()[0] for f in PIECES.split(", ")])

    return run


def repeats(docs: DataFrame, stretch: int | None = None) -> DataFrame:
    """k1, k2 (a document's key) and lo, hi: first and last starts of runs of repeated windows."""
    data = F.col("text").cast("binary").alias("data")
    texts = _keyed(docs).select("k1", "k2", data)
    runs = stored(texts.mapInArrow(_runs(stretch or STRETCH), RUNS), "phrases")
    # phrases under a trigger that occurs once are most of the input: they go first
    common = runs.groupBy("inner").count().filter("count > 1").select("inner")
    runs = stored(runs.join(common, "inner"), "phrases")
    place = ("k1", "k2", (F.col("at") - F.col("far")).alias("lo"), (F.col("at") - F.col("near")).alias("hi"))
    again, into = _settled(runs.withColumns({"n": F.lit(1).cast("long"), "mine": F.lit(True)}))
    whole = runs.join(again, ["inner", "outer"]).select(*place)

    # what is looked into, with its bytes; rows of equal documents only come from settled contexts
    asked = into.groupBy("k1", "k2").agg(
        F.collect_set(F.struct("inner", "at", "near", "far", "n", "mine")).alias("into")
    )
    cuts = texts.join(asked.hint("shuffle_hash"), ["k1", "k2"]).mapInArrow(_contexts, CUTS)
    cuts = stored(cuts, "contexts")
    pieces = stored(cuts.mapInArrow(_pieces(PIECE), PIECES), "pieces")
    again, into = _settled(pieces, "from", "to")
    parts = pieces.filter("mine").join(again, ["inner", "outer"]).select(*place)

    context = ["k1", "k2", "at", "from", "to"]
    narrow = cuts.select("inner", *context, "data").join(into.select(*context, "near", "far", "n", "mine"), context)
    windows = stored(narrow.mapInArrow(_pieces(1), PIECES), "windows")
    again = windows.groupBy("inner", "outer").agg(F.sum("n").alias("n"), F.max("mine").alias("mine"))
    again = again.filter("n > 1 and mine").select("inner", "outer")
    single = windows.filter("mine").join(again, ["inner", "outer"]).select(*place)
    return whole.unionAll(parts).unionAll(single)


def _merged(ranges: list[dict]) -> list[tuple[int, int]]:
    """Removed bytes as maximal [start, end) runs."""
    out: list[tuple[int, int]] = []
    for lo, hi in sorted((r["lo"], r["hi"] + WINDOW) for r in ranges):
        if out and lo <= out[-1][1]:
            out[-1] = out[-1][0], max(hi, out[-1][1])
        else:
            out.append((lo, hi))
    return out


def _cut(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    """The bytes outside of the spans."""
    ends = [0, *(x for s in spans for x in s), len(text)]
    return b"".join(text[a:b] for a, b in zip(ends[::2], ends[1::2], strict=True))


def _ranges(docs: DataFrame, stretch: int | None = None) -> DataFrame:
    """k1, k2 and ranges: the runs of repeated windows of each document that has any."""
    return repeats(docs, stretch).groupBy("k1", "k2").agg(F.collect_set(F.struct("lo", "hi")).alias("ranges"))


KEPT = "doc_id long, n_bytes long, n_removed long, n_spans long, spans array<bigint>, kept binary"


def _kept(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [f.split()[0] for f in KEPT.split(", ")]
    kinds = [pa.int64()] * 4 + [pa.list_(pa.int64()), pa.binary()]
    for batch in batches:
        rows = []
        for doc_id, data, ranges in zip(*batch.columns, strict=True):
            text = data.as_buffer().to_pybytes() if data.is_valid else b""
            spans = _merged(ranges.as_py() or [])
            kept, ends = _cut(text, spans), [x for s in spans for x in s]
            rows.append((doc_id.as_py(), len(text), len(text) - len(kept), len(spans), ends, kept))
        columns = zip(*rows, strict=True) if rows else [[]] * len(names)
        yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names)


def without_repeats(docs: DataFrame, stretch: int | None = None) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, spans (starts and ends in turn) and kept bytes.

    Every byte covered by a string of 200 bytes that also starts elsewhere, in any document, is
    removed. A null text is empty, and nothing of it is removed. Repeated rows are documents of
    their own, so both lose all such bytes. A null doc_id stays null; other columns are not
    carried. Kept bytes may end inside a character. ``stretch`` is the number of bytes that are
    hashed at a time, STRETCH if not given; the result does not depend on it.
    """
    ranges = stored(_ranges(docs, stretch), "ranges")
    data = F.col("text").cast("binary").alias("data")
    joined = _keyed(docs).select("k1", "k2", "doc_id", data).join(
        ranges.hint("shuffle_hash"), ["k1", "k2"], "left"
    )
    return joined.select("doc_id", "data", "ranges").mapInArrow(_kept, KEPT)


def shortened(docs: DataFrame) -> DataFrame:
    """Documents without their repeated passages, with the columns of documents.

    Where a passage ends inside a character, the rest of the character goes too. Null texts
    stay null; n_chars follows the text.
    """
    ranges = stored(_ranges(docs), "ranges")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for data, found in zip(batch.column("text"), batch.column("ranges"), strict=True):
                if data.is_valid and found.is_valid:
                    texts.append(_cut(data.as_buffer().to_pybytes(), _merged(found.as_py())).decode("utf-8", "ignore"))
                else:
                    texts.append(data.as_py())
            arrays = [pa.array(texts, pa.string()) if n == "text" else batch.column(n) for n in names]
            yield pa.record_batch(arrays, names)

    kept = picked(docs, doc_id="long", text="string", lang="string", source="string")
    names = kept.columns
    keys = F.xxhash64("doc_id", "text").alias("k1"), F.hash("text", "doc_id").alias("k2")
    joined = kept.select("*", *keys).join(ranges.hint("shuffle_hash"), ["k1", "k2"], "left")
    out = joined.select(*names, "ranges").mapInArrow(run, kept.schema)
    return out.withColumn("n_chars", F.length("text").cast("long"))


@query()
def op1_suffix_dedup(spark, sf_dir):
    """Repeated passages of at least 200 bytes in all documents."""
    found = without_repeats(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )
