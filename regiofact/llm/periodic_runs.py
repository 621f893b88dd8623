"""Maximal periodic runs of words, by the branching-tandem test on an enhanced suffix array.

A square ``ww`` whose next word breaks the period is a branching tandem: the suffixes at its two
halves agree on exactly ``|w|`` words. Such a pair parts at one boundary of the suffix array, in
the interval whose least common prefix is ``|w|``; so for every boundary the suffixes of its
smaller side look up, in the inverse suffix array, whether the suffix one depth before or after
them lies on the other side. Each suffix is on a smaller side at most log n times. All other
squares are rotations to the left of branching ones: a run ends where its branching square ends,
and starts where rotating it to the left stops.

Suffixes of one text only are compared, so many texts share an array and the work is numpy's.
Texts are not shuffled. Memory grows with the words of a group of texts (or of one longer text)
times the logarithm of the longest repetition in it.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regiofact.llm.base import picked, query, table

#: Bytes of the texts that share an array.
GROUP = 4 << 20
#: Pairs of a boundary and a suffix that are looked up at a time.
STEP = 1 << 19
RUNS = "array<struct<start:long,length:long,period:long>>"


class SuffixArray:
    """Suffix array of several texts, with ranks by the first 1, 2, 4, ... words of a suffix.

    ``codes`` are the words as numbers, ``ends`` the place where the text of each word ends.
    """

    def __init__(self, codes: np.ndarray, text: np.ndarray, ends: np.ndarray):
        n = len(codes)
        key = text.astype(np.int64) * (int(codes.max(initial=0)) + 1) + codes
        self.array = np.argsort(key, kind="stable")
        key = key[self.array]
        heads = np.flatnonzero(np.append(True, key[1:] != key[:-1])[:n])
        sizes = np.diff(np.append(heads, n))
        rank = np.empty(n, dtype=np.int32)
        rank[self.array] = np.repeat(heads, sizes)
        self.levels = [rank]
        places = np.flatnonzero(np.repeat(sizes > 1, sizes))
        step = 1
        while len(places):
            at = self.array[places]
            later = np.where(at + step < ends[at], rank[np.minimum(at + step, n - 1)].astype(np.int64) + 1, 0)
            key = rank[at].astype(np.int64) * (n + 1) + later
            order = np.argsort(key, kind="stable")
            key, at = key[order], at[order]
            self.array[places] = at
            heads = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
            sizes = np.diff(np.append(heads, len(places)))
            rank = rank.copy()
            rank[at] = np.repeat(places[heads], sizes)
            self.levels.append(rank)
            places = places[np.repeat(sizes > 1, sizes)]
            step *= 2
        self.rank = rank

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many words the suffixes at different places of one text have in common."""
        a, b, n = a.copy(), b.copy(), len(self.rank)
        out = np.zeros(len(a), dtype=np.int64)
        for j in reversed(range(len(self.levels))):
            level = self.levels[j]
            inside = np.maximum(a, b) < n
            same = inside & (level[np.minimum(a, n - 1)] == level[np.minimum(b, n - 1)])
            more = same.astype(np.int64) << j
            a, b, out = a + more, b + more, out + more
        return out

    def common_before(self, a: np.ndarray, b: np.ndarray, first: np.ndarray) -> np.ndarray:
        """How many words before a and before b agree, none before ``first``; a is smaller."""
        a, b = a.copy(), b.copy()
        out = np.zeros(len(a), dtype=np.int64)
        for j in reversed(range(len(self.levels))):
            level, step = self.levels[j], 1 << j
            inside = a - step >= first
            same = inside & (level[np.maximum(a - step, 0)] == level[np.maximum(b - step, 0)])
            more = same.astype(np.int64) << j
            a, b, out = a - more, b - more, out + more
        return out

    def prefixes(self) -> np.ndarray:
        """At each place the words in common with the suffix at the place before it."""
        out = np.zeros(len(self.array), dtype=np.int64)
        first = self.levels[0][self.array]
        near = np.flatnonzero(first[1:] == first[:-1]) + 1  # others part at the first word
        out[near] = self.common(self.array[near - 1], self.array[near])
        return out


def _reach(minima: list[np.ndarray], at: np.ndarray, value: np.ndarray, strict: bool) -> np.ndarray:
    """The first place from ``at`` on whose value is less than ``value`` (or, not strict, equal).

    ``minima`` grows by need: its j-th entry has the least of 2^j values from each place on. The
    last of all values is less than any other.
    """

    def higher(j: int, some: np.ndarray, value: np.ndarray) -> np.ndarray:
        while len(minima) <= j:
            last, half = minima[-1], 1 << len(minima) - 1
            minima.append(np.minimum(last, np.append(last[half:], np.full(min(half, len(last)), last[-1]))[: len(last)]))
        found = minima[j][some]
        return found >= value if strict else found > value

    at = at.copy()
    open_, j, tops = np.arange(len(at)), 0, []
    while len(open_):  # ever larger strides, as long as they hold no end
        on = higher(j, at[open_], value[open_])
        tops.append(open_[~on])
        open_ = open_[on]
        at[open_] += 1 << j
        j += 1
    falling = np.zeros(0, dtype=np.int64)
    while j:  # then ever smaller ones
        falling = np.concatenate([falling, tops[j - 1]])
        j -= 1
        on = higher(j, at[falling], value[falling])
        at[falling[on]] += 1 << j
    return at


def _sides(prefix: np.ndarray, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last-but-one place of the interval that each boundary of ``nodes`` splits.

    Of boundaries with one value the leftmost splits the whole interval, the next the rest.
    """
    ahead = np.append(prefix, -1)
    right = _reach([ahead], nodes + 1, prefix[nodes], True)
    back = ahead[::-1].copy()
    back[0], n = 0, len(prefix)
    back = np.append(back, -1)  # place p stands at n - p
    left = n - _reach([back], n - (nodes - 1), prefix[nodes], False)
    return left, right


def _ragged(sizes: np.ndarray) -> np.ndarray:
    return np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)


def runs_of(
    codes: np.ndarray, offsets: np.ndarray, least: int = 6, exponent: int = 4
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, period) of all runs of texts, by start and period; places count over all texts.

    ``offsets`` are the places where texts start, and the end of the last. A run has ``least``
    words and ``exponent`` periods (two at least) or more, and its smallest period is stated.
    """
    n = len(codes)
    none = np.zeros(0, dtype=np.int64)
    if not n:
        return none, none, none
    sizes = np.diff(offsets)
    text = np.repeat(np.arange(len(sizes)), sizes)
    first, ends = np.repeat(offsets[:-1], sizes), np.repeat(offsets[1:], sizes)
    suffixes = SuffixArray(codes, text, ends)
    prefix = suffixes.prefixes()
    # no run of this period fits into a text that is shorter
    long_enough = prefix * exponent <= (ends - first)[suffixes.array]
    nodes = np.flatnonzero((prefix > 0) & long_enough)
    left, right = _sides(prefix, nodes)
    smaller_left = nodes - left <= right - nodes
    low, high = np.where(smaller_left, left, nodes), np.where(smaller_left, nodes, right)
    other_low, other_high = np.where(smaller_left, nodes, left), np.where(smaller_left, right, nodes)
    squares = []
    cuts = np.searchsorted(np.cumsum(high - low), np.arange(STEP, (high - low).sum() + STEP, STEP))
    for some in np.split(np.arange(len(nodes)), np.unique(cuts)):
        if not len(some):
            continue
        width = high[some] - low[some]
        owner = np.repeat(some, width)
        at = suffixes.array[low[owner] + _ragged(width)]
        depth = prefix[nodes[owner]]
        for sign in (1, -1):
            partner = at + sign * depth
            inside = (partner >= first[at]) & (partner < ends[at])
            place = suffixes.rank[np.where(inside, partner, 0)]
            hit = inside & (place >= other_low[owner]) & (place < other_high[owner])
            squares.append((np.minimum(at, partner)[hit], depth[hit]))
    start, period = (np.concatenate([none, *(s[k] for s in squares)]) for k in range(2))
    end = start + 2 * period
    start = start - suffixes.common_before(start, start + period, first[start])  # rotate to the left
    order = np.lexsort((period, end, start))
    start, end, period = start[order], end[order], period[order]
    # of one stretch the smallest period, which divides the others
    again = np.append(False, (start[1:] == start[:-1]) & (end[1:] == end[:-1]))[: len(start)]
    keep = ~again & (end - start >= np.maximum(least, exponent * period))
    start, end, period = start[keep], end[keep], period[keep]
    order = np.lexsort((period, start))
    return start[order], end[order], period[order]


def by_size(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The batch in slices of about GROUP bytes of text."""
    done = np.cumsum(pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False)) // GROUP
    cuts = [0, *(np.flatnonzero(np.diff(done)) + 1).tolist(), batch.num_rows]
    for a, b in zip(cuts, cuts[1:], strict=False):
        if b > a:
            yield batch.slice(a, b - a)


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words of texts in a row, and where the words of each text start; null is empty."""
    split = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    flat = split.flatten()
    filled = pc.not_equal(flat, "").to_numpy(zero_copy_only=False)
    offsets = split.offsets.to_numpy().astype(np.int64)
    return flat.filter(pa.array(filled)), np.append(0, np.cumsum(filled))[offsets - offsets[0]]


def _found(least: int, exponent: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in by_size(whole):
                words, offsets = words_of(batch.column("text"))
                coded = words.dictionary_encode()
                codes = coded.indices.to_numpy().astype(np.int64)
                start, end, period = runs_of(codes, offsets, least, exponent)
                text = np.searchsorted(offsets, start, side="right") - 1
                # what follows a run's first period is dropped
                drop = np.zeros(len(codes) + 1, dtype=np.int64)
                np.add.at(drop, start + period, 1)
                np.add.at(drop, end, -1)
                kept = np.cumsum(drop[:-1]) == 0
                left = np.append(0, np.cumsum(kept))[offsets].astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(left), words.filter(pa.array(kept)))
                per_text = np.append(0, np.cumsum(np.bincount(text, minlength=batch.num_rows))).astype(np.int32)
                fields = [start - offsets[text], end - start, period]
                rows = pa.StructArray.from_arrays([pa.array(f) for f in fields], ["start", "length", "period"])
                yield pa.record_batch(
                    [
                        batch.column("doc_id"), pa.array(np.diff(offsets)),
                        pa.ListArray.from_arrays(pa.array(per_text), rows), pc.binary_join(lists, " "),
                    ],
                    ["doc_id", "n_words", "runs", "collapsed"],
                )

    return run


def runs(docs: DataFrame, least: int = 6, exponent: int = 4) -> DataFrame:
    """doc_id, n_words, runs (start, length, period; by start, then period) and collapsed of each row.

    Words are what lies between ASCII white space, compared byte by byte and numbered from 0. A run
    is a longest stretch of a smallest period with ``least`` words and ``exponent`` periods or
    more; texts are not compared with each other. ``collapsed`` has the words outside of what
    follows the first period of a run, joined by one space.

    A null or empty text has no words, no runs and an empty ``collapsed``. Runs may overlap; of
    equal stretches only the smallest period counts. Repeated rows return once each, a null
    doc_id stays null, other columns are not carried, an empty table gives an empty result.
    """
    schema = f"doc_id long, n_words long, runs {RUNS}, collapsed string"
    return picked(docs, doc_id="long", text="string").mapInArrow(_found(least, exponent), schema)


def strongest(found: str = "runs") -> Column:
    """The run of the greatest exact length / period; ties: smallest start, then period. Or null."""
    # of r and s the one whose ratio is greater, compared as products; runs come by start and period
    def better(r: Column, s: Column) -> Column:
        ahead = s["length"] * r["period"] > r["length"] * s["period"]
        return F.when(r.isNull() | ahead, s).otherwise(r)

    kind = "struct<start:long,length:long,period:long>"
    return F.aggregate(F.col(found), F.lit(None).cast(kind), better)


def looped(docs: DataFrame) -> DataFrame:
    """Documents of which about a tenth repeat a part of their words from some word on.

    With h the CRC-32 of the decimal doc_id and g = h / 10, a document with h % 10 = 0 and n words
    has from word a = g % n on only its words a to a + p - 1 in turn, with
    p = 1 + (n - a) / (3 + g % 8). Others, and those without doc_id, keep their texts.
    """
    kept = picked(docs, doc_id="long", text="string")
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.filter(F.split("text", "[\\x20\\x09-\\x0D]+"), lambda w: w != "")
    asked = kept.withColumn("h", h).withColumn("words", F.when(F.col("h") % 10 == 0, words))
    asked = asked.withColumn("n", F.size("words")).withColumn("g", F.floor(F.col("h") / 10))
    a = F.pmod("g", "n").cast("int")
    p = (1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8))).cast("int")
    asked = asked.withColumn("a", F.when(F.col("n") > 0, a)).withColumn("p", p)
    again = F.expr("slice(flatten(array_repeat(slice(words, a + 1, p), cast(ceil((n - a) / p) as int))), 1, n - a)")
    turned = F.array_join(F.concat(F.expr("slice(words, 1, a)"), again), " ")
    return asked.select("doc_id", F.when(F.col("a").isNotNull(), turned).otherwise(F.col("text")).alias("text"))


@query()
def op11_periodic_runs(spark, sf_dir):
    """Runs of all documents, a tenth of them looped, and digests of their runs and rest."""
    found = runs(looped(table(spark, sf_dir, "documents"))).withColumn("top", strongest())
    line = lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])
    lines = F.concat(F.array_join(F.transform("runs", line), "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("top.start").alias("start"),
        F.col("top.length").alias("length"),
        F.col("top.period").alias("period"),
        F.expr("1000 * top.length div top.period").alias("exponent_milli"),
        F.sha2(lines.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
