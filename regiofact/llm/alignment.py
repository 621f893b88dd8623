"""Alignment of the tokens of two vocabularies over the bytes of texts, with corpus-wide counts.

Equal texts are found by a shuffle of the whole texts, and each distinct text is tokenised and
aligned once. Where tokens of both vocabularies end at one byte the text is cut into groups, and
the two tokens that end there are linked. Links are counted over the corpus, a text's weighing as
many times as it occurs; the measures of each distinct text are joined to all its documents.

Of two tokens that end together the shorter is the end of the longer. The pairs that can be
linked are therefore known from the vocabularies, some hundred thousand whatever the corpus, so
a table of their counts is small enough for every worker.

Neither vocabulary has tokens that reach over the border between a word and white space after it.
So texts are cut there, and a worker aligns each distinct stretch between two borders once.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regiofact.llm.base import picked, query, stored, table, tokenizer
from regiofact.llm.token_counts import _byte_letters

#: A space or line end after a visible character starts a stretch; a last single space does not.
BORDER = re.compile(r"(?<=[\w!-~])(?=\n| [\s\S])")
#: Texts without it have borders at every space and line end.
UNEVEN = re.compile(r"[^\w!-~][ \n]|\A[ \n]| \Z")
#: Stretches a worker remembers before it starts anew, and the longest of them.
MEMORY, LONGEST = 250_000, 200
#: Characters of texts that are aligned together, and new stretches that are encoded together.
GROUP, ENCODED = 2 << 20, 8192


class Vocabularies:
    """The two tokenizers, the bytes of their tokens, and the pairs of tokens that can be linked."""

    def __init__(self, path_a: str, path_b: str):
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.a.no_truncation()
        self.a.no_padding()
        self.b = SentencePieceProcessor(model_file=path_b)
        byte_of = {c: i for i, c in enumerate(_byte_letters())}
        special = self.a.get_added_tokens_decoder()
        vocab = {i: t for t, i in self.a.get_vocab(with_added_tokens=True).items()}
        self.bytes_a = [
            b"" if t is None else t.encode() if i in special else bytes(byte_of[c] for c in t)
            for i, t in ((i, vocab.get(i)) for i in range(max(vocab) + 1))
        ]
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [
            bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
            for i, p in enumerate(pieces)
        ]
        self.sizes_a, self.sizes_b = (np.array([len(t) for t in x]) for x in (self.bytes_a, self.bytes_b))
        # a border inside of a piece would let it reach over the end of a stretch
        self.in_stretches = not any(re.search("[^▁]▁|\n", p) for p in pieces)
        ends: dict[bytes, list[int]] = {}
        for i, t in enumerate(self.bytes_b):
            ends.setdefault(t, []).append(i)
        found = {(i, j) for i, t in enumerate(self.bytes_a) for k in range(len(t)) for j in ends.get(t[k:], ())}
        ends = {}
        for i, t in enumerate(self.bytes_a):
            ends.setdefault(t, []).append(i)
        found |= {(i, j) for j, t in enumerate(self.bytes_b) for k in range(len(t)) for i in ends.get(t[k:], ())}
        #: The pairs that can be linked, as id of a times the size of b plus id of b, in order.
        self.pairs = np.array(sorted(i * len(pieces) + j for i, j in found), dtype=np.int64)

    def encode_a(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in a row, how many each has)."""
        found = self.a.encode(texts, is_pretokenized=True, add_special_tokens=False)
        return np.array(found.ids, dtype=np.int64), np.bincount(np.array(found.word_ids, dtype=np.int64), minlength=len(texts))

    def encode_b(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The same for texts that start with a space, which is the one that the library adds."""
        found = self.b.encode([t[1:] if t[0] == " " else t for t in texts], num_threads=1)
        found = [f[1:] if t[0] != " " else f for t, f in zip(texts, found, strict=True)]  # it adds one to the others too
        sizes = np.array([len(f) for f in found], dtype=np.int64)
        return np.fromiter((i for f in found for i in f), np.int64, sizes.sum()), sizes

    def align(self, texts: list[str]) -> list[tuple[int, int, np.ndarray, str] | None]:
        """(tokens of a, of b, numbers of the pairs linked, groups as text) of each, or None.

        None if the bytes of the tokens of a or of b are not those of the text. Texts start
        with the space that belongs to the first word, or are the stretch of a line end.
        """
        if not texts:
            return []
        (ids_a, n_a), (ids_b, n_b) = self.encode_a(texts), self.encode_b(texts)
        data = [t.encode() for t in texts]
        spelled = self._spelled(self.bytes_a, ids_a, n_a, data) & self._spelled(self.bytes_b, ids_b, n_b, data)
        if not spelled.all():
            ids_a, ids_b = ids_a[np.repeat(spelled, n_a)], ids_b[np.repeat(spelled, n_b)]
            n_a, n_b = n_a * spelled, n_b * spelled
        # texts end at one byte in both, so groups do not reach over their ends
        _, last_a, last_b = np.intersect1d(
            np.cumsum(self.sizes_a[ids_a]), np.cumsum(self.sizes_b[ids_b]), assume_unique=True, return_indices=True
        )
        linked = np.searchsorted(self.pairs, ids_a[last_a] * len(self.bytes_b) + ids_b[last_b]).astype("<i4")
        names_a, names_b = list(map(str, ids_a.tolist())), list(map(str, ids_b.tolist()))
        groups, i, j = [], 0, 0
        for x, y in zip((last_a + 1).tolist(), (last_b + 1).tolist(), strict=True):
            groups.append(",".join(names_a[i:x]) + "|" + ",".join(names_b[j:y]))
            i, j = x, y
        edges = np.searchsorted(last_a, np.cumsum(n_a) - 1, side="right").tolist()
        out, start = [], 0
        for ok, a, b, stop in zip(spelled.tolist(), n_a.tolist(), n_b.tolist(), edges, strict=True):
            out.append((a, b, linked[start:stop], ";".join(groups[start:stop])) if ok else None)
            start = stop
        return out

    def _spelled(self, pieces: list[bytes], ids: np.ndarray, sizes: np.ndarray, data: list[bytes]) -> np.ndarray:
        """Which texts are spelled by their tokens."""
        edges, names = np.cumsum(sizes).tolist(), ids.tolist()
        starts = [0, *edges[:-1]]
        spell = pieces.__getitem__
        return np.array([b"".join(map(spell, names[x:y])) == t for x, y, t in zip(starts, edges, data, strict=True)], dtype=bool)


class Aligner:
    """Aligns texts by stretches, with a worker's memory of them."""

    def __init__(self, path_a: str, path_b: str):
        self.both = Vocabularies(path_a, path_b)
        self.known: dict[str, tuple[int, int, bytes, str] | None] = {}

    def stretches(self, text: str) -> list[str]:
        """The stretches of a text, without the space that starts most of them.

        One that starts with white space is whole.
        """
        if not self.both.in_stretches:
            return [" " + text]
        if UNEVEN.search(text) is None:
            return text.replace("\n", " \n").split(" ")
        return [s[1:] if s[0] == " " and s[1:2] not in (" ", "\n") else s for s in BORDER.split(" " + text)]

    def of(self, texts: list[str]) -> list[tuple[int, int, bytes, str]]:
        """(tokens of a, of b, linked pairs as bytes, groups) of texts that are not empty."""
        if len(self.known) > MEMORY:
            self.known.clear()
        cut = [self.stretches(t) for t in texts]
        new = list(set().union(*cut).difference(self.known))
        for k in range(0, len(new), ENCODED):
            some = new[k : k + ENCODED]
            found = self.both.align([s if s[0] in " \n" else " " + s for s in some])
            self.known.update((s, (f[0], f[1], f[2].tobytes(), f[3]) if f else None) for s, f in zip(some, found, strict=True))
        out = []
        for text, parts in zip(texts, cut, strict=True):
            rows = list(map(self.known.__getitem__, parts))
            if None in rows:  # the parts might still make up the text
                whole = self.both.align([" " + text])[0]
                out.append((whole[0], whole[1], whole[2].tobytes(), whole[3]) if whole else (0, 0, b"", ""))
            else:
                a, b, linked, groups = zip(*rows, strict=True)
                out.append((sum(a), sum(b), b"".join(linked), ";".join(groups)))
        for s in new:
            if len(s) > LONGEST:
                del self.known[s]
        return out


@lru_cache(maxsize=1)
def aligner(path_a: str, path_b: str) -> Aligner:
    """The worker's memory for two vocabularies; it outlives a task."""
    return Aligner(path_a, path_b)


def distinct_texts(docs: DataFrame) -> DataFrame:
    """key (SHA-256), text and copies of every distinct text that is neither null nor empty.

    Copies are counted before the texts are shuffled, so a text that many rows share travels once
    from each task.
    """
    found = picked(docs, text="string").filter("text <> ''").groupBy("text").agg(F.count("*").alias("copies"))
    return found.select(F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("key"), "text", "copies")


ALIGNED = "key binary, copies long, n_a long, n_b long, links binary, groups string"


def aligned(texts: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """n_a, n_b, links (numbers of linked pairs, 4 bytes each) and groups of every distinct text.

    Groups are written ``a1,a2|b1;a3|b2,b3``. A text whose tokens do not spell it has none.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        align = aligner(path_a, path_b).of
        for batch in batches:
            texts = batch.column("text").to_pylist()
            places = np.cumsum([len(t) for t in texts]) // GROUP
            cuts = [0, *(np.flatnonzero(np.diff(places)) + 1).tolist(), len(texts)]
            for x, y in zip(cuts, cuts[1:], strict=False):
                if y > x:
                    some = batch.slice(x, y - x)
                    a, b, links, groups = zip(*align(texts[x:y]), strict=True)
                    yield pa.record_batch(
                        [
                            some.column("key"), some.column("copies"), pa.array(a, pa.int64()), pa.array(b, pa.int64()),
                            pa.array(links, pa.binary()), pa.array(groups, pa.string()),
                        ],
                        ["key", "copies", "n_a", "n_b", "links", "groups"],
                    )

    return texts.select("key", "text", "copies").mapInArrow(run, ALIGNED)


def _links(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """(numbers of the pairs linked, how many each row has)."""
    rows = batch.column("links").to_pylist()
    return np.frombuffer(b"".join(rows), dtype="<i4"), np.array([len(r) // 4 for r in rows], dtype=np.int64)


def pair_counts(found: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """pair, a, b, n (links of the pair in all documents) and best (no pair of its b has more).

    Counts are added up in each task first; there are no more rows than pairs that can be linked.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(aligner(path_a, path_b).both.pairs), dtype=np.int64)
        for batch in batches:
            links, sizes = _links(batch)
            copies = np.repeat(batch.column("copies").to_numpy(zero_copy_only=False), sizes)
            total += np.bincount(links, copies, minlength=len(total)).astype(np.int64)
        both = aligner(path_a, path_b).both
        at = np.flatnonzero(total)
        a, b = np.divmod(both.pairs[at], len(both.bytes_b))
        yield pa.record_batch([pa.array(x) for x in (at, a, b, total[at])], ["pair", "a", "b", "n"])

    tasks = found.select("copies", "links").mapInArrow(run, "pair long, a long, b long, n long")
    counts = tasks.groupBy("pair", "a", "b").agg(F.sum("n").alias("n"))
    most = counts.groupBy("b").agg(F.max("n").alias("most"))
    return counts.join(most, "b").select("pair", "a", "b", "n", (F.col("n") == F.col("most")).alias("best"))


def measured(found: DataFrame, counts: DataFrame) -> DataFrame:
    """n_links, n_best and count_sum of every distinct text, beside its other columns.

    The counts travel to every worker as one array; their number is bounded by the vocabularies.
    """
    rows = counts.select("pair", "n", "best").toArrow()
    pair = rows.column("pair").to_numpy()
    n, best = np.zeros(pair.max(initial=-1) + 1, dtype=np.int64), np.zeros(pair.max(initial=-1) + 1, dtype=np.int64)
    n[pair], best[pair] = rows.column("n").to_numpy(), rows.column("best").to_numpy().astype(np.int64)
    shared = found.sparkSession.sparkContext.broadcast((n, best))
    rest = [c for c in found.columns if c not in ("copies", "links")]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, best = shared.value
        for batch in batches:
            links, sizes = _links(batch)
            edges = np.append(0, np.cumsum(sizes))
            sums = [np.diff(np.append(0, np.cumsum(x[links]))[edges]) for x in (best, n)]
            columns = [*(batch.column(c) for c in rest), *(pa.array(x) for x in (sizes, *sums))]
            yield pa.record_batch(columns, [*rest, "n_links", "n_best", "count_sum"])

    kept = found.select(*rest, "links")
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in found.select(*rest).schema)
    return kept.mapInArrow(run, f"{schema}, n_links long, n_best long, count_sum long")


def alignments(docs: DataFrame, path_a: str, path_b: str, **more: F.Column) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best and count_sum of every document, and ``more``.

    ``more`` are columns over a distinct text's ``groups``, such as a digest; without them the
    groups themselves are returned. Vocabulary a is byte-level, and encodes the text after one
    space; b is one of pieces, which adds that space. Special strings inside texts are plain text.

    Documents whose text is null or empty, or is not spelled by both vocabularies' tokens, have
    zeros and no groups. Repeated rows return once each and weigh once each in the counts, as do
    different documents of one text; a null doc_id stays null; an empty table gives no rows.
    """
    more = more or {"groups": F.col("groups")}
    n_groups = F.when(F.col("groups") == "", 0).otherwise(F.length("groups") - F.length(F.replace("groups", F.lit(";"))) + 1)
    found = aligned(distinct_texts(docs), path_a, path_b)
    kept = stored(
        found.select("key", "copies", "n_a", "n_b", "links", n_groups.cast("long").alias("n_groups"),
                     *[c.alias(n) for n, c in more.items()]),
        "aligned",
    )
    measures = stored(measured(kept, pair_counts(kept, path_a, path_b)), "measures")
    keyed = picked(docs, doc_id="long", text="string")
    keyed = keyed.select("doc_id", F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("key"))
    whole = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]
    rows = keyed.join(measures, "key", "left")
    return rows.select(
        "doc_id", *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in whole],
        *[F.coalesce(n, F.lit("")).alias(n) for n in more],
    )


@query()
def op12_alignment(spark, sf_dir):
    """Links between the tokens of two vocabularies in all documents."""
    digest = F.when(F.col("groups") == "", "").otherwise(F.sha2(F.col("groups").cast("binary"), 256))
    return alignments(
        table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"), tokenizer("piece_bpe_32k.model"),
        groups_sha256=digest,
    )
