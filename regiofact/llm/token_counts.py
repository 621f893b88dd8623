"""Exact token counts at every prefix of a text, by dynamic programming over prefixes.

For byte-pair encoding, the encoding of a prefix ends in exactly one token ``t`` for which
the rest of the prefix encodes to what ends in a token compatible with ``t`` (the two side
by side encode to themselves). One pass over a word therefore gives the last token and the
token count at every prefix of it; a text's counts are sums over its words. Truncation and
budget questions are then answered by looking a prefix up, without encoding again.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regiofact.llm.base import picked, query, table, texts_of, tokenizer

#: The split pattern of byte-level tokenizers and its contractions.
WORD = regex.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)
CONTRACTIONS = frozenset(["'s", "'t", "'re", "'ve", "'m", "'ll", "'d"])
#: Characters outside of these are split by the library, whose Unicode tables decide.
UNUSUAL = regex.compile(r"[^\t\n\r\x20-\x7e\xa1-\xac\xae-ſ‐-‧]")
#: Entries of a worker's tables of pairs and prefixes, and of words, before they start anew.
MEMORY = 400_000
WORDS = 1_200_000
#: Prefixes of up to so many bytes are kept for other words.
SHARED = 32


def _byte_letters() -> list[str]:
    """The letter that stands for each byte in a byte-level vocabulary."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(rest)) for b in range(256)]


class PrefixCounter(dict):
    """Token count per word; a missing word is counted when it is first asked for."""

    def __init__(self, path: str):
        super().__init__()
        from tokenizers import Tokenizer

        full = Tokenizer.from_file(path)
        self.split_text = full.pre_tokenizer.pre_tokenize_str
        self.bare = Tokenizer(full.model)
        self.vocab = full.get_vocab(with_added_tokens=False)
        self.endings: dict = {}  # a tree of the tokens read backwards; "" marks a whole one
        for token in self.vocab:
            node = self.endings
            for c in reversed(token):
                node = node.setdefault(c, {})
            node[""] = {}
        specials = [t.content for t in full.get_added_tokens_decoder().values()]
        by_length = sorted(specials, key=len, reverse=True)
        self.special = regex.compile("(" + "|".join(map(regex.escape, by_length)) + ")") if specials else None
        self.specials = frozenset(specials)
        self.letters = {b: c for b, c in enumerate(_byte_letters())}
        self.bytes = {c: b for b, c in self.letters.items()}
        self.pairs: dict[tuple[str, str], bool] = {}
        self.edges: tuple[dict, dict] = ({}, {})
        self.prefixes: dict[str, tuple[int, str]] = {}
        merges = [tuple(m) for m in json.loads(full.to_str())["model"]["merges"]]
        self.ranks = {m: rank for rank, m in enumerate(merges)}
        self.halves = {left + right: (left, right) for left, right in merges}
        self.unique = len(self.halves) == len(merges)

    def __missing__(self, word: str) -> int:
        if word in self.specials:
            n = 1
        elif (s := self.spelled(word)) in self.vocab and self.compatible("", s):
            n = 1
        else:
            n = self.steps(word)[-1]
        self[word] = n
        return n

    def spelled(self, word: str) -> str:
        return word.encode("utf-8", "replace").decode("latin-1").translate(self.letters)

    def compatible(self, left: str, right: str) -> bool:
        """Whether the two tokens side by side encode to themselves (left may be empty)."""
        known = self.pairs.get((left, right))
        if known is None:
            if len(self.pairs) > MEMORY:
                self.pairs.clear()
            if left and self.unique:
                known = self._stay_apart(left, right)
            else:
                expected = [left, right] if left else [right]
                known = self.bare.encode(left + right).tokens == expected
            self.pairs[left, right] = known
        return known

    def _edge(self, token: str, side: int) -> list[tuple[str, float]]:
        """The tokens at one edge while ``token`` grows, each with the rank that ends it."""
        found = self.edges[side].get(token)
        if found is None:
            if token in self.halves:
                halves = self.halves[token]
                below = self._edge(halves[side], side)
                found = [*below[:-1], (below[-1][0], self.ranks[halves]), (token, float("inf"))]
            else:
                found = [(token, float("inf"))]
            self.edges[side][token] = found
        return found

    def _stay_apart(self, left: str, right: str) -> bool:
        """Whether no merge across the border comes before the merges on its two sides."""
        a, b = self._edge(left, 1), self._edge(right, 0)
        i = j = 0
        while True:
            (x, x_ends), (y, y_ends) = a[i], b[j]
            across = self.ranks.get((x, y))
            if across is not None and across < x_ends and across <= y_ends:
                return False
            if x_ends <= y_ends:
                if x_ends == float("inf"):
                    return True
                i += 1
            else:
                j += 1

    def steps(self, word: str) -> list[int]:
        """Token count at every byte prefix of one word, from 0 bytes on.

        Prefixes that earlier words shared are looked up.
        """
        s, known, endings, pairs = self.spelled(word), self.prefixes, self.endings, self.pairs
        if len(known) > MEMORY:
            known.clear()
        counts, last = [0], [""]
        end = 0
        while end < len(s) and (state := known.get(s[: end + 1])) is not None:
            counts.append(state[0])
            last.append(state[1])
            end += 1
        for end in range(end + 1, len(s) + 1):
            node, at, starts = endings, end, []
            while at and (node := node.get(s[at - 1])) is not None:
                at -= 1
                if "" in node:
                    starts.append(at)
            for start in reversed(starts):
                token = s[start:end]
                pair = last[start], token
                if pairs[pair] if pair in pairs else self.compatible(*pair):
                    counts.append(counts[start] + 1)
                    last.append(token)
                    break
            else:
                raise ValueError(f"no token ends at byte {end} of {word!r}")
            if end <= SHARED:
                known[s[:end]] = counts[end], token
        return counts

    def parts(self, text: str) -> list[str]:
        """A text between and including special strings."""
        if self.special is None:
            return [text]
        return [p for p in self.special.split(text) if p]

    def words(self, text: str) -> list[str]:
        """The pieces of a text that are encoded each on its own; special strings are one each."""
        if self.special is not None and self.special.search(text):
            return [
                w for p in self.parts(text) for w in ([p] if p in self.specials else self._words(p))
            ]
        return self._words(text)

    def _words(self, text: str) -> list[str]:
        if UNUSUAL.search(text) is None:
            return WORD.findall(text)
        return [
            bytes(self.bytes[c] for c in w).decode("utf-8", "replace") for w, _ in self.split_text(text)
        ]

    def count(self, text: str) -> int:
        if len(self) > WORDS:
            self.clear()
        return sum(map(self.__getitem__, self.words(text)))

    def prefix_counts(self, text: str) -> np.ndarray:
        """Token count of ``text[:i]`` for every i from 0 to its length.

        A special string counts from its last character on; a prefix that ends inside of it
        holds its characters as plain text.
        """
        out = np.zeros(len(text) + 1, dtype=np.int32)
        at = 0
        for part in self.parts(text):
            if part in self.specials:
                # inside, the characters are ordinary text: they may join what stands before
                before = text[:at]
                for i in range(1, len(part)):
                    out[at + i] = self.count(before + part[:i])
                out[at + len(part)] = out[at] + 1
            else:
                out[at : at + len(part) + 1] = out[at] + self._part_counts(part)
            at += len(part)
        return out

    def _part_counts(self, text: str) -> np.ndarray:
        out = np.zeros(len(text) + 1, dtype=np.int32)
        at = total = 0
        for word in self._words(text):
            if word in CONTRACTIONS:
                inside = [self["'"]] + [self["'"] + self[word[1:j]] for j in range(2, len(word))]
                out[at + 1 : at + len(word)] = total + np.array(inside[: len(word) - 1])
                out[at + len(word)] = total + self[word]
            else:
                out[at + 1 : at + len(word) + 1] = total + self._char_steps(word)
            total += self[word]
            at += len(word)
        for m in regex.finditer(r"\s+", text):  # a prefix that ends in white space ends in one run
            out[m.start() + 1 : m.end() + 1] = out[m.start()] + self._char_steps(m[0])
        # a run's last character may belong to the next word: that word's end counts from the sum
        return out

    def _char_steps(self, word: str) -> np.ndarray:
        ends = np.cumsum([len(c.encode("utf-8", "replace")) for c in word])
        return np.array(self.steps(word))[ends]


@lru_cache(maxsize=2)
def counter(path: str) -> PrefixCounter:
    """The worker's counter for a vocabulary file."""
    return PrefixCounter(path)


def count_tokens(docs: DataFrame, path: str, limit: int) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit (more than ``limit`` tokens) of whole texts.

    A null text is empty (0, 0, false); a null doc_id stays null; repeated rows are counted
    each; other columns are not carried. Work is one pass without a shuffle.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = counter(path)
        for ids, texts in texts_of(batches):
            counts = [known.count(t) for t in texts]
            sizes = [len(t.encode("utf-8", "replace")) for t in texts]
            yield pa.record_batch(
                [pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()), pa.array(counts, pa.int64())],
                ["doc_id", "n_bytes", "n_tokens"],
            )

    counted = picked(docs, doc_id="long", text="string").mapInArrow(
        run, "doc_id long, n_bytes long, n_tokens long"
    )
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)


def prefix_table(docs: DataFrame, path: str) -> DataFrame:
    """doc_id and prefix_tokens: the exact token count of every prefix, in characters from 0.

    A null or empty text has the one prefix of no tokens.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = counter(path)
        for ids, texts in texts_of(batches, 1 << 20):
            arrays = pa.array([known.prefix_counts(t) for t in texts], pa.list_(pa.int32()))
            yield pa.record_batch([pa.array(ids, pa.int64()), arrays], ["doc_id", "prefix_tokens"])

    return picked(docs, doc_id="long", text="string").mapInArrow(
        run, "doc_id long, prefix_tokens array<int>"
    )


def longest_prefix(prefixes: DataFrame, budget: int) -> DataFrame:
    """doc_id and n_chars of the longest prefix of at most ``budget`` tokens."""
    fits = F.transform("prefix_tokens", lambda n, i: F.when(n <= budget, i))
    return prefixes.select("doc_id", F.array_max(fits).alias("n_chars"))


@query()
def op2_token_counts(spark, sf_dir):
    """Token counts of all documents under the byte-level vocabulary."""
    return count_tokens(table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"), 512)
