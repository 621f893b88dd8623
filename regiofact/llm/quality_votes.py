"""Quality of documents by rules that vote or abstain, weighed by expectation-maximisation.

Each rule looks at one figure of a document and votes that it is good, or bad, or abstains. How
often each rule is right on good documents, and on the bad ones of several kinds, is estimated
without labels from the votes of all documents: documents with the same votes are one row, so the
estimation works on at most 3 to the number of rules rows, whatever the corpus. A document's quality is the posterior
probability of being good given all votes; no single rule has to pass.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regiofact.llm.base import picked, query, stored, table
from regiofact.llm.periodic_runs import by_size, words_of

#: Words of a window that counts as repeated when a text has it twice.
WINDOW = 5
#: A document of a lower probability of being good is not kept.
LEAST = 0.5
FIGURES = (
    "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words",
    "n_distinct", "n_with_letter", "n_ended_lines", "n_letters", "n_capitals", "n_exclaimed",
)


@dataclass(frozen=True)
class Rule:
    """A rule votes good or bad where these SQL conditions on the figures hold, else it abstains."""

    name: str
    good: str
    bad: str


RULES = (
    Rule("length", "n_words >= 50", "n_words < 10"),
    Rule("word_length", "word_chars between 3.5 * n_words and 7 * n_words", "word_chars < 2.5 * n_words or word_chars > 11 * n_words"),
    Rule("symbols", "n_symbols <= 0.02 * n_words", "n_symbols > 0.1 * n_words"),
    Rule("lines", "n_lines >= 3 and n_dup_lines <= 0.1 * n_lines", "n_dup_lines > 0.3 * n_lines"),
    Rule("repeats", "n_words >= 20 and n_repeat_words <= 0.05 * n_words", "n_repeat_words > 0.15 * n_words"),
    Rule("letters", "n_with_letter >= 0.95 * n_words", "n_with_letter < 0.8 * n_words"),
    Rule("capitals", "n_letters >= 20 and n_capitals <= 0.1 * n_letters", "n_letters >= 20 and n_capitals > 0.3 * n_letters"),
    Rule("ends", "n_ended_lines >= 0.7 * n_lines", "n_lines >= 3 and n_ended_lines < 0.2 * n_lines"),
    Rule("calm", "n_words >= 20 and n_exclaimed <= 0.05 * n_words", "n_words >= 10 and n_exclaimed > 0.3 * n_words"),
    Rule("variety", "n_words >= 20 and n_distinct >= 3 * sqrt(n_words)", "n_words >= 20 and n_distinct < 1.5 * sqrt(n_words)"),
)


def _per_text(marks: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    return np.diff(np.append(0, np.cumsum(marks, dtype=np.int64))[offsets])


def _ranked(keys: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of places whose key others have too: the places, and numbers that are equal as the keys are."""
    _, number, times = np.unique(keys, return_inverse=True, return_counts=True)
    again = times[number] > 1
    return at[again], number[again]


def repeated(codes: np.ndarray, offsets: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """Which words lie in a window of words that their text has twice or more; codes name words."""
    n = len(codes)
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    ends = offsets[1:][text]
    base = int(codes.max(initial=0)) + 1
    # windows that agree so far are numbered anew with each word, and single ones drop out
    at, number = np.arange(n), text.astype(np.int64)
    for step in range(window):
        inside = at + step < ends[at]
        at, number = at[inside], number[inside]
        at, number = _ranked(number * base + codes[at + step], at)
    cover = np.zeros(n + 1, dtype=np.int64)
    np.add.at(cover, at, 1)
    np.add.at(cover, at + window, -1)
    return np.cumsum(cover[:-1]) > 0


def _distinct(codes: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """How many different codes each text has."""
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    pairs = np.unique(text * (int(codes.max(initial=0)) + 1) + codes)
    return np.bincount(pairs // (int(codes.max(initial=0)) + 1), minlength=len(offsets) - 1)


def _codes(values: pa.Array) -> np.ndarray:
    return values.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)


def figures_of(texts: pa.Array) -> list[np.ndarray]:
    """The FIGURES of texts; null is empty."""
    texts = pc.fill_null(texts, "")
    numbers = lambda found: found.to_numpy(zero_copy_only=False).astype(np.int64)
    words, offsets = words_of(texts)
    codes = _codes(words)
    split = pc.split_pattern(texts, "\n")
    lines, edges = split.flatten(), split.offsets.to_numpy().astype(np.int64)
    filled = pc.match_substring_regex(lines, r"[^\x20\x09-\x0D]")
    marks = filled.to_numpy(zero_copy_only=False)
    edges = np.append(0, np.cumsum(marks))[edges - edges[0]]
    lines = lines.filter(filled)
    n_lines = np.diff(edges)
    return [
        np.diff(offsets),
        _per_text(numbers(pc.utf8_length(words)), offsets),
        numbers(pc.count_substring_regex(texts, "[#*$%&|<>]")),
        n_lines,
        n_lines - _distinct(_codes(lines), edges),
        _per_text(repeated(codes, offsets), offsets),
        _distinct(codes, offsets),
        _per_text(numbers(pc.match_substring_regex(words, r"\p{L}")), offsets),
        _per_text(numbers(pc.match_substring_regex(lines, "[.!?…\"'”’»:][\\x20\\x09-\\x0D]*$")), edges),
        numbers(pc.count_substring_regex(texts, r"\p{L}")),
        numbers(pc.count_substring_regex(texts, r"\p{Lu}")),
        numbers(pc.count_substring(texts, "!")),
    ]


def figures(docs: DataFrame) -> DataFrame:
    """doc_id and the FIGURES of each whole text.

    Words are what lies between ASCII white space; lines count if they have a word. A null text
    is empty: all figures are 0.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in by_size(whole):
                columns = [pa.array(c, pa.int64()) for c in figures_of(batch.column("text"))]
                yield pa.record_batch([batch.column("doc_id"), *columns], ["doc_id", *FIGURES])

    schema = ", ".join(f"{n} long" for n in ("doc_id", *FIGURES))
    return picked(docs, doc_id="long", text="string").mapInArrow(run, schema)


def pattern(rules: tuple[Rule, ...] = RULES) -> Column:
    """All votes of a document as one number: a digit to base three for each rule, 2 is good, 1 bad."""
    votes = [F.when(F.expr(r.bad), 1).when(F.expr(r.good), 2).otherwise(0) * 3**k for k, r in enumerate(rules)]
    return sum(votes[1:], votes[0]).cast("int")


@dataclass
class Votes:
    """What has been learned of the classes: good documents first, then a kind of bad ones per rule.

    ``shares`` are the parts of the documents that are in each class, ``fails`` how often each rule
    (column) votes bad on those of a class (row) on which it votes at all.
    """

    shares: np.ndarray
    fails: np.ndarray

    def classes(self, votes: np.ndarray) -> np.ndarray:
        """The probability of each class for documents with these votes (rows of 0, 1 bad, 2 good)."""
        ways = np.log(self.shares) + (votes == 1) @ np.log(self.fails).T + (votes == 2) @ np.log(1 - self.fails).T
        ways = np.exp(ways - ways.max(axis=1, initial=-np.inf, keepdims=True))
        return ways / ways.sum(axis=1, keepdims=True)

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        """The probability that documents with these votes are good."""
        return self.classes(votes)[:, 0]


def digits(patterns: np.ndarray, rules: int) -> np.ndarray:
    """The votes of each pattern, a row each."""
    return patterns[:, None] // 3 ** np.arange(rules) % 3


def estimate(votes: np.ndarray, times: np.ndarray, rounds: int = 300, firm: float = 20.0) -> Votes:
    """Shares and accuracies that make the votes likeliest; ``times`` says how often each row occurs.

    The first guess is that good documents are common and rarely fail a rule, and that the bad ones
    of a rule's kind fail it, and others seldom. Which rules fail together on a kind, and how
    often good documents fail each, is then learned. The guess also weighs in like ``firm``
    documents a class, so nothing becomes certain; without any document it is what is returned.
    """
    m = votes.shape[1]
    first = Votes(np.append(0.9, np.full(m, 0.1 / m)), np.vstack([np.full(m, 0.005), np.full((m, m), 0.1)]))
    first.fails[1:][np.eye(m, dtype=bool)] = 0.9
    now = first
    for _ in range(rounds):
        weight = now.classes(votes).T * times
        shares = (first.shares * firm + weight.sum(axis=1)) / (firm + times.sum())
        fails = (first.fails * firm + weight @ (votes == 1)) / (firm + weight @ (votes > 0))
        moved = np.abs(fails - now.fails).max(initial=0)
        now = Votes(shares, fails)
        if moved < 1e-9:
            break
    return now


def fit(voted: DataFrame, rules: tuple[Rule, ...] = RULES) -> tuple[Votes, DataFrame]:
    """What the votes of all rows say about the rules, and the quality of each pattern of votes.

    At most 3 to the number of rules patterns reach the driver, counted in Spark.
    """
    rows = voted.groupBy("pattern").count().orderBy("pattern").toArrow()
    patterns, times = (rows.column(n).to_numpy().astype(np.int64) for n in ("pattern", "count"))
    votes = digits(patterns, len(rules))
    model = estimate(votes, times.astype(float))
    pairs = list(zip(patterns.tolist(), model.posterior(votes).tolist(), strict=True))
    return model, voted.sparkSession.createDataFrame(pairs, "pattern int, quality double")


def judged(docs: DataFrame, rules: tuple[Rule, ...] = RULES, least: float = LEAST) -> DataFrame:
    """doc_id, the FIGURES, quality, base_failed and kept of every document.

    base_failed is true for fewer than ten words, or where over a fifth of the words lie in windows
    of five words that the text has twice. kept is false then, and else true if quality is
    ``least`` or more. Null and empty texts have no words, so they fail. Repeated rows return once
    each and count once each as votes, a null doc_id stays null, other columns are not carried, an
    empty table gives no rows.
    """
    voted = stored(figures(docs).withColumn("pattern", pattern(rules)), "figures")
    _, qualities = fit(voted, rules)
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    # as many rows as there are patterns of votes
    rows = voted.join(F.broadcast(qualities), "pattern").withColumn("base_failed", failed)
    kept = ~F.col("base_failed") & (F.col("quality") >= least)
    return rows.select("doc_id", *FIGURES, "quality", "base_failed", kept.alias("kept"))


@query()
def op13_quality_votes(spark, sf_dir):
    """Figures and verdicts of all documents."""
    found = judged(table(spark, sf_dir, "documents"))
    shown = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    return found.select(*shown, "quality")
