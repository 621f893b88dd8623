"""Language identification: averaged hashed subword embeddings under a linear softmax.

A word's subwords (itself and its character 2- to 4-grams between word marks) are hashed to
rows of an embedding table; a text is the mean of the embeddings of all its subwords, and a
linear layer with softmax gives the languages' probabilities. Table and layer are trained by
stochastic gradient descent in numpy on a bounded sample of labelled rows. Since the model is
linear up to the softmax, a trained word is one row of class sums, computed once per worker.

Rejection is calibrated on labelled rows kept out of the training: the temperature that
minimises their log loss, and the score that all but a small share of them reach.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regiofact.llm.base import picked, query, table, texts_of

#: A letter, then letters and marks; anything else divides words.
WORD = regex.compile(r"\p{L}[\p{L}\p{M}]*")
UNKNOWN = "und"
FEWEST, MOST = 2, 4
#: Tokens a worker remembers before it starts anew.
MEMORY = 250_000


@dataclass(frozen=True)
class Settings:
    """Bounds of the training sample and shape of the model.

    rows: labelled rows in the sample, those whose hashed doc_id is smallest; words: words
    drawn at random from each of them, so that the sample's size does not follow the texts'.
    """

    rows: int = 4000
    words: int = 100
    buckets: int = 1 << 15
    dims: int = 12
    epochs: int = 4
    rate: float = 0.5
    batch: int = 32
    rejected: float = 0.001
    seed: int = 7


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


_BASE = np.uint64(0x9E3779B97F4A7C15)


def subwords(words: list[str], buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashed rows, number of their word) of the n-grams of marked words and the words whole."""
    marked = [f"<{w}>" for w in words]
    sizes = np.array([len(m) for m in marked], dtype=np.int64)
    letters = "".join(marked).encode("utf-32-le", "surrogatepass")
    c = np.frombuffer(letters, "<u4").astype(np.uint64)
    if not len(c):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    ends, owner, at = np.cumsum(sizes), np.repeat(np.arange(len(words)), sizes), np.arange(len(c))
    left = ends[owner] - at  # letters from here to the word's end
    hashes, owners = [], []
    h = np.zeros(len(c), dtype=np.uint64)
    for k in range(1, MOST + 1):
        h = h[: len(c) - k + 1] * _BASE + c[k - 1 :]
        if k >= FEWEST:
            inside = left[: len(h)] >= k
            hashes.append(h[inside] + np.uint64(k))
            owners.append(owner[: len(h)][inside])
    powers = np.full(int(sizes.max()), _BASE)
    powers[0] = 1
    powers = np.cumprod(powers)
    starts = ends - sizes
    hashes.append(np.add.reduceat(_mixed(c) * powers[at - starts[owner]], starts))
    owners.append(np.arange(len(words)))
    rows = (_mixed(np.concatenate(hashes)) % np.uint64(buckets)).astype(np.int64)
    return rows, np.concatenate(owners)


@dataclass
class Model:
    """Class values per hashed subword, bias, temperature and the rejection score."""

    languages: list[str]
    table: np.ndarray
    bias: np.ndarray
    temperature: float = 1.0
    least: float = 0.0

    def __post_init__(self) -> None:
        self._forget()

    def _forget(self) -> None:
        #: What white space divides, with the place of its row of class sums and subword count.
        self.known: dict[str, int] = {}
        self.rows = np.zeros((1024, len(self.languages) + 1))

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k not in ("known", "rows")}

    def __setstate__(self, state: dict) -> None:
        self.__dict__.update(state)
        self._forget()

    def _learn(self, tokens: list[str]) -> None:
        """Rows of new tokens: the sums over the subwords of all their words."""
        found = [WORD.findall(t) for t in tokens]
        of_word = np.repeat(np.arange(len(tokens)), [len(w) for w in found])
        at, word = subwords([w for words in found for w in words], len(self.table))
        token, n = of_word[word], len(tokens)
        first, last = len(self.known), len(self.known) + n
        while last > len(self.rows):
            self.rows = np.concatenate([self.rows, np.zeros_like(self.rows)])
        for k in range(self.table.shape[1]):
            self.rows[first:last, k] = np.bincount(token, self.table[at, k], n)
        self.rows[first:last, -1] = np.bincount(token, minlength=n)
        self.known.update(zip(tokens, range(first, last), strict=True))

    def total(self, tokens: list[str]) -> np.ndarray:
        """Class sums and number of subwords of a text's tokens."""
        if new := sorted(set(tokens).difference(self.known)):
            self._learn(new)
        at = np.fromiter(map(self.known.__getitem__, tokens), dtype=np.int64, count=len(tokens))
        return self.rows[at].sum(axis=0)

    def logits(self, tokens: list[str]) -> np.ndarray:
        total = self.total(tokens)
        return total[:-1] / total[-1] + self.bias

    def predict(self, text: str) -> tuple[str, float]:
        """(language, score) of one whole text; no letter: unknown with score 0."""
        if len(self.known) > MEMORY:
            self._forget()
        tokens = text.lower().split()
        if not tokens or not self.languages or self.total(tokens)[-1] == 0:
            return UNKNOWN, 0.0
        z = self.logits(tokens) / self.temperature
        p = np.exp(z - z.max())
        p /= p.sum()
        best = int(p.argmax())
        return self.languages[best], float(p[best])


def train(samples: list[tuple[str, list[str]]], settings: Settings) -> Model:
    """A model from (language, words) samples; every tenth calibrates it."""
    samples = [(lang, words) for lang, words in samples if words]
    languages = sorted({lang for lang, _ in samples})
    if not languages:
        return Model([], np.zeros((1, 0), np.float32), np.zeros(0))
    number = {lang: i for i, lang in enumerate(languages)}
    held = [s for i, s in enumerate(samples) if i % 10 == 9]
    used = [s for i, s in enumerate(samples) if i % 10 != 9]
    features, labels = [], []
    for lang, words in used:
        features.append(subwords(words, settings.buckets)[0].astype(np.int32))
        labels.append(number[lang])
    labels = np.array(labels)
    rng = np.random.default_rng(settings.seed)
    emb = rng.normal(0, 0.1, (settings.buckets, settings.dims)).astype(np.float32)
    out = np.zeros((settings.dims, len(languages)), np.float32)
    bias = np.zeros(len(languages), np.float32)
    epochs = max(settings.epochs, -(-settings.epochs * 1000 // max(1, len(used))))
    for epoch in range(epochs):
        rate = settings.rate * (1 - epoch / epochs)
        order = rng.permutation(len(used))
        for start in range(0, len(order), settings.batch):
            chosen = order[start : start + settings.batch]
            flat = np.concatenate([features[i] for i in chosen])
            sizes = np.array([len(features[i]) for i in chosen])
            starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
            mean = np.add.reduceat(emb[flat], starts, axis=0) / sizes[:, None]
            z = mean @ out + bias
            p = np.exp(z - z.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(len(chosen)), labels[chosen]] -= 1
            step = p @ out.T / sizes[:, None]
            out -= rate * mean.T @ p
            bias -= rate * p.sum(axis=0) / len(chosen)
            owner = np.repeat(np.arange(len(chosen)), sizes)
            rows, at = np.unique(flat, return_inverse=True)
            weights = np.zeros((len(rows), settings.dims), np.float32)
            for d in range(settings.dims):
                weights[:, d] = np.bincount(at, step[owner, d], len(rows))
            emb[rows] -= settings.rate * 20 * weights
    model = Model(languages, (emb @ out).astype(np.float32), bias.astype(np.float64))
    _calibrate(model, held or used, number, settings)
    return model


def _calibrate(model: Model, held: list[tuple[str, list[str]]], number: dict[str, int], settings: Settings) -> None:
    z = np.array([model.logits(words) for _, words in held])
    y = np.array([number[lang] for lang, _ in held])

    def probabilities(t: float) -> np.ndarray:
        p = np.exp((z - z.max(axis=1, keepdims=True)) / t)
        return p / p.sum(axis=1, keepdims=True)

    def loss(t: float) -> float:
        return -np.log(np.maximum(probabilities(t)[np.arange(len(y)), y], 1e-12)).mean()

    model.temperature = min((float(t) for t in np.geomspace(0.2, 5, 33)), key=loss)
    scores = np.sort(probabilities(model.temperature).max(axis=1))
    even = 1 / len(model.languages)
    # a score is rejected when it is near an even guess, or below what almost all known texts reach
    model.least = float(min(scores[int(settings.rejected * len(scores))], even + 0.15))


def remainder(doc_id: Column) -> Column:
    """crc32 of a doc_id as text, modulo 5; null stays null."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 5


def fit(docs: DataFrame, settings: Settings = Settings()) -> Model:
    """Train on a bounded sample of the documents that are not held out.

    Rows without text, language or doc_id are no training rows.
    """
    rows = picked(docs, doc_id="long", text="string", lang="string")
    learned = rows.filter("lang is not null and text is not null and doc_id is not null")
    learned = learned.filter(remainder(F.col("doc_id")) != 0)
    order = F.xxhash64("doc_id")
    many, seed = settings.words, settings.seed

    def drawn(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            out = []
            for doc_id, text in zip(ids, batch.column("text").to_pylist(), strict=True):
                words = WORD.findall(text.lower())
                if len(words) > many:
                    at = np.random.default_rng([seed, doc_id % (1 << 63)]).choice(len(words), many, replace=False)
                    words = [words[i] for i in np.sort(at)]
                out.append(" ".join(words))
            yield pa.record_batch(
                [batch.column("doc_id"), batch.column("lang"), pa.array(out, pa.string())],
                ["doc_id", "lang", "words"],
            )

    # rows are chosen by hash before their texts are read
    ids = learned.select("doc_id").orderBy(order, "doc_id").limit(settings.rows)
    last = ids.agg(F.max(F.struct(order.alias("h"), "doc_id")).alias("m")).first()["m"]
    if last is None:
        return train([], settings)
    within = learned.filter((order < last["h"]) | ((order == last["h"]) & (F.col("doc_id") <= last["doc_id"])))
    small = within.mapInArrow(drawn, "doc_id long, lang string, words string")
    small = small.orderBy(order, "doc_id", "lang", "words").limit(settings.rows)
    return train([(r["lang"], r["words"].split()) for r in small.collect()], settings)


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang_pred, score and rejected of whole texts.

    A text that is null, empty or without a letter is ``und`` with score 0 and rejected.
    Only the text enters the prediction; repeated rows get the same answer each.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for ids, texts in texts_of(batches):
            found = [known.predict(t) for t in texts]
            yield pa.record_batch(
                [
                    pa.array(ids, pa.int64()),
                    pa.array([f[0] for f in found], pa.string()),
                    pa.array([f[1] for f in found], pa.float64()),
                    pa.array([f[0] == UNKNOWN or f[1] < known.least for f in found]),
                ],
                ["doc_id", "lang_pred", "score", "rejected"],
            )

    return picked(docs, doc_id="long", text="string").mapInArrow(
        run, "doc_id long, lang_pred string, score double, rejected boolean"
    )


def accepted(docs: DataFrame, model: Model) -> DataFrame:
    """The documents that are not rejected, with the columns of documents, unchanged."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            found = [known.predict(t or "") for t in batch.column("text").to_pylist()]
            yield batch.filter(pa.array([f[0] != UNKNOWN and f[1] >= known.least for f in found]))

    kept = picked(docs, doc_id="long", text="string", lang="string", source="string", n_chars="long")
    return kept.mapInArrow(run, kept.schema)


@query()
def op8_language_id(spark, sf_dir):
    """Languages of all documents, learned from four fifths of them."""
    docs = table(spark, sf_dir, "documents")
    held = F.coalesce(remainder(F.col("doc_id")) == 0, F.lit(False))
    return identify(docs, fit(docs)).select(
        "doc_id", held.alias("held_out"), "lang_pred", "score", "rejected"
    )
