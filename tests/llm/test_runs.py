"""Periodic runs against a search over all periods."""

import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from regiofact.llm import periodic_runs


def brute(words, least=6, exponent=4):
    """(start, length, period) of all runs, period by period."""
    found, n = {}, len(words)
    for q in range(1, n // 2 + 1):
        same = [words[i] == words[i + q] for i in range(n - q)] + [False]
        start = None
        for i, s in enumerate(same):
            if s and start is None:
                start = i
            if not s and start is not None:
                length = i - start + q
                if length >= max(least, exponent * q):
                    found.setdefault((start, length), q)
                start = None
    return sorted((s, n, q) for (s, n), q in found.items())


def expected(doc_id, text, least=6, exponent=4):
    """The row of the query for a document."""
    words = (text or "").encode().split()
    n = len(words)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = brute(words, least, exponent)
    top = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if runs else None
    drop = {i for s, length, q in runs for i in range(s + q, s + length)}
    digest = lambda b: hashlib.sha256(b).hexdigest()
    return (
        doc_id, len(runs), *(top or (None, None, None)), 1000 * top[1] // top[2] if top else None,
        digest("".join("%d,%d,%d\n" % r for r in runs).encode()),
        digest(b" ".join(w for i, w in enumerate(words) if i not in drop)),
    )


def texts():
    rnd = random.Random(11)
    rows = [(None, "a b a b a b a b a b"), (0, None), (1, ""), (2, " \t\n "), (3, "ha " * 5), (4, "ha " * 6)]
    rows += [(5, "ha " * 3000), (6, "x y z\x1c " * 9), (7, "q " + "b a " * 4 + "a b " * 6), (7, "q " + "b a " * 4 + "a b " * 6)]
    rows += [(8, "a a b " * 40 + "é " * 7), (9, " ".join(str(i % 211) for i in range(2110)))]
    for i in range(10, 200):
        k, n = rnd.choice([(1, 9), (2, 40), (3, 80), (9, 120), (50, 200)])
        words = [rnd.choice("abcdefghijklmnopqrstuvwxyz"[: min(k, 26)]) for _ in range(rnd.randint(0, n))]
        rows.append((i, rnd.choice([" ", "\n", "  "]).join(words)))
    return rows


ROWS = texts()


@pytest.fixture(scope="module")
def docs(spark):
    df = spark.createDataFrame(ROWS, "doc_id long, text string").repartition(3)
    return df.select("*", *[F.lit(1).alias(n) for n in ("runs", "n", "a", "p", "words", "n_words", "x.y")])


def test_query(spark, docs, tmp_path):
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    found = periodic_runs.op11_periodic_runs(spark, str(tmp_path))
    assert found.columns == [
        "doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256",
    ]
    assert sorted(map(tuple, found.collect()), key=str) == sorted((expected(*r) for r in ROWS), key=str)


def test_outputs(docs):
    rows = periodic_runs.runs(docs, 2, 2).collect()
    assert len(rows) == len(ROWS)
    by_id = {r.doc_id: r for r in rows}
    for i, text in ROWS[3:]:
        words = (text or "").encode().split()
        if len(words) < 300:
            assert [tuple(x) for x in by_id[i].runs] == brute(words, 2, 2)
            assert by_id[i].n_words == len(words)
    assert by_id[5].collapsed == "ha" and [tuple(x) for x in by_id[5].runs] == [(0, 3000, 1)]
    assert by_id[0].collapsed == by_id[2].collapsed == ""
    assert periodic_runs.runs(docs.filter("doc_id = -1")).count() == 0


def test_groups_of_any_size(docs, monkeypatch):
    whole = sorted(map(str, periodic_runs.runs(docs).collect()))
    monkeypatch.setattr(periodic_runs, "GROUP", 10)
    monkeypatch.setattr(periodic_runs, "STEP", 3)
    column = docs.select("text").toPandas()["text"]
    import pyarrow as pa

    for group in (1, 7, len(column)):
        words, offsets = periodic_runs.words_of(pa.array(list(column[:group]), pa.string()))
        codes = words.dictionary_encode().indices.to_numpy().astype(np.int64)
        start, end, period = periodic_runs.runs_of(codes, offsets)
        text = np.searchsorted(offsets, start, side="right") - 1
        found = sorted(zip(text.tolist(), (start - offsets[text]).tolist(), (end - start).tolist(), period.tolist(), strict=True))
        want = [(k, *r) for k, t in enumerate(column[:group]) for r in brute((t or "").encode().split()) if len(t or "") < 4000]
        assert [f for f in found if len(column[f[0]]) < 4000] == want
    assert sorted(map(str, periodic_runs.runs(docs).collect())) == whole
