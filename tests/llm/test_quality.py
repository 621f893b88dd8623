"""Quality votes: figures against brute force, estimates against planted truth and labels."""

import collections
import os
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from regiofact.llm import quality_votes as qv

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def texts():
    rnd = random.Random(13)
    words = ["the", "The", "a", "#", "x|y", "né", "12", "日本", "END.", "!!", "<b>", "\x1c", "\xa0", "İ"]
    rows = [(None, "one two three"), (0, None), (1, ""), (2, " \n\t\n "), (3, "a b c d e a b c d e"), (4, "a " * 3000)]
    rows += [(5, "line one\nline one\n\n line one\nline two"), (5, "line one\nline one\n\n line one\nline two"), (6, "a b c d e\nf a b c d\te")]
    rows += [(7, "w" * 5000), (8, "a\rb\n\r\na\rb"), (9, "é#*$%&|<>!!" * 30)]
    for i in range(10, 160):
        some = words[: rnd.choice([2, 4, 14])]
        rows.append((i, "".join(rnd.choice(some) + rnd.choice([" ", " ", "\n", "  "]) for _ in range(rnd.randint(0, 60)))))
    return rows


ROWS = texts()


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    places = collections.defaultdict(list)
    for i in range(len(words) - 4):
        places[tuple(words[i : i + 5])].append(i)
    again = {i + k for at in places.values() if len(at) > 1 for i in at for k in range(5)}
    return (
        len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines), len(lines) - len(set(lines)),
        len(again), len(set(words)), sum(any(c.isalpha() for c in w) for w in words),
    )


@pytest.fixture(scope="module")
def docs(spark):
    df = spark.createDataFrame(ROWS, "doc_id long, text string").repartition(3)
    return df.select("*", *[F.lit(1).alias(n) for n in ("pattern", "quality", "kept", "n_words", "count", "x.y")])


def test_query(spark, docs, tmp_path):
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    found = qv.op13_quality_votes(spark, str(tmp_path))
    shown = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    expected = []
    for doc_id, text in ROWS:
        n, chars, symbols, _, dups, again, _, _ = brute(text)
        expected.append((doc_id, n, chars, symbols, dups, again, n < 10 or 100 * again > 20 * n))
    assert sorted(map(tuple, found.select(*shown).collect()), key=str) == sorted(expected, key=str)
    assert found.filter("kept and base_failed").count() == found.filter("kept is null").count() == 0


def test_figures(docs, monkeypatch):
    monkeypatch.setattr("regiofact.llm.periodic_runs.GROUP", 100)
    found = qv.figures(docs).select("doc_id", *qv.FIGURES[:8]).collect()
    assert sorted(map(tuple, found), key=str) == sorted(((i, *brute(t)) for i, t in ROWS), key=str)
    assert qv.judged(docs.filter("doc_id = -1")).count() == 0


def test_estimate_finds_kinds_of_bad_documents():
    rnd = np.random.default_rng(4)
    m, n = 6, 20_000
    kind = rnd.choice([0, 1, 2], n, p=[0.85, 0.1, 0.05])
    fails = np.full((3, m), 0.02)
    fails[1, [0, 1]] = 0.8  # one kind fails two rules, the other one
    fails[2, 4] = 0.95
    votes = np.where(rnd.random((n, m)) < fails[kind], 1, 2) * (rnd.random((n, m)) < 0.9)
    patterns, times = np.unique(votes @ 3 ** np.arange(m), return_counts=True)
    assert (qv.digits(patterns, m) @ 3 ** np.arange(m) == patterns).all()
    model = qv.estimate(qv.digits(patterns, m), times.astype(float))
    assert abs(model.shares[0] - 0.85) < 0.02
    assert model.fails[0].max() < 0.06
    right = (model.posterior(votes) >= 0.5) == (kind == 0)
    assert right.mean() > 0.9
    # a document on which a rule fails that fails on many good ones is good all the same
    assert model.posterior(np.array([[2, 2, 1, 2, 2, 2], [1, 1, 2, 2, 2, 2], [0, 0, 0, 0, 0, 0]])).round(1).tolist()[:2] == [1.0, 0.0]


def test_without_votes():
    none = qv.estimate(np.zeros((0, 10), dtype=np.int64), np.zeros(0))
    assert none.shares.sum() == pytest.approx(1)


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")
def test_verdicts_agree_with_labels(spark):
    larger = SF_DIR.replace("sf0.001", "sf0.01")
    found = qv.op13_quality_votes(spark, larger)
    labels = spark.read.parquet(f"{larger}/labels.parquet").select("doc_id", F.col("quality").alias("label"))
    judged = found.join(labels, "doc_id").filter("not base_failed")
    good, bad = judged.filter("label = 1"), judged.filter("label = 0")
    assert good.filter("kept").count() >= 0.98 * good.count() > 0
    assert bad.filter("not kept").count() >= 0.9 * bad.count() > 0
