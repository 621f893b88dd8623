"""Operators on embeddings and pages, the queries, and the pipeline."""

import os
import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as spark_entry
import corpus_pipeline
from regiofact.llm import embedding_dedup, neighbours, urls
from workloads.compare import difference, oracle_rows, spark_rows

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
rng = np.random.default_rng(9)


def vectors():
    """(vec_id, embedding, label): clusters, copies, and rows that take no part."""
    rows = []
    for c in range(6):
        centre = rng.normal(size=16)
        rows += [(centre + rng.normal(scale=0.05 * (i % 4), size=16)).tolist() for i in range(12)]
    rows += [rng.normal(size=16).tolist() for _ in range(60)]
    rows += [rows[0]] * 30 + [[2 * x for x in rows[0]], [1e200 * x for x in rows[0]]]
    out = [(i, v, i % 2) for i, v in enumerate(rows)]
    nan, inf = float("nan"), float("inf")
    odd = [None, [], [0.0] * 16, [nan] + [1.0] * 15, [None] + [1.0] * 15, [inf] + [1.0] * 15, [1.0, 0.0], [1.0, 0.1]]
    out += [(1000 + i * 50, v, 0) for i, v in enumerate(odd)]
    out += [(2000, rows[0], None), (None, rows[0], 0)]
    return out


VECTORS = vectors()


@pytest.fixture(scope="module")
def embeddings(spark):
    df = spark.createDataFrame(VECTORS, "vec_id long, embedding array<double>, label int").repartition(3)
    return df.withColumns({n: F.lit(1) for n in ("part", "rep", "t", "rank", "dims")})


def unit(v):
    if not v or any(x is None or not np.isfinite(x) for x in v) or not any(v):
        return None
    v = np.array(v) / np.abs(v).max()
    return v / np.linalg.norm(v)


def test_embedding_dedup(embeddings, monkeypatch):
    units = {i: (unit(v), label) for i, v, label in VECTORS if i is not None}
    links = {i: set() for i in units}
    for i, (a, x) in units.items():
        for j, (b, y) in units.items():
            if i != j and a is not None and b is not None and x is not None and x == y and len(a) == len(b):
                if a @ b >= 0.93:
                    links[i].add(j)
    expected = []
    for i in links:
        seen, todo = {i}, [i]
        while todo:
            new = links[todo.pop()] - seen
            seen |= new
            todo += new
        expected.append((i, len(links[i]), min(seen), min(seen) == i))
    expected.append((None, 0, None, False))
    assert any(e[1] > 20 for e in expected)
    for block, bucket in ((1024, 256), (8, 8)):  # one block per bucket, then several
        monkeypatch.setattr(embedding_dedup, "BLOCK", block)
        monkeypatch.setattr(embedding_dedup, "BUCKET", bucket)
        found = [tuple(r) for r in embedding_dedup.near_duplicates(embeddings, 0.93).collect()]
        assert sorted(found, key=str) == sorted(expected, key=str)
    assert embedding_dedup.near_duplicates(embeddings.filter("vec_id < 0"), 0.93).count() == 0


def exact(rows, k):
    known = {i: u for i, v, _ in rows if i is not None and (u := unit(v)) is not None}
    for q, a in known.items():
        if q % 50 == 0:
            near = [(-round(float(a @ b), 9), i) for i, b in known.items() if i != q and len(a) == len(b)]
            for rank, (score, i) in enumerate(sorted(near)[:k], 1):
                yield q, rank, i, -score


def test_nearest(embeddings, monkeypatch):
    monkeypatch.setattr(neighbours, "BLOCK", 50)
    monkeypatch.setattr(neighbours, "QUERIES", 2)
    found = neighbours.nearest(embeddings, embeddings.filter("vec_id % 50 = 0"), 5).collect()
    rows = sorted((r.query_id, r["rank"], r.vec_id, round(r.score, 9)) for r in found)
    assert rows == sorted(exact(VECTORS, 5))
    none = embeddings.filter("vec_id < 0")
    assert neighbours.nearest(none, none, 5).count() == 0


def test_nearest_recall(spark):
    centres = rng.normal(size=(40, 24))
    x = centres[rng.integers(0, 40, 6000)] + rng.normal(scale=0.4, size=(6000, 24))
    rows = [(i, v) for i, v in enumerate(x.tolist())]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    settings = neighbours.Settings(sample=2000, rows=500)
    router = neighbours.fit(df.selectExpr("vec_id AS id", "embedding AS vector"), settings)
    assert router.weights.shape[1] == 12 and router.visits < 12
    found = neighbours.nearest(df, df.filter("vec_id % 50 = 0"), 5, settings).collect()
    got = {(r.query_id, r.vec_id) for r in found}
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    scores = u[::50] @ u.T
    scores[np.arange(120), np.arange(0, 6000, 50)] = -2
    want = {(50 * i, int(j)) for i, row in enumerate(scores) for j in np.argsort(-row)[:5]}
    assert len(got & want) / len(want) >= 0.9


def test_balanced_parts():
    x = rng.normal(size=(300, 8))
    part = neighbours.balanced_parts(neighbours.nearest_in(x, x, 5), 7, np.random.default_rng(0))
    assert np.bincount(part, minlength=7).max() <= 46 and (part >= 0).all()


URLS = [
    (1, "http://a.example.org/es/1", "a.example.org", "/es/1", "example.org/es/", "block"),
    (2, "https://example.org/en/1x?q#f", "example.org", "/en/1x", "example.org/en/1", "block"),
    (3, "http://WWW.Example.COM/de/", "www.example.com", "/de/", "com/de/", "block"),
    (4, "http://x.com/fr/a://b", "x.com", "/fr/a://b", "com/fr/", "allow"),
    (5, "ftp://notexample.org/es/", "notexample.org", "/es/", "org/", "allow"),
    (6, "http://example.org", "example.org", "", None, "allow"),
    (7, "no host", "", "", None, "allow"),
    (8, None, "", "", None, "allow"),
    (9, "http://bad.net?x/y", "bad.net", "", None, "block"),
    (None, "http://bad.net/de/1", "bad.net", "/de/1", None, "block"),
]


def test_urls(spark):
    more = [(100 + i, f"http://bad.net/{i}") for i in range(40)] + [(200 + i, f"http://good{i}.net/") for i in range(40)]
    pages = spark.createDataFrame([r[:2] for r in URLS] + more, "page_id long, url string").withColumn("host", F.lit(1))
    labels = [(100 + i, 1) for i in range(40)] + [(200 + i, 0) for i in range(40)] + [(100, 0), (None, 1)]
    found = urls.judge(pages, spark.createDataFrame(labels, "page_id long, bad int"))
    rows = [tuple(r) for r in found.filter("page_id is null or page_id < 100").collect()]
    assert sorted(rows, key=str) == sorted([(r[0], *r[2:]) for r in URLS], key=str)
    none = urls.judge(pages.limit(0), spark.createDataFrame([], "page_id long, bad int"))
    assert none.count() == 0


def test_rules_of_the_contract(spark):
    """Each rule's own page, whose verdict the contract names, by the code and by its SQL."""
    pages = [
        ("http://a.org/x", "org/", "allow"),
        ("http://a.example.org/es/x", "example.org/es/", "block"),
        ("http://a.example.org/en/1", "example.org/en/1", "block"),
        ("http://a.com/fr/x", "com/fr/", "allow"),
        ("http://a.com/de/x", "com/de/", "block"),
    ]
    made = spark.createDataFrame([(i, p[0]) for i, p in enumerate(pages)], "page_id long, url string")
    found = urls.judge(made, spark.createDataFrame([], "page_id long, bad int")).orderBy("page_id").collect()
    assert [(r.rule, r.verdict) for r in found] == [p[1:] for p in pages]
    with duckdb.connect() as db:
        db.execute("CREATE TABLE pages (page_id BIGINT, url VARCHAR)")
        db.execute("CREATE TABLE labels (doc_id BIGINT, quality INTEGER, toxic INTEGER)")
        db.executemany("INSERT INTO pages VALUES (?, ?)", [(i, p[0]) for i, p in enumerate(pages)])
        rows = db.execute(f"SELECT rule, verdict FROM ({urls.ORACLE}) ORDER BY page_id").fetchall()
    assert rows == [p[1:] for p in pages]


QUERIES, ORACLES = spark_entry.queries(), spark_entry.oracle_sql()
NAMES = sorted(n for n in QUERIES if n.startswith("op") or n == "pipeline")


def test_registered():
    assert {n.split("_")[0] for n in NAMES if n != "pipeline"} == {f"op{i}" for i in range(1, 14)}


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")
@pytest.mark.parametrize("name", sorted(ORACLES.keys() & set(NAMES)))
def test_query_matches_sql(spark, name):
    columns, found = spark_rows(QUERIES[name](spark, SF_DIR))
    expected_columns, expected = oracle_rows(SF_DIR, ORACLES[name])
    assert columns == expected_columns and difference(found, expected) is None


def test_pipeline(spark, tmp_path):
    random.seed(2)
    words = ["the", "thing", "and", "shore", "house", "river", "of", "to"]
    text = lambda n: " ".join(random.choice(words) for _ in range(n))
    copy, passage = text(80), text(60)
    rows = [(i, text(120), "en") for i in range(40)]
    rows += [(50, copy, "en"), (51, copy, "en"), (60, text(90) + passage + text(70), "en"), (61, text(50) + passage, "en")]
    rows += [(70, "123 456", None), (71, None, None), (72, text(40) + " password=abc123xyz " + text(40), "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    docs = docs.withColumns({"source": F.lit("s"), "n_chars": F.length("text").cast("long")})
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    kept, at = {}, docs
    for name, stage in corpus_pipeline.STAGES:
        at = corpus_pipeline.stored(stage(spark, at, str(tmp_path)), name)
        kept[name] = at
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "language_id", "simhash_near_dedup", "suffix_array_dedup", "secret_scan", "packing"
    ]
    for name in list(kept)[:-1]:
        assert kept[name].columns == docs.columns
    ids = lambda name: {r.doc_id for r in kept[name].select("doc_id").collect()}
    assert ids("language_id") == {r[0] for r in rows} - {70, 71}
    assert 50 in ids("simhash_near_dedup") and 51 not in ids("simhash_near_dedup")
    texts = {r.doc_id: r.text for r in kept["secret_scan"].collect()}
    assert passage not in texts[60] + texts[61] and "[SECRET]" in texts[72] and "abc123xyz" not in texts[72]
    packed = spark_entry.queries()["pipeline"](spark, str(tmp_path))
    same = ["doc_id", "start", "length", "ids_crc32"]
    assert sorted(map(tuple, packed.select(same).collect())) == sorted(map(tuple, kept["packing"].select(same).collect()))
