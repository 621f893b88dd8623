"""Alignment of two vocabularies against both libraries on whole texts."""

import collections
import hashlib
import random

import pytest
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from regiofact.llm import alignment
from regiofact.llm.base import tokenizer
from regiofact.llm.token_counts import _byte_letters

A, B = tokenizer("byte_bpe_50k.json"), tokenizer("piece_bpe_32k.model")
PIECES = [
    " ", "  ", "\n", "\n\n", "'re", "'", "s", "ab", "É", "12", "!", "<|endoftext|>", "日本", "\t", " the", "😀", "\x1c",
    "\x85", "▁", "<0x0A>", "\r\n", "\xa0", "_", "\x00", "ﬁ", "é", " international", "</s>", "<unk>", "　", "﻿",
]


def rows():
    rnd = random.Random(12)
    out = [(0, None), (1, ""), (2, " "), (3, "\n"), (4, "a "), (5, "a\n"), (6, "word " * 5000), (None, "the the"), (7, "the the")]
    out += [(7, "the the"), (8, "x" * 3000), (9, "the\nthe"), (10, "  the \n the  "), (11, "▁"), (12, "same text"), (13, "same text")]
    return out + [(20 + i, "".join(rnd.choice(PIECES) for _ in range(rnd.randint(0, 12)))) for i in range(150)]


ROWS = rows()


def expected(table):
    """(doc_id, n_a, n_b, groups, links) of every row, then the row of the query."""
    one, other = Tokenizer.from_file(A), SentencePieceProcessor(model_file=B)
    one.encode_special_tokens = True
    letters = {c: i for i, c in enumerate(_byte_letters())}
    aligned, counts = [], collections.Counter()
    for doc_id, text in table:
        found = one.encode(" " + text, add_special_tokens=False) if text else None
        a = [(i, bytes(letters[c] for c in t)) for i, t in zip(found.ids, found.tokens, strict=True)] if text else []
        b = [
            (i, bytes([int(p[3:5], 16)]) if other.is_byte(i) else p.replace("▁", " ").encode())
            for i, p in ((i, other.id_to_piece(i)) for i in other.encode(text))
        ] if text else []
        whole = (" " + (text or "")).encode()
        if not text or b"".join(t for _, t in a) != whole or b"".join(t for _, t in b) != whole:
            a = b = []
        ends = []
        for tokens in (a, b):
            at, places = 0, {}
            for k, (_, t) in enumerate(tokens):
                at += len(t)
                places[at] = k
            ends.append(places)
        groups, links, i, j = [], [], 0, 0
        for at in sorted(set(ends[0]) & set(ends[1])):
            x, y = ends[0][at], ends[1][at]
            groups.append(",".join(str(t[0]) for t in a[i : x + 1]) + "|" + ",".join(str(t[0]) for t in b[j : y + 1]))
            links.append((a[x][0], b[y][0]))
            i, j = x + 1, y + 1
        counts.update(links)
        aligned.append((doc_id, len(a), len(b), groups, links))
    most = collections.Counter()
    for (_, b), n in counts.items():
        most[b] = max(most[b], n)
    return [
        (
            doc_id, n_a, n_b, len(groups), len(links), sum(counts[p] == most[p[1]] for p in links),
            sum(counts[p] for p in links), hashlib.sha256(";".join(groups).encode()).hexdigest() if n_a else "",
        )
        for doc_id, n_a, n_b, groups, links in aligned
    ]


@pytest.fixture(scope="module")
def docs(spark):
    df = spark.createDataFrame(ROWS, "doc_id long, text string").repartition(3)
    return df.select("*", *[F.lit(1).alias(n) for n in ("key", "copies", "n_a", "links", "groups", "x.y")])


def test_query(spark, docs, tmp_path):
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    found = alignment.op12_alignment(spark, str(tmp_path))
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert found.columns == names
    assert sorted(map(tuple, found.collect()), key=str) == sorted(expected(ROWS), key=str)


def test_small_memory(spark, docs, monkeypatch):
    whole = sorted(map(str, alignment.alignments(docs, A, B).collect()))
    for name, value in (("MEMORY", 3), ("LONGEST", 2)):
        monkeypatch.setattr(alignment, name, value)
    few = alignment.Aligner(A, B)
    texts = [t for _, t in ROWS if t and len(t) < 1000]
    assert [r for t in texts for r in few.of([t])] == alignment.Aligner(A, B).of(texts)
    assert len(whole) == len(ROWS)


def test_without_borders(spark):
    # a vocabulary whose pieces reach over borders is applied to whole texts
    some = alignment.Aligner(A, B)
    texts = [t for _, t in ROWS if t]
    by_stretch = some.of(texts)
    some.both.in_stretches = False
    some.known.clear()
    assert some.of(texts) == by_stretch


def test_without_texts(docs):
    assert alignment.alignments(docs.filter("doc_id = -1"), A, B).count() == 0
    found = alignment.alignments(docs.filter("doc_id < 2"), A, B).collect()
    assert sorted(map(tuple, found)) == [(0, 0, 0, 0, 0, 0, 0, ""), (1, 0, 0, 0, 0, 0, 0, "")]
