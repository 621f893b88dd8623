"""Operators on documents against brute force, with odd rows of every kind."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from regiofact.llm import bpe, language, packing, secrets, simhash, suffix_dedup, token_counts
from regiofact.llm.base import tokenizer
from regiofact.llm.components import components

BYTE, WORD = tokenizer("byte_bpe_50k.json"), tokenizer("word_bpe_49k.json")
random.seed(5)
LINE = "".join(random.choice("abcdefgh ") for _ in range(900))
PIECES = [
    " ", "  ", "\n", "'re", "'", "s", "ab", "É", "12", "!", "<|endoftext|>", "日本", "ẋ", "\t", " the",
    "😀", "\x1c", "\x85", "'LL", "<|endof", "İ", "ΑΣ", "²", "½", "ǅ", "<|startoftext|>", "_", "\xad",
]
MIXED = ["".join(random.choice(PIECES) for _ in range(random.randint(0, 9))) for _ in range(60)]

ROWS = [
    (1, LINE, "en"), (2, LINE[:450] + LINE[460:], "en"), (2, LINE, "en"), (None, LINE[100:320], None),
    (4, "x" * 150 + LINE[300:499] + "y" * 150, "de"), (5, "q" * 50 + LINE[300:500] + "z" * 60, "de"),
    (6, None, "fr"), (7, "", None), (8, "a" * 5000, "fr"), (9, "a" * 199, None), (10, "é" * 150, "es"),
    (11, "the passage " * 30, "en"), (12, "w" + ("the passage " * 30)[:201], "en"), (13, "   \n\t ", None),
    (14, "".join(random.choice("ab") for _ in range(3000)), "es"), (15, LINE[50:251] + "日本" * 100, "de"),
    (16, "One two three four", "en"), (17, "one TWO three four", "en"), (18, "x " * 20_000, "en"),
    *((100 + i, t, "en") for i, t in enumerate(MIXED)),
]


@pytest.fixture(scope="module")
def docs(spark):
    """Odd documents, with extra columns whose names the operators use themselves."""
    df = spark.createDataFrame(ROWS, "doc_id long, text string, lang string").repartition(3)
    extra = ["inner", "k1", "f", "n_tokens", "block", "spans", "score", "ranges", "n", "dotted.name"]
    return df.select("*", F.lit("s").alias("source"), F.lit(1).alias("n_chars"), *[F.lit(1).alias(n) for n in extra])


@pytest.fixture(scope="module")
def none(docs):
    return docs.filter("doc_id = -1")


def same(df, expected):
    key = lambda r: tuple(map(str, r))
    assert sorted(map(tuple, df.collect()), key=key) == sorted(map(tuple, expected), key=key)


def sha(text):
    return hashlib.sha256(text.encode() if isinstance(text, str) else text).hexdigest()


def test_token_counts(docs, none):
    library = Tokenizer.from_file(BYTE)
    counts = [(i, len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False).ids)) for i, t, _ in ROWS]
    same(token_counts.count_tokens(docs, BYTE, 512), [(*c, c[2] > 512) for c in counts])
    assert token_counts.count_tokens(none, BYTE, 512).count() == 0


def test_prefixes(docs):
    library = Tokenizer.from_file(BYTE)
    short = docs.filter("length(text) < 60")
    table = token_counts.prefix_table(short, BYTE)
    texts = {i: t for i, t, _ in ROWS if t is not None and len(t) < 60}
    for row in table.collect():
        text = texts[row.doc_id]
        expected = [len(library.encode(text[:i], add_special_tokens=False).ids) for i in range(len(text) + 1)]
        assert row.prefix_tokens == expected, text
    for row in token_counts.longest_prefix(table, 3).collect():
        text = texts[row.doc_id]
        fits = [i for i in range(len(text) + 1) if len(library.encode(text[:i], add_special_tokens=False).ids) <= 3]
        assert row.n_chars == fits[-1]


def test_bpe(docs, none):
    library = Tokenizer.from_file(WORD)
    expected = []
    for i, t, _ in ROWS:
        ids = library.encode(t or "", add_special_tokens=False).ids
        expected.append((i, ids, library.decode(ids, skip_special_tokens=False)))
    same(bpe.encode_decode(docs, WORD), expected)
    same(bpe.encode_decode(docs.filter("doc_id in (6, 7)"), WORD), [(6, [], ""), (7, [], "")])
    assert bpe.encode_decode(none, WORD).count() == 0


def test_small_blocks(docs, monkeypatch):
    monkeypatch.setattr(bpe, "BLOCK", 300)
    monkeypatch.setattr(bpe, "ROW", 2)
    sizes = {i: len(Tokenizer.from_file(WORD).encode(t or "", add_special_tokens=False).ids) for i, t, _ in ROWS if i != 2}
    found = bpe.encode_decode(docs.filter("doc_id <> 2"), WORD).select("doc_id", F.size("ids"))
    same(found, [(i, n) for i, n in sizes.items() if i is not None])


def test_packing(docs, none):
    library = Tokenizer.from_file(WORD)
    for window in (64, 4096):
        rows = packing.packed(docs.filter("doc_id is not null and doc_id <> 2"), WORD, window).collect()
        pieces, sequences = collections.defaultdict(list), collections.defaultdict(list)
        for r in rows:
            pieces[r.doc_id].append(r)
            sequences[r.sequence_id].append((r.offset, r.length))
        for i, t, _ in ROWS:
            if i is None or i == 2:
                continue
            ids = np.array([*library.encode(t or "", add_special_tokens=False).ids, 2], dtype="<u4")
            at = 0
            for r in sorted(pieces.pop(i), key=lambda r: r.start):
                assert (r.start, r.doc_tokens) == (at, len(ids)) and r.length > 0
                assert r.ids_crc32 == zlib.crc32(ids[at : at + r.length].tobytes())
                at += r.length
            assert at == len(ids)
        assert not pieces
        for parts in sequences.values():
            at = 0
            for offset, length in sorted(parts):
                assert offset == at
                at += length
            assert at <= window and (at == window or at & (at - 1) == 0)
    assert packing.packed(docs, WORD).agg(F.count_distinct("sequence_id")).first()[0] > 0
    assert packing.packed(none, WORD).count() == 0


def test_packing_takes_neighbours():
    topic = [np.array([t] * 5 + [7], dtype="<u4") for t in (1, 2, 1, 2, 1, 2)]
    pieces = packing.pack(topic, 18)
    order = [p[0] for p in pieces if p[3] == 0]
    assert order == [0, 2, 4]


def test_packing_scores_all_terms():
    """A seed of many heavy terms of its own still meets the document that shares a light one."""
    docs = [np.array([*range(10, 60), 5, 2]), np.array([70, 71, 2]), np.array([72, 5, 2]), np.array([73, 5, 2])]
    docs = [d.astype("<u4") for d in docs]
    index = packing.Index(docs, packing.corpus_of(docs))
    unused = np.array([False, True, True, True])
    assert index.ranked(0, unused).tolist() == [2, 3, 1]
    held = np.ones(100, dtype=np.int64)
    held[5], held[2] = 900, 4  # what is rare here is frequent in the corpus
    assert packing.Index(docs, packing.Corpus(held, 1000, 20_000)).ranked(0, unused)[-1] == 1


def test_packing_meets_related_documents_of_other_splits(spark):
    """Shards of two documents each: the topics lie in different splits, and meet nevertheless."""
    topics = [" ".join(w for _ in range(20)) for w in ("harbour", "violin", "glacier", "pepper", "copper", "window")]
    rows = [(100 * split + t, f"{topic} number") for split in range(4) for t, topic in enumerate(topics)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartitionByRange(4, "doc_id")
    assert docs.rdd.getNumPartitions() == 4
    with_sequence = collections.defaultdict(set)
    for r in packing.packed(docs, WORD, 64, shard=100).collect():
        with_sequence[r.sequence_id].add(r.doc_id)
    together = [{i % 100 for i in ids} for ids in with_sequence.values() if len(ids) > 1]
    assert sum(len(t) == 1 for t in together) >= len(together) / 2 > 2


def passages(texts, window=200):
    counts = collections.Counter(t[p : p + window] for t in texts for p in range(len(t) - window + 1))
    for t in texts:
        covered = bytearray(len(t))
        for p in range(len(t) - window + 1):
            if counts[t[p : p + window]] > 1:
                covered[p : p + window] = b"\1" * window
        kept = bytes(x for x, y in zip(t, covered, strict=True) if not y)
        spans = sum(c and not (i and covered[i - 1]) for i, c in enumerate(covered))
        yield len(t), sum(covered), spans, sha(kept)


def test_passages(docs, none):
    columns = ("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256))
    some = [r for r in ROWS if r[0] != 18]
    expected = [(r[0], *p) for r, p in zip(some, passages([(r[1] or "").encode() for r in some]), strict=True)]
    found = suffix_dedup.without_repeats(docs.filter("doc_id is null or doc_id <> 18"))
    same(found.select(*columns), expected)
    assert suffix_dedup.without_repeats(none).count() == 0


def test_passages_in_stretches(monkeypatch):
    """Phrases of a long text do not depend on where it is cut, once they are resolved."""
    monkeypatch.setattr(suffix_dedup, "STRETCH", 256)
    text = (LINE * 3).encode()
    found = set()
    for data, starts, ends, _, offsets in suffix_dedup._stretches([text, b"", b"short"]):
        doc, _, _, _, first, last = suffix_dedup.phrases(data, starts, ends)
        for d, a, b in zip(doc, first, last, strict=True):
            found |= {offsets[d] + x - starts[d] for x in range(a, b + 1)}
    assert found == set(range(len(text) - 199))


def test_passages_of_long_texts(spark):
    """Texts of many stretches: phrases that a stretch border parts share a trigger, and are cut apart."""
    rng = random.Random(3)
    letters = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    shared = [letters(n) for n in (260, 205, 700)]
    texts = [letters(rng.randint(50, 900)).join(rng.sample(shared, 3)) + letters(1500) for _ in range(8)]
    texts += [texts[0][300:1900] + letters(400), letters(3000), "ab" * 700]
    expected = [(i, *p) for i, p in enumerate(passages([t.encode() for t in texts]))]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    columns = ("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256))
    for stretch in (150, 256, 1000):
        same(suffix_dedup.without_repeats(docs, stretch).select(*columns), expected)


def test_shortened(docs):
    rows = {r.doc_id: r for r in suffix_dedup.shortened(docs.filter("doc_id in (1, 5, 6, 7, 16)")).collect()}
    assert rows[6].text is None and rows[7].text == "" and rows[16].text == "One two three four"
    assert rows[5].text == "q" * 50 + "z" * 60 and rows[5].n_chars == 110


def plain_fingerprint(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    runs = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64(r.encode(), seed=42).intdigest() for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash(docs, none):
    prints = [(i, plain_fingerprint(t)) for i, t, _ in ROWS]
    group = {f: f for _, f in prints}
    changed = True
    while changed:
        changed = False
        for a in group:
            for b in group:
                if (a ^ b).bit_count() <= 2 and group[a] != group[b]:
                    group[a] = group[b] = min(group[a], group[b])
                    changed = True
    least = {}
    for i, f in prints:
        ids = [j for j, g in prints if group[g] == group[f] and j is not None]
        least[f] = min(ids, default=None)
    same(simhash.near_duplicates(docs), [(i, f"{f:016x}", least[f]) for i, f in prints])
    assert simhash.near_duplicates(none).count() == 0


def test_masks_cover():
    masks = simhash.masks()
    assert len(masks) == 7
    for i in range(64):
        for j in range(i):
            assert any(not m >> i & 1 and not m >> j & 1 for m in masks)


def test_links_of_near_values(spark):
    base = random.getrandbits(63)
    values = [base, base ^ 1, base ^ 3 << 5, base ^ 7 << 20, base ^ 1 ^ 1 << 62 ^ 1 << 40, 0, 7, 1 << 63]
    signed = [simhash._signed(v) for v in values]
    pairs = simhash.links(spark.createDataFrame([(v,) for v in signed], "f long"))
    found = {r.node: r.component for r in components(pairs).collect()}
    groups = [{found.get(v, v) for v in signed[:3]}, {found.get(v, v) for v in (signed[0], signed[4])}]
    assert [len(g) for g in groups] == [1, 1]
    assert found.get(signed[3], signed[3]) != found[signed[0]]
    assert signed[6] not in found and found[signed[7]] == found[signed[5]] if signed[7] in found else True


def test_representatives(docs):
    kept = [r.doc_id for r in simhash.representatives(docs).collect()]
    assert 16 in kept and 17 not in kept and None in kept and len(set(kept)) == len(kept)


def test_representatives_of_repeated_ids(spark):
    """Of two texts with one doc_id, a copy of another document goes and the other one stays."""
    texts = ["a b c d e f", "a b c d e f", "g h i j k l", "m n o p q r", "m n o p q r"]
    rows = list(zip([1, 2, 2, 2, 3], texts, strict=True))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    docs = docs.withColumns({"lang": F.lit("en"), "source": F.lit("s"), "n_chars": F.lit(11)})
    kept = simhash.representatives(docs)
    same(kept.select("doc_id", "text"), [(1, texts[0]), (2, texts[2]), (2, texts[3])])


def edited_copies():
    """(doc_id, text): texts with copies of which 0 to 6 % of the words are replaced, and a large group."""
    rng = random.Random(11)
    word = lambda: f"w{rng.randrange(5000)}"
    texts = []
    for n in (4, 30, 120, 300, 700) * 4:
        base = [word() for _ in range(n)]
        texts.append(base)
        for share in (0.005, 0.01, 0.02, 0.03, 0.06):
            texts.append([word() if rng.random() < share else w for w in base])
    base = [word() for _ in range(150)]
    texts += [[word() if rng.random() < rng.choice((0.01, 0.03)) else w for w in base] for _ in range(60)]
    return [(i, " ".join(t)) for i, t in enumerate(texts)] + [(900, None), (901, "  "), (902, "One two")]


def test_representatives_of_edited_copies(spark):
    """One text of each component of fingerprints at two bits stays, for copies edited more or less."""
    rows = edited_copies()
    prints = {i: plain_fingerprint(t) for i, t in rows}
    least = {i: i for i in prints}
    for _ in prints:
        before = dict(least)
        for a in prints:
            for b in prints:
                if (prints[a] ^ prints[b]).bit_count() <= 2:
                    least[a] = least[b] = min(least[a], least[b])
        if before == least:
            break
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns(
        {"lang": F.lit("en"), "source": F.lit("s"), "n_chars": F.lit(1), "f": F.lit(2), "k": F.lit(3), "c": F.lit(4)}
    )
    found = {r.doc_id: r.component_id for r in simhash.near_duplicates(docs).collect()}
    assert found == least and len(set(least.values())) < len(least) - 10
    assert {r.doc_id for r in simhash.representatives(docs).collect()} == set(least.values())
    by_word = {r.doc_id: r.fingerprint for r in simhash.near_duplicates(docs, size=1).collect()}
    assert by_word[902] != f"{prints[902]:016x}" and by_word[900] == "0" * 16


def test_components(spark):
    edges = [(i, i + 1) for i in range(1, 60)] + [(100, 99), (99, 100), (5, 5), (None, 3), (200, 201), (300, 300)]
    edges += [(1000, i) for i in range(1001, 1200)]
    found = {r.node: r.component for r in components(spark.createDataFrame(edges, "x long, y long")).collect()}
    expected = {i: 1 for i in range(1, 61)} | {99: 99, 100: 99, 200: 200, 201: 200}
    assert found == expected | {i: 1000 for i in range(1000, 1200)}
    assert components(spark.createDataFrame([], "x long, y long")).count() == 0


SECRETS = [
    "password=abc123", "password=abc12", 'TOKEN: "ab-cd_ef.gh"', "api_key=xyz123 apikey = 'qqqqqq'", "AKIA" + "A" * 16,
    "AKIA" + "A" * 15, "0" * 24, "g" + "0a" * 12 + "g", "secret=" + "f" * 30, "é password:é password: geheim1", "passwd=",
    "pwd: Xk9#mQ2$vL8p!", "auth_token = hello", "ſecret=abcdefg", None, "", "token=AKIA" + "Z" * 20,
]


def test_secrets(spark):
    patterns = [
        ("assign", re.compile(r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""), 6, 2),
        ("access", re.compile(r"AKIA[A-Z0-9]+"), 20, 0), ("hex", re.compile(r"[0-9a-f]+"), 24, 0),
    ]
    expected = []
    for i, text in enumerate(SECRETS):
        spans, counts = [], []
        for order, (kind, pattern, least, g) in enumerate(patterns):
            found = [m for m in pattern.finditer(text or "") if len(m[g]) >= least]
            counts.append(len(found))
            spans += [(m.start(), order, f"{kind}:{m.start()}:{m.end()}") for m in found]
        expected.append((i, *counts, sha(",".join(s for _, _, s in sorted(spans)))))
    rows = spark.createDataFrame(list(enumerate(SECRETS)), "doc_id long, text string")
    same(secrets.scan(rows).drop("spans"), expected)
    spans = {r.doc_id: r.spans for r in secrets.scan(rows).collect()}
    assert spans[11] == "guess:5:17" and spans[12] == "" and spans[0] == "assign:0:15"
    texts = rows.withColumns({"lang": F.lit("en"), "source": F.lit("s"), "spans": F.lit(1)})
    kept = {r.doc_id: r for r in secrets.redacted(texts).collect()}
    assert kept[14].text is None and kept[0].text == "[SECRET]" and kept[1].text == SECRETS[1]
    assert kept[16].text == "[SECRET]" and kept[11].n_chars == len(kept[11].text)


HARD_VALUES = ("Xk9#mQ2$vL8p", "v8R$kw2Zq!Lt")
RUNS = [
    ('{"password":"letmein1","title":"Xclean","n":12345678,"x":"aB3$xY7#"}', []),
    ('{"pwd":"%s","home":"https://example.org/a","token":"%s"}', [0, 1]),
    ("user=a;pwd=%s;title=clean;Token=%s;n=12345678", [0, 1]),
    ("?pwd=%s&next=https://example.org/&auth_token=%s&page=2", [0, 1]),
    ("f(passcode='%s', clean='Zq8$kW3!pL'), credential := `%s`", [0, 1]),
    ("pwd:      %s and userPwd\t=\t%s", [0, 1]),
    ('{\\"pwd\\":\\"%s\\",\\"clean\\":\\"a\\"} accessToken == "%s"', [0, 1]),
    ('"Authorization":"Bearer %s","clean":"%s"', [0]),
    ('"passphrase": "%s and; %s", "clean": 1', [0, 1]),
    ('secret: "https://example.org/?pwd=%s&n=1" bypwd=%s', [0]),
]


def test_credentials_in_one_run():
    """Each value ends by itself; what follows it in the run is neither priced nor replaced with it."""
    for pattern, places in RUNS:
        text = pattern % HARD_VALUES[: pattern.count("%s")]
        values = [HARD_VALUES[i] for i in places]
        found = [text[s:e] for s, e, kind in secrets.spans_of(text)[1] if kind == "guess"]
        if "passphrase" in pattern:
            values = [" and; ".join(values)]
        assert found == values, text
    text = RUNS[1][0] % HARD_VALUES
    assert secrets.redact(text) == RUNS[1][0] % ("[SECRET]", "[SECRET]")
    assert secrets.redact(RUNS[0][0]) == '{"[SECRET]","title":"Xclean","n":12345678,"x":"aB3$xY7#"}'


def test_guess_costs():
    cost = secrets.guess_cost
    assert cost("passwordpassword") < cost("hunter2") < 6 < 10 < cost("Xk9#mQ2$vL8p")
    assert cost("qwertyuiop") < 6 and cost("20240101") < 6 and cost("aaaaaaaaaaaaaaaa") < 4
    assert cost("4eC39HqLyjWDarjtT1zdp7dc") > 20


def test_languages(spark):
    rng = random.Random(1)
    words = {"aa": ["the", "thing", "and", "shore"], "bb": ["der", "und", "schon", "zeit"], "cc": ["los", "que", "ción", "año"]}
    rows = [(i, " ".join(rng.choice(words[lang]) for _ in range(20)), lang) for i, lang in enumerate(sorted(words) * 60)]
    rows += [(900, None, "aa"), (901, "", "bb"), (902, "123 \u0301!", None), (903, "the thing", None), (None, "und zeit", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("score", F.lit(1))
    model = language.fit(docs, language.Settings(rows=150, words=15))
    found = {r.doc_id: r for r in language.identify(docs, model).collect()}
    assert [found[i].lang_pred for i in (900, 901, 902, 903)] == ["und", "und", "und", "aa"]
    assert found[902].rejected and not found[903].rejected and found[None].lang_pred == "bb"
    held = [r for r in rows[:180] if zlib.crc32(str(r[0]).encode()) % 5 == 0]
    assert held and all(found[i].lang_pred == lang for i, _, lang in held)
    assert all(0 <= r.score <= 1 for r in found.values())
    full = docs.withColumns({"source": F.lit("s"), "n_chars": F.lit(3)})
    assert language.accepted(full, model).count() == 182
    empty = docs.filter("doc_id < 0")
    assert language.identify(empty, language.fit(empty)).count() == 0
    unlabelled = language.fit(docs.withColumn("lang", F.lit(None).cast("string")))
    assert language.identify(docs, unlabelled).filter("lang_pred = 'und'").count() == len(rows)


def test_words_encoded_in_one_call_are_the_library_s():
    from regiofact.llm.base import tokenizer
    from regiofact.llm.packing import Ids
    from regiofact.llm.word_pieces import word_pieces

    path = tokenizer("word_bpe_49k.json")
    pieces = word_pieces(path)
    words = ["hello", "née", "''", "!?", "7", "á", "x\ty", "\x85", "unbelievabilities", "çà"]
    for some in (words, [*words, "<|endoftext|>"], [*words, "two words"], [*words, ""], []):
        ids, sizes = pieces.encode_many(some)
        expected, lengths = pieces.encode(some)
        assert ids.tolist() == expected.tolist() and sizes.tolist() == lengths.tolist()
    texts = ["", "Hello, hello! x''s don't 1234", "né,née ﬁne <|endoftext|> Hello", "\x00 a\tb <|x hello"]
    known = Ids(path)
    asked = []
    known.pieces = type("Counted", (), {
        "tokens": staticmethod(pieces.tokens), "words": staticmethod(pieces.words),
        "encode_many": staticmethod(lambda some: asked.extend(some) or pieces.encode_many(some)),
    })
    expected = [np.array([*pieces.full.encode(t, add_special_tokens=False).ids, 2], "<u4").tobytes() for t in texts]
    assert known.of(texts, 2, "<u4") == expected == known.of(texts, 2, "<u4")
    assert asked.count("hello") == 1 and len(asked) == len(set(asked))


def test_packing_looks_up_a_batch_s_distinct_words_once():
    class Counted(dict):
        asked = 0

        def get(self, key, default=None):
            Counted.asked += 1
            return super().get(key, default)

        def __getitem__(self, key):
            Counted.asked += 1
            return super().__getitem__(key)

    known = packing.Ids(WORD)
    known.known = Counted()
    texts = ["Again and again, it's " * 500, "", "again ", "\n\n"]
    library = Tokenizer.from_file(WORD)
    expected = [np.array([*library.encode(t, add_special_tokens=False).ids, 2], "<u2").tobytes() for t in texts]
    assert known.of(texts, 2, "<u2") == expected == known.of(texts, 2, "<u2")
    assert Counted.asked < 50


def test_words_of_many_texts_are_the_pattern_s():
    from regiofact.llm.word_pieces import CODE, KINDS, parted, usual, word_pieces

    pieces = word_pieces(WORD)
    rng = random.Random(3)
    parts = ["'", "'s", "'re", "'LL", "'ve", "'d", "s", "r", "l", " ", "\n", "1", "²", "!", "É", "ß", "ª", "“", "ab"]
    texts = ["", "'", "''s", "a'", "'rex'vet", *("".join(rng.choices(parts, k=rng.randint(0, 20))) for _ in range(500))]
    texts += [f"a{c}b {c}{c}'s" for c in map(chr, range(len(KINDS))) if usual(c)]
    words, ends = parted(texts)
    words, at = words.to_pylist(), 0
    assert len(ends) == len(texts)
    for text, end in zip(texts, ends, strict=True):
        assert [w.decode(CODE) for w in words[at:end] if w is not None] == pieces.split(text)
        at = end + 1
    assert parted(["", " "])[1].tolist() == [0, 2]
    # a zero, or a blank of Python's alone, is a word of the library where a text has others too
    odd = ["\0", "a \0 b", "\x1c", "日本 \x1c\0", " ", ""]
    library = Tokenizer.from_file(WORD)
    expected = [np.array([*library.encode(t, add_special_tokens=False).ids, 2], "<u2").tobytes() for t in odd]
    assert packing.Ids(WORD).of(odd, 2, "<u2") == expected


def test_packing_counts_terms_of_many_documents_at_once(spark):
    rng = np.random.default_rng(4)
    for kind, most in (("<u2", 1 << 16), ("<u4", 1 << 20)):
        docs = [rng.integers(0, rng.choice([3, most]), size=s).astype(kind) for s in [1, 70_000, 1, 300, 5, 66_000, 2]]
        owners, terms, times = map(np.concatenate, zip(*packing.terms_of(docs), strict=True))
        for i, d in enumerate(docs):
            ids, counts = np.unique(d, return_counts=True)
            assert terms[owners == i].tolist() == ids.tolist() and times[owners == i].tolist() == counts.tolist()
        corpus = packing.corpus_of(docs)
        for i, tops in enumerate(packing.heaviest(docs, corpus).T.tolist()):
            ids, counts = np.unique(docs[i], return_counts=True)
            ids, counts = ids[corpus.shared[ids]], counts[corpus.shared[ids]]
            order = np.argsort(-corpus.weights(ids, counts, len(docs[i])), kind="stable")[:2]
            assert tops == [*ids[order].tolist(), -1, -1][:2]
    # the figures of the corpus are written by the tasks that encode, with null and repeated rows
    rows = [(1, "one two two"), (1, "one two two"), (None, "three"), (4, None), (5, "")]
    texts = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = packing._corpus(texts.mapInArrow(packing._encoded(WORD, 2, "<u2"), packing.ENCODED))
    library = Tokenizer.from_file(WORD)
    docs = [np.array([*library.encode(t or "", add_special_tokens=False).ids, 2], "<u2") for _, t in rows]
    expected = packing.corpus_of(docs)
    assert (found.docs, found.tokens) == (5, sum(map(len, docs)))
    assert np.array_equal(found.idf, expected.idf) and np.array_equal(found.shared, expected.shared)
