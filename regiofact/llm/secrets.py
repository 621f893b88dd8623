"""Secret scans: fixed patterns, and values in a credential context that are hard to guess.

How hard a value is to guess is the cost of its cheapest segmentation, found by dynamic
programming: each segment is a word, a date, a repeat, a keyboard walk or brute force, and costs
the logarithm of the guesses that an attacker who knows these forms would need.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regiofact.llm.base import picked, query, table, texts_of

#: Patterns of the three base kinds, in their order, with their least lengths.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.ASCII | re.IGNORECASE,
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
KINDS = ("assign", "access", "hex")
LEAST = {"assign": 6, "access": 20, "hex": 24}

#: What introduces a credential, beyond the words of the first pattern; a border of camel case
#: starts a word too. A quoted value ends at its own closing quote on the same line, any other at a
#: blank, a separator, a closing bracket or a quote.
CONTEXT = re.compile(
    r"""(?:(?<![A-Za-z0-9])|(?-i:(?<=[a-z0-9])(?=[A-Z])))"""
    r"""(?:pass(?:word|wd|phrase|code)?|passwort|pwd|secret|token|bearer|credentials?"""
    r"""|auth(?:orization|[_-]?token)?|(?:api|access|private|secret|client|signing|encryption)"""
    r"""[_-]?(?:key|secret|token))(?:\\?["'`])?\s*(?:=>|:=|={1,3}|:)\s*(?:(?:bearer|basic)\s+)?"""
    r"""(?:(?P<quote>\\?["'`])(?:(?:bearer|basic)\s+)?"""
    r"""(?P<quoted>(?:(?!(?P=quote))(?:\\[^\r\n]|[^\\\r\n])){6,4096})(?P=quote)(?![A-Za-z0-9])"""
    r"""|(?:\\?["'`])?(?:(?:bearer|basic)\s+)?(?P<bare>[!#-%(*+\--:<-_a-|~]{6,}))""",
    re.ASCII | re.IGNORECASE,
)
HINTS = ("pass", "pwd", "secret", "token", "bearer", "credential", "auth", "key")
#: Log10 of the guesses from which a value counts as a secret.
HARD = 10.0

#: Frequent words in passwords, most frequent first.
COMMON = (
    "password pass admin user test secret token key love welcome login master letmein dragon monkey"
    " qwerty abc root guest changeme default example sample hello world summer winter spring autumn"
    " sunshine princess football baseball shadow superman batman trustno iloveyou access server"
    " database system temp demo foo bar baz value string none null true false your my the"
).split()
RANK = {w: n for n, w in enumerate(COMMON, 1)}
ROWS = ("`1234567890-=", "qwertyuiop[]", "asdfghjkl;'", "zxcvbnm,./")
NEXT = {(a, b) for r in ROWS for x, y in zip(r, r[1:], strict=False) for a, b in ((x, y), (y, x))}
DATE = re.compile(
    r"(?:19|20)\d\d[-/._]?(?:0[1-9]|1[0-2])[-/._]?(?:0[1-9]|[12]\d|3[01])"
    r"|(?:0[1-9]|[12]\d|3[01])[-/._]?(?:0[1-9]|1[0-2])[-/._]?(?:19|20)\d\d|(?:19|20)\d\d"
)
VOWELS = frozenset("aeiouy")
LETTERS = re.compile(r"[A-Za-z]+")


def _letter_cost(c: str) -> float:
    if c in "-_.":  # what joins words
        return 0.6
    return 1.0 if c.isdigit() else math.log10(26) if c.isalpha() else math.log10(33)


def _word_cost(word: str) -> float | None:
    """Rank of a known word, or 10,000 for letters that read like one; None for others."""
    low = word.lower()
    if low in RANK:
        cost = math.log10(1 + RANK[low])
    elif len(low) >= 3 and 0.2 <= sum(c in VOWELS for c in low) / len(low) <= 0.75 and (
        word.islower() or word.istitle() or word.isupper()
    ):
        cost = 4.0 + 0.35 * max(0, len(low) - 8)
    else:
        return None
    return cost if word.islower() else cost + (0.3 if word.istitle() or word.isupper() else 1.0)


@lru_cache(maxsize=10_000)
def guess_cost(value: str) -> float:
    """Log10 of the guesses that the cheapest segmentation of a value needs."""
    n = len(value)
    ends: list[list[tuple[int, float]]] = [[] for _ in range(n + 1)]  # by start: (end, cost)
    for m in LETTERS.finditer(value):
        for i in range(m.start(), m.end()):
            for j in range(i + 2, min(m.end(), i + 24) + 1):
                if (cost := _word_cost(value[i:j])) is not None:
                    ends[i].append((j, cost))
    for i in range(n):
        if m := DATE.match(value, i):
            ends[i].append((m.end(), 2.1 if m.end() - i == 4 else 4.6))
        j = i + 1
        while j < n and (value[j - 1].lower(), value[j].lower()) in NEXT:
            j += 1
        if j - i >= 3:
            ends[i].append((j, math.log10(94) + 0.5 * (j - i - 1)))
        for size in range(1, min(12, (n - i) // 2) + 1):
            j = i + size
            while value[j : j + size] == value[i : i + size]:
                j += size
            if j > i + size and (j - i) >= 3:
                block = sum(map(_letter_cost, value[i : i + size]))
                ends[i].append((j, block + math.log10((j - i) // size)))
    best = [0.0] + [math.inf] * n
    brute = [True] * (n + 1)  # whether the best way here ends in brute force
    for i in range(n):
        one = best[i] + _letter_cost(value[i]) + (0.0 if i and brute[i] else 0.3)
        if one < best[i + 1]:
            best[i + 1], brute[i + 1] = one, True
        for j, cost in ends[i]:
            if best[i] + cost + 0.3 < best[j]:
                best[j], brute[j] = best[i] + cost + 0.3, False
    return best[n]


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the three fixed patterns, by start, then kind."""
    out = []
    low = text.lower()
    if any(w in low for w in ("passw", "secret", "token", "api")):
        for m in ASSIGN.finditer(text):
            if len(m[2]) >= LEAST["assign"]:
                out.append((m.start(), m.end(), "assign"))
    if "AKIA" in text:
        out += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if len(m[0]) >= LEAST["access"]]
    if _HEX_RUN in text.translate(_HEX_MARKS):
        out += [(m.start(), m.end(), "hex") for m in HEX.finditer(text) if len(m[0]) >= LEAST["hex"]]
    return sorted(out, key=lambda s: (s[0], KINDS.index(s[2])))


_HEX_MARKS = {ord(c): "\x00" for c in "0123456789abcdef"}
_HEX_RUN = "\x00" * LEAST["hex"]


def guessed_spans(text: str, base: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    """Values in a credential context that are hard to guess and not inside a base span."""
    low = text.lower()
    if not any(w in low for w in HINTS):
        return []
    out, at = [], 0
    while m := CONTEXT.search(text, at):
        start = at = m.start(m.lastgroup)
        value = m[m.lastgroup]
        if m.lastgroup == "bare":
            value = value.rstrip(""".,;:!?)]}>"'""")
        end = start + len(value)
        if len(value) < 6 or "://" in value or any(s <= start and end <= e for s, e, _ in base):
            continue  # what is no secret as a whole may hold credentials of its own
        if guess_cost(value) >= HARD:
            out.append((start, end, "guess"))
            at = end
    return out


def spans_of(text: str) -> tuple[list[tuple[int, int, str]], list[tuple[int, int, str]]]:
    """(base spans, all spans by start)."""
    base = base_spans(text)
    added = guessed_spans(text, base)
    order = {k: i for i, k in enumerate((*KINDS, "guess"))}
    return base, sorted(base + added, key=lambda s: (s[0], order[s[2]]))


def joined(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


def redact(text: str, mark: str = "[SECRET]") -> str:
    """The text with each span, or run of overlapping spans, replaced by a mark."""
    out, at = [], 0
    for start, end, _ in spans_of(text)[1]:
        if start >= at:
            out += [text[at:start], mark]
        at = max(at, end)
    return "".join(out) + text[at:]


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans of whole texts.

    Spans are code points, end exclusive. A null text is empty: counts 0 and the digest of
    nothing. Repeated rows are scanned each; a null doc_id stays null. One pass, no shuffle.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in texts_of(batches):
            found = [spans_of(t) for t in texts]
            counts = [[sum(k == kind for _, _, k in base) for base, _ in found] for kind in KINDS]
            digests = [hashlib.sha256(joined(base).encode()).hexdigest() for base, _ in found]
            arrays = [pa.array(ids, pa.int64()), *(pa.array(c, pa.int64()) for c in counts)]
            arrays += [pa.array(digests, pa.string()), pa.array([joined(s) for _, s in found], pa.string())]
            yield pa.record_batch(arrays, ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])

    return picked(docs, doc_id="long", text="string").mapInArrow(
        run,
        "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string",
    )


def redacted(docs: DataFrame) -> DataFrame:
    """The documents with their secrets replaced; n_chars follows the text, null stays null.

    Columns other than those of documents are not carried.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [None if t is None else redact(t) for t in batch.column("text").to_pylist()]
            arrays = [pa.array(texts, pa.string()) if n == "text" else batch.column(n) for n in batch.schema.names]
            yield pa.record_batch(arrays, batch.schema.names)

    kept = picked(docs, doc_id="long", text="string", lang="string", source="string")
    out = kept.mapInArrow(run, kept.schema)
    return out.withColumn("n_chars", F.length("text").cast("long"))


@query()
def op5_secret_scan(spark, sf_dir):
    """Secrets in all documents."""
    return scan(table(spark, sf_dir, "documents"))
