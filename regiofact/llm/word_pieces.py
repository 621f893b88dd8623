"""Words of a vocabulary whose pieces end words, split as the tokenizers library splits them."""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex

#: Fixed value: the split pattern of the vocabulary, on lower-case text.
WORD = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+")
#: Characters outside of these are normalised and split by the library, whose tables decide.
UNUSUAL = regex.compile(r"[^\t\n\r\x20-\x7e\xa1-\xac\xae-įı-ň‐-‧]")
#: How byte-level vocabularies write bytes; a blank stays.
_SHOWN = [*range(33, 127), *range(161, 173), *range(174, 256)]
_HIDDEN = sorted(set(range(256)).difference(_SHOWN))
SPELLED = np.arange(256, dtype="<u4")
SPELLED[_HIDDEN] = 256 + np.arange(len(_HIDDEN))
SPELLED[32] = 32
#: Kinds of the characters of usual texts; numbers and the end of a text are words of one character.
BLANK, OTHER, LETTER, NUMBER, END = range(5)
KINDS = np.array([
    LETTER if regex.match(r"\p{L}", c) else NUMBER if regex.match(r"\p{N}", c) else BLANK if c.isspace() else OTHER
    for c in map(chr, range(0x2028))
], dtype=np.uint8)
KINDS[0] = END
#: Two bytes for each of these characters.
CODE = "utf-16-le"
#: Words a worker remembers before it starts anew.
MEMORY = 800_000


def usual(text: str) -> bool:
    """Whether the split pattern alone decides where the words of a text are."""
    return UNUSUAL.search(text) is None and "<|" not in text


def parted(texts: list[str]) -> tuple[pa.DictionaryArray, np.ndarray]:
    """Words of usual texts in order, in ``CODE``, and the place where each text ends.

    This is the split pattern over all characters at once. Stretches of blanks and the zero that
    ends a text have places too, and are null.
    """
    data = "".join([t + "\0" for t in texts]).lower().encode(CODE)
    chars = np.frombuffer(data, "<u2")
    kinds = KINDS[chars]
    starts = np.ones(len(chars) + 1, dtype=bool)
    starts[1:-1] = (kinds[1:] != kinds[:-1]) | (kinds[1:] >= NUMBER)
    # an apostrophe on its own takes the letters of a contraction from the word after it
    marks = np.flatnonzero(chars[:-2] == ord("'"))
    marks = marks[starts[marks] & (kinds[marks + 1] == LETTER)]
    first, second = chars[marks + 1], chars[marks + 2]
    one = np.isin(first, [ord(c) for c in "stmd"])
    two = np.zeros(len(marks), dtype=bool)
    for a, b in ("re", "ve", "ll"):
        two |= (first == ord(a)) & (second == ord(b))
    marks, sizes = marks[one | two], np.where(one, 1, 2)[one | two]
    starts[marks + 1] = False
    starts[marks + 1 + sizes] = True
    bounds = np.flatnonzero(starts)
    words = (kinds[bounds[:-1]] != BLANK) & (kinds[bounds[:-1]] != END)
    buffers = [pa.py_buffer(np.packbits(words, bitorder="little")), pa.py_buffer(2 * bounds), pa.py_buffer(data)]
    found = pa.Array.from_buffers(pa.large_binary(), len(words), buffers).dictionary_encode()
    return found, np.searchsorted(bounds, np.flatnonzero(kinds == END))


class WordPieces:
    """Splits texts into words, and words into ids, with a vocabulary file."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        self.full = Tokenizer.from_file(path)
        added = self.full.get_added_tokens_decoder()
        self.special_ids = {t.content: i for i, t in added.items()}
        ordered = sorted(self.special_ids, key=len, reverse=True)
        self.special = regex.compile("(" + "|".join(map(regex.escape, ordered)) + ")") if ordered else None
        self.bare = Tokenizer.from_file(path)
        self.bare.no_truncation()
        self.bare.no_padding()
        self.bare.encode_special_tokens = True
        self.bare.normalizer = None
        self.bare.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        # the same for words whose bytes are written as the vocabulary's characters, between blanks
        self.spelled = Tokenizer.from_str(self.bare.to_str())
        self.spelled.encode_special_tokens = True
        self.spelled.pre_tokenizer = pre_tokenizers.CharDelimiterSplit(" ")
        suffix = getattr(self.full.model, "end_of_word_suffix", None)
        usable = suffix and all(t.special for t in added.values())
        self.ends = np.array([usable and p is not None and p.endswith(suffix) for p in self.pieces], dtype=bool)

    def split(self, text: str) -> list[str]:
        """The words of a text in order; special strings are one word each."""
        if usual(text):
            return WORD.findall(text.lower())
        parts = self.special.split(text) if self.special is not None else [text]
        return [w for p in parts for w in ([p] if p in self.special_ids else self._slow(p))]

    def tokens(self, text: str) -> list[str]:
        """What white space divides, lower case: no word reaches over it. Other texts as words."""
        if usual(text):
            return text.lower().split()
        return self.split(text)

    def _slow(self, text: str) -> list[str]:
        clean = self.full.normalizer.normalize_str(text) if self.full.normalizer else text
        return [clean[a:b] for _, (a, b) in self.full.pre_tokenizer.pre_tokenize_str(clean)]

    def encode(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words in a row, how many ids each word has), each word on its own."""
        rest = [w for w in words if w not in self.special_ids]
        found = self.bare.encode(rest, is_pretokenized=True, add_special_tokens=False)
        ids = np.array(found.ids, dtype=np.int64)
        sizes = np.bincount(np.array(found.word_ids, dtype=np.int64), minlength=len(rest))
        if len(rest) == len(words):
            return ids, sizes
        starts, all_sizes, parts, at = np.cumsum(sizes) - sizes, [], [], 0
        for w in words:
            if w in self.special_ids:
                parts.append([self.special_ids[w]])
            else:
                parts.append(ids[starts[at] : starts[at] + sizes[at]])
                at += 1
            all_sizes.append(len(parts[-1]))
        return np.concatenate([np.zeros(0, np.int64), *parts]), np.array(all_sizes, dtype=np.int64)

    def encode_many(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The same in one call, where pieces that end words tell the words apart."""
        text = " ".join(words)
        alone = text.count(" ") == len(words) - 1 and "" not in words
        if alone and self.special_ids.keys().isdisjoint(words):
            text = SPELLED[np.frombuffer(text.encode(), np.uint8)].tobytes().decode("utf-32-le")
            ids = np.array(self.spelled.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype=np.int64)
            last = np.nonzero(self.ends[ids])[0]
            if len(last) == len(words):
                return ids, np.diff(last, prepend=-1)
        return self.encode(words)

    def words(self, token: str) -> list[str]:
        """The words of a token, each encoded on its own."""
        if token.isalpha() or token in self.special_ids or UNUSUAL.search(token) is not None:
            return [token]
        return WORD.findall(token)

    @property
    def pieces(self) -> list[str | None]:
        """The piece of each id."""
        vocab = self.full.get_vocab(with_added_tokens=True)
        out: list[str | None] = [None] * (max(vocab.values()) + 1)
        for piece, i in vocab.items():
            out[i] = piece
        return out


@lru_cache(maxsize=2)
def word_pieces(path: str) -> WordPieces:
    """The worker's splitter for a vocabulary file."""
    return WordPieces(path)
