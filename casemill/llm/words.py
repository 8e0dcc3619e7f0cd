"""Cut texts into words with numpy: character classes of a whole batch at once, cut positions from class changes.

A batch of texts is one string joined by NUL separators. Every function takes code points and classes of that string and returns
the start and end of each word; separators never belong to a word.
"""

from __future__ import annotations

import functools
import hashlib
import unicodedata

import numpy as np
import pyarrow as pa
from tokenizers import Regex, normalizers, pre_tokenizers

from casemill.llm.arrow import gather, ragged
from casemill.llm.spans import binary_array, pieces

LETTER, NUMBER, SPACE, OTHER, END = 0, 1, 2, 3, 4
# White_Space of Unicode (fixed values).
SPACES = [*range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
BATCH_CHARS = 1_000_000


def class_of(char: int) -> int:
    if char in SPACES:
        return SPACE
    kind = unicodedata.category(chr(char))[0]
    return LETTER if kind == "L" else NUMBER if kind == "N" else OTHER


def class_table() -> np.ndarray:
    """Classes of the first 65,536 code points; the others are looked up when a text holds them."""
    return np.fromiter((class_of(c) for c in range(0x10000)), np.uint8, 0x10000)


@functools.cache
def newer_characters() -> tuple[dict[int, int], dict[int, str]]:
    """Classes and lower case of characters that the tokenizers' Unicode tables know and Python's do not. Called on the driver; a few thousand entries."""
    unknown = "".join(chr(c) for c in range(0x40000) if unicodedata.category(chr(c)) == "Cn")  # the planes beyond hold no characters
    classes = {}
    for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+")):
        at = 0
        for _, (start, end) in [*pre_tokenizers.Split(Regex(pattern), "removed").pre_tokenize_str(unknown), ("", (len(unknown), len(unknown)))]:
            classes |= {ord(c): kind for c in unknown[at:start]}
            at = end
    lower = normalizers.Lowercase()
    return classes, {c: x for c in classes if (x := lower.normalize_str(chr(c))) != chr(c)}


def with_newer(table: np.ndarray, newer: dict[int, int]) -> np.ndarray:
    """A class table with these characters in it."""
    size = max([table.size, *(c + 1 for c in newer)])
    out = np.fromiter((class_of(c) for c in range(table.size, size)), np.uint8, size - table.size)
    out = np.concatenate([table, out])
    out[list(newer)] = list(newer.values())
    return out


class Batch:
    """Some texts joined into one string."""

    def __init__(self, texts: list[str], table: np.ndarray):
        self.count = len(texts)
        self.text = "\0".join([*texts, ""])
        self.points = np.frombuffer(self.text.encode("utf-32-le", "surrogatepass"), "<u4")
        lengths = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
        self.ends = np.cumsum(lengths) - 1
        self.starts = self.ends - lengths + 1
        self.classes = table[np.minimum(self.points, table.size - 1)]
        far = np.flatnonzero(self.points >= table.size)
        if far.size:
            chars, at = np.unique(self.points[far], return_inverse=True)
            self.classes[far] = np.fromiter((class_of(int(c)) for c in chars), np.uint8, chars.size)[at]
        self.classes[self.ends] = END

    def text_of(self, positions: np.ndarray) -> np.ndarray:
        """The text each position lies in."""
        return np.searchsorted(self.ends, positions, side="right")

    def slices(self, starts: np.ndarray, ends: np.ndarray) -> list[str]:
        text = self.text
        return [text[a:b] for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]

    def distinct(self, starts: np.ndarray, ends: np.ndarray) -> tuple[pa.Array, np.ndarray]:
        """The distinct spans in order of their first occurrence, as UTF-8 bytes, and the number of each span's. Spans are compared by content."""
        points = self.points
        at = np.zeros(points.size + 1, np.int64)
        np.cumsum(1 + (points >= 0x80) + (points >= 0x800) + (points >= 0x10000).astype(np.int64), out=at[1:])
        data = np.frombuffer(self.text.encode("utf-8", "surrogatepass"), np.uint8)
        coded = binary_array(data[gather(at[starts], at[ends] - at[starts])], ragged(at[ends] - at[starts])).dictionary_encode()
        return coded.dictionary, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)


def batches(texts: list[str], table: np.ndarray, limit: int = BATCH_CHARS):
    """(first index, Batch) of consecutive texts with about ``limit`` characters; a longer text makes a batch by itself."""
    first, size = 0, 0
    for i, text in enumerate(texts):
        if size and size + len(text) > limit:
            yield first, Batch(texts[first:i], table)
            first, size = i, 0
        size += len(text) + 1
    if first < len(texts):
        yield first, Batch(texts[first:], table)


def contractions(b: Batch, apostrophes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of apostrophes that start a word: those that open one of 's 't 'm 'd 're 've 'll, and the contraction's length."""
    points = np.concatenate([b.points, np.zeros(2, b.points.dtype)])
    one, two = points[apostrophes + 1], points[np.minimum(apostrophes + 2, points.size - 1)]
    single = np.isin(one, [ord(c) for c in "stmd"])
    double = ((one == ord("r")) & (two == ord("e"))) | ((one == ord("v")) & (two == ord("e"))) | ((one == ord("l")) & (two == ord("l")))
    hit = single | double
    return apostrophes[hit], np.where(single[hit], 2, 3)


def spaced_words(b: Batch) -> tuple[np.ndarray, np.ndarray]:
    """Words of the byte-level pre-tokeniser: runs of letters, numbers or other characters with one blank before, and white space.

    White space before a word leaves its last character apart; a blank there joins the word.
    """
    cls, points = b.classes, b.points
    n = cls.size
    change = np.empty(n, bool)
    change[0] = True
    np.not_equal(cls[1:], cls[:-1], out=change[1:])
    change[b.ends] = True
    if n > 1:
        change[b.ends[:-1] + 1] = True
    solid = (cls != SPACE) & (cls != END)
    at = np.flatnonzero(change & solid)
    cut = change
    inner = at[at > 0]
    before_space = inner[cls[inner - 1] == SPACE]
    blank = points[before_space - 1] == 32
    cut[before_space - 1] = True  # the last white-space character is a word of its own ...
    cut[before_space[blank]] = False  # ... or, if a blank, the start of the word
    marks = at[points[at] == ord("'")]
    marks = marks[cut[marks]]
    if marks.size:
        heads, lengths = contractions(b, marks)
        cut[heads + 1] = False
        cut[heads + lengths] = True
    starts = np.flatnonzero(cut)
    ends = np.append(starts[1:], n)
    keep = cls[starts] != END
    return starts[keep], ends[keep]


def runs(b: Batch, classes: tuple[int, ...] = (LETTER, NUMBER)) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of characters of these classes taken together."""
    inside = np.isin(b.classes, classes).view(np.int8)
    edge = np.diff(inside, prepend=0, append=0)
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def visible_words(b: Batch) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs without white space."""
    return runs(b, (LETTER, NUMBER, OTHER))


MULTIPLIER = 0x9E3779B97F4A7C15
INVERSE = pow(MULTIPLIER, -1, 1 << 64)


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (fixed constants of a public mixing function)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Hasher:
    """64-bit hashes of spans: a polynomial of mixed characters, taken from differences of one prefix sum per batch.

    They only deal words to buckets: different texts can be built that share a hash, so it never stands for the text.
    """

    def __init__(self) -> None:
        self.mix = mixed(np.arange(1, 0x10001, dtype=np.uint64))
        self.up = self.down = np.ones(1, np.uint64)

    def grow(self, n: int) -> None:
        if self.up.size < n:
            n = max(n, 2 * self.up.size)
            for name, base in (("up", MULTIPLIER), ("down", INVERSE)):
                steps = np.full(n, base, np.uint64)
                steps[0] = 1
                setattr(self, name, np.cumprod(steps, dtype=np.uint64))

    def __call__(self, points: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        self.grow(points.size + 1)
        terms = self.mix[np.minimum(points, 0xFFFF)]
        far = np.flatnonzero(points > 0xFFFF)
        if far.size:
            terms[far] = mixed(points[far].astype(np.uint64) + np.uint64(1))
        terms *= self.up[: points.size]
        total = np.zeros(points.size + 1, np.uint64)
        np.cumsum(terms, out=total[1:])
        return mixed((total[ends] - total[starts]) * self.down[starts] + (ends - starts).astype(np.uint64))


def digests(spans: pa.Array, size: int = 8) -> np.ndarray:
    """Cryptographic digests of byte strings, as rows of 64-bit numbers: no structure of texts makes two of them meet."""
    data = b"".join(hashlib.blake2b(x, digest_size=size).digest() for x in pieces(spans))
    return np.frombuffer(data, np.uint64).reshape(-1, size // 8)


def shingle_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of every window of ``size`` consecutive word hashes."""
    n = words.size - size + 1
    out = np.zeros(n, np.uint64)
    for k in range(size):
        out = (out + words[k : k + n]) * np.uint64(MULTIPLIER)
        out ^= out >> np.uint64(29)
    return mixed(out)
