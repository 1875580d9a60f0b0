"""Text as arrays of code points, for the numpy parts that run inside tasks."""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

TOP = 0x33000  # letters lie below
SPACE = 32
CONTEXT = 1  # in place of a third character
BUCKETS = 1 << 17  # of trigrams
CHUNK = 1 << 19


@cache
def lower_table() -> np.ndarray:
    """Code point to its lower case, where that is one code point."""
    table = np.arange(TOP, dtype=np.uint32)
    for i in range(TOP):
        low = chr(i).lower()
        if len(low) == 1:
            table[i] = ord(low)
    return table


@cache
def letter_table() -> np.ndarray:
    return np.array([chr(i).isalpha() for i in range(TOP)])


def chunks(texts: list, most: int = CHUNK) -> Iterator[tuple[int, int]]:
    """Bounds of runs of texts of about `most` characters; a longer text is a run
    of its own."""
    yield from _bounds([len(text) if text else 0 for text in texts], most)


def slices(texts: pa.Array, most: int = CHUNK) -> Iterator[pa.Array]:
    """The runs that `chunks` names, of an Arrow array: one run at a time becomes Python's
    strings, however many rows come at once."""
    sizes = pc.fill_null(pc.utf8_length(texts), 0).to_pylist()
    for i, j in _bounds(sizes, most):
        yield texts.slice(i, j - i)


def _bounds(sizes: list[int], most: int) -> Iterator[tuple[int, int]]:
    start = size = 0
    for i, n in enumerate(sizes):
        n += 1
        if size and size + n > most:
            yield start, i
            start, size = i, 0
        size += n
    if start < len(sizes):
        yield start, len(sizes)


class Scan:
    """A run of texts as one array of code points, a line end after each.

    `codes` as written, `low` in lower case, `letter` a mask; text i lies at
    ``starts[i]`` and has ``sizes[i]`` code points. Word j, a run of letters, is
    ``codes[word_start[j]:word_end[j]]`` of text ``word_doc[j]``.
    """

    def __init__(self, texts: list):
        texts = [t or "" for t in texts]
        joined = "\n".join(texts) + "\n"
        self.codes = np.frombuffer(
            joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32
        )
        self.sizes = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
        self.starts = np.concatenate(([0], np.cumsum(self.sizes + 1)[:-1])).astype(np.int64)
        small = np.minimum(self.codes, TOP - 1)
        self.letter = letter_table()[small] & (self.codes < TOP)
        self.low = np.where(self.codes < TOP, lower_table()[small], self.codes)
        edge = np.diff(self.letter.astype(np.int8), prepend=0, append=0)
        self.word_start = np.flatnonzero(edge == 1)
        self.word_end = np.flatnonzero(edge == -1)
        self.word_doc = self.doc_of(self.word_start)

    def doc_of(self, at: np.ndarray) -> np.ndarray:
        """The texts that the places `at`, in order, lie in."""
        return np.repeat(
            np.arange(len(self.starts)),
            np.diff(np.searchsorted(at, np.append(self.starts, len(self.codes)))),
        )

    def trigrams(self, contexts: bool = False) -> tuple[np.ndarray, ...]:
        """The trigrams of all words, each word with a space on either side: their
        hashes, and where each word's first one stands or, with `contexts`, the
        hashes of the two characters before."""
        seen = np.where(self.letter, self.low, np.uint32(SPACE))
        one = np.empty_like(seen)
        one[0], one[1:] = SPACE, seen[:-1]
        two = np.empty_like(seen)
        two[:2], two[2:] = SPACE, seen[:-2]
        two[one == SPACE] = SPACE
        used = self.letter | (one != SPACE)
        hashed = trigram_hash(two, one, seen)[used]
        if contexts:
            return hashed, trigram_hash(two, one, np.full_like(seen, CONTEXT))[used]
        first = np.cumsum(used, dtype=np.int32)[self.word_start] - 1
        return hashed, first


def trigram_hash(two, one, now):
    """A 17-bit hash of three code points, for uint32 arrays or numbers alike."""
    a, b, c, s = 2654435761, 2246822519, 3266489917, 15
    if isinstance(now, np.ndarray):  # uint32 wraps as the mask below does
        a, b, c, s = (np.uint32(x) for x in (a, b, c, s))
        mixed = two * a + one * b + now * c
        mixed ^= mixed >> s
        mixed *= c
        return mixed >> s
    mixed = (two * a + one * b + now * c) & 0xFFFFFFFF
    return ((mixed ^ (mixed >> s)) * c & 0xFFFFFFFF) >> s
