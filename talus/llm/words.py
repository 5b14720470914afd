"""Words of whole texts as numpy arrays: boundaries, 64-bit hashes of words, and hashes of word runs.

A word is a longest run of bytes other than space and 0x09-0x0D. Hashes are chained: each step mixes all bits before the next
eight bytes, or the next run, come in, so that no arrangement of repeated parts cancels out as in a sum of powers. Two different
words or runs share a hash by chance only, with a probability of about 2^-64 a pair; where that is not enough, words are compared.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import xxhash

U = np.uint64
#: Bytes of text in one pass: bounds the arrays of a pass to some 60 MB, unless a single text is longer.
PASS_BYTES = 4 << 20
#: Bytes of a word up to which numpy hashes it with others; longer ones are hashed one by one.
LONG = 256

_SEPARATOR = np.zeros(256, bool)
_SEPARATOR[[0x20, 9, 10, 11, 12, 13]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: Keeps the first 0 to 8 bytes of a little-endian integer.
_FIRST = np.array([(1 << 8 * k) - 1 for k in range(9)], U)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every input bit."""
    x = x ^ (x >> U(30))
    x *= U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


def joined(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The hash of a run from those of its two parts."""
    return mix(a * U(0x9E3779B97F4A7C15) + b)


class Words:
    """The words of several texts. start, end: bytes of each word; doc: its text's place in the list;
    first: index of each text's first word, with one entry more at the end; hash: of each word."""

    def __init__(self, texts: list[bytes], lower: bool = False):
        whole = b" ".join([b"", *texts, b" " * 8])
        b = np.frombuffer(whole, np.uint8)
        if lower:
            b = _LOWER[b]
        self.bytes = b
        sep = _SEPARATOR[b]
        edge = np.flatnonzero(sep[1:] != sep[:-1]) + 1
        self.start, self.end = edge[0::2], edge[1::2]
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        begins = np.cumsum(np.concatenate(([1], lengths + 1)))
        self.first = np.searchsorted(self.start, begins)
        self.doc = np.repeat(np.arange(len(texts)), np.diff(self.first))
        self.hash = self._hashes()

    def _hashes(self) -> np.ndarray:
        size = self.end - self.start
        wide = np.ndarray(len(self.bytes) - 7, "<u8", self.bytes, 0, (1,))
        h = mix(size.astype(U) + U(0xD6E8FEB86659FD93))
        h = mix(h ^ (wide[self.start] & _FIRST[np.minimum(size, 8)]))
        rest, at = np.flatnonzero(size > 8), 8
        while len(rest) and at < LONG:
            h[rest] = mix(h[rest] ^ (wide[self.start[rest] + at] & _FIRST[np.minimum(size[rest] - at, 8)]))
            at += 8
            rest = rest[size[rest] > at]
        for i in rest.tolist():
            h[i] = U(xxhash.xxh3_64_intdigest(self.bytes[self.start[i] : self.end[i]]))
        return h

    def grams(self, size: int) -> np.ndarray:
        """Hashes of all runs of `size` words, by their first words; those that cross from one text to the next are no runs of `starts`."""
        n = len(self.hash) - size + 1
        if n <= 0:
            return np.zeros(0, U)
        power, out, at = {1: self.hash}, None, 0
        while (k := 1 << len(power) - 1) * 2 <= size:
            power[2 * k] = joined(power[k][:-k], power[k][k:])
        for k in sorted(power, reverse=True):
            if size & k:
                part = power[k][at : at + n]
                out = part if out is None else joined(out, part)
                at += k
        return out

    def starts(self, width: int) -> np.ndarray:
        """Indices of words at which a run of width words of the same text starts."""
        i = np.arange(max(0, len(self.hash) - width + 1))
        return i[self.doc[i] == self.doc[i + width - 1]] if len(i) else i


def encoded(column: list) -> list[bytes]:
    return [t.encode() if t else b"" for t in column]


def passes(texts: list[bytes], most: int = PASS_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of texts with about `most` bytes each; empty texts count a little too."""
    at, size = 0, 0
    for i, t in enumerate(texts):
        size += len(t) + 64
        if size >= most:
            yield at, i + 1
            at, size = i + 1, 0
    if at < len(texts):
        yield at, len(texts)


def slices(batches, rows: int = 512):
    """Arrow batches as smaller ones, so that the texts of few rows are Python objects at a time."""
    for b in batches:
        for lo in range(0, b.num_rows, rows):
            yield b.slice(lo, rows)
