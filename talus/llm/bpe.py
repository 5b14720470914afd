"""Byte-pair tokens: counts by a heap over a linked list, and ids of whole texts through a bounded cache.

The vocabulary is a tokenizer's .json file, read by path and never copied. Texts are split at spaces
into chunks that the tokenizer's own pre-tokenizer treats independently of each other; a text in which
a space has white space on both sides (or before it at the text's end) is not split. Counts and ids of
chunks are kept in a bounded dictionary of the worker, because words repeat.
"""

from __future__ import annotations

import heapq
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

#: Entries of a generation of a worker's cache.
CACHE_ENTRIES = 500_000
_UNSPLITTABLE = re.compile(r"\s (?:\s|\Z)")


def byte_alphabet() -> dict[str, str]:
    """From the printable stand-ins of byte-level vocabularies to the bytes they mean, as Latin-1 characters:
    printable bytes stand for themselves, the others in order for the characters from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): chr(b) for b in plain} | {chr(256 + k): chr(b) for k, b in enumerate(other)}


class Vocabulary:
    """merges: rank of each pair of symbols (Latin-1 strings of bytes); special: added tokens and their ids."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        table = str.maketrans(byte_alphabet())
        pairs = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        self.merges = {(a.translate(table), b.translate(table)): rank for rank, (a, b) in enumerate(pairs)}
        self.special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        self.ids = {t.translate(table): i for t, i in spec["model"]["vocab"].items() if t not in self.special}
        self.size = 1 + max([*self.ids.values(), *self.special.values()])
        self.split_special = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None

    def parts(self, text: str) -> Iterator[tuple[bool, str]]:
        """(is a special token, text) in order."""
        if self.split_special is None or not any(s in text for s in self.special):
            yield False, text
            return
        for k, part in enumerate(self.split_special.split(text)):
            if part:
                yield bool(k % 2), part


def merged_count(symbols: str, merges: dict[tuple[str, str], int]) -> int:
    """Symbols left after byte-pair merging: initial symbols minus merges.

    Symbols are a doubly linked list; a heap holds (rank, place) of adjacent pairs. The lowest rank
    (leftmost among equals) is merged first; entries whose pair has changed since are skipped.
    """
    n = len(symbols)
    if n < 2:
        return n
    part: list[str | None] = list(symbols)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = [(r, i) for i in range(n - 1) if (r := merges.get((symbols[i], symbols[i + 1]))) is not None]
    heapq.heapify(heap)
    done = 0
    while heap:
        rank, i = heapq.heappop(heap)
        j = after[i]
        if part[i] is None or j >= n or merges.get((part[i], part[j])) != rank:
            continue
        part[i] += part[j]
        part[j] = None
        done += 1
        after[i] = k = after[j]
        if k < n:
            before[k] = i
            if (r := merges.get((part[i], part[k]))) is not None:
                heapq.heappush(heap, (r, i))
        if (h := before[i]) >= 0 and (r := merges.get((part[h], part[i]))) is not None:
            heapq.heappush(heap, (r, h))
    return n - done


class _Cache(dict):
    """Values of a function by key. When a generation is full it becomes the old one, and only what is asked for again is taken over, so
    frequent keys stay and at most two generations are held."""

    def __init__(self, of, entries: int = CACHE_ENTRIES):
        self.of, self.entries, self.old = of, entries, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.of(key)
        if len(self) >= self.entries:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value


class Counter:
    """Token counts of whole texts."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.vocabulary = Vocabulary(path)
        self._split = Tokenizer.from_file(path).pre_tokenizer.pre_tokenize_str
        self._table = str.maketrans(byte_alphabet())
        self._piece = _Cache(lambda piece: merged_count(piece, self.vocabulary.merges))
        self._after_space = _Cache(lambda chunk: self._pieces(" " + chunk))

    def _pieces(self, text: str) -> int:
        piece = self._piece
        # One word behind a space or from its first letter on; anything else at the front (an apostrophe) may split off with letters.
        if (text[0] == " " or text[0].isalpha()) and text.isascii():
            if text[1:].isalpha():
                return piece[text]
            if text[-1] in ".,|" and text[1:-1].isalpha():
                return piece[text[:-1]] + 1
        return sum(piece[p.translate(self._table)] for p, _ in self._split(text))

    def _plain(self, text: str) -> int:
        if _UNSPLITTABLE.search(text):
            return self._pieces(text)
        first, *rest = text.split(" ")
        return (self._pieces(first) if first else 0) + sum(map(self._after_space.__getitem__, rest))

    def count(self, text: str) -> int:
        return sum(1 if special else self._plain(part) for special, part in self.vocabulary.parts(text))


class Encoder:
    """Ids of whole texts, as the bytes of little-endian unsigned integers of `width` bytes each."""

    def __init__(self, path: str):
        import tiktoken

        self.vocabulary = v = Vocabulary(path)
        self.width = 2 if v.size <= 1 << 16 else 4
        self.dtype = np.dtype(f"<u{self.width}")
        ranks = {t.encode("latin-1"): i for t, i in v.ids.items()}
        # In this kind of vocabulary a symbol's id orders it as its merge does; the tests hold the ids against the library.
        pattern = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
        ordinary = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        dtype = self.dtype
        self._whole = lambda text: np.array(ordinary(text), dtype).tobytes()
        self._after_space = _Cache(lambda chunk: np.array(ordinary(" " + chunk), dtype).tobytes(), CACHE_ENTRIES // 2)

    def _plain(self, text: str) -> bytes:
        if _UNSPLITTABLE.search(text):
            return self._whole(text)
        first, *rest = text.split(" ")
        return (self._whole(first) if first else b"") + b"".join(map(self._after_space.__getitem__, rest))

    def encode(self, text: str) -> bytes:
        return b"".join(np.array([self.vocabulary.special[part]], self.dtype).tobytes() if special else self._plain(part) for special, part in self.vocabulary.parts(text))


def token_counts(docs: DataFrame, path: str, limit: int = 1024) -> DataFrame:
    """Token count of every row's whole text.

    Returns doc_id, n_bytes (UTF-8), n_tokens, over_limit (n_tokens > limit), a row for each row of docs.
    Null and empty texts: 0 bytes, 0 tokens. Repeated rows and null doc_ids are kept; other columns are not read.
    One pass over the scan without a shuffle; memory is an Arrow batch and the bounded caches.
    """

    def run(batches):
        counter = Counter(path)
        for b in batches:
            texts = [t or "" for t in b.column(1).to_pylist()]
            n = [counter.count(t) for t in texts]
            size = [len(t.encode()) for t in texts]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(size, pa.int64()), pa.array(n, pa.int64())], ["doc_id", "n_bytes", "n_tokens"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n_bytes long, n_tokens long").withColumn("over_limit", F.col("n_tokens") > limit)
