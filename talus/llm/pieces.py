"""SentencePiece-style merge segmentation with seeded dropout, and its lossless decoding.

Segmentation works on an agenda: adjacent symbols whose concatenation is a piece are candidates, taken by score (leftmost among
equals). A candidate is skipped for good if a keyed hash of (seed, document, its place in the text, its length) falls under the dropout
rate, so a run with the same seed repeats itself, and other seeds, documents and occurrences of a word are segmented otherwise.
Symbols that are no piece become byte pieces.

The words of many texts are segmented side by side: numpy takes each word's best candidate and merges it, one merge of every word
at a time. Very long words have an agenda of their own, a heap. Nothing is cached, so every occurrence is drawn anew.
"""

from __future__ import annotations

import hashlib
import heapq
import zlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from .words import U, mix, slices

SPACE = "▁"
#: Characters of a word up to which it is segmented beside others of its width, by widths; longer words have a heap.
WIDTHS = (4, 8, 16, 32, 64)
#: Characters of texts in one pass.
PASS_CHARS = 1 << 19
#: A symbol that has become part of the one before it, and one that is neither a piece nor a character of any.
GONE, UNKNOWN = -2, -1
_STEP, _64 = U(0x9E3779B97F4A7C15), (1 << 64) - 1


def draws(key: np.ndarray, place: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The candidates' keyed hashes, 32 bits. key: of seed and document; place: in the text."""
    return mix(key + (place.astype(U) << U(20) | length.astype(U)) * _STEP) >> U(32)


class Pieces:
    """A merge-type model whose pieces hold the space mark only at their beginning, with byte pieces and no normalisation
    beyond the space mark put before a text."""

    def __init__(self, path: str, dropout: float = 0.0, seed: int = 0):
        from sentencepiece import SentencePieceProcessor

        sp = SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        self.piece = [sp.id_to_piece(i) for i in range(n)]
        ordinary = [i for i in range(n) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
        self.id = {self.piece[i]: i for i in ordinary}
        self.byte = np.array([sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)], np.int32)
        self.bytes_of = {i: bytes([b]) for b, i in enumerate(self.byte.tolist())}
        for i in ordinary:
            self.bytes_of[i] = self.piece[i].replace(SPACE, " ").encode()
        if any(SPACE in p.lstrip(SPACE) for p in self.id):
            raise ValueError("pieces with a space mark inside are not supported")
        self.bar, self.seed = int(dropout * (1 << 32)), seed & _64
        # Symbols are the pieces, by their ids, and single characters that are none but occur in pieces.
        self.symbol = dict(self.id)
        for c in sorted(set("".join(self.id)) - self.id.keys()):
            self.symbol[c] = n + len(self.symbol) - len(self.id)
        self.pieces, self.size = n, max(self.symbol.values()) + 1
        self.score = np.full(self.size, -np.inf, np.float32)
        self.score[ordinary] = [sp.get_score(i) for i in ordinary]
        self.character = np.full(0x110000, UNKNOWN, np.int32)
        for c, i in self.symbol.items():
            if len(c) == 1:
                self.character[ord(c)] = i
        # A space mark in the text itself becomes bytes, so that it isn't read as a space again.
        self.character[ord(" ")], self.character[ord(SPACE)] = self.character[ord(SPACE)], UNKNOWN
        self._tabulate()

    def _tabulate(self) -> None:
        """An open-addressing table from pairs of symbols to the piece that they make."""
        pairs = {a * self.size + b: i for p, i in self.id.items() for k in range(1, len(p)) if (a := self.symbol.get(p[:k])) is not None and (b := self.symbol.get(p[k:])) is not None}
        keys, values = np.fromiter(pairs, np.int64, len(pairs)), np.fromiter(pairs.values(), np.int32, len(pairs))
        self._bits = max(8, (4 * len(pairs)).bit_length())
        self._keys, self._values = np.full(1 << self._bits, -1, np.int64), np.full(1 << self._bits, UNKNOWN, np.int32)
        slot = self._slot(keys)
        while len(keys):
            free = self._keys[slot] == -1
            first = np.unique(np.where(free, slot, -1), return_index=True)[1]
            first = first[free[first]]
            self._keys[slot[first]], self._values[slot[first]] = keys[first], values[first]
            rest = np.ones(len(keys), bool)
            rest[first] = False
            keys, values, slot = keys[rest], values[rest], (slot[rest] + 1) & ((1 << self._bits) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.view(U) * _STEP) >> U(64 - self._bits)).astype(np.int64)

    def made(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The piece that each pair of symbols makes, or UNKNOWN."""
        key = a.astype(np.int64) * self.size + b
        key[(a < 0) | (b < 0)] = -3
        slot = self._slot(key)
        there = self._keys[slot]
        out = np.where(there == key, self._values[slot], UNKNOWN)
        more = np.flatnonzero((there != key) & (there != -1) & (key >= 0))
        while len(more):
            slot[more] = (slot[more] + 1) & ((1 << self._bits) - 1)
            there = self._keys[slot[more]]
            hit = there == key[more]
            out[more[hit]] = self._values[slot[more[hit]]]
            more = more[~hit & (there != -1)]
        return out

    def key(self, document: object) -> int:
        return xxhash.xxh64_intdigest("" if document is None else str(document), self.seed)

    def encode_all(self, texts: list[str], documents: list) -> list[bytes]:
        """Ids of each text as little-endian 32-bit integers; none for an empty text."""
        full = [i for i, t in enumerate(texts) if t]
        out = [b""] * len(texts)
        if not full:
            return out
        raw = [(" " + texts[i]).encode("utf-32-le") for i in full]
        codes = np.frombuffer(b"".join(raw), "<u4")
        edges = np.cumsum([0, *(len(r) // 4 for r in raw)])
        space = codes == 32
        begins = space.copy()
        begins[1:] &= ~space[:-1]
        begins[edges[:-1]] = True
        start = np.flatnonzero(begins)
        text = np.searchsorted(edges, start, "right") - 1
        keys = np.array([self.key(documents[i]) for i in full], U)[text]
        size = np.diff(np.append(start, len(codes)))
        symbol = self.character[codes]
        after, before = np.arange(1, len(codes) + 1), np.arange(-1, len(codes) - 1)
        least = 1
        for width in WIDTHS:
            own = np.flatnonzero((size > least) & (size <= width))
            least = width
            if len(own):
                self._merge(symbol, after, before, start[own], start[own] + size[own], edges[text[own]], keys[own], width)
        for w in np.flatnonzero(size > least).tolist():
            lo, hi = int(start[w]), int(start[w] + size[w])
            symbol[lo:hi] = self._one(symbol[lo:hi].tolist(), lo - int(edges[text[w]]), int(keys[w]))
        return self._spelled(symbol, codes, edges, out, full)

    def _offer(self, a: np.ndarray, b: np.ndarray, place: np.ndarray, length: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The piece of each pair and its score, which is least if there is none or it is skipped."""
        piece = self.made(a, b)
        score = np.where(piece >= 0, self.score[piece], -np.inf)
        if self.bar:
            some = np.flatnonzero(piece >= 0)
            skipped = draws(key[some], place[some], length[some]) < U(self.bar)
            score[some[skipped]] = -np.inf
        return piece, score

    def _merge(self, symbol, after, before, start, end, origin, key, width: int) -> None:
        """Merges within the words [start, end) of at most `width` characters, all at once; changes symbol, after and before."""
        place = start[:, None] + np.arange(width - 1)
        row, at = np.nonzero(place + 1 < end[:, None])
        here = place[row, at]
        score = np.full((len(start), width), -np.inf, np.float32)
        piece = np.full((len(start), width), UNKNOWN, np.int32)
        piece[row, at], score[row, at] = self._offer(symbol[here], symbol[here + 1], here - origin[row], np.full(len(here), 2), key[row])
        row = np.arange(len(start))
        while len(row):
            if len(row) < len(score) // 2:
                # Words that are done leave the table.
                score, piece, start, end, origin, key, row = score[row], piece[row], start[row], end[row], origin[row], key[row], np.arange(len(row))
            best = score.argmax(1)[row] if len(row) == len(score) else score[row].argmax(1)
            on = score[row, best] > -np.inf
            row, best = row[on], best[on]
            if not len(row):
                break
            lo, first, last = start[row], start[row] + best, end[row]
            second = after[first]
            third = after[second]
            symbol[first] = new = piece[row, best]
            symbol[second] = GONE
            after[first] = third
            score[row, second - lo] = -np.inf
            score[row, best] = -np.inf
            right = np.flatnonzero(third < last)
            f, t, r = first[right], third[right], row[right]
            before[t] = f
            piece[r, best[right]], score[r, best[right]] = self._offer(new[right], symbol[t], f - origin[r], after[t] - f, key[r])
            left = np.flatnonzero(first > lo)
            r, h = row[left], before[first[left]]
            p, s = self._offer(symbol[h], new[left], h - origin[r], third[left] - h, key[r])
            piece[r, h - lo[left]], score[r, h - lo[left]] = p, s

    def _one(self, part: list[int], place: int, key: int) -> list[int]:
        """The same for one long word whose first character is at `place` of its text: symbols, GONE where they have been merged."""
        n = len(part)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        one = lambda x, kind=np.int64: np.array([x], kind)
        agenda: list[tuple[float, int, int, int]] = []

        def offer(i: int, j: int) -> None:
            piece, score = self._offer(one(part[i]), one(part[j]), one(place + i), one(after[j] - i), one(key, U))
            if score[0] > -np.inf:
                heapq.heappush(agenda, (-float(score[0]), i, after[j] - i, int(piece[0])))

        codes = np.array(part, np.int64)
        at = np.arange(n - 1)
        pieces, scores = self._offer(codes[:-1], codes[1:], place + at, np.full(n - 1, 2), np.full(n - 1, key, U))
        agenda = [(-s, i, 2, p) for s, i, p in zip(scores.tolist(), at.tolist(), pieces.tolist(), strict=True) if s > -np.inf]
        heapq.heapify(agenda)
        while agenda:
            _, i, length, piece = heapq.heappop(agenda)
            if part[i] == GONE or (j := after[i]) >= n or after[j] - i != length:
                continue
            part[i], part[j] = piece, GONE
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                offer(i, k)
            if before[i] >= 0:
                offer(before[i], i)
        return part

    def _spelled(self, symbol: np.ndarray, codes: np.ndarray, edges: np.ndarray, out: list[bytes], full: list[int]) -> list[bytes]:
        """Each text's ids; symbols that are no pieces become the bytes of their characters."""
        count = (symbol != GONE).astype(np.int64)
        odd = np.flatnonzero((symbol == UNKNOWN) | (symbol >= self.pieces))
        spelled = [chr(c).replace(" ", SPACE).encode() for c in codes[odd].tolist()]
        count[odd] = [len(x) for x in spelled]
        ids = np.repeat(symbol, count)
        ends = np.concatenate(([0], np.cumsum(count)))
        if len(odd):
            n = count[odd]
            at = np.repeat(ends[odd], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            ids[at] = self.byte[np.frombuffer(b"".join(spelled), np.uint8)]
        raw = ids.astype("<i4").tobytes()
        bounds = (4 * ends[edges]).tolist()
        for k, i in enumerate(full):
            out[i] = raw[bounds[k] : bounds[k + 1]]
        return out

    def encode(self, text: str, document: object = None) -> bytes:
        return self.encode_all([text], [document])[0]

    def decode(self, ids) -> str:
        return b"".join(map(self.bytes_of.__getitem__, ids)).decode()[1:]


def _passes(texts: list[str]):
    """Ranges of texts with about PASS_CHARS characters each."""
    at, size = 0, 0
    for i, t in enumerate(texts):
        size += len(t) + 64
        if size >= PASS_CHARS:
            yield at, i + 1
            at, size = i + 1, 0
    if at < len(texts):
        yield at, len(texts)


def encode_pieces(docs: DataFrame, path: str, dropout: float = 0.1, seed: int = 1, with_ids: bool = True) -> DataFrame:
    """Whole texts as ids of a merge-type model under seeded merge-dropout, each decoded again and compared.

    Returns doc_id, n_bytes, n_ids, ids_crc32 (of little-endian unsigned 32-bit ids), decoded_sha256, lossless and, if asked for,
    ids. Dropout is drawn anew for every occurrence of a word, by seed, doc_id and place; epochs take other seeds. Null and empty texts: no ids.
    Repeated rows and null ids are kept; a null id draws as an empty one. One pass without a shuffle; memory is an Arrow batch and the
    arrays of PASS_CHARS characters, or of a single longer text.
    """

    def run(batches):
        model = Pieces(path, dropout, seed)
        for b in slices(batches):
            rows = []
            ids_of, texts = b.column(0).to_pylist(), [t or "" for t in b.column(1).to_pylist()]
            for lo, hi in _passes(texts):
                for text, raw in zip(texts[lo:hi], model.encode_all(texts[lo:hi], ids_of[lo:hi]), strict=True):
                    ids = np.frombuffer(raw, "<i4")
                    back = model.decode(ids.tolist())
                    rows.append((len(text.encode()), len(ids), zlib.crc32(raw), hashlib.sha256(back.encode()).hexdigest(), back == text, ids))
            columns = list(zip(*rows, strict=True)) if rows else [[]] * 6
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.bool_(), pa.list_(pa.int32())]
            names = ["n_bytes", "n_ids", "ids_crc32", "decoded_sha256", "lossless", "ids"]
            m = 6 if with_ids else 5
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(c, t) for c, t in zip(columns[:m], kinds[:m], strict=True))], ["doc_id", *names[:m]])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n_bytes long, n_ids long, ids_crc32 long, decoded_sha256 string, lossless boolean" + ", ids array<int>" * with_ids)


def decode_pieces(encoded: DataFrame, path: str) -> DataFrame:
    """doc_id and text of rows with doc_id and ids; null ids give a null text, no ids an empty one."""

    def run(batches):
        model = Pieces(path)
        for b in batches:
            texts = [None if ids is None else model.decode(ids) for ids in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    kind = encoded.schema["doc_id"].dataType.simpleString()
    return encoded.select("doc_id", F.col("ids").cast("array<int>")).mapInArrow(run, f"doc_id {kind}, text string")
