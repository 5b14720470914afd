"""Telephony audio: companded and ADPCM samples in WAVE containers, decoded with numpy and resampled.

Codecs (format tags of the WAVE container): A-law 6, mu-law 7, IMA ADPCM 0x11. Companded bytes are expanded by
256-entry tables; ADPCM blocks are decoded side by side, one step for all blocks at a time.
"""

from __future__ import annotations

import hashlib
import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .scratch import materialize
from .words import passes

#: Fixed values of the WAVE container.
TAGS = {"alaw": 6, "mulaw": 7, "ima": 0x11}
#: Bytes of an ADPCM block: a 4-byte header, then two samples a byte.
BLOCK = 64
RATE, RESAMPLED = 8000, 16000


def _mulaw_table() -> np.ndarray:
    """ITU-T G.711 mu-law by its rule: inverted bits are sign, 3 bits of exponent, 4 of mantissa; bias 132."""
    u = ~np.arange(256, dtype=np.int32) & 0xFF
    size = (((u & 15) << 3) + 132 << ((u >> 4) & 7)) - 132
    return np.where(u & 0x80, -size, size).astype(np.int16)


def _alaw_table() -> np.ndarray:
    """ITU-T G.711 A-law by its rule: even bits inverted, sign set for positive values."""
    a = np.arange(256, dtype=np.int32) ^ 0x55
    e, m = (a >> 4) & 7, (a & 15) << 4
    size = np.where(e == 0, m + 8, (m + 0x108) << np.maximum(e - 1, 0))
    return np.where(a & 0x80, size, -size).astype(np.int16)


MULAW, ALAW = _mulaw_table(), _alaw_table()

#: Fixed values of IMA ADPCM: quantiser steps and index moves.
STEPS = np.array([
    7, 8, 9, 10, 11, 12, 13, 14, 16, 17, 19, 21, 23, 25, 28, 31, 34, 37, 41, 45, 50, 55, 60, 66, 73, 80, 88, 97, 107, 118,
    130, 143, 157, 173, 190, 209, 230, 253, 279, 307, 337, 371, 408, 449, 494, 544, 598, 658, 724, 796, 876, 963, 1060,
    1166, 1282, 1411, 1552, 1707, 1878, 2066, 2272, 2499, 2749, 3024, 3327, 3660, 4026, 4428, 4871, 5358, 5894, 6484,
    7132, 7845, 8630, 9493, 10442, 11487, 12635, 13899, 15289, 16818, 18500, 20350, 22385, 24623, 27086, 29794, 32767,
], np.int32)
MOVES = np.array([-1, -1, -1, -1, 2, 4, 6, 8] * 2, np.int32)
#: What each of the 89 * 16 states adds to the predicted sample, and the next index.
_code = np.arange(16)
_DELTA = np.where(_code & 8, -1, 1) * ((STEPS[:, None] >> 3) + np.where(_code & 4, STEPS[:, None], 0) + np.where(_code & 2, STEPS[:, None] >> 1, 0) + np.where(_code & 1, STEPS[:, None] >> 2, 0))
DELTA = _DELTA.astype(np.int32).ravel()
NEXT = (np.clip(np.arange(89)[:, None] + MOVES, 0, 88) * 16).astype(np.int32).ravel()


def wave(samples: bytes, codec: str = "mulaw", rate: int = RATE) -> bytes:
    """A RIFF/WAVE file of one channel with the coded bytes as its data chunk."""
    bits, align = (4, BLOCK) if codec == "ima" else (8, 1)
    per_block = (BLOCK - 4) * 2 + 1
    extra = struct.pack("<HH", 2, per_block) if codec == "ima" else struct.pack("<H", 0)
    rate_bytes = rate * BLOCK // per_block if codec == "ima" else rate
    n = len(samples) // BLOCK * per_block if codec == "ima" else len(samples)
    fmt = struct.pack("<HHIIHH", TAGS[codec], 1, rate, rate_bytes, align, bits) + extra
    body = b"WAVE" + b"fmt " + struct.pack("<I", len(fmt)) + fmt + b"fact" + struct.pack("<II", 4, n) + b"data" + struct.pack("<I", len(samples)) + samples + b"\0" * (len(samples) % 2)
    return b"RIFF" + struct.pack("<I", len(body)) + body


def read_wave(media: bytes) -> tuple[str, int, bytes]:
    """Codec, rate and coded bytes; ValueError for what is not such a file."""
    if media[:4] != b"RIFF" or media[8:12] != b"WAVE":
        raise ValueError("not a RIFF/WAVE file")
    at, tag, rate = 12, None, 0
    while at + 8 <= len(media):
        name, size = media[at : at + 4], struct.unpack_from("<I", media, at + 4)[0]
        if name == b"fmt ":
            tag, _, rate = struct.unpack_from("<HHI", media, at + 8)
        elif name == b"data" and tag is not None:
            return {v: k for k, v in TAGS.items()}[tag], rate, media[at + 8 : at + 8 + size]
        at += 8 + size + size % 2
    raise ValueError("no fmt and data chunk")


def decode_ima(blocks: np.ndarray) -> np.ndarray:
    """PCM samples (block, 121) of ADPCM blocks (block, 64): a loop over the steps of a block, numpy across blocks.
    An index over 88 in a header counts as 88."""
    n = len(blocks)
    value = blocks[:, 0].astype(np.int32) | (blocks[:, 1].astype(np.int8).astype(np.int32) << 8)
    state = np.minimum(blocks[:, 2].astype(np.int32), 88) * 16
    out = np.empty(((BLOCK - 4) * 2 + 1, n), np.int16)
    out[0] = value
    data = np.ascontiguousarray(blocks[:, 4:].T)
    for k in range(BLOCK - 4):
        for j, code in ((1, data[k] & 15), (2, data[k] >> 4)):
            state = state + code
            value = value + DELTA[state]
            np.clip(value, -32768, 32767, out=value)
            state = NEXT[state]
            out[2 * k + j] = value
    return out.T


def decode(codec: str, coded: bytes) -> np.ndarray:
    """16-bit PCM of coded bytes; an ADPCM tail shorter than a block is not decoded."""
    b = np.frombuffer(coded, np.uint8)
    if codec == "ima":
        return decode_ima(b[: len(b) // BLOCK * BLOCK].reshape(-1, BLOCK)).ravel()
    return (MULAW if codec == "mulaw" else ALAW)[b]


def upsample(pcm: np.ndarray, ends: np.ndarray | None = None) -> np.ndarray:
    """Twice the rate by linear interpolation: each sample, then the mean with the next. The last sample of a signal is repeated;
    ends: where signals end if pcm holds several."""
    out = np.empty(2 * len(pcm), np.int16)
    out[0::2] = pcm
    if len(pcm):
        wide = pcm.astype(np.int32)
        out[1:-1:2] = (wide[:-1] + wide[1:]) >> 1
        last = np.array([len(pcm)]) - 1 if ends is None else ends - 1
        out[2 * last + 1] = pcm[last]
    return out


def payload(text: bytes) -> bytes:
    """The bytes with zero bytes up to a positive multiple of 64."""
    return text + b"\0" * (-len(text) % 64 if text else 64)


def features(pcm: np.ndarray, ends: np.ndarray) -> dict[str, np.ndarray]:
    """Length, peak, mean energy and zero crossings of the signals of pcm that end at `ends` (none is empty). Integers only, so that
    equal samples give equal features anywhere."""
    wide, starts = pcm.astype(np.int64), np.concatenate(([0], ends[:-1]))
    n = ends - starts
    turns = np.zeros(len(pcm), np.int64)
    turns[:-1] = (pcm[1:] < 0) != (pcm[:-1] < 0)
    turns[ends - 1] = 0
    return {"n": n, "peak": np.maximum.reduceat(np.abs(wide), starts), "energy": np.add.reduceat(wide * wide, starts) // n, "crossings": np.add.reduceat(turns, starts)}


#: Bytes of text that are coded in one pass, unless a single text is longer.
PASS_BYTES = 1 << 20


def codec_of(coded: bytes) -> str:
    """One of the codecs, by the bytes."""
    return sorted(TAGS)[zlib.crc32(coded) % len(TAGS)]


def encode_texts(docs: DataFrame, codec: str | None = None) -> DataFrame:
    """doc_id, n_bytes, media of every row: its whole text, with its padding, as coded 8-bit samples (ADPCM: as blocks) in a WAVE file.

    Without a codec each text has one by the hash of its bytes, so that equal texts have equal files. A null or empty text is 64 zero bytes. Repeated rows and null ids are kept. One pass without a shuffle.
    """

    def run(batches):
        for b in batches:
            texts = [t.encode() if t else b"" for t in b.column(1).to_pylist()]
            for lo, hi in passes(texts, PASS_BYTES):
                media = [wave(p, codec or codec_of(p)) for p in map(payload, texts[lo:hi])]
                yield pa.RecordBatch.from_arrays([b.column(0).slice(lo, hi - lo), pa.array([len(t) for t in texts[lo:hi]], pa.int64()), pa.array(media, pa.binary())], ["doc_id", "n_bytes", "media"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n_bytes long, media binary")


DECODED = ("payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature")


def decode_media(files: DataFrame, pcm: bool = True, digest: bool = True) -> DataFrame:
    """files (doc_id, n_bytes, media: WAVE files of one codec each) with pcm, the 16-bit little-endian samples at twice the rate, instead of media,
    and with digest what was read back: payload_bytes, payload_sha256 and tail_crc32 of the coded bytes, media_bytes, media_sha256,
    feature (of the resampled signal, by the file's own codec).

    Files of each codec are decoded together, the blocks of many files side by side. A file that is no such WAVE file is an error.
    """
    strings = ("payload_sha256", "media_sha256", "feature")
    names = [*(["pcm"] if pcm else []), *(DECODED if digest else ())]

    def rows(codec: str, media: list[bytes], stored: list[bytes]) -> list[dict]:
        unit, samples = (BLOCK, (BLOCK - 4) * 2 + 1) if codec == "ima" else (1, 1)
        whole, ends = b"".join(stored), np.cumsum([len(x) for x in stored]) // unit * samples
        signal = upsample(decode(codec, whole), ends)
        raw, edges = signal.astype("<i2").tobytes(), np.concatenate(([0], 4 * ends)).tolist()
        out = [{"pcm": raw[a:b]} for a, b in zip(edges, edges[1:], strict=False)]
        found = features(signal, 2 * ends) if digest else {}
        for i, (r, own) in enumerate(zip(out, stored, strict=True) if digest else ()):
            r |= {"payload_bytes": len(own), "payload_sha256": hashlib.sha256(own).hexdigest(), "tail_crc32": zlib.crc32(own[-64:]), "media_bytes": len(media[i]), "media_sha256": hashlib.sha256(media[i]).hexdigest()}
            r["feature"] = f"{codec};" + ";".join(f"{k}={v[i]}" for k, v in found.items()) + f";pcm_crc32={zlib.crc32(r['pcm'])}"
        return out

    def run(batches):
        for b in batches:
            files = b.column(2).to_pylist()
            for lo, hi in passes(files, PASS_BYTES):
                read = [read_wave(m) for m in files[lo:hi]]
                made: list[dict] = [{}] * (hi - lo)
                for codec in sorted({c for c, _, _ in read}):
                    mine = [i for i, (c, _, _) in enumerate(read) if c == codec]
                    for i, r in zip(mine, rows(codec, [files[lo + i] for i in mine], [read[i][2] for i in mine]), strict=True):
                        made[i] = r
                kinds = [pa.binary() if k == "pcm" else pa.string() if k in strings else pa.int64() for k in names]
                arrays = [pa.array([r[k] for r in made], kind) for k, kind in zip(names, kinds, strict=True)]
                yield pa.RecordBatch.from_arrays([b.column(0).slice(lo, hi - lo), b.column(1).slice(lo, hi - lo), *arrays], ["doc_id", "n_bytes", *names])

    kind = files.schema["doc_id"].dataType.simpleString()
    columns = ", ".join(f"{k} {'binary' if k == 'pcm' else 'string' if k in strings else 'long'}" for k in names)
    return files.select("doc_id", "n_bytes", "media").mapInArrow(run, f"doc_id {kind}, n_bytes long, {columns}")


def telephony(docs: DataFrame, codec: str | None = None) -> DataFrame:
    """doc_id, n_bytes and the digest of decode_media, a row for each row of docs: the files are written as a table to the shared folder, and
    what is read back from there is decoded."""
    return decode_media(materialize(encode_texts(docs, codec), "media"), pcm=False)
