import hashlib
import zlib

import numpy as np
import pytest

from talus.llm import media


def test_mulaw_and_alaw_known_values():
    assert media.MULAW[[0xFF, 0x7F, 0x80, 0x00]].tolist() == [0, 0, 32124, -32124]
    assert media.ALAW[[0xD5, 0x55, 0xAA, 0x2A]].tolist() == [8, -8, 32256, -32256]
    for t in (media.MULAW, media.ALAW):
        assert sorted(np.abs(t[:128].astype(int))) == sorted(np.abs(t[128:].astype(int)))


def slow_ima(block):
    """One block, sample by sample."""
    value, index = int.from_bytes(block[:2], "little", signed=True), min(block[2], 88)
    out = [value]
    for byte in block[4:]:
        for code in (byte & 15, byte >> 4):
            step = int(media.STEPS[index])
            diff = (step >> 3) + (step if code & 4 else 0) + (step >> 1 if code & 2 else 0) + (step >> 2 if code & 1 else 0)
            value = max(-32768, min(32767, value - diff if code & 8 else value + diff))
            index = max(0, min(88, index + int(media.MOVES[code])))
            out.append(value)
    return out


def test_adpcm_across_blocks():
    b = np.random.default_rng(1).integers(0, 256, (50, media.BLOCK)).astype(np.uint8)
    got = media.decode_ima(b)
    assert [row.tolist() for row in got] == [slow_ima(x.tobytes()) for x in b]


@pytest.mark.parametrize("codec", list(media.TAGS))
def test_container_round_trip(codec):
    data = bytes(range(256)) * 3
    assert media.read_wave(media.wave(data, codec)) == (codec, 8000, data)
    with pytest.raises(ValueError):
        media.read_wave(b"RIFFxxxx")


def test_resampling():
    assert media.upsample(np.array([0, 10, -10], np.int16)).tolist() == [0, 5, 10, 0, -10, -10]
    assert media.upsample(np.zeros(0, np.int16)).tolist() == []
    assert media.upsample(np.array([0, 10, -10, 8], np.int16), np.array([2, 4])).tolist() == [0, 5, 10, 10, -10, -1, 8, 8]


def test_features_of_joined_signals():
    rng = np.random.default_rng(4)
    parts = [rng.integers(-32768, 32767, n).astype(np.int16) for n in (1, 5, 300, 2)]
    got = media.features(np.concatenate(parts), np.cumsum([len(x) for x in parts]))
    for i, x in enumerate(parts):
        wide = x.astype(int).tolist()
        want = (len(x), max(map(abs, wide)), sum(v * v for v in wide) // len(x), sum((a < 0) != (b < 0) for a, b in zip(wide, wide[1:])))
        assert tuple(int(v[i]) for v in got.values()) == want


def by_hand(t):
    """Payload, file and PCM of one text, each decoded by itself."""
    p = t + b"\0" * (-len(t) % 64 or (0 if t else 64))
    codec = sorted(media.TAGS)[zlib.crc32(p) % 3]
    narrow = [v for k in range(0, len(p), 64) for v in slow_ima(p[k : k + 64])] if codec == "ima" else [int({"mulaw": media.MULAW, "alaw": media.ALAW}[codec][x]) for x in p]
    wide = [x for a, b in zip(narrow, [*narrow[1:], narrow[-1]], strict=True) for x in (a, (a + b) >> 1)]
    return codec, p, media.wave(p, codec), np.array(wide, np.int16)


def test_query(spark, data):
    """All columns of all rows, each text coded and decoded by itself; all codecs occur."""
    from talus.llm.queries import queries

    docs = {r.doc_id: (r.text or "").encode() for r in spark.read.parquet(f"{data}/documents.parquet").collect()}
    codecs, rows = set(), queries()["op4_telephony_audio"](spark, data).collect()
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    for r in rows:
        t = docs[r.doc_id]
        codec, p, file, pcm = by_hand(t)
        codecs.add(codec)
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(t), len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-64:]))
        assert (r.media_bytes, r.media_sha256) == (len(file), hashlib.sha256(file).hexdigest())
        x = pcm.astype(int)
        want = {"n": len(x), "peak": abs(x).max(), "energy": int((x * x).sum()) // len(x), "crossings": int(((x[1:] < 0) != (x[:-1] < 0)).sum()), "pcm_crc32": zlib.crc32(pcm.astype("<i2").tobytes())}
        assert r.feature == f"{codec};" + ";".join(f"{k}={v}" for k, v in want.items())
    assert codecs == set(media.TAGS)


def test_real_outputs_and_odd_rows(spark):
    df = spark.createDataFrame([(1, None, 0), (None, "", 1), (2, "héllo" * 40, 2), (2, "héllo" * 40, 2), (3, "x" * 3_000_000, 3)], "doc_id int, text string, pcm int")
    files = media.encode_texts(df, codec="alaw")
    rows = files.collect()
    assert len(rows) == 5
    texts = {1: b"", None: b"", 2: ("héllo" * 40).encode(), 3: b"x" * 3_000_000}
    for r in rows:
        codec, _, coded = media.read_wave(bytes(r.media))
        assert codec == "alaw" and coded == media.payload(texts[r.doc_id])
    for r in media.decode_media(files, digest=False).collect():
        p = np.frombuffer(media.payload(texts[r.doc_id]), np.uint8)
        assert bytes(r.pcm) == media.upsample(media.ALAW[p]).astype("<i2").tobytes()
    assert media.telephony(df.limit(0)).collect() == []
