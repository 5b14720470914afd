import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from talus.llm import bpe, packing

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)
HARD = [
    "", " ", "  ", "a", " a", "a  b", "a   b", "a \n b", "a\n\n b", "a \n\nb  ", "x\n ", "x \n", "\n \n", "it's we'll I'M", "  lead", "tail  ", "\t\ttab\tx", "a\u00a0 b\u2003c", "a\u00a0",
    "日本語テキスト café naïve", "🙂🙂 emoji👍🏽", "1234567890 12 3", "a<|endoftext|>b", "<|endoftext|>", "x <|endoftext|> y <|endoftext|>", "<|endoftext|><|endoftext|> ", "<|endoftext| >",
    "word," * 50, "a|b|c|", " |", "...", "\x1c x\x1d \x85y", "e\u0301 \u200d x", "a" * 5000, "ab" * 3000, " " * 300 + "x", "\r\n\r\n x",
]


def library_ids(text):
    return LIBRARY.encode(text, add_special_tokens=False).ids


@pytest.fixture(scope="module")
def counter():
    return bpe.Counter(PATH)


@pytest.fixture(scope="module")
def encoder():
    return bpe.Encoder(PATH)


@pytest.mark.parametrize("text", HARD)
def test_hard_texts(counter, encoder, text):
    want = library_ids(text)
    assert counter.count(text) == len(want)
    assert np.frombuffer(encoder.encode(text), encoder.dtype).tolist() == want


@settings(max_examples=300, deadline=None)
@given(st.one_of(st.text(max_size=60), st.text(alphabet=" \n\t\u00a0ab'sé1.,<|endoftext>", max_size=60)))
def test_any_text(counter, encoder, text):
    want = library_ids(text)
    assert counter.count(text) == len(want)
    assert np.frombuffer(encoder.encode(text), encoder.dtype).tolist() == want


def test_every_space_and_letter_boundary(counter, encoder):
    for c in map(chr, [*range(1, 0x250), *range(0x2000, 0x2070), 0x3000, 0x1680, 0xFEFF]):
        text = f"ab {c} c{c}d {c}{c} e{c}"
        want = library_ids(text)
        assert counter.count(text) == len(want), hex(ord(c))
        assert np.frombuffer(encoder.encode(text), encoder.dtype).tolist() == want, hex(ord(c))


def test_contractions_at_the_front(counter):
    """A first chunk has no space before it: an apostrophe there may begin a contraction."""
    words = ["strong", "third", "s", "t", "relay", "vein", "llama", "mad", "dog", "other", "strong.", "third,", "dog|"]
    for text in [front + "'" + w for front in ("", "<|endoftext|>", "x <|endoftext|>") for w in words]:
        assert counter.count(text) == len(library_ids(text)), text


def test_count_query(spark, data):
    from talus.llm.queries import queries

    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{data}/documents.parquet").collect()}
    for r in queries()["op2_token_counts"](spark, data).collect():
        n = len(library_ids(docs[r.doc_id]))
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(docs[r.doc_id].encode()), n, n > 1024)


def test_counts_of_nulls_and_repeats(spark):
    df = spark.createDataFrame([(1, None, "x"), (1, "", "y"), (None, "a b", "z"), (2, "c", "c"), (2, "c", "c")], "doc_id int, text string, n_tokens string")
    got = sorted((tuple(r) for r in bpe.token_counts(df, PATH, limit=1).collect()), key=repr)
    assert got == sorted([(1, 0, 0, False)] * 2 + [(None, 3, 2, True)] + [(2, 1, 1, False)] * 2, key=repr)


def check_pieces(rows, pieces, end=0, window=1024):
    """Every id of every document lies in one piece; sequences are gapless and full, or a power of two."""
    ids = {(i, k): [*library_ids(t or ""), end] for k, (i, t) in enumerate(rows)}
    want = defaultdict(list)
    for (i, _), x in ids.items():
        want[i].append(x)
    cover = defaultdict(list)
    for p in pieces:
        cover[p.doc_id].append(p)
    assert set(cover) == set(want)
    for i, own in cover.items():
        assert sum(p.length for p in own) == sum(map(len, want[i]))
        for p in own:
            slices = [x[p.start : p.start + p.length] for x in want[i] if len(x) == p.doc_tokens]
            assert p.ids_crc32 in {zlib.crc32(np.array(s, "<u4").tobytes()) for s in slices if len(s) == p.length}
        if len(want[i]) == 1:
            at = 0
            for p in sorted(own, key=lambda p: p.start):
                assert p.start == at
                at += p.length
            assert at == own[0].doc_tokens
    sequences = defaultdict(list)
    for p in pieces:
        sequences[p.sequence_id].append((p.offset, p.length))
    for s in sequences.values():
        at = 0
        for offset, length in sorted(s):
            assert offset == at and length > 0
            at += length
        assert at == window or at & (at - 1) == 0 and at < window
    return sequences


def test_pack_query(spark, data):
    from talus.llm.queries import queries

    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{data}/documents.parquet").collect()]
    check_pieces(docs, queries()["op10_packing"](spark, data).collect())


def test_pack_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, "a<|endoftext|>b"), (None, "x y z"), (4, "word " * 9000), (5, "same"), (5, "same"), (6, "日本 " * 700)]
    df = spark.createDataFrame([(i, t, s, 0) for (i, t), s in zip(rows, ["a", None, "b", "a", "hot", "a", "a", None])], "doc_id long, text string, source string, block int")
    pieces = packing.pack(df, PATH, with_ids=True).collect()
    check_pieces(rows, pieces)
    assert all(len(p.ids) == p.length and zlib.crc32(np.array(p.ids, "<u4").tobytes()) == p.ids_crc32 for p in pieces)
    assert packing.pack(df.limit(0), PATH).collect() == []


def test_windows_keep_the_mixture(spark):
    """Two sources with shares 3:1; every full window is within a packet of each source's target."""
    rows = [(k, "a b c d e " * 200, "big") for k in range(60)] + [(100 + k, "f g h i j " * 200, "small") for k in range(20)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    share = defaultdict(lambda: defaultdict(int))
    for p in packing.pack(df, PATH, packet=64).collect():
        share[p.sequence_id][p.source] += p.length
    full = [s for s in share.values() if sum(s.values()) == 1024]
    assert len(full) > 60
    assert all(abs(s["small"] - 256) <= 2 * 64 for s in full[:-4])
