import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st
from sentencepiece import SentencePieceProcessor

from talus.llm import pieces

PATH = public_tokenizers.path("piece_bpe_32k.model")
LIBRARY = SentencePieceProcessor(model_file=PATH)
HARD = ["", " ", "  ", "a", " a", "a  b   c", "tail  ", "\n", "a\nb\t c", "日本語 café", "🙂👍🏽", "▁", "a▁b ▁ c", "<s> </s> <unk>", "x" * 500, "\u0000 \u200b", "<0x0A>", "the quick brown fox"]


@pytest.fixture(scope="module")
def plain():
    return pieces.Pieces(PATH)


@pytest.fixture(scope="module")
def dropped():
    return pieces.Pieces(PATH, 0.3, 7)


def ids(model, text):
    return np.frombuffer(model.encode(text), "<i4").tolist()


@pytest.mark.parametrize("text", HARD)
def test_hard_texts(plain, dropped, text):
    if "▁" not in text:
        assert ids(plain, text) == LIBRARY.encode(text)
    for m in (plain, dropped):
        assert m.decode(ids(m, text)) == text


@settings(max_examples=300, deadline=None)
@given(st.one_of(st.text(max_size=50), st.text(alphabet=" \nabthe▁é1", max_size=50)))
def test_any_text(plain, dropped, text):
    if "▁" not in text and "\0" not in text:
        assert ids(plain, text) == LIBRARY.encode(text)
    for m in (plain, dropped):
        assert m.decode(ids(m, text)) == text


def test_seeds_vary_and_repeat(dropped):
    text = "international communication networks everywhere"
    again, other = pieces.Pieces(PATH, 0.3, 7), pieces.Pieces(PATH, 0.3, 8)
    assert ids(again, text) == ids(dropped, text) != ids(other, text)
    assert len(ids(dropped, text)) > len(LIBRARY.encode(text))
    everything = pieces.Pieces(PATH, 1.0)
    assert len(ids(everything, "abc def")) == 8


def test_dropout_varies_by_occurrence_and_document(spark):
    """A word is segmented in several ways within one text, and equal texts of two documents differently; equal rows alike."""
    text = "communication " * 200
    docs = spark.createDataFrame([(1, text), (2, text), (2, text)], "doc_id long, text string")
    rows = [(r.doc_id, r.ids) for r in pieces.encode_pieces(docs, PATH, 0.1, 1).collect()]
    one, two, again = (ids for _, ids in sorted(rows))
    assert one != two == again
    model = pieces.Pieces(PATH, 0.1, 1)
    ways = set("/".join(model.piece[i] for i in one).split(pieces.SPACE))
    assert len(ways) > 5
    assert np.array(one, "<i4").tobytes() == model.encode(text, 1)


def agenda(model, text, document, rate, seed):
    """The definition, one candidate after the other: the best of all candidates that are adjacent and not skipped."""
    key, bar, out = pieces.xxhash.xxh64_intdigest(str(document), seed), int(rate * (1 << 32)), []

    def mixed(x):
        x = (x ^ x >> 30) * 0xBF58476D1CE4E5B9 % (1 << 64)
        x = (x ^ x >> 27) * 0x94D049BB133111EB % (1 << 64)
        return x ^ x >> 31

    for m in re.finditer(" *[^ ]+| +$", " " + text):
        part = [(m.start() + k, pieces.SPACE if c == " " else "\0\0" if c == pieces.SPACE else c) for k, c in enumerate(m[0])]
        while True:
            found = []
            for i in range(len(part) - 1):
                whole = part[i][1] + part[i + 1][1]
                drawn = mixed((key + (part[i][0] << 20 | len(whole)) * 0x9E3779B97F4A7C15) % (1 << 64)) >> 32
                if whole in model.id and drawn >= bar:
                    found.append((-LIBRARY.get_score(model.id[whole]), i))
            if not found:
                break
            i = min(found)[1]
            part[i : i + 2] = [(part[i][0], part[i][1] + part[i + 1][1])]
        for _, p in part:
            out += [model.id[p]] if p in model.id else [int(model.byte[b]) for b in (pieces.SPACE if p == "\0\0" else p).encode()]
    return out


@pytest.mark.parametrize("rate", [0.0, 0.1, 0.5])
def test_dropout_like_brute_force(rate):
    """Texts with short and very long words, spaces and odd characters, many in one pass."""
    rng = random.Random(2)
    words = ["communication", "aaaa", "international", "x▁ythe", " café", "日本語", "the", "a", "", "\n", "🙂", "electroencephalographically" * 4, "ab" * 60, "<s>", "<0x0A>"]
    texts = [" ".join(rng.choice(words) for _ in range(rng.randint(0, 40))) for _ in range(60)] + HARD
    model = pieces.Pieces(PATH, rate, 3)
    got = model.encode_all(texts, list(range(len(texts))))
    for k, text in enumerate(texts):
        ids = np.frombuffer(got[k], "<i4").tolist()
        assert ids == (agenda(model, text, k, rate, 3) if text else []), text[:60]
        assert model.decode(ids) == text


def test_the_rate_is_that_of_the_draws():
    place = np.arange(100_000)
    drawn = pieces.draws(np.full(len(place), 12345, np.uint64), place, np.full(len(place), 3))
    assert abs((drawn < int(0.1 * (1 << 32))).mean() - 0.1) < 0.005


def test_widths_and_heap_agree(monkeypatch):
    texts = ["international banana aaaaaaa x▁ythe café"] * 3
    model = pieces.Pieces(PATH, 0.3, 5)
    want = model.encode_all(texts, [1, 2, 3])
    monkeypatch.setattr(pieces, "WIDTHS", ())
    assert model.encode_all(texts, [1, 2, 3]) == want


def test_query_and_decoding(spark, data):
    from talus.llm.queries import queries

    rows = queries()["op6_merge_dropout"](spark, data).collect()
    assert rows and all(r.lossless for r in rows)
    model, texts = pieces.Pieces(PATH), {r.doc_id: r.text or "" for r in spark.read.parquet(f"{data}/documents.parquet").collect()}
    for r in rows[::20]:
        want = agenda(model, texts[r.doc_id], r.doc_id, 0.1, 1) if texts[r.doc_id] else []
        assert (r.n_ids, r.ids_crc32) == (len(want), zlib.crc32(np.array(want, "<i4").tobytes()))
    docs = spark.createDataFrame([(1, None, 3), (2, "", 4), (None, "a b", 5), (3, "x ▁ y" * 2000, 6)], "doc_id long, text string, ids int")
    encoded = pieces.encode_pieces(docs, PATH)
    back = {r.doc_id: r.text for r in pieces.decode_pieces(encoded, PATH).collect()}
    assert back == {1: "", 2: "", None: "a b", 3: "x ▁ y" * 2000}
    assert pieces.encode_pieces(docs.limit(0), PATH).collect() == []
