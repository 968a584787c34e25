import zlib
from functools import cache

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from skyfold.llm.encoding import encoder
from skyfold.llm.token_file import CHUNK_IDS, decode_ids, encode_ids, token_digest

ODD = ["", " ", "a  b", "Hi there, you. And\nthen", ".a,b", "x ., y", "don't  stop", "é.è, ç", "á. b", "12.5,7", "a\tb\n\nc", " x y", "<|endoftext|> y", "q" * 5000, "a. b, " * 3000, "nul\0 x", "!!.? wow...", "a<|endoftext|>", "<|endoftext|><|endoftext|>\n b. <|endof text|>", "语言模型" * 2000, "日本。, x\n" * 300, "ab" * 70 + " " + "é" * 90]


@given(st.lists(st.one_of(st.integers(0, 3), st.integers(0, 50256), st.integers(0, 2**64 - 1)), max_size=900))
@settings(max_examples=60, deadline=None)
def test_round_trip(ids):
    assert decode_ids(encode_ids(np.array(ids, dtype=np.uint64))).tolist() == ids


def test_zeros_pack_tight():
    assert len(encode_ids(np.zeros(25_600, dtype=np.uint64))) < 40 + 4 * 101 + 8 * 300 + 1


def plain(vocabulary):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(vocabulary)
    return lambda x: t.encode(x or "", add_special_tokens=False).ids


loaded = cache(plain)


@given(st.lists(st.text(alphabet=st.sampled_from(list("ab.,' \n\t!é5́_A \x00")), max_size=12), max_size=6))
@settings(max_examples=300, deadline=None)
def test_pieces_encode_like_whole_texts(texts):
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.json")
    own, ref = encoder(path), loaded(path)
    ids, offsets = own(pa.array(texts, pa.string()))
    assert [ids[a:b].tolist() for a, b in zip(offsets, offsets[1:])] == [ref(x) for x in texts]


def test_digest_matches_brute_force(spark, make_docs, vocabulary):
    rows = [*enumerate(ODD, start=5), (1, None), (2, "same"), (2, "same"), (None, "no id")]
    found = sorted(tuple(r) for r in token_digest(make_docs(rows), vocabulary).collect() if r.doc_id is not None)
    ref, start, expected = plain(vocabulary), 0, []
    for i, text in sorted(rows, key=lambda r: -1 if r[0] is None else r[0]):
        ids = [*ref(text), 2]
        expected.append((i, start, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())))
        start += len(ids)
    assert found == [x for x in expected if x[0] is not None]


def test_several_chunks(spark, make_docs, vocabulary):
    """Texts of more ids than a chunk has, between short ones."""
    long = " ".join(f"w{k * 7919 % 100_003}" for k in range(90_000))
    rows = [(1, "first"), (2, long), (3, None), (4, long[::-1] + "<|endoftext|>"), (5, "x"), (6, long), (7, "last")]
    found = sorted(tuple(r) for r in token_digest(make_docs(rows), vocabulary).collect())
    ref, start = plain(vocabulary), 0
    for (i, text), got in zip(rows, found, strict=True):
        ids = [*ref(text), 2]
        assert got == (i, start, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes()))
        start += len(ids)
    assert start > 3 * CHUNK_IDS


def test_memory_stays_bounded(vocabulary):
    from skyfold.llm.encoding import KEPT_BYTES, Encoder

    own, ref = Encoder(vocabulary), plain(vocabulary)
    for k in range(12):
        texts = [" ".join(f"{(k * 1000 + n) * 7919 % 1_000_003}q{n}" for n in range(40_000)), "z" * 300_000]
        ids, offsets = own(pa.array(texts))
        assert ids[: offsets[1]].tolist() == ref(texts[0])
        assert own.pieces.nbytes + own.ids.nbytes + own.ends.nbytes <= KEPT_BYTES + 4_000_000
        assert max(map(len, own.pieces.to_pylist())) <= 64


def test_empty_table(spark, make_docs, vocabulary):
    assert token_digest(make_docs([]), vocabulary).count() == 0


def test_foreign_bytes():
    with pytest.raises(ValueError):
        decode_ids(b"\0" * 40)
