"""Chunked encoding against the library's own encoding of whole texts, and exact round trips."""

import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from stratus.llm import byte_bpe as B


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("whole", pat_str=public_tokenizers.PATTERN, special_tokens={},
                             mergeable_ranks=B.ranks_of(public_tokenizers.path(B.VOCABULARY)))


@pytest.fixture(scope="module")
def encoder():
    return B.Encoder(B.ranks_of(public_tokenizers.path(B.VOCABULARY)), B.spelt_out(public_tokenizers.PATTERN))


ALPHABET = ["a", "b", "Z", "'", "'ll", "'s", " ", "  ", "\n", "\t", "\r\n", "7", "12", "é", "日本", "😀", "\x1c", "\x85",
            " ", "​", "́", "²", "Ⅷ", ".", "...", "<|endoftext|>", "\x00", "﻿",
            "՘", "Ᲊ", "Ɤ", "\U00010d4a", "\U00016d70", "١", "the", " word"]


def random_text(rng, n):
    return "".join(rng.choice(ALPHABET) for _ in range(n))


def test_pre_tokens_as_the_library_cuts_them(library, encoder):
    rng = random.Random(1)
    for text in [random_text(rng, rng.randrange(80)) for _ in range(2000)]:
        assert np.frombuffer(encoder.piece(text, len(text)), "<i4").tolist() == library.encode_ordinary(text)


def test_every_code_point(library, encoder):
    """Each code point between letters and beside a blank: its class is the library's."""
    for low in range(0, 0x110000, 0x8000):
        text = "".join(f"a{chr(c)}b {chr(c)}" for c in range(low, low + 0x8000) if not 0xD800 <= c < 0xE000)
        assert np.frombuffer(encoder.piece(text, len(text)), "<i4").tolist() == library.encode_ordinary(text)


def test_pattern_spelt_out():
    assert B.spelt_out(r"a\.[^b\]]|\[x]") == r"a\.[^b\]]|\[x]"
    assert B.spelt_out(r"\S+") .startswith(r"[^\U00000009-\U0000000d")
    with pytest.raises(ValueError):
        B.spelt_out(r"[\S]")


def test_ends_do_not_depend_on_what_follows(encoder):
    """An end that a cut text reports is an end of the whole text: REACH is far enough."""
    rng = random.Random(2)
    for _ in range(300):
        text = random_text(rng, 30)
        whole = set(encoder.ends(text, True))
        for cut in range(len(text)):
            assert set(encoder.ends(text[:cut], False)) <= whole


LONG = ["word and more'll  words\n\n  12 " * 60, "a" * 1500, "a" * 700 + " b" * 300 + " " * 400 + "c", "日本語" * 200,
        " " * 900, "\n" * 130 + "x" + " \n" * 300, "x" * 129, "x" * 140 + " ", "'ll" * 300, "1" * 333 + "a" * 333]


def test_spark_encoding_is_the_library_s(spark, library):
    rng = random.Random(3)
    texts = [None, "", " ", "a", "same", "same", *LONG, LONG[0], LONG[2],
             *[random_text(rng, rng.randrange(1, 900)) for _ in range(120)]]
    docs = spark.createDataFrame([(i % 60 if i % 7 else None, i, t, "k", 1) for i, t in enumerate(texts)],
                                 "doc_id long, i int, text string, key string, start int").repartition(5)
    want = {i: library.encode_ordinary(t or "") for i, t in enumerate(texts)}
    for chunk, overlap in [(128, 16), (64, 8), (500, 100), (B.CHUNK, B.OVERLAP)]:
        out = B.encode(docs, keep=("i", "key", "start", "doc_id"), chunk=chunk, overlap=overlap)
        rows = out.collect()
        assert out.columns == ["i", "key", "start", "doc_id", "ids"]
        assert {r.i: r.ids for r in rows} == want and len(rows) == len(texts)
        assert {(r.key, r.start) for r in rows} == {("k", 1)}
    back = {r.i: bytes(r.decoded) for r in B.decode(out, keep=("i",)).collect()}
    assert back == {i: (t or "").encode() for i, t in enumerate(texts)}


def test_very_long_text(spark, library):
    """Ten chunks of production size, and a run of one letter across several of them."""
    rng = random.Random(4)
    texts = [random_text(rng, 300_000), "z" * 250_000 + " end " * 20_000]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    rows = {r.doc_id: r.ids for r in B.encode(docs).collect()}
    assert all(rows[i] == library.encode_ordinary(t) for i, t in enumerate(texts))


def test_stitching_leaves_no_text_out(spark):
    texts = spark.createDataFrame([(str(i), t) for i, t in enumerate(LONG) if len(t) > 80], "key string, text string")
    shared = B._shared(spark, public_tokenizers.path(B.VOCABULARY), public_tokenizers.PATTERN)
    pieces = {}
    for r in B.stitched(texts, shared, 64, 16).collect():
        pieces.setdefault(r.key, []).append((r.start, r.until))
    for i, t in enumerate(LONG):
        if len(t) > 80:
            own = sorted(pieces[str(i)])
            assert own[0][0] == 0 and own[-1][1] == len(t)
            assert all(a[1] == b[0] for a, b in zip(own, own[1:]))


def test_empty_table_and_query_columns(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, ids int")
    assert B.encode(docs).collect() == []
    ids = spark.createDataFrame([(1, None), (2, []), (3, [64, 64])], "doc_id long, ids array<int>")
    assert [bytes(r.decoded) for r in B.decode(ids).orderBy("doc_id").collect()] == [b"", b"", b"aa"]
    out = B.round_trip(docs)
    assert out.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] and out.collect() == []
    one = B.round_trip(spark.createDataFrame([(1, None, 5)], docs.schema)).first()
    nothing = "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"
    assert (one.n_tokens, one.ids_sha256, one.decoded_sha256) == (0, nothing, nothing)
