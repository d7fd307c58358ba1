"""N-best segmentation against enumeration, and exact round trips."""

import random
import time

import numpy as np
import pytest

from stratus.llm import sentencepiece_codec as C


@pytest.fixture(scope="module")
def vocabulary():
    return C.Vocabulary.load()


def enumerate_all(v, text):
    out = []

    def walk(at, score, ids):
        if at == len(text):
            out.append((score, ids))
            return
        for end in range(at + 1, len(text) + 1):
            for start, s, own in v._edges(text, end):
                if start == at:
                    walk(end, score + s, ids + own)

    walk(0, 0.0, ())
    return sorted(out, key=lambda x: -x[0])


@pytest.mark.parametrize("chunk", [" the", " thnter", "ation", ".,", " ▁", "\n", "   ", "😀é", " thereing"])
def test_n_best_matches_enumeration(vocabulary, chunk):
    expected = enumerate_all(vocabulary, chunk)
    got = vocabulary.n_best(chunk, 5)
    assert np.allclose([s for s, _ in got], [s for s, _ in expected[:5]])
    assert all(abs(sum(vocabulary.scores[list(ids)]) - s) < 1e-9 for s, ids in got)
    ids, gap = vocabulary.solve([chunk])[chunk]
    assert np.isclose(vocabulary.scores[np.frombuffer(ids, "<u2")].sum(), expected[0][0])
    assert np.isclose(gap, expected[0][0] - expected[1][0] if len(expected) > 1 else np.inf)


@pytest.mark.parametrize("text", ["the thnt é", "a, b", "no\nno"])
def test_whole_text_alternatives_match_enumeration(vocabulary, text):
    expected = [s for s, _ in enumerate_all(vocabulary, " " + text)[:4]]
    ways = vocabulary.alternatives(*vocabulary.best([text])[0], 4)
    assert np.allclose([0.0] + [c for c, _ in ways], [expected[0] - s for s in expected])
    for _, edits in ways:
        ids = vocabulary.encode(text)
        for at, drop, own in reversed(edits):
            ids[at:at + drop] = own
        assert vocabulary.decode(ids) == text


def test_round_trips(vocabulary):
    rng = random.Random(3)
    alphabet = "ab e\n\t.,▁ é日😀\x00﻿'<0x41>"
    texts = ["", " ", "  a  ", "▁", "<s>", "a" * 5000, "\n\n"] + [
        "".join(rng.choice(alphabet) for _ in range(rng.randrange(60))) for _ in range(500)]
    for t in texts:
        assert vocabulary.decode(vocabulary.encode(t)) == t


@pytest.mark.parametrize("chunk, n", [("a" * 20_000, 2), ("x" * 5_000, 4), ("ab" * 3_000, 4), ("日" * 4_000, 2)])
def test_long_runs_end(vocabulary, chunk, n):
    """Countless equal paths: the search takes n steps a position, not one a path."""
    began = time.perf_counter()
    found = vocabulary.n_best(chunk, n)
    assert time.perf_counter() - began < 5
    assert all(b"".join(vocabulary.strings[i] for i in ids).decode() == chunk for _, ids in found)
    assert [s for s, _ in found] == sorted((s for s, _ in found), reverse=True)
    assert len({ids for _, ids in found}) == len(found)


@pytest.mark.parametrize("chunk", ["aaaaaaaa", "xxxxxxx", "ababab"])
def test_n_best_of_runs_matches_enumeration(vocabulary, chunk):
    expected = [s for s, _ in enumerate_all(vocabulary, chunk)[:6]]
    assert np.allclose([s for s, _ in vocabulary.n_best(chunk, 6)], expected)


def test_spark_encoding_and_decoding(spark, vocabulary):
    texts = [None, "", "The cat sat. The cat sat.", "x" * 3000, "same", "same"]
    docs = spark.createDataFrame([(i, t, 0) for i, t in enumerate(texts)], "doc_id long, text string, ids int")
    rows = {r.doc_id: r for r in C.encoded(docs).collect()}
    assert len(rows) == 6 and all(r.exact for r in rows.values())
    assert rows[0].ids == rows[1].ids == [] and rows[1].alternatives == [] and rows[1].score == 0
    assert rows[4].ids == rows[5].ids == vocabulary.encode("same")
    assert rows[2].n_pieces == len(rows[2].ids) and len(rows[2].alternatives) == C.N_BEST - 1
    assert all(w.score <= rows[2].score for w in rows[2].alternatives)
    back = {r.doc_id: r.text for r in C.decoded(C.encoded(docs)).collect()}
    assert back == {i: t or "" for i, t in enumerate(texts)}
    assert C.encoded(docs.limit(0)).count() == 0
