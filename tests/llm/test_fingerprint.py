"""Fingerprints: order independence, edits by insertion and deletion, the row that follows."""

import hashlib

import numpy as np
import pytest

from stratus.llm.fingerprint import Fingerprint, compare_with_next, edited, edited_fingerprint


def random_text(rng, lines):
    words = [f"word{i}" for i in range(2000)]
    return "\n".join(" ".join(rng.choice(words, rng.integers(0, 30))) for _ in range(lines))


def test_sum_over_paragraphs_in_any_order():
    a, b, c = "first line here", "", "x"
    assert Fingerprint.of("\n".join([a, b, c])) == Fingerprint.of("\n".join([c, a, b]))
    assert str(Fingerprint.of(a) + Fingerprint.of(b)) == str(Fingerprint.of(a + "\n" + b))
    assert Fingerprint.of(a + "\n" + c) - Fingerprint.of(c) == Fingerprint.of(a)
    assert not Fingerprint.of("a a") == Fingerprint.of("a a a")
    assert Fingerprint.parse(str(Fingerprint.of(a))) == Fingerprint.of(a)
    assert Fingerprint.of(None) == Fingerprint.of("")


def test_edit_by_deletion_and_insertion_equals_the_edited_texts_own():
    rng = np.random.default_rng(2)
    for _ in range(60):
        a, b = (random_text(rng, int(rng.integers(0, 12))) for _ in "ab")
        assert edited_fingerprint(a, Fingerprint.of(a), b) == Fingerprint.of(edited(a, b))


def test_likeness_follows_the_share_of_common_text():
    rng = np.random.default_rng(3)
    near, far = [], []
    for _ in range(30):
        a, b = random_text(rng, 20), random_text(rng, 20)
        fa = Fingerprint.of(a)
        near.append(fa.likeness(edited_fingerprint(a, fa, b)))
        far.append(fa.likeness(Fingerprint.of(b)))
        assert fa.likeness(Fingerprint.of(a)) == 1.0
    assert min(near) > 0.4 > 0.3 > max(far) and abs(np.mean(near) - 2 / 3) < 0.1


def test_more_equal_windows_than_two_bytes_hold():
    a = "word " * 40_000
    fa, fe = Fingerprint.of(a), edited_fingerprint(a, Fingerprint.of(a), "other text " * 20_000)
    n, m = 40_000 - 2, len(a) * 2 // 3 // 5 - 2
    assert abs(fa.counts()).max() == n > 32_767
    # the edit's lanes: m of the same windows, and those of the two words that it inserts
    other = Fingerprint.of(edited(a, "other text " * 20_000))
    assert fe == other and 0.5 < fa.likeness(fe) < 1
    short = Fingerprint.of("word " * m)
    k = m - 2
    assert fa.likeness(short) == pytest.approx(2 * n * k / (n * n + k * k)) and fa.likeness(short) > 0.9
    for x in (fa, fe, short):
        assert Fingerprint.parse(str(x)) == x and Fingerprint.parse(str(x)).likeness(fa) == x.likeness(fa)
    assert fa - short + short == fa and len(str(short)) < len(str(fa))


def expected(rows):
    order = sorted(rows, key=lambda r: -r[0])
    out = {}
    for (d, t), (_, n) in zip(order, order[1:] + order[:1]):
        t, n = t or "", n or ""
        k = len(t) // 3
        new = t[:len(t) - k] + n[:k]
        own = Fingerprint.of(t)
        out[d] = (d, len(t), hashlib.sha256(new.encode()).hexdigest(), str(own), str(Fingerprint.of(new)),
                  own.likeness(Fingerprint.of(new)), own.likeness(Fingerprint.of(n)))
    return out


@pytest.mark.parametrize("parts", [1, 5, 40])
def test_every_row_meets_the_next_one(spark, parts):
    rng = np.random.default_rng(4)
    rows = [(int(i) * 7 - 50, random_text(rng, 4)) for i in range(60)] + [(1000, None), (1001, ""), (1002, "日本語 é" * 20)]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, bucket int").repartition(3)
    got = {r.doc_id: tuple(r) for r in compare_with_next(docs, parts).collect()}
    assert got == expected(rows)


def test_odd_tables(spark):
    schema = "doc_id long, text string"
    assert compare_with_next(spark.createDataFrame([], schema), 4).count() == 0
    one = compare_with_next(spark.createDataFrame([(7, "a b c d e f")], schema), 4).collect()
    assert [(r.doc_id, r.near_next) for r in one] == [(7, 1.0)]
    rows = [(1, "a b c"), (1, "a b c"), (1, "d e f"), (None, "x"), (None, "x"), (None, None)]
    got = compare_with_next(spark.createDataFrame(rows, schema), 3).collect()
    assert sorted(str(r.doc_id) for r in got) == ["1", "1", "1", "None", "None", "None"]
