"""Whitening against a plain eigendecomposition in exact and double arithmetic."""

import math
from fractions import Fraction

import numpy as np
import pytest

from stratus.llm import whitening as W

SCHEMA = "vec_id long, embedding array<float>, label int, component int, n string"


def frame(spark, vectors, schema=SCHEMA):
    return spark.createDataFrame([(i, v, 7, 9, "n") for i, v in enumerate(vectors)], schema)


def plain(vectors):
    """Fit list, sums, eigenvalues and components by brute force."""
    xs = [tuple(math.floor(256 * c) for c in v) for v in vectors
          if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    fit = sorted(set(xs))
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    a = np.array([[float(Fraction(n * c - s, n)) for c, s in zip(x, sums)] for x in fit])
    e, v = np.linalg.eigh(a.T @ a / n)
    return n, sums, e[::-1], v[:, ::-1]


def check(spark, vectors, df=None):
    rows = W.whiten(df if df is not None else frame(spark, vectors)).collect()
    n, sums, e, v = plain(vectors)
    usable = [(i, x) for i, x in enumerate(vectors)
              if x is not None and all(c is not None and math.isfinite(c) for c in x)]
    got = {(r.vec_id, r.component): r for r in rows}
    assert len(got) == len(rows) == 4 * len(usable)
    signs = {}
    for i, vec in usable:
        x = [math.floor(256 * c) for c in vec]
        for k in range(4):
            r = got[i, k + 1]
            assert (r.n, r.deviation) == (n, sum((n * c - s) ** 2 for c, s in zip(x, sums)))
            assert math.isclose(r.explained, e[k] / e.sum(), rel_tol=1e-9)
            assert r.identity_error < 1e-9
            want = np.dot([c - s / n for c, s in zip(x, sums)], v[:, k]) / math.sqrt(e[k])
            if abs(want) > 1e-3:
                signs.setdefault(k, math.copysign(1, want) * math.copysign(1, r.whitened))
            assert abs(r.whitened - signs.get(k, 1) * want) < 1e-7 * max(1, abs(want))


def test_matches_eigendecomposition(spark):
    rng = np.random.default_rng(5)
    scale = np.array([9.0, 5.0, 3.0, 2.0, 1.0, 0.5])
    vectors = [[float(np.float32(c)) for c in v] for v in rng.normal(size=(300, 6)) * scale]
    vectors += [vectors[3]] * 50 + [None, [1.0, None, 1.0, 1.0, 1.0, 1.0], [math.nan] + [0.0] * 5,
                                    [math.inf] + [0.0] * 5, [-0.0] * 6]
    check(spark, vectors)


def test_ill_conditioned_and_large_values(spark):
    """Neighbouring dimensions nearly equal, numbers of 2, 4 and 8 bytes, deviations beyond int64 sums."""
    rng = np.random.default_rng(6)
    base = rng.normal(size=(400, 4)) * np.array([1e6, 3e4, 1e3, 20.0])
    vectors = np.c_[base, base[:, 0] + rng.normal(size=400) * 0.02].tolist()
    df = frame(spark, vectors, SCHEMA.replace("float", "double"))
    rows = W.whiten(df).collect()
    n, sums, e, v = plain(vectors)
    by = {(r.vec_id, r.component): r for r in rows}
    for k in range(3):
        assert math.isclose(by[0, k + 1].explained, e[k] / e.sum(), rel_tol=1e-4)
    assert rows[0].identity_error < 1e-6
    x = [math.floor(256 * c) for c in vectors[0]]
    exact = sum((n * c - s) ** 2 for c, s in zip(x, sums))
    assert by[0, 1].deviation == (exact if exact < 2 ** 63 else None)


def test_small_component_survives(spark):
    """A component 10^-9 of the largest in size is found: the Gram matrix alone would lose it."""
    rng = np.random.default_rng(7)
    big, small = rng.integers(-2 ** 30, 2 ** 30, 200).astype(float), rng.integers(-2, 3, 200).astype(float)
    vectors = [[float(b), float(b + s), float(t)] for b, s, t in zip(big, small, rng.normal(size=200) * 1e8)]
    rows, d = W.distinct_vectors(frame(spark, vectors, SCHEMA.replace("float", "double")), "embedding")
    model = W.fit(rows, d)
    x = np.array([[math.floor(256 * c) for c in v] for v in vectors], np.longdouble)
    a = (x - x.mean(axis=0)).astype(float)
    want = np.linalg.svd(a)[1] ** 2 / len(a)
    assert np.allclose(model.eigenvalues, want, rtol=1e-5) and model.eigenvalues[2] > 0


def test_dependent_and_constant_dimensions(spark):
    rng = np.random.default_rng(8)
    base = rng.normal(size=(60, 2)).round(2)
    vectors = [[a, b, 1.5, a] for a, b in base.tolist()]
    rows = W.whiten(frame(spark, vectors)).collect()
    assert {r.component for r in rows} == {1, 2} and rows[0].identity_error < 1e-6
    assert math.isclose(sum({r.component: r.explained for r in rows}.values()), 1.0, rel_tol=1e-9)


def test_more_dimensions_than_vectors(spark):
    rng = np.random.default_rng(9)
    vectors = rng.normal(size=(3, 10)).tolist()
    rows = W.whiten(frame(spark, vectors)).collect()
    assert {r.component for r in rows} == {1, 2} and len(rows) == 6 and rows[0].identity_error < 1e-6


@pytest.mark.parametrize("vectors", [[], [None, None], [[1.0, 2.0]] * 5, [[], []], [[math.nan]]])
def test_without_components(spark, vectors):
    out = W.whiten(frame(spark, vectors))
    assert out.collect() == []
    assert out.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def test_lengths_ids_and_repeats(spark):
    rows = [(None, [0.0, 0.0]), (None, [1.0, 0.0]), (1, [0.0, 2.0]), (1, [0.0, 2.0]), (2, [1.0] * 5), (3, [5.0])]
    out = W.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert sorted((r.vec_id or 0) for r in out) == [0, 0, 0, 0, 1, 1, 1, 1] and {r.n for r in out} == {3}


def test_sums_in_a_tree(spark, monkeypatch):
    """More partitions than the fan-in: levels of partial sums give the same matrix."""
    monkeypatch.setattr(W, "SUM_BYTES", 1)
    rng = np.random.default_rng(10)
    x = rng.integers(-1000, 1000, (500, 3))
    df = spark.createDataFrame([(c,) for c in W.packed(x)], "x binary").repartition(11)
    got = W.added(df, lambda codes: (W.unpacked(codes, 3).T @ W.unpacked(codes, 3)).ravel().astype(float), 9)
    assert (got.reshape(3, 3) == x.T @ x).all()
    assert W.exact_sums(df, 3) == (500, x.sum(axis=0).tolist())


def test_packing():
    x = np.array([[0, -1, 2 ** 15 - 1], [2 ** 15, 0, 0], [2 ** 31, -2 ** 62, 5], [0, 0, 0]])
    codes = W.packed(x)
    assert [c[0] for c in codes] == [2, 4, 8, 2] and (W.unpacked(codes, 3) == x).all()
