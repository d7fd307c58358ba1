"""SimHash classes against brute force over all pairs."""

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from stratus.llm import simhash as S
from stratus.llm.components import components


def brute_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i:i + 3]) for i in range(max(len(words) - 2, 1))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_classes(rows):
    prints = [brute_fingerprint(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 3:
                root[find(i)] = find(j)
    out = []
    for i, (doc, _) in enumerate(rows):
        ids = [d for j, (d, _) in enumerate(rows) if find(j) == find(i) and d is not None]
        out.append((doc, f"{prints[i]:016x}", min(ids) if ids else None))
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(5)
    vocabulary = [f"w{i}" for i in range(300)] + ["Über", "日本", "A"]
    out = [(0, None), (1, ""), (2, " \t\n"), (3, "one"), (4, "ONE"), (5, "two words"), (6, "\x1fone")]
    for g in range(12):
        base = list(rng.choice(vocabulary, 400))
        for k in range(6):
            own = list(base)
            for _ in range(k % 4):
                own[int(rng.integers(400))] = str(rng.choice(vocabulary))
            out.append((100 * g + 10 + k, " ".join(own)))
    return out + [out[-1], (None, out[-1][1]), (None, "only without an id here"), (5000, "w1 " * 3000)]


@pytest.mark.parametrize("dense,block", [(512, 2048), (1, 8)])
def test_classes_match_brute_force(spark, rows, monkeypatch, dense, block):
    monkeypatch.setattr(S.links, "__defaults__", (3, dense, block))
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("fp", F.lit("clash"))
    got = sorted((tuple(r) for r in S.near_duplicate_classes(docs).collect()), key=str)
    assert got == brute_classes(rows)


@pytest.mark.parametrize("dense, block", [(16, 2048), (16, 8), (300, 64)])
def test_crowded_cells_lose_no_link(spark, dense, block):
    """700 fingerprints of one cell of the lower half: swapped segments below, flipped bits above."""
    rng = np.random.default_rng(7)
    base, fps = 0x5AA56996_12345678, set()
    for _ in range(700):
        x = int(base)
        for segment in rng.integers(0, 16, rng.integers(0, 3)):
            pair = x >> 2 * int(segment) & 3
            if pair in (1, 2):
                x ^= 3 << 2 * int(segment)
        for bit in rng.integers(32, 63, rng.integers(0, 7)):
            x ^= 1 << int(bit)
        fps.add(x)
    fps = sorted(fps)
    df = spark.createDataFrame([(int(np.uint64(f).astype(np.int64)),) for f in fps], "fp long")
    found = {(int(r.a) & (2**64 - 1), int(r.b) & (2**64 - 1)) for r in S.links(df, 3, dense, block).collect()}
    assert all((a ^ b).bit_count() <= 3 for a, b in found)

    def groups(pairs):
        root = {f: f for f in fps}

        def find(f):
            while root[f] != f:
                f = root[f]
            return f
        for a, b in pairs:
            x, y = sorted((find(a), find(b)))
            root[y] = x
        return {f: find(f) for f in fps}

    every = [(a, b) for i, a in enumerate(fps) for b in fps[:i] if (a ^ b).bit_count() <= 3]
    assert groups(found) == groups(every) and len(set(groups(every).values())) > 3


def test_keep_one_keeps_the_least_id_of_each_class(spark, rows):
    docs = spark.createDataFrame([(d, t, "x") for d, t in rows], "doc_id long, text string, fp string")
    kept = S.keep_one(docs)
    assert kept.columns == docs.columns
    expected = {(d, c) for d, _, c in brute_classes(rows)}
    ids = sorted((r.doc_id is None, r.doc_id) for r in kept.collect())
    assert ids == sorted((c is None, c) for c in {c for _, c in expected})


def test_manhattan_is_a_lower_bound(spark):
    rng = np.random.default_rng(1)
    pairs = [(int(a), int(a ^ sum(1 << int(b) for b in set(rng.integers(0, 63, 3)))))
             for a in rng.integers(-2**62, 2**62, 300)]
    df = spark.createDataFrame(pairs, "a long, b long").select(
        S._manhattan(F.col("a"), F.col("b")).alias("m"), F.bit_count(F.col("a").bitwiseXOR(F.col("b"))).alias("h"))
    assert all(r.m <= r.h for r in df.collect())


def test_empty_table(spark):
    assert S.near_duplicate_classes(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 140)] + [(7, 7), (200, 201), (201, 200)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 140)}, 200: 200, 201: 200}


def test_a_repeated_id_names_several_classes(spark):
    texts = [" ".join(f"{w}{i}" for i in range(60)) for w in ("alpha", "beta", "gamma", "delta")]
    rows = [(7, texts[0]), (7, texts[1]), (8, texts[1]), (7, texts[1]), (None, texts[2]), (None, texts[3]), (None, texts[0])]
    assert all((S.fingerprint(a) ^ S.fingerprint(b)).bit_count() > 3 for a in texts for b in texts if a != b)
    kept = S.keep_one(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(map(tuple, kept), key=str) == sorted(
        [(7, texts[0]), (7, texts[1]), (None, texts[2]), (None, texts[3])], key=str)
