"""The manifest against a plain recursive tree, and proofs that catch tampering."""

import random
import zlib
from hashlib import sha256

import pytest

from stratus.llm import merkle as M

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, path string, group int, pos string"


def h(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def leaf_of(r, text):
    return h(*map(field, (r["doc_id"], r["source"], r["lang"], r["n_chars"], text)))


def up(nodes):
    return [h(*nodes[i:i + 8]) for i in range(0, len(nodes), 8)]


def plain(rows):
    """(doc_id, leaf) -> sorted list of (subroot, root, proof, folded root, verified)."""
    groups = {}
    for r in rows:
        groups.setdefault(r["lang"], []).append(r)

    def climb(nodes, at):
        """Root of ``nodes`` and the siblings of the node at ``at`` by level, with its place."""
        steps = []
        while len(nodes) > 1:
            low = at - at % 8
            run = nodes[low:low + 8]
            steps.append((run[:at - low], run[at - low + 1:]))
            nodes, at = up(nodes), at // 8
        return nodes[0], steps

    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    leaves = {}
    for g in names:
        groups[g].sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf_of(r, r["text"])))
        leaves[g] = [leaf_of(r, r["text"]) for r in groups[g]]
    subroots = [climb(leaves[g], 0)[0] for g in names]
    out = {}
    for k, g in enumerate(names):
        root, high = climb(subroots, k)
        for i, r in enumerate(groups[g]):
            steps = climb(leaves[g], i)[1] + high
            text = r["text"]
            if r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 0 and text is not None:
                text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
            node = leaf_of(r, text)
            for before, after in steps:
                node = h(*before, node, *after)
            proof = h(*(s for before, after in steps for s in before + after))
            out.setdefault((r["doc_id"], leaves[g][i]), []).append((subroots[k], root, proof, node, node == root))
    return {k: sorted(v) for k, v in out.items()}


def run(spark, rows, parts=7):
    df = spark.createDataFrame([(r["doc_id"], r["text"], r["lang"], r["source"], r["n_chars"], "p", 3, "x") for r in rows],
                               SCHEMA).repartition(parts)
    got = {}
    for r in M.verify_documents(df).collect():
        got.setdefault((r.doc_id, r.leaf), []).append((r.subroot, r.root, r.proof_sha256, r.folded_root, r.verified))
    return {k: sorted(v) for k, v in got.items()}


def docs(n, langs, rng, ids=None):
    return [{"doc_id": i if ids is None else rng.choice(ids), "text": rng.choice([None, "", "Abc É ß", f"Text {i}", "x" * 50_000]),
             "lang": rng.choice(langs), "source": rng.choice([None, "web", "böok"]), "n_chars": rng.choice([None, 0, i])}
            for i in range(n)]


@pytest.mark.parametrize("n, langs", [(1, ["en"]), (8, ["en"]), (9, ["en"]), (64, ["en"]), (65, ["en"]), (3, [None, "a", "b"]),
                                      (700, [None, "", "en", "de", "é", "z"])])
def test_small_manifests(spark, n, langs):
    rows = docs(n, langs, random.Random(n))
    assert run(spark, rows) == plain(rows)


def test_many_subtrees_and_a_hot_group(spark):
    """One group holds most rows and reaches above the first stored level."""
    rng = random.Random(11)
    rows = docs(6000, ["en"] * 30 + ["de", None], rng)
    got = run(spark, rows)
    assert got == plain(rows)
    verdicts = [v[4] for k in got for v in got[k]]
    assert any(verdicts) and not all(verdicts)


def test_several_stored_levels(spark, monkeypatch):
    """Stored levels 0, 2, 4 and 6 of groups of unequal height."""
    monkeypatch.setattr(M, "STORED_EVERY", 2)
    rng = random.Random(12)
    rows = docs(4200, ["a"] * 60 + ["b"] * 3 + ["c"], rng) + docs(1, ["lone"], rng)
    assert run(spark, rows) == plain(rows)


def test_many_groups(spark):
    rng = random.Random(13)
    rows = docs(400, [f"g{i}" for i in range(150)], rng)
    assert run(spark, rows) == plain(rows)


def test_repeated_and_null_ids(spark):
    rng = random.Random(14)
    rows = docs(90, ["en", None], rng, ids=[None, 1, 2, 3])
    rows += rows[:20]
    got, want = run(spark, rows), plain(rows)
    assert got.keys() == want.keys()
    assert {k: [v[:2] for v in x] for k, x in got.items()} == {k: [v[:2] for v in x] for k, x in want.items()}
    assert sorted(v for x in got.values() for v in x) == sorted(v for x in want.values() for v in x)


def test_empty_table(spark):
    out = M.verify_documents(spark.createDataFrame([], SCHEMA))
    assert out.collect() == []
    assert out.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def test_tampering_is_found(spark):
    rows = [{"doc_id": i, "text": "Upper", "lang": "en", "source": "s", "n_chars": 5} for i in range(30)]
    for (doc, _), [(_, root, _, fold, ok)] in run(spark, rows).items():
        drawn = zlib.crc32(str(doc).encode()) % 3 == 0
        assert ok == (not drawn) == (fold == root)
