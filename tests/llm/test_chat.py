"""Reply trees and the chat template."""

import hashlib
import random

from stratus.llm import chat as C
from stratus.llm import common


def test_escape_is_reversible():
    rng = random.Random(1)
    bits = ["<", "|", "<|", "\\", "<\\|", "[INST]", "[/INST]", "</s>", "<s>", "<<SYS>>", "<</SYS>>", "[\\INST]", "turn|>", "é", " ", "<|end|>"]
    for _ in range(3000):
        text = "".join(rng.choice(bits) for _ in range(rng.randrange(12)))
        assert C.unescaped(C.escaped(text)) == text
        assert "<|" not in C.escaped(text) and "</s>" not in C.escaped(text) and "[/INST]" not in C.escaped(text)


def test_format_and_parse():
    turns = [("system", "<|end|>"), ("user", None), ("assistant", "a</s>"), (None, ""), ("assistant", "<|turn|>é")]
    text, spans = C.formatted(turns)
    assert C.parsed(text) == [(r or "", t or "") for r, t in turns]
    assert "".join(C.unescaped(text[a:b]) for a, b in spans) == "a</s><|turn|>é"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_conversations_against_a_plain_version(spark):
    rng = random.Random(2)
    control = "</s>[INST] ok [/INST]"
    rows = [(c, t, rng.choice(["user", "assistant", "system"]), rng.choice([None, "", "hello", control, "é日本"]))
            for c in range(30) for t in range(rng.randrange(1, 40))]
    rows += [(-1, 0, "user", control), (-1, 1, "assistant", control), (None, 0, "user", "x"), (None, 1, "assistant", "y")]
    rows += [(77, t, "user" if t % 2 else "assistant", f"m{t}") for t in range(300)]
    shuffled = rng.sample(rows, len(rows))
    df = spark.createDataFrame([(*r, 0) for r in shuffled], "conv_id long, turn long, role string, text string, up int")
    got = {r.conv_id: tuple(r)[1:5] for r in C.format_all(df).collect()}
    for conv in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == conv), key=lambda r: r[1])
        said = "".join(f"{r}\n{t or ''}\n" for _, _, r, t in own)
        loss = "".join(t or "" for _, _, r, t in own if r == "assistant")
        assert got[conv] == (len(own), sha(said), len(loss), sha(loss))
    assert len(got) == len({r[0] for r in rows})


def test_trees_are_enumerated_and_ranked(spark):
    # 0 -> 1 -> 2, 0 -> 3 -> 4 -> 5; a second root 6; a cycle 8 <-> 9; 10 answers a message that is not there
    edges = [(0, None), (1, 0), (2, 1), (3, 0), (4, 3), (5, 4), (6, None), (8, 9), (9, 8), (10, 99)]
    scores = {2: 9.0, 5: 0.5}
    rows = [("t", n, p, "user" if n % 2 else "assistant", f"m{n}", scores.get(n, 1.0)) for n, p in edges]
    rows.append(rows[2])
    df = spark.createDataFrame(rows, "tree string, node long, parent long, role string, text string, score double")
    found, jumps = C.branches(df)
    assert {r.leaf: r.branch_score for r in found.collect()} == {2: 11 / 3, 5: 0.875, 6: 1.0, 10: 1.0}
    got = {}
    for r in C.paths(found.select("tree", "leaf"), jumps).collect():
        got.setdefault(r.leaf, []).append((r.up, r.node))
    assert {k: [n for _, n in sorted(v)] for k, v in got.items()} == {
        2: [2, 1, 0], 5: [5, 4, 3, 0], 6: [6], 10: [10]}
    best = C.conversations(C.best_branches(df, 2)).collect()
    assert sorted(r.leaf for r in best) == [2, 6]                 # mean scores 11/3, 1 (tie: 6 before 10), 0.875
    text = next(r.formatted for r in best if r.leaf == 2)
    assert [t for _, t in C.parsed(text)] == ["m0", "m1", "m2"]


def test_random_forests_against_a_plain_version(spark):
    rng = random.Random(5)
    rows, trees = [], {}
    for tree in ["a", "b", None, "deep"]:
        parents = {}
        for n in range(60 if tree != "deep" else 200):
            parents[n] = rng.choice([None, 999, *range(max(0, n - 3), n)]) if tree != "deep" else (n - 1 if n else None)
        score = {n: rng.choice([None, 0.0, 1.0, 2.5, -1.0]) for n in parents}
        trees[tree] = (parents, score)
        rows += [(tree, n, p, "user", f"{tree}{n}", score[n]) for n, p in parents.items()]
    df = spark.createDataFrame(rows, "tree string, node long, parent long, role string, text string, score double")
    want = {}
    for tree, (parents, score) in trees.items():
        if tree is None:
            continue                                     # joined below as a tree of its own name
        branches = []
        for leaf in set(parents) - set(parents.values()):
            path, at = [], leaf
            while at in parents:
                path.append(at)
                at = parents[at]
            known = [score[n] for n in path if score[n] is not None]
            branches.append((-(sum(known) / len(known)) if known else float("inf"), leaf, path))
        want[tree] = [(leaf, path[::-1]) for _, leaf, path in sorted(branches)[:3]]
    got = {}
    for r in C.best_branches(df.where("tree is not null"), 3).collect():
        got.setdefault((r.tree, r.leaf), {})[r.up] = r.node
    got = {k: [v[u] for u in sorted(v, reverse=True)] for k, v in got.items()}
    assert got == {(t, leaf): path for t, own in want.items() for leaf, path in own}


def test_a_trunk_under_many_branches_is_not_written_out_for_each(spark, monkeypatch):
    """400 messages in a row with 400 answers to the last: rows follow the messages, not their product."""
    rows = [("t", n, n - 1 if n else None, "user", "x", 0.0) for n in range(400)]
    rows += [("t", 1000 + i, 399, "assistant", "y", float(i)) for i in range(400)]
    df = spark.createDataFrame(rows, "tree string, node long, parent long, role string, text string, score double")
    sizes, write = [], common._written

    def counted(d, path):
        out = write(d, path)
        sizes.append(out.count())
        return out

    monkeypatch.setattr(common, "_written", counted)
    best = C.best_branches(df).collect()
    assert len(best) == 401 and {r.leaf for r in best} == {1399} and max(sizes) <= len(rows)


def test_very_long_texts_and_empty_trees(spark):
    rows = [("t", 0, None, "user", "w " * 200_000, None), ("t", 1, 0, "assistant", None, None), ("u", 0, 0, "user", "self", 1.0)]
    df = spark.createDataFrame(rows, "tree string, node long, parent long, role string, text string, score double")
    out = C.conversations(C.best_branches(df)).collect()
    assert [r.tree for r in out] == ["t"] and C.parsed(out[0].formatted) == [("user", "w " * 200_000), ("assistant", "")]
    assert C.best_branches(df.limit(0)).count() == 0


def test_empty_table(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert C.format_all(df).count() == 0
