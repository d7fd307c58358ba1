"""Mixing against a sequential version, and its edge cases."""

import hashlib
import re

from stratus.llm import mixing as M


def brute(rows):
    size = [len(re.findall("[^\x20\x09-\x0d]+", t or "")) for _, t, _ in rows]
    place = [int(hashlib.md5(("" if d is None else str(d)).encode()).hexdigest()[:15], 16) for d, _, _ in rows]
    sources = sorted({s for _, _, s in rows}, key=lambda s: (s is None, s or ""))
    total = {s: sum(z for z, r in zip(size, rows) if r[2] == s) for s in sources}
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(sources)}
    capped = set()
    while True:
        free = sum(weight[s] for s in sources if s not in capped)
        level = (sum(total.values()) - 3 * sum(total[s] for s in capped)) / free if free else 0.0
        more = {s for s in sources if 3 * total[s] < level * weight[s]} | capped
        if more == capped:
            break
        capped = more
    target = {s: min(3.0 * total[s], level * weight[s]) for s in sources}
    out = []
    for i, (d, _, s) in enumerate(rows):
        whole = target[s] // total[s] if total[s] else 0
        budget = target[s] - whole * total[s]
        below = sum(z for z, p, r in zip(size, place, rows) if r[2] == s and p < place[i])
        own = sum(z for z, p, r in zip(size, place, rows) if r[2] == s and p == place[i])
        more = total[s] and (below + own <= budget or (
            below <= budget and below + own - budget < budget - below))
        out.append((d, size[i], total[s], target[s], int(size[i] * (whole + bool(more)))))
    return sorted(out, key=str)


def cases():
    rows = [(i, "w " * (i * 37 % 90), f"src{i % 5}" if i % 9 else None) for i in range(400)]
    rows += [(1000 + i, "a b\tc", "hot") for i in range(300)]
    return rows + [(1000, "a b\tc", "hot"), (None, "x y", "hot"), (None, None, "src1"), (5, "", "void")]


def test_matches_sequential_version(spark):
    rows = cases()
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, source string, size int")
    got = sorted((tuple(r) for r in M.mix(docs).collect()), key=str)
    assert got == brute(rows)
    again = sorted((tuple(r) for r in M.mix(docs.repartition(7)).collect()), key=str)
    assert again == got


def test_repeated_rows_are_the_mix(spark):
    rows = cases()
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    taken = {}
    for d, size, _, _, words in brute(rows):
        if size:
            taken[d] = taken.get(d, 0) + words // size
    got = {}
    for r in M.repeated(docs).collect():
        if r.text and r.text.split():
            got[r.doc_id] = got.get(r.doc_id, 0) + 1
    assert got == {d: n for d, n in taken.items() if n}


def test_empty_and_wordless_tables(spark):
    assert M.mix(spark.createDataFrame([], "doc_id long, text string, source string")).count() == 0
    got = M.mix(spark.createDataFrame([(1, None, None), (2, " ", "a")], "doc_id long, text string, source string"))
    assert {(r.doc_id, r.target, r.taken) for r in got.collect()} == {(1, 0.0, 0), (2, 0.0, 0)}
