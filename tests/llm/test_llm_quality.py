"""Classifier and weak supervision on held-out labels, counts against a plain version."""

import re
from collections import Counter

import numpy as np
import pytest

from stratus.llm import quality_classifier as Q
from stratus.llm import quality_rules as R
from stratus.llm.common import read

SF = "/root/testdata/sf0.01"
DOCS = "doc_id long, text string"


def plain_counts(text):
    words = re.findall("[^\x20\x09-\x0d]+", text or "")
    windows = Counter(zip(words, words[1:], words[2:]))
    covered = set()
    for i, w in enumerate(zip(words, words[1:], words[2:])):
        if windows[w] > 1:
            covered |= {i, i + 1, i + 2}
    lines = [x for x in (text or "").split("\n") if re.search("[^\x20\x09-\x0d]", x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")),
            len(lines) - len(set(lines)), len(covered))


def texts():
    rng = np.random.default_rng(1)
    pool = ["a", "b", "c", "é", "日本", "#x", "$$|", "A!", "end.", "\u00a0", "\x1f"]
    out = [None, "", " \n\t", "a b c a b c", "a a a a", "l\nl\nl \n\n", "x\u2028y", "w " * 50_000]
    for _ in range(80):
        out.append("".join(str(rng.choice(pool)) + str(rng.choice([" ", "\n", "\t", "  ", "\r", "\x0b"]))
                           for _ in range(int(rng.integers(0, 90)))))
    return out


def test_counts_match_the_plain_version(spark):
    rows = list(enumerate(texts()))
    docs = spark.createDataFrame([(i, t, 9) for i, t in rows], DOCS + ", n_words int")
    got = {r.doc_id: r for r in R.judge(docs).collect()}
    for i, t in rows:
        expected = plain_counts(t)
        assert tuple(got[i][c] for c in R.COUNTS[:5]) == expected, repr(t)[:80]
        assert got[i].base_failed == (expected[0] < 50 or 100 * expected[4] > 50 * expected[0])
        assert not (got[i].base_failed and got[i].kept)
    assert R.judge(docs.limit(0)).count() == 0


@pytest.fixture(scope="module")
def own(spark):
    return R._own_votes(R.GROUPS, list(R.rules()))


def simulated(seed, n=40_000):
    """Votes of the production rules on good documents and three bad kinds, each caught by some rules of its group.

    Every rule errs on every kind of document now and then, and abstains often.
    """
    rng = np.random.default_rng(seed)
    names = list(R.rules())
    kinds = [(), R.GROUPS["symbols"][:4], R.GROUPS["repetition"], R.GROUPS["shouting"]]
    kind = rng.choice(4, n, p=[0.86, 0.06, 0.05, 0.03])
    votes = np.zeros((n, len(names)), int)
    for i, r in enumerate(names):
        caught = np.array([r in own for own in kinds])[kind]
        says_bad = rng.random(n) < np.where(caught, 0.9, 0.02)
        votes[:, i] = np.where(rng.random(n) < 0.85, np.where(says_bad, -1, 1), 0)
    return kind == 0, votes


@pytest.mark.parametrize("seed", [2, 3])
def test_em_weighs_votes_of_several_bad_kinds(own, seed):
    """Production parameters: better than a majority and than all-must-pass, and neither of them."""
    good, votes = simulated(seed)
    patterns, at, weight = np.unique(votes, axis=0, return_inverse=True, return_counts=True)
    found = (R.estimate(patterns, weight.astype(float), own) >= 0.5)[at.ravel()]
    must_pass, majority = (votes >= 0).all(axis=1), votes.sum(axis=1) > 0
    right = (found == good).mean()
    assert right > 0.97 and right > (must_pass == good).mean() + 0.05 and right > (majority == good).mean() + 0.05
    one_bad = (votes < 0).sum(axis=1) == 1
    assert found[one_bad & good].mean() > 0.95              # a single bad vote does not reject by itself
    assert found[~good].mean() < 0.12


def test_em_without_bad_documents_keeps_nearly_all(own):
    """Only noise: no kind of bad document is made up from sound ones."""
    rng = np.random.default_rng(4)
    votes = np.where(rng.random((30_000, len(own[0]))) < 0.02, -1, 1)
    patterns, at, weight = np.unique(votes, axis=0, return_inverse=True, return_counts=True)
    assert ((R.estimate(patterns, weight.astype(float), own) >= 0.5)[at.ravel()]).mean() > 0.97


def test_verdicts_equal_an_independent_estimate(spark):
    """``kept`` against votes and EM of one's own, row by row."""
    docs = read(spark, SF, "documents")
    rows = {r.doc_id: r for r in R.judge(docs).collect()}
    texts = {r.doc_id: r.text for r in docs.collect()}
    names, bounds = list(R.rules()), {}
    for d, t in texts.items():
        c = dict(zip(R.COUNTS, R.counts(t)))
        n = max(c["n_words"], 1)
        x = {"word_length": c["word_chars"] / n, "short_words": c["n_short"] / n, "symbols": c["n_symbols"] / n,
             "symbol_words": c["n_symbol_words"] / n, "letters": c["n_plain_signs"] / n,
             "lines": c["n_dup_lines"] / max(c["n_lines"], 1), "repeats": c["n_repeat_words"] / n,
             "upper": c["n_upper"] / max(c["n_letters"], 1), "marks": c["n_marks"] / n, "sentences": c["n_ends"] / n,
             "length": n}
        good = {"word_length": 3 <= x["word_length"] <= 8, "short_words": x["short_words"] >= 0.15,
                "symbols": x["symbols"] < 0.02, "symbol_words": x["symbol_words"] < 0.02, "letters": x["letters"] < 0.1,
                "lines": x["lines"] < 0.1, "repeats": x["repeats"] < 0.2, "upper": x["upper"] < 0.15,
                "marks": x["marks"] < 0.05, "sentences": 0.01 <= x["sentences"] <= 0.4, "length": n >= 80}
        bad = {"word_length": not 2.5 <= x["word_length"] <= 10, "short_words": x["short_words"] < 0.02,
               "symbols": x["symbols"] > 0.1, "symbol_words": x["symbol_words"] > 0.1, "letters": x["letters"] > 0.2,
               "lines": x["lines"] > 0.3, "repeats": x["repeats"] > 0.45, "upper": x["upper"] > 0.4,
               "marks": x["marks"] > 0.3, "sentences": x["sentences"] > 0.8, "length": n < 50}
        bounds[d] = tuple(1 if good[r] else -1 if bad[r] else 0 for r in names)
    # EM over the documents one by one, in plain loops over classes and rules
    ids, kinds = sorted(bounds), list(R.GROUPS.values())
    resp = []
    for d in ids:
        share = []
        for own in kinds:
            v = [bounds[d][names.index(r)] for r in own]
            share.append(sum(a < 0 for a in v) / max(sum(a != 0 for a in v), 1))
        row = np.array([np.prod([1 - a for a in share]), *share]) + R.SMOOTHING
        resp.append(row / row.sum())
    resp = np.array(resp)
    for _ in range(R.ROUNDS):
        scores = np.zeros_like(resp)
        for k in range(resp.shape[1]):
            prior = resp[:, k].mean() * (1 - R.SMOOTHING) + R.SMOOTHING / resp.shape[1]
            scores[:, k] = np.log(prior)
            for j, r in enumerate(names):
                v = np.array([bounds[d][j] for d in ids])
                rate = np.array([resp[v == a, k].sum() / len(ids) + R.SMOOTHING / 3 for a in (-1, 0, 1)])
                rate /= rate.sum()
                if (k == 0 and rate[0] > rate[2]) or (k and r in kinds[k - 1] and rate[2] > rate[0]):
                    rate[0] = rate[2] = (rate[0] + rate[2]) / 2
                scores[:, k] += np.log(rate)[v + 1]
        new = np.exp(scores - scores.max(axis=1, keepdims=True))
        new /= new.sum(axis=1, keepdims=True)
        if np.abs(new - resp).max() < 1e-10:
            break
        resp = new
    for d, p in zip(ids, resp[:, 0]):
        assert abs(rows[d].posterior - p) < 1e-6
        assert rows[d].kept == (not rows[d].base_failed and rows[d].posterior >= 0.5)


def test_rules_keep_good_documents(spark):
    rows = (R.judge(read(spark, SF, "documents")).join(read(spark, SF, "labels"), "doc_id")
             .where("not base_failed").toPandas())
    assert rows[rows.quality == 1].kept.mean() > 0.97
    assert rows[rows.quality == 0].kept.mean() < 0.2


@pytest.fixture(scope="module")
def scored(spark):
    rows = Q.score_documents(read(spark, SF, "documents"), read(spark, SF, "labels"))
    return rows.join(read(spark, SF, "labels"), "doc_id").toPandas()


def test_held_out_labels_are_predicted(scored):
    rows = scored[scored.held_out]
    assert (rows.predicted == rows.quality).mean() > 0.95
    assert ((scored.predicted == 1) == (scored.score >= 0.3)).all()
    assert scored.score.between(0, 1).all()


def test_learning_ignores_held_out_labels_and_other_columns(spark):
    docs, labels = read(spark, SF, "documents"), read(spark, SF, "labels")
    from pyspark.sql import functions as F
    flipped = labels.withColumn("quality", F.when(Q.held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
    other = docs.withColumn("lang", F.lit("xx")).withColumn("source", F.lit(None).cast("string")).withColumn(
        "score", F.lit(1.0)).withColumn("statistics", F.lit("clash"))
    a = {r.doc_id: round(r.score, 9) for r in Q.score_documents(docs, labels).collect()}
    b = {r.doc_id: round(r.score, 9) for r in Q.score_documents(other, flipped).collect()}
    assert a == b


def test_odd_inputs(spark):
    docs = spark.createDataFrame([(1, None), (2, ""), (3, "a"), (3, "a"), (None, "b")], DOCS)
    empty = spark.createDataFrame([], "doc_id long, quality int")
    assert [r.score for r in Q.score_documents(docs, empty).collect()] == [0.5] * 5
    one_class = spark.createDataFrame([(1, 1), (2, 1), (2, None), (9, 0)], "doc_id long, quality int")
    assert {r.score for r in Q.score_documents(docs, one_class).collect()} == {1.0}
    both = spark.createDataFrame([(i, i % 2) for i in range(1, 4)] + [(None, 1)], "doc_id long, quality int")
    rows = Q.score_documents(docs, both).collect()
    assert len(rows) == 5 and all(0 <= r.score <= 1 for r in rows)
    assert Q.score_documents(docs.limit(0), both).count() == 0
    assert Q.keep_good(docs, one_class).columns == docs.columns


def test_cholesky_scores_equal_the_plain_densities(spark):
    rng = np.random.default_rng(6)
    p = len(Q.STATISTICS)
    x = {k: rng.normal(k, 1 + k, (400, p)) for k in (0, 1)}
    rows = [(k, [float(v) for v in r]) for k in (0, 1) for r in x[k]]
    model = Q.fit(spark.createDataFrame(rows, "label int, v array<double>"), "v", "label", pooled=0.0, identity=0.0)
    probe = rng.normal(0.5, 1.5, (50, p))
    logs = []
    for k in (0, 1):
        mean, cov = x[k].mean(axis=0), np.cov(x[k].T, bias=True)
        d = probe - mean
        logs.append(-0.5 * (d * np.linalg.solve(cov, d.T).T).sum(axis=1) - 0.5 * np.linalg.slogdet(cov)[1])
    raw = logs[1] - logs[0]
    squashed = np.clip(np.sign(raw) * np.log1p(abs(raw)), -Q.SQUASHED_LIMIT, Q.SQUASHED_LIMIT)
    assert np.allclose(model.odds(probe), squashed, atol=1e-3)
