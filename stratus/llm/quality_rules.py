"""Quality rules by weak supervision (operator 9).

Each rule looks at one statistic of a whole text and votes good, bad, or
abstains. The rules form groups, each of which watches for one kind of bad
text. Expectation-maximisation over the counts of the vote patterns, taken
over all documents, estimates the shares of good documents and of every bad
kind, and how often each rule gives each vote on each of them; a document's
verdict is the posterior probability that its pattern comes from a good one.
No bad vote decides by itself: it weighs as much as its rule's estimated
accuracy, and several bad votes that go together outweigh the good votes of
rules that watch for something else.

The one assumption is that a rule is right more often than wrong: on good
documents it votes good at least as often as bad, on its own kind of bad ones
bad at least as often as good. No label is used, neither for the estimate nor
for the thresholds, which are common heuristics of corpus filtering.

The driver sees only the pattern counts, at most 3^11 rows whatever the corpus.

Cases: a null or empty text has all counts 0 and fails the base rules;
repeated rows get the same verdict; equal odds keep; an empty table gives no
rows; extra columns are ignored; texts of any length are counted whole.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratus.llm.common import written

LEAST_WORDS = 50
MOST_REPEATED_PERCENT = 50
ROUNDS = 500
# Pseudo-counts of EM: a share of the documents, so that estimates never reach 0 or 1.
SMOOTHING = 1e-6
_SPACES = (" ", "\t", "\n", "\v", "\f", "\r")
_SYMBOLS = np.frombuffer(b"#*$%&|<>", np.uint8)
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines",
          "n_upper", "n_letters", "n_marks", "n_ends", "n_short", "n_symbol_words", "n_plain_signs")
# Words that hold a symbol; words without a letter (bytes beyond ASCII count as letters).
_SYMBOL_WORD = re.compile(rb"[^ \t-\r]*[#*$%&|<>][^ \t-\r]*")
_NO_LETTER = re.compile(rb"(?<![^ \t-\r])[^A-Za-z\x80-\xff \t-\r]+(?![^ \t-\r])")
_C = (np.uint64(0x9E3779B185EBCA87), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9))


def counts(text: str | None) -> tuple[int, ...]:
    """The ``COUNTS`` of one whole text."""
    text = text or ""
    raw = text.encode("utf-8", "replace")
    words = raw.split()                          # on space and U+0009..U+000D
    n = len(words)
    if not n:
        return (0,) * len(COUNTS)
    seen = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    word_chars = len(text) - sum(text.count(c) for c in _SPACES)
    lines = [x for x in text.split("\n") if x.strip("".join(_SPACES))]
    repeated = 0
    if n > 3:
        digest = xxhash.xxh3_64_intdigest
        h = np.fromiter([digest(w) for w in words], np.uint64, n)
        windows = h[:-2] * _C[0] + h[1:-1] * _C[1] + h[2:] * _C[2]
        windows ^= windows >> np.uint64(31)
        _, group, size = np.unique(windows, return_inverse=True, return_counts=True)
        at = np.flatnonzero(size[group] > 1)
        covered = np.zeros(n, bool)
        for i in range(3):
            covered[at + i] = True
        repeated = int(covered.sum())
    ends = sum(w[-1] in b".!?" for w in words)
    return (n, word_chars, int(seen[_SYMBOLS].sum()), len(lines) - len(set(lines)), repeated, len(lines),
            int(seen[65:91].sum()), int(seen[65:91].sum() + seen[97:123].sum()),
            int(seen[[33, 63, 58, 59]].sum()), ends, sum(len(w) <= 3 for w in words),
            len(_SYMBOL_WORD.findall(raw)) if seen[_SYMBOLS].any() else 0, len(_NO_LETTER.findall(raw)))


def with_counts(docs: DataFrame) -> DataFrame:
    """doc_id and the ``COUNTS`` (long) of every row."""
    names = ["doc_id", *COUNTS]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [counts(t) for t in batch.column(1).to_pylist()]
            columns = zip(*rows) if rows else [[]] * len(COUNTS)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, pa.int64()) for c in columns)], names)

    schema = T.StructType([docs.schema["doc_id"]] + [T.StructField(c, T.LongType()) for c in COUNTS])
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def _vote(good: Column, bad: Column) -> Column:
    return F.when(good, 1).when(bad, -1).otherwise(0)


def rules() -> dict[str, Column]:
    """Rule votes over the ``COUNTS``: 1 good, -1 bad, 0 abstain."""
    n, c = F.greatest(F.col("n_words"), F.lit(1)), F.col
    length = c("word_chars") / n
    symbols = c("n_symbols") / n
    lines = c("n_dup_lines") / F.greatest(c("n_lines"), F.lit(1))
    repeats = c("n_repeat_words") / n
    upper = c("n_upper") / F.greatest(c("n_letters"), F.lit(1))
    marks, ends, short = c("n_marks") / n, c("n_ends") / n, c("n_short") / n
    marked, signs = c("n_symbol_words") / n, c("n_plain_signs") / n
    return {
        "word_length": _vote(length.between(3, 8), (length < 2.5) | (length > 10)),
        "short_words": _vote(short >= 0.15, short < 0.02),
        "symbols": _vote(symbols < 0.02, symbols > 0.1),
        "symbol_words": _vote(marked < 0.02, marked > 0.1),
        "letters": _vote(signs < 0.1, signs > 0.2),
        "lines": _vote(lines < 0.1, lines > 0.3),
        "repeats": _vote(repeats < 0.2, repeats > 0.45),
        "upper": _vote(upper < 0.15, upper > 0.4),
        "marks": _vote(marks < 0.05, marks > 0.3),
        "sentences": _vote(ends.between(0.01, 0.4), ends > 0.8),
        "length": _vote(n >= 80, n < LEAST_WORDS),
    }


# What the rules of a group watch for together; a rule may belong to several.
GROUPS = {"symbols": ("symbols", "symbol_words", "letters", "word_length", "short_words"),
          "repetition": ("lines", "repeats"),
          "shouting": ("upper", "marks", "sentences"),
          "fragments": ("length", "word_length", "sentences")}


def _own_votes(groups: dict[str, tuple[str, ...]], names: list[str]) -> np.ndarray:
    """(bad kind, rule): whether the rule watches for the kind."""
    return np.array([[r in own for r in names] for own in groups.values()])


def estimate(patterns: np.ndarray, weights: np.ndarray, own: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """Posterior probability of good for each row of ``patterns`` (votes -1, 0, 1), by EM.

    Classes are good and one bad kind a group; ``own`` tells which rules watch
    for which kind. Votes are independent given the class. It starts from the
    share of bad votes in each group.
    """
    if not len(patterns):
        return np.zeros(0)
    w = weights / weights.sum()
    one_hot = np.stack([patterns == v for v in (-1, 0, 1)], axis=2).astype(float)
    bad, cast = (patterns < 0) @ own.T.astype(float), (patterns != 0) @ own.T.astype(float)
    share = bad / np.maximum(cast, 1.0)
    p = np.column_stack([np.prod(1 - share, axis=1), share])
    p = (p + SMOOTHING) / (p + SMOOTHING).sum(axis=1, keepdims=True)
    # rules whose bad votes may not outnumber the good ones in a class, and the other way round
    right = np.vstack([np.ones((1, own.shape[1]), bool), own])
    for _ in range(rounds):
        mass = np.einsum("i,ik,irv->krv", w, p, one_hot) + SMOOTHING / 3
        vote = mass / mass.sum(axis=2, keepdims=True)
        for k in range(len(vote)):
            low, high = (0, 2) if k == 0 else (2, 0)          # the vote that may not prevail, the one that must
            wrong = right[k] & (vote[k, :, low] > vote[k, :, high])
            middle = (vote[k, :, 0] + vote[k, :, 2]) / 2
            vote[k, wrong, 0] = vote[k, wrong, 2] = middle[wrong]
        prior = (w @ p) * (1 - SMOOTHING) + SMOOTHING / p.shape[1]
        logs = np.log(prior)[None] + np.einsum("irv,krv->ik", one_hot, np.log(vote))
        new = np.exp(logs - logs.max(axis=1, keepdims=True))
        new /= new.sum(axis=1, keepdims=True)
        done = np.abs(new - p).max() < 1e-10
        p = new
        if done:
            break
    return p[:, 0]


def judge(docs: DataFrame) -> DataFrame:
    """doc_id, the counts, base_failed, posterior and kept for every row."""
    votes = rules()
    code = sum((votes[r] + 1) * 3 ** i for i, r in enumerate(votes)).cast("int")
    table = written(with_counts(docs).withColumn("pattern", code), "counts")
    found = table.groupBy("pattern").agg(F.count(F.lit(1)).alias("n")).orderBy("pattern").collect()
    codes = np.array([r["pattern"] for r in found], np.int64)
    patterns = codes[:, None] // 3 ** np.arange(len(votes)) % 3 - 1
    posterior = np.full(3 ** len(votes), 0.0)
    posterior[codes] = estimate(patterns, np.array([r["n"] for r in found], float), _own_votes(GROUPS, list(votes)))
    known = dict(zip(codes.tolist(), posterior[codes].tolist()))
    spark = docs.sparkSession
    lookup = spark.createDataFrame(list(known.items()) or [(-1, 0.0)], "pattern int, posterior double")
    failed = (F.col("n_words") < LEAST_WORDS) | (
        100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words"))
    return (table.join(F.broadcast(lookup), "pattern")
                 .select("doc_id", *COUNTS[:5], failed.alias("base_failed"),
                         (~failed & (F.col("posterior") >= 0.5)).alias("kept"), "posterior"))
