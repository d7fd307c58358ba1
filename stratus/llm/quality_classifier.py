"""Regularised quadratic discriminant over document statistics (operator 8).

Each text gives a vector of transformed statistics. Per class, Spark sums the
vectors and their products over the training rows; the driver turns these
sums (a fixed few hundred numbers) into shrunken class covariances and keeps
their Cholesky factors. The score of a text is the logistic of the difference
of the two Gaussian log densities, from two triangular products, map-only.

Cases: a null text counts as empty and gets a score like any other; repeated
rows are scored alike; labels that are null or belong to no document are
ignored; with no training row of one class every score is the share of the
other class (0.5 without any training row); equal statistics give equal
scores, and a score at the threshold is predicted good; texts of any length are
read whole; an empty table gives no rows. ``score_documents`` ignores extra
columns, ``keep_good`` keeps them, whatever they are called.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratus.llm.common import written

HELD_OUT_FOLDS = 5
THRESHOLD = 0.3
# Covariances: (1 - POOLED) * class + POOLED * pooled, then IDENTITY of it to the mean variance.
POOLED = 0.1
IDENTITY = 0.02
# Density log-odds are squashed to sign(x) log(1 + |x|), cut into bins of this width within
# +-SQUASHED_LIMIT, and calibrated by a logistic curve fitted to the bins' label counts: the
# statistics are not Gaussian, so the raw densities overstate their certainty.
BIN = 0.05
SQUASHED_LIMIT = 15.0

STATISTICS = ("n_words", "word_length", "word_length_spread", "symbols", "upper", "digits", "marks",
              "distinct_words", "repeated_windows", "repeated_lines", "words_per_line",
              "words_without_letters", "short_words", "longest_word")
_SYMBOLS = np.frombuffer(b"#*$%&|<>{}[]\\^~=+@_", np.uint8)
_MARKS = np.frombuffer(b"!?;:\"", np.uint8)


def statistics(text: str | None) -> np.ndarray:
    """Transformed statistics of one whole text: logs of counts, square roots of shares."""
    text = text or ""
    words = text.split()
    n = len(words)
    if not n:
        return np.zeros(len(STATISTICS))
    lengths = np.fromiter(map(len, words), np.int64, n)
    chars = np.bincount(np.frombuffer(text.encode("utf-8", "replace"), np.uint8), minlength=256)
    letters = chars[65:91].sum() + chars[97:123].sum() + chars[128:].sum() / 2
    lines = [x for x in text.split("\n") if x and not x.isspace()]
    windows = max(n - 2, 1)
    share = (chars[_SYMBOLS].sum() / lengths.sum(),
             chars[65:91].sum() / max(letters, 1),
             chars[48:58].sum() / lengths.sum(),
             chars[_MARKS].sum() / n,
             len(set(words)) / n,
             1 - len(set(zip(words, words[1:], words[2:]))) / windows if n > 2 else 0.0,
             1 - len(set(lines)) / max(len(lines), 1))
    plain = sum(map(str.isalpha, words))
    s = np.sqrt(np.maximum(share, 0.0))
    return np.array([np.log1p(n), np.log(lengths.mean()), np.log1p(lengths.std()), *s,
                     np.log(n / max(len(lines), 1)), np.sqrt(1 - plain / n),
                     np.sqrt((lengths <= 3).mean()), np.log(lengths.max())])


@F.pandas_udf(T.ArrayType(T.DoubleType()))
def _statistics(texts: pd.Series) -> pd.Series:
    return pd.Series([statistics(t) for t in texts])


def with_statistics(docs: DataFrame, out: str = "statistics", text: str = "text") -> DataFrame:
    return docs.withColumn(out, _statistics(F.col(text)))


@dataclass(frozen=True)
class Discriminant:
    """Class log priors, means and inverse Cholesky factors, on standardised statistics."""

    share: float                 # of label 1; the score when a class is missing
    centre: np.ndarray
    scale: np.ndarray
    means: np.ndarray | None = None
    factors: np.ndarray | None = None      # inverses of the lower Cholesky factors
    constants: np.ndarray | None = None    # log prior - half log determinant
    slope: float = 1.0
    offset: float = 0.0

    def odds(self, x: np.ndarray) -> np.ndarray:
        """Squashed log density difference of label 1 and label 0."""
        z = (x - self.centre) / self.scale
        logs = [c - 0.5 * (((z - m) @ f.T) ** 2).sum(axis=1)
                for m, f, c in zip(self.means, self.factors, self.constants)]
        raw = logs[1] - logs[0]
        return np.clip(np.sign(raw) * np.log1p(np.abs(raw)), -SQUASHED_LIMIT, SQUASHED_LIMIT)

    def scores(self, x: np.ndarray) -> np.ndarray:
        if self.means is None:
            return np.full(len(x), self.share)
        return 1 / (1 + np.exp(-(self.slope * self.odds(x) + self.offset)))


def fit(training: DataFrame, vector: str, label: str, pooled: float = POOLED,
        identity: float = IDENTITY) -> Discriminant:
    """Discriminant of the rows of ``training`` (label 0 or 1, statistics in ``vector``).

    Only sums reach the driver: two rows of 1 + p + p(p+1)/2 numbers, then the
    label counts of the calibration bins (two rows for each of 601 bins at most).
    """
    p = len(STATISTICS)
    x = [F.col(vector)[i] for i in range(p)]
    pairs = [(i, j) for i in range(p) for j in range(i, p)]
    rows = (training.where(F.col(label).isin(0, 1)).groupBy(F.col(label).alias("__label"))
            .agg(F.count(F.lit(1)).alias("n"), F.array(*[F.sum(c) for c in x]).alias("s"),
                 F.array(*[F.sum(x[i] * x[j]) for i, j in pairs]).alias("ss")).collect())
    sums = {int(r["__label"]): r for r in rows}
    n = np.array([sums[k]["n"] if k in sums else 0 for k in (0, 1)], float)
    if not n.all():
        share = float(n[1] / n.sum()) if n.sum() else 0.5
        return Discriminant(share, np.zeros(p), np.ones(p))
    means = np.array([sums[k]["s"] for k in (0, 1)]) / n[:, None]
    seconds = np.zeros((2, p, p))
    for k in (0, 1):
        for (i, j), v in zip(pairs, sums[k]["ss"]):
            seconds[k, i, j] = seconds[k, j, i] = v / n[k]
    centre = (n @ means) / n.sum()
    spread = (n @ seconds.reshape(2, -1)).reshape(p, p) / n.sum() - np.outer(centre, centre)
    variance = np.diag(spread)
    scale = np.where(variance > 1e-12, np.sqrt(np.maximum(variance, 1e-12)), 1.0)
    means = (means - centre) / scale
    own = [(seconds[k] - np.outer(centre + means[k] * scale, centre + means[k] * scale))
           / np.outer(scale, scale) for k in (0, 1)]
    common = (n[0] * own[0] + n[1] * own[1]) / n.sum()
    factors, constants = [], []
    for k in (0, 1):
        c = (1 - pooled) * own[k] + pooled * common
        mean_variance = max(np.trace(c) / p, 1e-3)
        c = (1 - identity) * c + identity * mean_variance * np.eye(p)
        low = np.linalg.cholesky((c + c.T) / 2 + 1e-9 * np.eye(p))
        factors.append(np.linalg.inv(low))
        constants.append(np.log(n[k] / n.sum()) - np.log(np.diag(low)).sum())
    model = Discriminant(float(n[1] / n.sum()), centre, scale, means, np.array(factors),
                         np.array(constants))
    return replace(model, **_calibrated(training, vector, label, model))


def _calibrated(training: DataFrame, vector: str, label: str, model: Discriminant) -> dict:
    """Slope and offset of the logistic curve through the training rows' binned odds."""

    @F.pandas_udf(T.DoubleType())
    def odds(vectors: pd.Series) -> pd.Series:
        if not len(vectors):
            return pd.Series([], dtype=float)
        return pd.Series(model.odds(np.stack(vectors.to_numpy())))

    rows = (training.where(F.col(label).isin(0, 1))
            .groupBy(F.col(label).alias("__label"), F.round(odds(vector) / BIN).alias("__bin"))
            .agg(F.count(F.lit(1)).alias("n")).collect())
    y = np.array([r["__label"] for r in rows], float)
    t = np.array([r["__bin"] for r in rows], float) * BIN
    w = np.array([r["n"] for r in rows], float)
    w = w / np.where(y == 1, w[y == 1].sum(), w[y == 0].sum())      # classes weigh the same
    w /= w.sum()
    slope, offset, ridge = 1.0, 0.0, 1e-3
    for _ in range(100):                                             # Newton steps
        prob = 1 / (1 + np.exp(-np.clip(slope * t + offset, -60, 60)))
        g = np.array([(w * (prob - y) * t).sum() + ridge * slope, (w * (prob - y)).sum()])
        v = w * prob * (1 - prob)
        h = np.array([[(v * t * t).sum() + ridge, (v * t).sum()], [(v * t).sum(), v.sum() + 1e-9]])
        step = np.linalg.solve(h, g)
        step *= min(1.0, 1.0 / max(np.abs(step).max(), 1e-12))
        slope, offset = slope - step[0], offset - step[1]
        if np.abs(step).max() < 1e-9:
            break
    return {"slope": float(max(slope, 1e-3)), "offset": float(offset)}


def scorer(model: Discriminant) -> Callable[[Column], Column]:
    """Column function: statistics array to score."""

    @F.pandas_udf(T.DoubleType())
    def score(vectors: pd.Series) -> pd.Series:
        if not len(vectors):
            return pd.Series([], dtype=float)
        return pd.Series(model.scores(np.stack(vectors.to_numpy())))

    return score


def text_scorer(model: Discriminant) -> Callable[[Column], Column]:
    """Column function: text to score."""

    @F.pandas_udf(T.DoubleType())
    def score(texts: pd.Series) -> pd.Series:
        if not len(texts):
            return pd.Series([], dtype=float)
        return pd.Series(model.scores(np.stack([statistics(t) for t in texts])))

    return score


def held_out(doc_id: str = "doc_id") -> Column:
    """True for the fifth of the ids whose labels are never learnt."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % HELD_OUT_FOLDS == 0,
                      F.lit(False))


def _training(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Labels open to learning, joined to their documents' statistics."""
    known = labels.select("doc_id", F.col("quality").alias("label")).where(
        F.col("label").isNotNull() & ~held_out())
    return docs.select("doc_id", "statistics").join(known, "doc_id")


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted for every row; texts are read once."""
    table = written(with_statistics(docs.select("doc_id", "text")).select("doc_id", "statistics"),
                    "statistics")
    model = fit(_training(table, labels), "statistics", "label")
    score = scorer(model)
    return (table.select("doc_id", held_out().alias("held_out"),
                         score("statistics").alias("score"))
                 .withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int")))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` with predicted label 1, columns unchanged.

    Two passes over the texts, no shuffle of them: statistics of all rows for
    the training join, then a map-only filter by the fitted model.
    """
    table = written(with_statistics(docs.select("doc_id", "text")).select("doc_id", "statistics"),
                    "statistics")
    model = fit(_training(table, labels), "statistics", "label")
    return docs.where(text_scorer(model)(F.col("text")) >= THRESHOLD)
