"""Whitening of embeddings by shifted Cholesky QR (operator 11).

The fit list is every distinct vector once, as whole numbers x = floor(256 c).
Its centred rows A = x - S/n are orthogonalised without ever being stored
again: a pass over the list forms the Gram matrix of A R1^-1 R2^-1 ... by
triangular solves in the tasks, its Cholesky factor is the next R. The first
pass shifts the Gram matrix, so that its factor exists at any condition; two
more passes make the rows orthonormal. With R the product of the factors and G
the last Gram matrix, V = R' G R / n holds exactly, so the singular values and
right vectors of G^(1/2) R are the eigenvalues (as squares over n) and the
components of V. Nothing is squared on the way, which keeps small components.

A task sends one d x d matrix, matrices are added in a tree of bounded fan-in,
and the driver sees at most that many; it holds d x d numbers and the tasks
get as many. Vectors move once, packed, to find the distinct ones.

Cases: rows whose vector is null or holds a null, a NaN, an infinity or an
entry beyond a long are dropped. Of vectors of several lengths only the
commonest length among the distinct vectors (ties: the longest) can be
whitened together; rows of other lengths are dropped, too. Ids may be null or
repeated; equal vectors count once in the fit, and all their rows are
returned. Components whose eigenvalue is zero in double precision are left
out, so a table with one distinct vector, or none, gives no rows; where
eigenvalues are equal, any basis of their space. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratus.llm.common import written

SCALE = 256
COMPONENTS = 4
# Passes after the shifted one: two suffice unless dimensions are dependent.
MOST_PASSES = 6
ORTHONORMAL = 1e-12
# Bytes of partial sums that one task adds up at once.
SUM_BYTES = 64 * 1024 * 1024
# Rows that are solved together.
ROWS = 4096


# -- vectors ------------------------------------------------------------------

def whole(column: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, x as int64 matrix) of the usable vectors of a list column, by length."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    lengths = np.asarray(pc.fill_null(pc.list_value_length(column), -1))
    flat = pc.fill_null(pc.cast(column.flatten(), pa.float64()), float("nan")).to_numpy(zero_copy_only=False)
    x = np.floor(np.where(np.isfinite(flat), flat, 0.0) * SCALE)
    bad = ~np.isfinite(flat) | (np.abs(x) >= 2.0 ** 63)
    ends = np.cumsum(np.maximum(lengths, 0))
    starts = ends - np.maximum(lengths, 0)
    faults = np.concatenate([[0], np.cumsum(bad)])
    fit = (lengths >= 0) & (faults[ends] == faults[starts])
    x = np.where(bad, 0.0, x).astype(np.int64)
    out = []
    for d in np.unique(lengths[fit]):
        rows = np.flatnonzero(fit & (lengths == d))
        out.append((rows, x[starts[rows][:, None] + np.arange(d)]))
    return out


def packed(x: np.ndarray) -> list[bytes]:
    """Rows as bytes: the width of a number, then the numbers in the least of 2, 4 and 8 bytes."""
    low, high = x.min(axis=1, initial=0), x.max(axis=1, initial=0)
    need = np.where((low >= -2 ** 15) & (high < 2 ** 15), 2,
                    np.where((low >= -2 ** 31) & (high < 2 ** 31), 4, 8))
    out = [b""] * len(x)
    for width in np.unique(need):
        rows = np.flatnonzero(need == width)
        blob, size = x[rows].astype(f"<i{width}").tobytes(), int(width) * x.shape[1]
        for i, row in enumerate(rows.tolist()):
            out[row] = bytes([width]) + blob[i * size:(i + 1) * size]
    return out


def unpacked(codes: list[bytes], d: int) -> np.ndarray:
    """The int64 matrix of packed rows of ``d`` numbers."""
    x = np.empty((len(codes), d), np.int64)
    widths = np.array([c[0] for c in codes])
    for width in np.unique(widths):
        rows = np.flatnonzero(widths == width)
        x[rows] = np.frombuffer(b"".join([codes[i][1:] for i in rows]), f"<i{width}").reshape(len(rows), d)
    return x


def _codes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for _, x in whole(batch.column(0)):
            yield pa.RecordBatch.from_arrays(
                [pa.array(packed(x), pa.binary()), pa.array([x.shape[1]] * len(x), pa.int32())], ["x", "d"])


# -- sums over the fit list ---------------------------------------------------

def added(rows: DataFrame, block: Callable[[list[bytes]], np.ndarray], size: int) -> np.ndarray:
    """Sum of ``block`` (``size`` doubles) over the packed vectors, in one order at every run.

    Tasks add up their blocks; their sums are added in a tree by partition number.
    """
    def of_task(batches):
        total = np.zeros(size)
        for batch in batches:
            codes = batch.column(0).to_pylist()
            for at in range(0, len(codes), ROWS):
                total += block(codes[at:at + ROWS])
        yield pa.RecordBatch.from_arrays(
            [pa.array([TaskContext.get().partitionId()], pa.int64()), pa.array([total.tobytes()], pa.binary())],
            ["part", "sums"])

    def of_group(key, frame):
        frame = frame.sort_values("part")
        total = np.zeros(size)
        for s in frame["sums"]:
            total += np.frombuffer(s)
        return pd.DataFrame({"part": [key[0]], "sums": [total.tobytes()]})

    fan = max(2, min(64, SUM_BYTES // (8 * max(size, 1))))
    parts, count = rows.select("x").mapInArrow(of_task, "part long, sums binary"), rows.rdd.getNumPartitions()
    while count > fan:
        parts = parts.groupBy(F.floor(F.col("part") / fan).alias("part")).applyInPandas(
            of_group, "part long, sums binary")
        count = -(-count // fan)
    found = sorted((r.part, r.sums) for r in parts.collect())      # at most ``fan`` rows
    return sum((np.frombuffer(s) for _, s in found), np.zeros(size))


def exact_sums(rows: DataFrame, d: int) -> tuple[int, list[int]]:
    """Number of packed vectors and their sum by dimension, as exact integers."""
    def of_task(batches):
        n, total = 0, np.zeros(d, object)
        for batch in batches:
            codes = batch.column(0).to_pylist()
            for at in range(0, len(codes), ROWS):
                x = unpacked(codes[at:at + ROWS], d)
                # halves of 32 bits: no sum of a block can overflow
                total += ((x >> 32).sum(axis=0).astype(object) << 32) + (x & 0xFFFFFFFF).sum(axis=0).astype(object)
                n += len(x)
        if n:
            yield pa.RecordBatch.from_arrays(
                [pa.array([-1, *range(d)], pa.int32()), pa.array([str(v) for v in [n, *total]], pa.string())],
                ["place", "s"])

    sums = dict(rows.select("x").mapInArrow(of_task, "place int, s string")
                .groupBy("place").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).collect())
    return int(sums.get(-1, 0)), [int(sums.get(j, 0)) for j in range(d)]


# -- the factorisation --------------------------------------------------------

def solved(a: np.ndarray, r: np.ndarray) -> np.ndarray:
    """``a`` R^-1 for an upper triangular R, column by column."""
    q = np.array(a.T, order="C")
    for j in range(len(r)):
        if j:
            q[j] -= r[:j, j] @ q[:j]
        q[j] /= r[j, j]
    return q.T


def _cholesky(g: np.ndarray, shift: float) -> np.ndarray:
    """Upper factor of ``g`` + shift, a shift raised until the factor exists."""
    while True:
        try:
            return np.linalg.cholesky(g + shift * np.eye(len(g))).T
        except np.linalg.LinAlgError:
            shift = 10 * shift if shift else np.finfo(float).eps * max(np.trace(g), np.finfo(float).tiny)


@dataclass
class Whitening:
    """What a fit learns: ``components`` are columns, by falling ``eigenvalues`` (all of V's)."""
    n: int
    sums: list[int]
    mean: np.ndarray
    eigenvalues: np.ndarray
    components: np.ndarray
    passes: int
    identity_error: float | None = None

    def kept(self, k: int) -> int:
        """How many of the first ``k`` components have an eigenvalue above zero."""
        e = self.eigenvalues
        floor = (e[0] if len(e) else 0.0) * (8 * len(e) * np.finfo(float).eps) ** 2
        return int((e[:k] > floor).sum())

    def explained(self) -> np.ndarray:
        return self.eigenvalues / self.eigenvalues.sum()

    def projector(self, k: int) -> np.ndarray:
        m = self.kept(k)
        return self.components[:, :m] / np.sqrt(self.eigenvalues[:m])


def distinct_vectors(df: DataFrame, vector: str) -> tuple[DataFrame, int]:
    """The fit list as written table (x: packed), and its dimension."""
    found = df.select(F.col(vector).alias("v")).mapInArrow(_codes, "x binary, d int").distinct()
    rows = written(found, "whitening-fit")
    by_length = rows.groupBy("d").agg(F.count(F.lit(1)).alias("n"))
    top = by_length.orderBy(F.desc("n"), F.desc("d")).first()
    d = top.d if top else 0
    return rows.where(F.col("d") == d).select("x"), d


def fit(rows: DataFrame, d: int, k: int = COMPONENTS) -> Whitening:
    """Components of the packed vectors ``rows`` by passes of shifted Cholesky QR."""
    n, sums = exact_sums(rows, d) if d else (0, [])
    mean = np.array([float(Fraction(s, n)) for s in sums]) if n else np.zeros(d)
    factors: list[np.ndarray] = []

    def gram() -> np.ndarray:
        done = list(factors)

        def block(codes):
            q = unpacked(codes, d) - mean
            for r in done:
                q = solved(q, r)
            return (q.T @ q).ravel()
        return added(rows, block, d * d).reshape(d, d)

    g = gram() if n > 1 else np.zeros((d, d))
    if not g.any():
        return Whitening(n, sums, mean, np.zeros(d), np.eye(d), 1)
    eps = np.finfo(float).eps
    shift, passes = 11 * (n * d + d * (d + 1)) * eps / 2 * float(np.trace(g)), 1
    shift = min(shift, float(np.trace(g)))
    while passes <= MOST_PASSES and np.abs(g - np.eye(d)).max() > ORTHONORMAL:
        factors.append(_cholesky(g, shift))
        g, shift, passes = gram(), 0.0, passes + 1
    r = np.eye(d)
    for factor in factors:
        r = factor @ r
    values, vectors = np.linalg.eigh(g)
    root = (vectors * np.sqrt(np.maximum(values, 0.0))) @ vectors.T
    _, s, right = np.linalg.svd(root @ r)
    model = Whitening(n, sums, mean, s * s / n, right.T, passes)
    model.identity_error = _identity_error(rows, model, d, k)
    return model


def _identity_error(rows: DataFrame, model: Whitening, d: int, k: int) -> float | None:
    """Largest absolute entry of the whitened fit list's covariance minus the identity."""
    w, mean, m = model.projector(k), model.mean, model.kept(k)
    if not m:
        return None

    def block(codes):
        z = (unpacked(codes, d) - mean) @ w
        return np.concatenate([z.sum(axis=0), (z.T @ z).ravel()])

    total = added(rows, block, m + m * m)
    centre, second = total[:m] / model.n, total[m:].reshape(m, m) / model.n
    return float(np.abs(second - np.outer(centre, centre) - np.eye(m)).max())


# -- rows ---------------------------------------------------------------------

def deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int]:
    """Exact sum over the dimensions of (n x - S)^2 for every row."""
    high = max([abs(s) for s in sums] + [0]) + n * int(np.abs(x).max(initial=0))
    if high * high * max(len(sums), 1) < 2 ** 63:
        y = n * x - np.array(sums, np.int64)
        return (y * y).sum(axis=1).tolist()
    y = n * x.astype(object) - np.array(sums, object)
    return (y * y).sum(axis=1).tolist()


def whitened(df: DataFrame, model: Whitening, vector: str, keep: list[str], k: int = COMPONENTS) -> DataFrame:
    """``keep`` columns with component, deviation (exact) and whitened, by usable row and component."""
    w, mean, sums, n, d, m = (model.projector(k), model.mean, model.sums, model.n, len(model.mean), model.kept(k))

    def run(batches):
        for batch in batches:
            for rows, x in whole(batch.column(batch.num_columns - 1)):
                if x.shape[1] != d or not m:
                    continue
                z = (x - mean) @ w
                own = pa.RecordBatch.from_arrays(batch.columns[:-1], keep).take(
                    pa.array(np.repeat(rows, m), pa.int64()))
                spread = [str(v) for v in deviations(x, n, sums) for _ in range(m)]
                yield pa.RecordBatch.from_arrays(
                    [*own.columns, pa.array(np.tile(np.arange(1, m + 1, dtype=np.int32), len(x))),
                     pa.array(spread, pa.string()), pa.array(z.ravel())],
                    [*keep, "component", "deviation", "whitened"])

    added_fields = [T.StructField("component", T.IntegerType()), T.StructField("deviation", T.StringType()),
                    T.StructField("whitened", T.DoubleType())]
    out = df.select(*keep, F.col(vector).alias("v")).mapInArrow(
        run, T.StructType([df.schema[c] for c in keep] + added_fields))
    return out.withColumn("deviation", F.col("deviation").cast("decimal(38,0)"))


def whiten(df: DataFrame, vector: str = "embedding", key: str = "vec_id", k: int = COMPONENTS) -> DataFrame:
    """Rows of ``df`` by component up to ``k``: key, component, n, deviation, whitened, explained, identity_error.

    ``deviation`` is null where it is beyond a long.
    """
    rows, d = distinct_vectors(df, vector)
    model = fit(rows, d, k)
    share = F.element_at(F.array(*[F.lit(float(v)) for v in model.explained()[:k]]), F.col("component")) \
        if model.kept(k) else F.lit(None).cast("double")
    return whitened(df, model, vector, [key], k).select(
        key, "component", F.lit(model.n).cast("long").alias("n"),
        F.col("deviation").try_cast("long").alias("deviation"), "whitened",
        share.alias("explained"), F.lit(model.identity_error).cast("double").alias("identity_error"))
