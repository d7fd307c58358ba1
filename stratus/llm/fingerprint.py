"""Homomorphic multiset fingerprints of documents (operator 7).

A paragraph (a line) is hashed to a wide vector: 16 lanes modulo 2^64 from the
line's bytes and 256 lanes modulo 2^32 to which each of its three-word windows
(three-character windows in lines of fewer words) adds or takes away one. A
text's fingerprint is the lane-wise sum over its paragraphs, so it does not
depend on their order, and paragraphs are inserted or deleted by adding or
subtracting their vectors. Equal multisets of lines have equal fingerprints.
The second kind of lane also compares texts: the likeness 2ab / (aa + bb) of
two fingerprints estimates the share of windows they have in common, within
about 0.06. Written out, these lanes take two bytes each where all of a text's
fit (below 2^15 in absolute value), else four.

Cases: a null text counts as empty (one empty paragraph); rows are compared in
descending doc_id, nulls last, repeated ids by the hash of their text; the row
after the last is the first, and a single row is its own next; an empty table
gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

EXACT_LANES = 16
LANES = 256
WINDOW = 3
_A, _B, _C = (np.uint64(x) for x in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))


class Fingerprint:
    """Sum of the vectors of a multiset of paragraphs."""

    __slots__ = ("exact", "lanes")

    def __init__(self, exact: np.ndarray, lanes: np.ndarray):
        self.exact, self.lanes = exact, lanes

    @staticmethod
    def of(text: str | None) -> Fingerprint:
        lines = (text or "").split("\n")
        exact = np.frombuffer(b"".join([
            hashlib.shake_128(x.encode("utf-8", "replace")).digest(8 * EXACT_LANES) for x in lines]), "<u8")
        exact = exact.reshape(len(lines), EXACT_LANES).sum(axis=0, dtype=np.uint64)
        tokens: list[str] = []
        sizes = []
        for x in lines:
            own = x.split()
            if len(own) < WINDOW:
                own = [x] if len(x) <= WINDOW and own else list(x) if own else []
            tokens.extend(own)
            sizes.append(len(own))
        lanes = np.zeros(LANES, np.int64)
        n = len(tokens)
        if n:
            digest = xxhash.xxh3_64_intdigest
            h = np.zeros(n + 2, np.uint64)
            h[:n] = np.fromiter([digest(t) for t in tokens], np.uint64, n)
            line = np.append(np.repeat(np.arange(len(sizes)), sizes), [-1, -1])
            size = np.array(sizes)[line[:n]]
            mixed = h[:-2] * _A + h[1:-1] * _B + h[2:] * _C
            inside = line[:n] == line[2:]
            alone = size < WINDOW                  # a line too short for any window: its token
            mixed = np.where(alone, h[:n], mixed)[inside | alone]
            mixed ^= mixed >> np.uint64(29)
            mixed *= _C
            mixed ^= mixed >> np.uint64(32)
            sign = 1.0 - 2.0 * (mixed & np.uint64(1)).astype(np.float64)
            lanes = np.bincount((mixed >> np.uint64(56)).astype(np.int64), weights=sign,
                                minlength=LANES).astype(np.int64)
        return Fingerprint(exact, lanes.astype(np.uint32))

    def __add__(self, other: Fingerprint) -> Fingerprint:
        return Fingerprint(self.exact + other.exact, self.lanes + other.lanes)

    def __sub__(self, other: Fingerprint) -> Fingerprint:
        return Fingerprint(self.exact - other.exact, self.lanes - other.lanes)

    def __eq__(self, other) -> bool:
        return (self.exact == other.exact).all() and (self.lanes == other.lanes).all()

    def counts(self) -> np.ndarray:
        """The lanes with their signs."""
        return self.lanes.view(np.int32)

    def __str__(self) -> str:
        counts = self.counts()
        short = (counts.astype(np.int16) == counts).all()
        return base64.b64encode(self.exact.astype("<u8").tobytes()
                                + counts.astype("<i2" if short else "<i4").tobytes()).decode()

    @staticmethod
    def parse(text: str) -> Fingerprint:
        raw = base64.b64decode(text)
        exact, lanes = raw[:8 * EXACT_LANES], raw[8 * EXACT_LANES:]
        counts = np.frombuffer(lanes, "<i2" if len(lanes) == 2 * LANES else "<i4").astype(np.int32)
        return Fingerprint(np.frombuffer(exact, "<u8"), counts.view(np.uint32))

    def likeness(self, other: Fingerprint) -> float:
        """1 for equal fingerprints, else the estimated share of common windows."""
        if self == other:
            return 1.0
        a, b = (x.counts().astype(np.float64) for x in (self, other))
        both = a @ a + b @ b
        return float(min(max(2 * (a @ b) / both, 0.0), 1.0)) if both else 0.0


def edited(text: str, following: str) -> str:
    """``text`` with its last third of code points replaced by the first of ``following``."""
    k = len(text) // 3
    return text[:len(text) - k] + following[:k]


def edited_fingerprint(text: str, own: Fingerprint, following: str) -> Fingerprint:
    """Fingerprint of ``edited``: the paragraphs from the cut on deleted, the new ones inserted."""
    k = len(text) // 3
    cut = len(text) - k
    start = text.rfind("\n", 0, cut) + 1
    return own - Fingerprint.of(text[start:]) + Fingerprint.of(text[start:cut] + following[:k])


# Bytes of text and rows that one bucket holds on average, and the most buckets (numbers on the driver).
BUCKET_BYTES = 16 * 1024 * 1024
BUCKET_ROWS = 2_000
MOST_BUCKETS = 20_000


def buckets_for(docs: DataFrame) -> int:
    """As many buckets as the texts' bytes and rows ask for, whatever the session's settings."""
    held, rows = docs.agg(F.sum(F.octet_length("text")), F.count(F.lit(1))).first()
    return max(1, min(MOST_BUCKETS, max(-(-(held or 0) // BUCKET_BYTES), -(-rows // BUCKET_ROWS))))


def _bucket(bounds: list[int]) -> Column:
    """How many of the ascending ``bounds`` are above a row's doc_id; one more where it is null.

    Found in two steps, among every ``step``-th bound and then between two of them.
    """
    step = max(1, math.isqrt(len(bounds)))

    def numbers(values: list[int]) -> Column:
        return F.split(F.lit(",".join(map(str, values))), ",").cast("array<long>") if values else F.array().cast("array<long>")

    def passed(values: Column) -> Column:
        return F.size(F.filter(values, lambda q: q <= F.col("doc_id")))

    whole = passed(numbers(bounds[step - 1::step])) * step
    rest = passed(F.slice(numbers(bounds), whole + 1, F.lit(step))) if bounds else F.lit(0)
    return F.when(F.col("doc_id").isNull(), len(bounds) + 1).otherwise(len(bounds) - whole - rest).cast("int")


def in_order(docs: DataFrame, parts: int) -> DataFrame:
    """Rows (bucket, ghost, doc_id, text), each partition sorted by bucket and descending doc_id.

    Buckets are ranges of ids between approximate quantiles (``parts`` numbers
    on the driver). The first row of each bucket also ends the bucket before
    it as a ghost, so each row's next one is in its own partition; texts are
    shuffled once.
    """
    order = F.col("doc_id").desc_nulls_last()
    keyed = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn(
        "hash", F.xxhash64("text"))
    quantiles = docs.select(F.percentile_approx(
        "doc_id", [i / parts for i in range(1, parts)], 10 * parts)).first()[0] if parts > 1 else None
    keyed = keyed.withColumn("bucket", _bucket(sorted({int(q) for q in quantiles or []})))
    # one row per bucket: its first row, and the bucket before it (before the first: the last)
    all_buckets = Window.orderBy("bucket")
    first = (keyed.groupBy("bucket").agg(F.min(F.struct(
        F.col("doc_id").isNull(), (-F.col("doc_id").cast("decimal(20,0)")).alias("down"), "hash")).alias("f"))
        .select("bucket", (-F.col("f.down")).alias("first_id"), F.col("f.hash").alias("first_hash"),
                F.lag("bucket").over(all_buckets).alias("before"),
                F.max("bucket").over(Window.partitionBy()).alias("final")))
    is_first = (F.col("hash") == F.col("first_hash")) & F.col("doc_id").eqNullSafe(F.col("first_id"))
    own = F.struct("bucket", F.lit(False).alias("ghost"))
    ghost = F.struct(F.coalesce("before", "final").alias("bucket"), F.lit(True).alias("ghost"))
    place = F.when(is_first, F.array(own, ghost)).otherwise(F.array(own))
    return (keyed.join(F.broadcast(first), "bucket")
                 .select("doc_id", "hash", "text", F.explode(place).alias("p"))
                 .select("p.bucket", "p.ghost", "doc_id", "hash", "text")
                 .repartitionById(parts, "bucket")
                 .sortWithinPartitions("bucket", "ghost", order, "hash")
                 .select("bucket", "ghost", "doc_id", "text"))


_SCHEMA = [T.StructField("n_chars", T.LongType()), T.StructField("edited_sha256", T.StringType()),
           T.StructField("fingerprint", T.StringType()), T.StructField("edited_fingerprint", T.StringType()),
           T.StructField("near_edited", T.DoubleType()), T.StructField("near_next", T.DoubleType())]
_ARROW = (pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64())
_BATCH = 256


def _compared(text: str, own: Fingerprint, following: str, next_own: Fingerprint) -> tuple:
    new = edited_fingerprint(text, own, following)
    return (len(text), hashlib.sha256(edited(text, following).encode("utf-8", "replace")).hexdigest(),
            str(own), str(new), own.likeness(new), own.likeness(next_own))


def compare_with_next(docs: DataFrame, parts: int | None = None) -> DataFrame:
    """doc_id and the fingerprints of each row's text and of its edit with the next row's text."""
    parts = parts or buckets_for(docs)
    names = ["doc_id", *(f.name for f in _SCHEMA)]
    id_type = docs.schema["doc_id"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, ids, rows = None, [], []         # held: (doc_id, text, fingerprint) awaiting its next row
        id_arrow = None
        for batch in batches:
            id_arrow = batch.column(2).type
            for at in range(0, batch.num_rows, _BATCH):
                part = batch.slice(at, _BATCH)
                for _, ghost, doc_id, text in zip(*(c.to_pylist() for c in part.columns)):
                    if ghost and held is None:
                        continue                # a repeated ghost
                    own = Fingerprint.of(text)
                    if held is not None:
                        ids.append(held[0])
                        rows.append(_compared(held[1], held[2], text, own))
                    held = None if ghost else (doc_id, text, own)
                if rows:
                    yield _batch(ids, rows, id_arrow, names)
                    ids, rows = [], []
        if held is not None:
            raise ValueError("a bucket has no row after its last")

    schema = T.StructType([T.StructField("doc_id", id_type)] + _SCHEMA)
    return in_order(docs, parts).mapInArrow(run, schema)


def _batch(ids: list, rows: list[tuple], id_arrow: pa.DataType, names: list[str]) -> pa.RecordBatch:
    columns = [pa.array(c, t) for c, t in zip(zip(*rows), _ARROW)]
    return pa.RecordBatch.from_arrays([pa.array(ids, id_arrow), *columns], names)
