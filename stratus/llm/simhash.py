"""SimHash near duplicates by segment popcounts (operator 6).

A fingerprint's 64 bits are cut into 32 segments of two bits; the popcounts of
the segments are its embedding, and the Manhattan distance of two embeddings
never exceeds the Hamming distance. The embedding is a grid of two halves of
16 coordinates. Of a pair within 3 bits, one half is within Manhattan distance
1, so its members lie in one cell of that half or in cells one step apart. Each
fingerprint enters its own two cells and asks at the cells one step up (one
step down is found from the other side): at most 34 rows, 26 on average. Pairs
that meet are held to the whole lower bound, then to the exact distance.

Equal fingerprints count once, whatever the number of copies. A cell with more
than ``DENSE`` fingerprints is split by the values of their four quarters, of
which a pair within 3 bits has one in common. Where more than ``DENSE`` remain
together, members are dealt into blocks, each pair of blocks is compared in a
task of bounded memory, and only links that join different groups of that task
are returned (a spanning forest), so the output follows the number of members.

Cases: a null or blank text has fingerprint 0 and is linked like any other;
repeated rows share a class; a null doc_id is never the smallest of a class
that has another id (a class of null ids only has a null component_id); an
empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratus.llm.common import unpacked_row, whole_row, written
from stratus.llm.components import components
from stratus.operators.joins import bounded

SHINGLE = 3
MAX_BITS = 3
SEED = 42
DENSE = 512
BLOCK = 2048
_PAIRS = 0x5555555555555555


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """SimHash of the lower-cased (A-Z) words' shingles, as an unsigned 64-bit number."""
    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return 0
    digest = xxhash.xxh64_intdigest
    if len(words) <= shingle:
        hashes = [digest(b" ".join(words), SEED)]
    else:
        hashes = [digest(b" ".join(w), SEED) for w in zip(*(words[i:] for i in range(shingle)))]
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 65536):        # 4 MB of bits at a time
        part = np.array(hashes[at:at + 65536], dtype=">u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes)).tobytes(), "big")


def fingerprint_column(text: Column, shingle: int = SHINGLE) -> Column:
    """The fingerprint as a long (two's complement)."""

    @F.pandas_udf(T.LongType())
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint(t, shingle) for t in texts], np.uint64).view(np.int64))

    return of(text)


def _half(fp: Column, half: int) -> Column:
    """Embedding of one half: popcounts of its 16 segments, each in two bits of a long."""
    bits = F.shiftrightunsigned(fp, 32 * half).bitwiseAND(F.lit(0xFFFFFFFF))
    pairs = F.lit(_PAIRS & 0xFFFFFFFF)
    return bits.bitwiseAND(pairs) + F.shiftrightunsigned(bits, 1).bitwiseAND(pairs)


def _manhattan(a: Column, b: Column) -> Column:
    """Manhattan distance of the embeddings of two fingerprints.

    The counts 0, 1, 2 in unary (00, 01, 11) make the distance a popcount.
    """
    def unary(fp: Column) -> Column:
        next_bit = F.shiftrightunsigned(fp, 1)
        some = fp.bitwiseOR(next_bit).bitwiseAND(F.lit(_PAIRS))
        both = fp.bitwiseAND(next_bit).bitwiseAND(F.lit(_PAIRS))
        return some.bitwiseOR(F.shiftleft(both, 1))
    return F.bit_count(unary(a).bitwiseXOR(unary(b)))


def _cells(fps: DataFrame) -> DataFrame:
    """(half, cell, fp): the two cells of each fingerprint."""
    halves = F.array(_half(F.col("fp"), 0), _half(F.col("fp"), 1))
    return fps.select("fp", F.posexplode(halves).alias("half", "cell"))


def _questions(cells: DataFrame) -> DataFrame:
    """(half, cell, fp, up): each fingerprint at its own cell and at the cells one step up."""
    steps = F.array(*[F.lit(1 << (2 * i)).cast("long") for i in range(16)])
    free = F.filter(steps, lambda s: F.col("cell").bitwiseAND(s * 2) == 0)
    return (cells.select("half", "fp", "cell", F.explode(
                F.concat(F.array(F.lit(0).cast("long")), free)).alias("step"))
                 .select("half", "fp", (F.col("cell") + F.col("step")).alias("cell"),
                         (F.col("step") > 0).alias("up")))


def _within(a: Column, b: Column, bits: int) -> Column:
    return (_manhattan(a, b) <= bits) & (F.bit_count(a.bitwiseXOR(b)) <= bits)


def _block_links(bits: int):
    """applyInPandas function: a spanning forest of the links among one task's fingerprints."""

    def links(rows: pd.DataFrame) -> pd.DataFrame:
        fps = np.unique(rows["fp"].to_numpy()).view(np.uint64)
        group = np.arange(len(fps))
        out = []
        for i in range(len(fps) - 1):
            near = np.flatnonzero(np.bitwise_count(fps[i + 1:] ^ fps[i]) <= bits) + i + 1
            for j in near[group[near] != group[i]]:
                if group[j] != group[i]:
                    out.append((fps[i], fps[j]))
                    group[group == group[j]] = group[i]
        a = np.array(out, np.uint64).reshape(-1, 2).view(np.int64)
        return pd.DataFrame({"a": a[:, 0], "b": a[:, 1]})

    return links


def links(fps: DataFrame, bits: int = MAX_BITS, dense: int = DENSE, block: int = BLOCK) -> DataFrame:
    """Links (a, b) between distinct fingerprints (column fp, long) within ``bits`` <= 3 bits.

    Every pair outside dense cells; inside them links enough to join the same
    groups.
    """
    if not 0 <= bits <= 3:
        raise ValueError("the two-halves grid holds up to 3 bits")
    cells = _cells(fps)
    crowded = written(cells.groupBy("half", "cell").agg(F.count(F.lit(1)).alias("n"))
                           .where(F.col("n") > dense).select("half", "cell"), "crowded")
    asked = _questions(cells)
    sparse = cells.join(crowded, ["half", "cell"], "left_anti").select("half", "cell", F.col("fp").alias("b"))
    pairs = (asked.withColumnRenamed("fp", "a").join(sparse, ["half", "cell"])
                  .where((F.col("up") | (F.col("a") < F.col("b"))) & _within(F.col("a"), F.col("b"), bits))
                  .select("a", "b"))
    if crowded.isEmpty():
        return pairs
    return pairs.union(_crowded_links(asked.join(crowded, ["half", "cell"]), bits, dense, block))


def _crowded_links(met: DataFrame, bits: int, dense: int, block: int) -> DataFrame:
    """Links among the fingerprints that meet in crowded cells (half, cell, fp).

    Of the four quarters of 16 bits of a pair within three bits one is equal,
    so a cell is split by the quarters' values. What is still crowded then
    (fingerprints alike in a half's popcounts and in a quarter) is compared in
    blocks.
    """
    quarters = F.array(*[F.shiftrightunsigned("fp", 16 * q).bitwiseAND(F.lit(0xFFFF)) for q in range(4)])
    keys = ["half", "cell", "quarter", "value"]
    split = written(met.select("half", "cell", "fp").distinct().select(
        "half", "cell", "fp", F.posexplode(quarters).alias("quarter", "value")), "quarters")
    sizes = split.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    few = split.join(sizes.where((F.col("n") > 1) & (F.col("n") <= dense)).drop("n"), keys)
    pairs = (few.withColumnRenamed("fp", "a").join(few.withColumnRenamed("fp", "b"), keys)
                .where((F.col("a") < F.col("b")) & _within(F.col("a"), F.col("b"), bits)).select("a", "b"))
    # members dealt into blocks; a pair of blocks is one task
    many = split.join(sizes.where(F.col("n") > dense), keys).withColumn(
        "blocks", F.ceil(F.col("n") / block).cast("int"))
    own = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
    dealt = (many.withColumn("own", own)
                 .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
                 .select(*keys, F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "fp"))
    inside = dealt.groupBy(*keys, "i", "j").applyInPandas(_block_links(bits), "a long, b long")
    return pairs.union(inside)


def classes(docs: DataFrame, shingle: int = SHINGLE, bits: int = MAX_BITS,
            key: tuple[str, ...] = ("doc_id",), text: str = "text") -> DataFrame:
    """(key..., fp, root, component_id) for every row of ``docs``; ``root`` is a fingerprint of the class."""
    table = written(docs.select(*key, fingerprint_column(F.col(text), shingle).alias("fp")),
                    "fingerprints")
    least = written(table.groupBy("fp").agg(F.min(key[0]).alias("least")), "classes")
    joined = components(links(least.select("fp"), bits))
    rooted = (least.join(joined, least.fp == joined.node, "left")
                   .select("fp", F.coalesce("root", "fp").alias("root"), "least"))
    smallest = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = written(rooted.select("fp", "root").join(smallest, "root").select("fp", "root", "component_id"),
                    "components")
    return table.join(named, "fp").select(*key, "fp", "root", "component_id")


def near_duplicate_classes(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint, component_id for every row."""
    return classes(docs).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                                "component_id")


def keep_one(docs: DataFrame, shingle: int = SHINGLE, bits: int = MAX_BITS) -> DataFrame:
    """The row with the smallest doc_id of each class, columns unchanged.

    Rows that tie (repeated doc_ids) are told apart by a hash of the text, and
    of rows alike in both one is kept, that with the least hash of all its
    columns; of a class without any id the row with the smallest text hash stays.

    What stays is decided on ids and hashes. The rows are then filtered by the
    keys, which are broadcast if they pass the size check; only rows whose key
    is repeated are grouped.
    """
    keyed = docs.select("doc_id", F.xxhash64("text").alias("content"), "text")
    table = written(classes(keyed, shingle, bits, key=("doc_id", "content")), "named")
    # a repeated or null id may name several classes; the root tells them apart
    first = (table.where(F.col("doc_id").eqNullSafe(F.col("component_id")))
                  .groupBy("root", "component_id").agg(F.min("content").alias("content"))
                  .select(F.col("component_id").alias("id"), "content").distinct())
    often = table.groupBy("doc_id", "content").agg(F.count(F.lit(1)).alias("n"))
    keep = written(first.join(often, F.col("id").eqNullSafe(F.col("doc_id")) & (first["content"] == often["content"]))
                   .select("id", first["content"].alias("same"), "n"), "kept-keys")
    rows = docs.select(whole_row(docs).alias("row"), F.col("doc_id").alias("own"), F.xxhash64("text").alias("content"))

    def among(keys: DataFrame) -> DataFrame:
        return rows.join(bounded(keys), F.col("own").eqNullSafe(F.col("id")) & (F.col("content") == F.col("same")),
                         "left_semi")

    once = among(keep.where("n = 1")).select(*unpacked_row(docs, "row"))
    repeated = keep.where("n > 1")
    if repeated.isEmpty():
        return once
    one = among(repeated).groupBy("own", "content").agg(F.min_by("row", F.xxhash64(F.to_json("row"))).alias("row"))
    return once.union(one.select(*unpacked_row(docs, "row")))
