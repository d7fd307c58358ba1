"""Byte-level BPE encoding by overlapping chunks, and decoding (operator 12).

A text is cut into chunks that overlap, and every chunk is pre-tokenised on
its own, wherever Spark runs it. Where a pre-token of one chunk ends at the
same place as one of the next chunk, both read on alike, as a match depends
only on the text behind its start: the chunks are stitched there. Between two
such places lies a piece, whose pre-tokens are encoded by the merge ranks;
a text's ids are those of its pieces in order. Chunks that find no common end
within their overlap (a run of letters longer than it) become one chunk, which
is pre-tokenised again, until all meet; the result never depends on the size
of a chunk. A text of one chunk is one piece and stays in its task, longer
ones are dealt out by chunk, equal texts once. Decoding concatenates the bytes
of the ids.

The ranks and the pattern are a public tokenizer's. Character classes of the
pattern are spelt out as the library that defines the encoding reads them, so
that characters newer than its tables fall where it puts them.

Cases: null is encoded like the empty text, to no ids; ids that are null decode
to no bytes; strings of special tokens are ordinary text; rows may repeat and
extra columns are kept only where named. One text's ids must fit one row, as
its text does.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratus.llm.common import written

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
# Code points of a chunk and of the stretch that it shares with the next one.
CHUNK = 65_536
OVERLAP = 2_048
# A match may depend on this many code points behind its end (a contraction's letters, the sign
# after white space).
REACH = 2
# Pre-tokens whose ids a task keeps.
KEPT = 100_000
# Rows that a task works on at once.
BLOCK = 256
_BYTES = {bytes([i]): i for i in range(256)}


# -- pattern and ranks --------------------------------------------------------

def ranks_of(path: str) -> dict[bytes, int]:
    """Merge ranks from a file of base64 tokens and ranks."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def _members(name: str) -> str:
    """The code points that the encoding library counts to a class, as ranges for a character class."""
    every = "".join(map(chr, (c for c in range(0x110000) if not 0xD800 <= c < 0xE000)))
    only = tiktoken.Encoding("class", pat_str=name, mergeable_ranks=_BYTES, special_tokens={})
    codes = np.frombuffer(only.decode_bytes(only.encode_ordinary(every)).decode().encode("utf-32-le"), "<u4")
    cuts = np.flatnonzero(np.diff(codes) != 1)
    first, last = codes[np.r_[0, cuts + 1]], codes[np.r_[cuts, len(codes) - 1]]
    return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in zip(first.tolist(), last.tolist()))


def spelt_out(pattern: str) -> str:
    r"""``pattern`` with \s, \S and \p{..} as explicit ranges."""
    known: dict[str, str] = {}
    out, inside, at = [], False, 0
    while at < len(pattern):
        found = re.compile(r"\\(?:[sS]|[pP]\{\w+\})").match(pattern, at)
        if not found:
            step = 2 if pattern[at] == "\\" else 1
            inside = {"[": True, "]": False}.get(pattern[at], inside)
            out.append(pattern[at:at + step])
            at += step
            continue
        name, negated = found.group(), found.group()[1] in "SP"
        group = r"\s" if name in (r"\s", r"\S") else r"\p" + name[2:]
        if negated and inside:
            raise ValueError(f"{name} inside a character class")
        ranges = known.get(group)
        if ranges is None:
            ranges = known[group] = _members(group)
        out.append(ranges if inside else f"[{'^' if negated else ''}{ranges}]")
        at = found.end()
    return "".join(out)


class _Kept(dict):
    """Ids of recent pre-tokens, as little-endian int32 bytes."""

    def __init__(self, single):
        super().__init__()
        self.single = single

    def __missing__(self, word: str) -> bytes:
        own = np.array(self.single(word.encode()), "<i4").tobytes()
        if len(word) < 64:
            if len(self) >= KEPT:
                self.clear()
            self[word] = own
        return own


class Encoder:
    """Pre-tokens of a text and their ids."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.pattern = re.compile(pattern)
        self.get = _Kept(tiktoken.Encoding("ranks", pat_str=r"\s", mergeable_ranks=ranks,
                                           special_tokens={})._core_bpe.encode_single_piece).__getitem__

    def ends(self, text: str, whole: bool) -> list[int]:
        """Ends of the pre-tokens of ``text`` that do not depend on what follows it."""
        safe = len(text) if whole else len(text) - REACH
        return [e for m in self.pattern.finditer(text) if (e := m.end()) <= safe]

    def piece(self, text: str, length: int) -> bytes:
        """Ids (int32 bytes) of the first ``length`` code points, read with the text behind them."""
        if length == len(text):
            return b"".join(map(self.get, self.pattern.findall(text)))
        return b"".join([self.get(m.group()) for m in self.pattern.finditer(text) if m.end() <= length])


def _shared(spark, vocabulary: str, pattern: str):
    """Ranks and pattern for the tasks: as large as the vocabulary file."""
    return spark.sparkContext.broadcast((ranks_of(vocabulary), spelt_out(pattern)))


def _ids_array(ids: list[bytes]) -> pa.Array:
    offsets = np.zeros(len(ids) + 1, np.int32)
    np.cumsum([len(i) // 4 for i in ids], out=offsets[1:])
    return pa.ListArray.from_arrays(offsets, np.frombuffer(b"".join(ids), "<i4"))


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of ``BLOCK`` rows at most: what a task holds besides its input."""
    for batch in batches:
        for at in range(0, batch.num_rows, BLOCK):
            yield batch.slice(at, BLOCK)


# -- long texts ---------------------------------------------------------------

def _slices(texts: DataFrame, cuts: DataFrame, until: str) -> DataFrame:
    """A row by (key, start): its columns of ``cuts`` and the text from ``start`` to ``until``."""
    names = cuts.columns[1:]
    by_text = cuts.groupBy("key").agg(F.collect_list(F.struct(*names)).alias("cuts"))
    every = texts.join(by_text, "key").select("key", "text", F.explode("cuts").alias("cut"))
    return every.select("key", *[F.col("cut")[n].alias(n) for n in names],
                        F.col("text").substr(F.col("cut.start") + 1, F.col(f"cut.{until}") - F.col("cut.start"))
                        .alias("slice")).repartition("key", "start")


def _edges(texts: DataFrame, chunks: DataFrame, shared, overlap: int) -> DataFrame:
    """Chunks with the ends of pre-tokens in the stretches that they share with their neighbours."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = None
        for batch in _blocks(batches):
            encoder = encoder or Encoder(*shared.value)
            heads, tails = [], []
            start, stop, last, slices = (batch.column(i).to_pylist() for i in (1, 2, 3, 4))
            for a, b, end, text in zip(start, stop, last, slices):
                ends = [a + e for e in encoder.ends(text, end)]
                heads.append([a] + [e for e in ends if e < a + overlap])
                tails.append([] if end else [e for e in ends if e >= b - overlap])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(heads, pa.list_(pa.int32())), pa.array(tails, pa.list_(pa.int32()))],
                ["key", "start", "stop", "last", "head", "tail"])

    return _slices(texts, chunks, "stop").mapInArrow(
        run, "key string, start int, stop int, last boolean, head array<int>, tail array<int>")


def stitched(texts: DataFrame, shared, chunk: int, overlap: int) -> DataFrame:
    """Pieces (key, start, until, stop) of the long ``texts`` (key, text).

    A piece reaches from ``start`` to ``until``; its chunk goes on to ``stop``.
    """
    size = F.length("text")
    chunks = texts.select("key", size.alias("size"), F.explode(F.sequence(
        F.lit(0), F.floor((size - 1) / chunk).cast("int"))).alias("i")).select(
        "key", (F.col("i") * chunk).cast("int").alias("start"),
        F.least(F.col("size"), (F.col("i") + 1) * chunk + overlap).cast("int").alias("stop"),
        (F.col("size") <= (F.col("i") + 1) * chunk).alias("last"))
    order = Window.partitionBy("key").orderBy("start")     # as many rows as a text has chunks
    done = None
    while True:
        edges = _edges(texts, chunks, shared, overlap)
        done = written(edges if done is None else done.unionByName(edges), "bpe-chunks")
        meet = F.array_min(F.array_intersect("tail", F.lead("head").over(order)))
        met = written(done.withColumn("meet", F.when(~F.col("last"), meet)), "bpe-met")
        apart = F.when(F.col("last") | F.col("meet").isNotNull(), 0).otherwise(1)
        if not met.where(apart == 1).limit(1).count():
            break
        # chunks that did not meet the next one become one chunk with it
        group = met.select("key", "start", "stop", "last", "head", "tail", (1 - F.coalesce(F.lag(apart).over(order), F.lit(0)))
                           .alias("opens")).withColumn("place", F.sum("opens").over(order))
        runs = group.groupBy("key", "place").agg(
            F.min("start").alias("start"), F.max("stop").alias("stop"), F.max("last").alias("last"),
            F.count(F.lit(1)).alias("n"), F.first("head").alias("head"), F.first("tail").alias("tail"))
        runs = written(runs, "bpe-runs")
        done = runs.where("n = 1").select("key", "start", "stop", "last", "head", "tail")
        chunks = runs.where("n > 1").select("key", "start", "stop", "last")
    return met.select("key", F.coalesce(F.lag("meet").over(order), F.lit(0)).alias("start"),
                      F.coalesce("meet", "stop").alias("until"), "stop")


def _long_ids(texts: DataFrame, shared, chunk: int, overlap: int) -> DataFrame:
    """(key, ids) of the long ``texts`` (key, text)."""
    pieces = stitched(texts, shared, chunk, overlap).where("until > start")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = None
        for batch in _blocks(batches):
            encoder = encoder or Encoder(*shared.value)
            start, until, slices = (batch.column(i).to_pylist() for i in (1, 2, 4))
            ids = _ids_array([encoder.piece(t, b - a) for a, b, t in zip(start, until, slices)])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), ids], ["key", "start", "ids"])

    encoded = _slices(texts, pieces, "stop").mapInArrow(run, "key string, start int, ids array<int>")
    return encoded.groupBy("key").agg(F.flatten(F.transform(
        F.sort_array(F.collect_list(F.struct("start", "ids"))), lambda p: p["ids"])).alias("ids"))


# -- tables -------------------------------------------------------------------

def encode(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",), text: str = "text",
           vocabulary: str | None = None, pattern: str = public_tokenizers.PATTERN,
           chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """``keep`` columns and ``ids`` (array of int) of every row."""
    if overlap >= chunk:
        raise ValueError("a chunk must be longer than its overlap")
    spark = docs.sparkSession
    shared = _shared(spark, vocabulary or public_tokenizers.path(VOCABULARY), pattern)
    schema = T.StructType([docs.schema[c] for c in keep] + [T.StructField("ids", T.ArrayType(T.IntegerType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = None
        for batch in _blocks(batches):
            encoder = encoder or Encoder(*shared.value)
            texts = batch.column(batch.num_columns - 1).to_pylist()
            ids = _ids_array([encoder.piece(t, len(t)) if t else b"" for t in texts])
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], ids], schema.names)

    long = F.length(text) > chunk + overlap
    short = docs.where(long.isNull() | ~long).select(*keep, text).mapInArrow(run, schema)
    rows = docs.where(long).select(F.struct(*keep).alias("kept"), F.sha2(F.col(text).cast("binary"), 256).alias("key"),
                                   F.col(text).alias("text"))
    texts = written(rows.groupBy("key").agg(F.first("text").alias("text")), "bpe-long")
    if not texts.limit(1).count():
        return short
    ids = written(_long_ids(texts, shared, chunk, overlap), "bpe-long-ids")
    return short.union(rows.select("kept", "key").join(ids, "key").select("kept.*", "ids"))


def decode(rows: DataFrame, keep: tuple[str, ...] = ("doc_id",), ids: str = "ids",
           vocabulary: str | None = None) -> DataFrame:
    """``keep`` columns and ``decoded`` (binary): the bytes of the ids, one after another."""
    ranks = ranks_of(vocabulary or public_tokenizers.path(VOCABULARY))
    shared = rows.sparkSession.sparkContext.broadcast(ranks)
    schema = T.StructType([rows.schema[c] for c in keep] + [T.StructField("decoded", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.full(max(shared.value.values()) + 1, b"", object)
        for token, rank in shared.value.items():
            table[rank] = token
        for batch in _blocks(batches):
            column = batch.column(batch.num_columns - 1)
            lengths = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
            flat, ends = column.flatten().to_numpy(zero_copy_only=False), np.cumsum(lengths)
            texts = [b"".join(table[flat[e - n:e]].tolist()) for e, n in zip(ends.tolist(), lengths.tolist())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(texts, pa.binary())], schema.names)

    return rows.select(*keep, ids).mapInArrow(run, schema)


def round_trip(docs: DataFrame) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of every row, encoded and decoded again."""
    encoded = encode(docs).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"), "ids")
    back = decode(encoded, keep=("doc_id", "n_tokens", "ids_sha256"))
    return back.select("doc_id", "n_tokens", "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256"))
