"""SentencePiece encoding and decoding with N-best segmentation (operator 2).

The vocabulary of a public SentencePiece model is read; its scores are merge
ranks, which Zipf's law turns into log probabilities, -log(rank + 1). A text's
lattice holds every piece at every place, and UTF-8 byte pieces where no
single-character piece exists. No piece has white space after another
character, nor a Latin letter beside another kind of character (checked on
loading), so the lattice is a chain of small ones, one for each run of spaces
with the letters or the other characters behind it.

A chunk's forward Viterbi scores give its best segmentation, and are the exact
heuristic of the backward A* search that lists its N best. The N best of a text
differ from the best one in the N - 1 places with the smallest gap between
the first and second segmentation, so only those chunks are searched; Viterbi
over the two best scores gives the gaps, for all new chunks of a block of
texts at once.

Texts are never shuffled; a task holds one block of texts and a bounded table
of chunks already solved. The vocabulary is broadcast (32,000 short strings).

Cases: a null text counts as empty; an empty text has no pieces, score 0 and
no alternatives; decoding returns every text exactly, U+2581 and unassigned
characters included; of segmentations with equal scores the one with the
longer last piece comes first; repeated rows and extra columns do no harm; an
empty table gives no rows.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

MODEL = public_tokenizers.path("piece_bpe_32k.model")
N_BEST = 4
BYTE_LOG_PROBABILITY = -20.0
SPACE = "▁"
# Places where no piece crosses: around line ends, before spaces, between Latin letters and others.
_LATIN = "A-Za-zÀ-ÖØ-öø-ɏ"
_CHUNK = re.compile(rf"\n| *[{_LATIN}]+| *[^{_LATIN} \n]+| +")
# Texts per block, chunk length up to which chunks are solved together and kept, kept chunks.
BLOCK = 256
SHORT = 32
KEPT = 400_000
_BASE = np.uint64(0x9E3779B97F4A7C15)
_SPREAD = np.uint64(0xC2B2AE3D27D4EB4F)
_MASK = np.uint64((1 << 20) - 1)


@dataclass
class Vocabulary:
    """Pieces (with plain spaces), their log probabilities, and the ids of the bytes."""

    strings: list[bytes]                   # by id: what a piece decodes to
    scores: np.ndarray                     # by id
    ids: dict[str, int]                    # of ordinary pieces
    byte_ids: list[int]
    hashes: np.ndarray                     # of the ordinary pieces, for many lookups at once
    hash_ids: np.ndarray                   # their ids
    _kept: dict = field(default_factory=dict, repr=False)
    _searched: dict = field(default_factory=dict, repr=False)

    def __post_init__(self):
        self.longest = max(map(len, self.ids))
        self.known_scores = np.append(self.scores[self.hash_ids], -np.inf)
        self.known_ids = np.append(self.hash_ids, -1).astype(np.int32)
        self.known_hashes = np.append(self.hashes, np.uint64(0))
        # positions of the pieces by some bits of their hash; those that collide go to the next table
        none, left, self.tables = len(self.hashes), np.arange(len(self.hashes)), []
        for shift in (44, 30, 16):
            slot = ((self.hashes[left] * _SPREAD >> np.uint64(shift)) & _MASK).astype(np.int64)
            table = np.full(int(_MASK) + 1, none, np.int32)
            table[slot] = left
            left = left[table[slot] != left]
            self.tables.append((np.uint64(shift), table))
            if not len(left):
                break
        if len(left):
            raise ValueError("the hashes of the pieces collide")

    def parts(self) -> tuple:
        """The fields, as plain values that travel to the workers."""
        return self.strings, self.scores, self.ids, self.byte_ids, self.hashes, self.hash_ids

    @staticmethod
    def load(path: str = MODEL) -> Vocabulary:
        from sentencepiece import SentencePieceProcessor
        model = SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        strings, scores, ids, byte_ids = [b""] * n, np.full(n, -np.inf), {}, [0] * 256
        rank = 0
        for i in range(n):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                value = int(piece[3:5], 16)
                strings[i], scores[i], byte_ids[value] = bytes([value]), BYTE_LOG_PROBABILITY, i
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                rank += 1
                plain = piece.replace(SPACE, " ")
                if len(_CHUNK.findall(plain)) != 1:
                    raise ValueError(f"piece {plain!r} crosses a place where texts are cut")
                ids[plain], strings[i], scores[i] = i, plain.encode(), -np.log(rank + 1)
        hashes = np.array([Vocabulary._hash(p) for p in ids], np.uint64)
        return Vocabulary(strings, scores, ids, byte_ids, hashes, np.array(list(ids.values()), np.int64))

    @staticmethod
    def _hash(piece: str) -> int:
        h = 0
        for c in piece:
            h = (h * int(_BASE) + ord(c) + 1) & 0xFFFFFFFFFFFFFFFF
        return h

    # -- one chunk -----------------------------------------------------------

    def _edges(self, chunk: str, end: int) -> Iterator[tuple[int, float, tuple[int, ...]]]:
        """(start, score, ids) of the lattice edges that end at ``end``, longest first."""
        for start in range(max(0, end - self.longest), end):
            i = self.ids.get(chunk[start:end])
            if i is not None:
                yield start, self.scores[i], (i,)
            elif start == end - 1:
                raw = chunk[start].encode("utf-8", "surrogatepass")
                yield start, BYTE_LOG_PROBABILITY * len(raw), tuple(self.byte_ids[b] for b in raw)

    def forward(self, chunk: str) -> list[float]:
        """Viterbi score of every prefix of ``chunk``."""
        best = [0.0]
        for end in range(1, len(chunk) + 1):
            best.append(max(best[start] + s for start, s, _ in self._edges(chunk, end)))
        return best

    def n_best(self, chunk: str, n: int) -> list[tuple[float, tuple[int, ...]]]:
        """The n best segmentations: A* from the end, forward scores as exact heuristic.

        No position is expanded more than n times: its first n suffixes are the
        best, and none of the n best segmentations needs a further one. So a
        run of one letter, where countless paths score the same, takes n steps
        a position.
        """
        if not chunk:
            return [(0.0, ())]
        ahead = self.forward(chunk)
        # (-total, order of arrival, position, score of the suffix, linked ids of the suffix)
        agenda, arrived, found = [(-ahead[-1], 0, len(chunk), 0.0, None)], 1, []
        visits = [0] * (len(chunk) + 1)
        while agenda and len(found) < n:
            _, _, at, suffix, ids = heapq.heappop(agenda)
            visits[at] += 1
            if visits[at] > n:
                continue
            if not at:
                out = []
                while ids is not None:
                    out.extend(ids[0])
                    ids = ids[1]
                found.append((suffix, tuple(out)))
                continue
            for start, s, own in self._edges(chunk, at):
                total = suffix + s
                heapq.heappush(agenda, (-(total + ahead[start]), arrived, start, total, (own, ids)))
                arrived += 1
        return found

    # -- many chunks ---------------------------------------------------------

    def _find(self, h: np.ndarray) -> np.ndarray:
        """Positions of hashes among the pieces' (their number where there is none)."""
        none = len(self.hashes)
        found = np.full(len(h), none, np.int32)
        spread = h * _SPREAD
        for shift, table in self.tables:
            at = table[((spread >> shift) & _MASK).astype(np.int64)]
            hit = self.known_hashes[at] == h
            found[hit] = at[hit]
        return found

    def solve(self, chunks: list[str]) -> dict[str, tuple[bytes, float]]:
        """Best ids (as little-endian uint16 bytes) and gap to the second best, by chunk."""
        out, by_length = {}, {}
        for c in chunks:
            by_length.setdefault(len(c), []).append(c)
        for length, same in by_length.items():
            if length > SHORT:
                for c in same:
                    found = self.n_best(c, 2)
                    gap = found[0][0] - found[1][0] if len(found) > 1 else np.inf
                    out[c] = (np.array(found[0][1], "<u2").tobytes(), float(gap))
            else:
                out.update(self._solve_alike(same, length))
        return out

    def _solve_alike(self, chunks: list[str], length: int) -> Iterator:
        n = len(chunks)
        codes = np.frombuffer("".join(chunks).encode("utf-32-le", "surrogatepass"), "<u4").reshape(n, length)
        codes = codes.astype(np.uint64).T + np.uint64(1)
        raw = codes - np.uint64(1)
        width = 1 + (raw > 0x7F) + (raw > 0x7FF) + (raw > 0xFFFF)
        # best and second best score, start and id of the last edge of the best, by end position
        one = np.full((length + 1, n), -np.inf)
        two = np.full((length + 1, n), -np.inf)
        last = np.zeros((length + 1, n), np.int64)
        edge = np.full((length + 1, n), -1)
        one[0] = 0.0
        for start in range(length):
            h = np.zeros(n, np.uint64)
            for end in range(start + 1, min(length, start + self.longest) + 1):
                h = h * _BASE + codes[end - 1]
                at = self._find(h)
                s = self.known_scores[at]
                if end == start + 1:
                    s = np.where(at < len(self.hashes), s, BYTE_LOG_PROBABILITY * width[start])
                elif (s == -np.inf).all():
                    continue
                a, b = one[start] + s, two[start] + s
                better = a > one[end]
                two[end] = np.maximum(np.minimum(one[end], a), np.where(better, b, two[end]))
                last[end][better] = start
                edge[end][better] = self.known_ids[at[better]]
                one[end] = np.maximum(one[end], a)
        gaps = (one[length] - two[length]).tolist()
        # walk back from the ends of all chunks at once; ids fill the rows from the right
        own, at = np.zeros((n, length), "<u2"), np.full(n, length)
        count, bytes_in, every = np.zeros(n, np.int64), np.zeros(n, bool), np.arange(n)
        while (live := at > 0).any():
            ids = edge[at, every]
            bytes_in |= live & (ids < 0)
            count += live
            own[every[live], length - count[live]] = np.maximum(ids[live], 0)
            at = np.where(live, last[at, every], 0)
        blob, count = own.tobytes(), count.tolist()
        for k, chunk in enumerate(chunks):
            if bytes_in[k]:
                ids = self._walk(chunk, last[:, k].tolist(), edge[:, k].tolist())
                yield chunk, (np.array(ids, "<u2").tobytes(), gaps[k])
            else:
                yield chunk, (blob[2 * ((k + 1) * length - count[k]):2 * (k + 1) * length], gaps[k])

    def _walk(self, chunk: str, last: list[int], edge: list[int]) -> list[int]:
        """Ids along the last edges from the end, byte pieces spelt out."""
        end, ids = len(chunk), []
        while end:
            if edge[end] < 0:
                raw = chunk[last[end]].encode("utf-8", "surrogatepass")
                ids.extend(self.byte_ids[x] for x in reversed(raw))
            else:
                ids.append(edge[end])
            end = last[end]
        return ids[::-1]

    # -- texts ---------------------------------------------------------------

    def best(self, texts: list[str | None]) -> list[tuple[list[str], tuple, tuple]]:
        """Chunks of each text, their best ids (as bytes) and their gaps to the second best."""
        split = [_CHUNK.findall(" " + t) if t else [] for t in texts]
        if len(self._kept) > KEPT:
            self._kept.clear()
        new = set().union(*split) - self._kept.keys()
        self._kept.update(self.solve(list(new)))
        get = self._kept.__getitem__
        out = [(chunks, *zip(*map(get, chunks))) if chunks else ([], (), ()) for chunks in split]
        for c in new:
            if len(c) > SHORT:
                del self._kept[c]
        return out

    def alternatives(self, chunks: list[str], blobs: tuple, gaps: tuple, n: int):
        """The 2nd to nth best of a text: (score below the best, [(place, drop, ids), ...])."""
        if n < 2 or not chunks:
            return []
        gaps = np.array(gaps)
        k = min(n - 1, len(gaps))
        places = np.sort(np.argpartition(gaps, k - 1)[:k])
        sizes = np.fromiter(map(len, blobs), np.int64, len(blobs)) // 2
        starts = np.cumsum(sizes) - sizes
        ways = [(0.0, ())]
        for p in places[np.isfinite(gaps[places])]:
            chunk = chunks[p]
            found = self._searched.get((chunk, n))
            if found is None:
                found = self.n_best(chunk, n)
                if len(chunk) <= SHORT:
                    if len(self._searched) > KEPT // 10:
                        self._searched.clear()
                    self._searched[chunk, n] = found
            top = found[0][0]
            more = [(cost + top - s, edits + (((int(starts[p]), int(sizes[p]), ids),) if j else ()))
                    for cost, edits in ways for j, (s, ids) in enumerate(found)]
            ways = heapq.nsmallest(n, more, key=lambda w: w[0])
        return ways[1:]

    def encode(self, text: str | None) -> list[int]:
        return np.frombuffer(b"".join(self.best([text])[0][1]), "<u2").tolist()

    def decode(self, ids) -> str:
        """The text of a list of ids."""
        strings = self.strings
        return b"".join([strings[i] for i in ids]).decode("utf-8", "surrogatepass")[1:]


_EDIT = T.StructType([T.StructField("at", T.IntegerType()), T.StructField("drop", T.IntegerType()),
                      T.StructField("ids", T.ArrayType(T.IntegerType()))])
_WAY = T.StructType([T.StructField("score", T.DoubleType()), T.StructField("edits", T.ArrayType(_EDIT))])
_OUTPUT = [T.StructField("n_pieces", T.IntegerType()), T.StructField("ids", T.ArrayType(T.IntegerType())),
           T.StructField("score", T.DoubleType()), T.StructField("alternatives", T.ArrayType(_WAY)),
           T.StructField("exact", T.BooleanType())]


def encoded(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",), text: str = "text",
            model: str = MODEL, n: int = N_BEST) -> DataFrame:
    """``keep`` columns with n_pieces, ids, score, alternatives and exact for every row.

    ``alternatives``: the 2nd to nth best segmentation, each as its score and
    its edits of ``ids`` (at, drop, ids). ``exact``: decoding ``ids`` gives the
    whole text back.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(Vocabulary.load(model).parts())
    names = [f.name for f in _OUTPUT]
    arrow = pa.schema([("n_pieces", pa.int32()), ("ids", pa.list_(pa.int32())), ("score", pa.float64()),
                       ("alternatives", pa.list_(pa.struct([("score", pa.float64()), ("edits", pa.list_(pa.struct(
                           [("at", pa.int32()), ("drop", pa.int32()), ("ids", pa.list_(pa.int32()))])))]))),
                       ("exact", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = Vocabulary(*shared.value)
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                part = batch.slice(at, BLOCK)
                texts = part.column(part.num_columns - 1).to_pylist()
                counts, ids, scores, ways, exact = [], [], [], [], []
                for t, (chunks, blobs, gaps) in zip(texts, vocabulary.best(texts)):
                    own = np.frombuffer(b"".join(blobs), "<u2").astype(np.int32)
                    score = float(vocabulary.scores[own].sum())
                    counts.append(len(own))
                    ids.append(own)
                    scores.append(score)
                    ways.append([{"score": score - cost, "edits": [
                        {"at": a, "drop": d, "ids": list(i)} for a, d, i in edits]}
                        for cost, edits in vocabulary.alternatives(chunks, blobs, gaps, n)])
                    exact.append(vocabulary.decode(own.tolist()) == (t or ""))
                offsets = np.zeros(len(counts) + 1, np.int32)
                np.cumsum(counts, out=offsets[1:])
                arrays = [pa.array(counts, pa.int32()),
                          pa.ListArray.from_arrays(offsets, np.concatenate([*ids, np.zeros(0, np.int32)])),
                          pa.array(scores, pa.float64()), pa.array(ways, arrow.field("alternatives").type),
                          pa.array(exact, pa.bool_())]
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], *arrays], [*keep, *names])

    schema = T.StructType([docs.schema[c] for c in keep] + _OUTPUT)
    return docs.select(*keep, text).mapInArrow(run, schema)


def decoded(rows: DataFrame, keep: tuple[str, ...] = ("doc_id",), ids: str = "ids",
            model: str = MODEL) -> DataFrame:
    """``keep`` columns with the text of ``ids`` for every row; null ids give an empty text."""
    shared = rows.sparkSession.sparkContext.broadcast(Vocabulary.load(model).parts())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = Vocabulary(*shared.value)
        for batch in batches:
            texts = [vocabulary.decode(x or []) for x in batch.column(batch.num_columns - 1).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(texts, pa.string())], [*keep, "text"])

    schema = T.StructType([rows.schema[c] for c in keep] + [T.StructField("text", T.StringType())])
    return rows.select(*keep, ids).mapInArrow(run, schema)
