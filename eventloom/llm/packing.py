"""Best-fit-decreasing packing of token sequences.

Documents are encoded, closed with an end id and, where longer than a
sequence, cut into full pieces with the shorter one first.  Packing needs
nothing of a piece but its length, and there are no more lengths than a sequence
has tokens.  So the corpus' histogram of lengths (``capacity`` rows) is
packed by the method, longest first, each into the tightest open bin that a
segment tree over the remaining capacities finds in logarithmic time; equal
pieces meet equal bins, so whole runs of them are placed at one step and the
plan stays small whatever the corpus.  The plan says for each length and rank
which sequence and offset it gets; pieces learn their rank among their equals
from a running count in their own task plus the counts of the tasks before.
That is the packing of the whole corpus by best-fit decreasing, not of shards.

Defined cases: NULL text counts as empty (its end id is still packed); NULL
ids are kept; repeated rows are packed each; other columns are not looked at;
an empty table has no pieces.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventloom.llm.bpe import append_id, tokenizer
from eventloom.llm.common import documents, runs, staged

PLAN = "length int, lo long, hi long, each int, first_sequence long, first_offset int"


class OpenBins:
    """Bins by remaining capacity, under a segment tree of which capacities are open.

    A run of bins (first sequence, number) shares one remaining capacity.
    """

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.open = [False] * (2 * self.leaves)
        self.runs: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]

    def _mark(self, room: int, value: bool) -> None:
        at = room + self.leaves
        self.open[at] = value
        while at > 1:
            at //= 2
            self.open[at] = self.open[2 * at] or self.open[2 * at + 1]

    def add(self, room: int, first: int, number: int) -> None:
        if number and room:
            self.runs[room].append((first, number))
            self._mark(room, True)

    def take(self, room: int) -> tuple[int, int]:
        run = self.runs[room].pop()
        self._mark(room, bool(self.runs[room]))
        return run

    def tightest(self, length: int) -> int | None:
        """The least remaining capacity of at least ``length`` with an open bin."""
        at = length + self.leaves
        if self.open[at]:
            return length
        while at > 1:
            if at % 2 == 0 and self.open[at + 1]:
                at += 1
                while at < self.leaves:
                    at = 2 * at if self.open[2 * at] else 2 * at + 1
                return at - self.leaves
            at //= 2
        return None


def plan(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """Best-fit decreasing of ``counts`` pieces of each length into bins of ``capacity``.

    Rows (length, lo, hi, each, first_sequence, first_offset): pieces of that length
    with ranks lo <= r < hi go to sequence first_sequence + (r - lo) // each at offset
    first_offset + (r - lo) % each * length.
    """
    bins, sequences, out = OpenBins(capacity), 0, []

    def place(length, rank, left, room, first, number):
        """Equal pieces into ``number`` equal bins: each bin is filled before the next,
        since a bin just used stays the tightest one while a piece still fits."""
        each = room // length
        full = min(number, left // each)
        if full:
            out.append((length, rank, rank + full * each, each, first, capacity - room))
            bins.add(room - each * length, first, full)
        rest = left - full * each if full < number else 0
        if rest:
            out.append((length, rank + full * each, rank + full * each + rest, rest, first + full, capacity - room))
            bins.add(room - rest * length, first + full, 1)
        bins.add(room, first + full + bool(rest), number - full - bool(rest))
        return full * each + rest

    for length in sorted(counts, reverse=True):
        rank, total = 0, counts[length]
        while rank < total:
            room = bins.tightest(length)
            if room is None:
                number = -(-(total - rank) // (capacity // length))
                rank += place(length, rank, total - rank, capacity, sequences, number)
                sequences += number
            else:
                rank += place(length, rank, total - rank, room, *bins.take(room))
    return out


def cut(size: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For documents of ``size`` ids: each piece's document, number and length."""
    pieces = -(-size // capacity)
    doc = np.repeat(np.arange(len(size)), pieces)
    number = np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    head = size - (pieces - 1) * capacity
    return doc, number, np.where(number == 0, head[doc], capacity)


def _ranks(length: np.ndarray, seen: np.ndarray) -> np.ndarray:
    """How many pieces of the same length came before; ``seen`` goes on counting."""
    order = np.argsort(length, kind="stable")
    sizes = length[order]
    first = np.flatnonzero(np.concatenate(([True], sizes[1:] != sizes[:-1])))
    count = np.diff(np.concatenate((first, [len(sizes)])))
    rank = np.empty(len(length), dtype=np.int64)
    rank[order] = np.arange(len(sizes)) - np.repeat(first, count) + np.repeat(seen[sizes[first]], count)
    seen[sizes[first]] += count
    return rank


def pieces_of(docs: DataFrame, tokenizer_path: str, end_id: int = 2, capacity: int = 1024,
              id_col: str = "doc_id", text_col: str = "text", added_tokens: bool = False) -> DataFrame:
    """Pieces with their ids, written once: part, id, piece, start, length, rank, ids_crc32, ids."""
    schema = T.StructType([
        T.StructField("part", T.IntegerType()), T.StructField(id_col, docs.schema[id_col].dataType), T.StructField("piece", T.IntegerType()),
        *(T.StructField(c, T.LongType()) for c in ("start", "length", "rank", "ids_crc32")), T.StructField("ids", T.ArrayType(T.IntegerType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, part, seen = tokenizer(tokenizer_path, added_tokens), TaskContext.get().partitionId(), np.zeros(capacity + 1, dtype=np.int64)
        for batch in runs(batches, text_col):
            ids, size = append_id(*bpe.encode(batch.column(text_col)), end_id)
            doc, piece, length = cut(size, capacity)
            at = np.concatenate(([0], np.cumsum(length)))
            raw = memoryview(ids.astype("<i4", copy=False)).cast("B")
            crc = np.fromiter((zlib.crc32(raw[4 * a:4 * b]) for a, b in zip(at[:-1].tolist(), at[1:].tolist())), np.int64, len(length))
            start = at[:-1] - (np.cumsum(size) - size)[doc]
            lists = pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(ids, pa.int32()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(doc), part, np.int32)), batch.column(id_col).take(pa.array(doc)), pa.array(piece.astype(np.int32)),
                 pa.array(start), pa.array(length), pa.array(_ranks(length, seen)), pa.array(crc), lists], names=schema.names)

    return staged(documents(docs, id_col, text_col).mapInArrow(run, schema), "pieces")


def pack(docs: DataFrame, tokenizer_path: str, end_id: int = 2, capacity: int = 1024,
         id_col: str = "doc_id", text_col: str = "text", added_tokens: bool = False) -> DataFrame:
    """Pieces with ``sequence_id`` and ``offset``; columns: the id, piece, start, length,
    ids_crc32, ids, sequence_id, offset.  ``added_tokens``: special tokens in a text get
    their own id, as by the library's default."""
    pieces = pieces_of(docs, tokenizer_path, end_id, capacity, id_col, text_col, added_tokens)
    counts = pieces.groupBy("length", "part").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    # One row for each length: at most ``capacity`` rows.
    histogram = {r.length: r.n for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    steps = docs.sparkSession.createDataFrame(plan(histogram, capacity), PLAN)
    ranked = pieces.join(base, ["part", "length"]).withColumn("rank", F.col("rank") + F.col("before"))
    nth = F.col("rank") - F.col("lo")
    placed = ranked.join(F.broadcast(steps), "length").where("rank >= lo and rank < hi")
    return placed.select(
        id_col, "piece", "start", "length", "ids_crc32", "ids",
        (F.col("first_sequence") + F.floor(nth / F.col("each"))).alias("sequence_id"),
        (F.col("first_offset") + nth % F.col("each") * F.col("length")).alias("offset"))


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids): the packed sequences; a group never exceeds the capacity."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.flatten(F.transform(parts, lambda p: p["ids"])).alias("ids"))
