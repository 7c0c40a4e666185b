"""SimHash near-duplicates with bit-sliced comparison.

A text's fingerprint has bit ``b`` where more than half of its shingles' XXH64
hashes have it.  Fingerprints within ``radius`` bits are linked, and linked
fingerprints form components.

Candidates come from the pigeonhole principle, which loses no pair: of
``radius + 2`` blocks of the 64 bits two fingerprints within the radius agree on at
least two, so each distinct fingerprint is filed under every pair of its
blocks.  Rows of one file are compared in bit-sliced form: the fingerprints'
bit planes are stored vertically (64 fingerprints to a machine word), the
differing bits of one plane are added to all distances at once by a carry-save
counter, and rows whose whole block has passed the radius are abandoned.

Equal fingerprints are collapsed first, so copies cost nothing.  A file with
more than ``TILE`` rows is cut into sub-blocks that are compared pair by pair,
each pair a group of its own on some task.  A task reports only the links
that join what it has not joined yet (a spanning forest), never all pairs.

Defined cases: a text of fewer words than a shingle hashes its whole word
sequence; one without words (NULL and empty texts too) has fingerprint zero
and is linked like any other; repeated rows share a component; NULL ids are
kept and never become a component's id unless the component has no other; texts
of any length are read whole, one at a time where they are long; an empty table
gives an empty result; other columns, whatever their names, stay as they are.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventloom.llm.common import documents, runs, staged, texts, unused
from eventloom.llm.components import components

TILE = 4096
#: Rows of small files that are compared in one go, whatever files they are from.
PACK = 512
SEED = 42
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def fingerprints_of(values: list[str], shingle: int) -> np.ndarray:
    """One unsigned 64-bit fingerprint for each text."""
    hashes: list[int] = []
    counts = np.zeros(len(values), dtype=np.int64)
    digest = xxhash.xxh64_intdigest
    for i, value in enumerate(values):
        words = value.encode("utf-8", "surrogatepass").translate(LOWER).split()
        if not words:
            continue
        line = b" ".join(words)
        if len(words) <= shingle:
            hashes.append(digest(line, SEED))
            counts[i] = 1
            continue
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        begins = np.concatenate(([0], ends[:-shingle] + 1)).tolist()
        stops = ends[shingle - 1:].tolist()
        hashes += [digest(line[b:e], SEED) for b, e in zip(begins, stops)]
        counts[i] = len(stops)
    out = np.zeros(len(values), dtype=np.uint64)
    some = np.flatnonzero(counts)
    if len(some):
        h = np.array(hashes, dtype=np.uint64).astype(">u8").view(np.uint8).reshape(-1, 8)
        first = (np.cumsum(counts) - counts)[some]
        ones = np.add.reduceat(np.unpackbits(h, axis=1), first, axis=0, dtype=np.int64)
        bits = np.packbits(ones * 2 > counts[some][:, None], axis=1)
        out[some] = np.ascontiguousarray(bits).view(">u8").ravel()
    return out


def with_fingerprint(docs: DataFrame, text_col: str, shingle: int, name: str = "fp") -> DataFrame:
    """``docs`` with the fingerprint as a long (the same 64 bits)."""
    schema = T.StructType([*docs.schema.fields, T.StructField(name, T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in runs(batches, text_col):
            fp = fingerprints_of(texts(batch, text_col), shingle).view(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(fp)], names=[*batch.schema.names, name])

    return docs.mapInArrow(run, schema)


def _planes(values: np.ndarray) -> np.ndarray:
    """(64, words): row b holds bit b of every value, 64 values to a word."""
    bits = np.unpackbits(values.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
    padded = np.zeros((64, -(-len(values) // 64) * 64), dtype=np.uint8)
    padded[:, :len(values)] = bits.T
    return np.packbits(padded, axis=1, bitorder="little").view("<u8")


def near_lanes(queries: np.ndarray, lanes: np.ndarray, radius: int) -> Iterator[tuple[int, np.ndarray]]:
    """For each query with any lane within ``radius`` bits: its index and those lanes.

    The counter of ``k`` bit planes starts at ``2**k - 1 - radius``, so that it
    overflows into ``over`` exactly at the first bit beyond the radius.
    """
    planes = _planes(lanes)
    k = max(1, int(radius).bit_length())
    start = (1 << k) - 1 - radius
    rows = np.arange(len(queries))
    ones = ~np.uint64(0)
    over = np.zeros((len(queries), planes.shape[1]), dtype=np.uint64)
    if tail := len(lanes) % 64:
        over[:, -1] = ones << np.uint64(tail)
    counter = [np.full_like(over, ones if start >> b & 1 else 0) for b in range(k)]
    big = queries.astype(np.uint64)
    for p in range(64):
        mask = np.where(big >> np.uint64(63 - p) & np.uint64(1), ones, np.uint64(0))
        carry = planes[p][None, :] ^ mask[:, None]
        for c in counter:
            both = c & carry
            c ^= carry
            carry = both
        over |= carry
        if p % 8 == 7:
            live = (over != ones).any(axis=1)
            if not live.any():
                return
            if live.mean() < 0.75:
                rows, big, over = rows[live], big[live], over[live]
                counter = [c[live] for c in counter]
    near = np.unpackbits((~over).view(np.uint8), axis=1, bitorder="little")[:, :len(lanes)]
    for r, line in zip(rows.tolist(), near):
        found = np.flatnonzero(line)
        if len(found):
            yield r, found


def forest(values: np.ndarray, sides: tuple[np.ndarray, np.ndarray], radius: int) -> list[tuple[int, int]]:
    """Links within the radius between two index sets of ``values``, less those that
    join what others have joined already."""
    left, right = sides
    label = np.arange(len(values))
    out: list[tuple[int, int]] = []
    for at in range(0, len(left), PACK):
        part = left[at:at + PACK]
        for q, found in near_lanes(values[part], values[right], radius):
            me = label[part[q]]
            others = np.unique(label[right[found]])
            others = others[others != me]
            if len(others):
                out += [(int(values[me]), int(values[o])) for o in others]
                label[np.isin(label, others)] = me
    return out


def _linker(radius: int) -> Callable:
    def edges_of(group: list[np.ndarray], side: list[np.ndarray], two: bool) -> list[tuple[int, int]]:
        values, sides = np.concatenate(group).view(np.uint64), np.concatenate(side)
        every = np.arange(len(values))
        return forest(values, (every[sides == 0], every[sides == 1]) if two else (every, every), radius)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by (key, i, j).  ``open_*`` gathers one group, at most two
        sub-blocks; complete small groups gather in ``pack`` until PACK rows."""
        pack: list[np.ndarray] = []
        packed = 0
        open_key, open_fp, open_side = None, [], []

        def emit(links: list[tuple[int, int]]) -> Iterator[pa.RecordBatch]:
            if links:
                ab = np.array(links, dtype=np.uint64).view(np.int64).reshape(-1, 2)
                yield pa.RecordBatch.from_arrays([pa.array(ab[:, 0]), pa.array(ab[:, 1])], names=["a", "b"])

        def close(force: bool) -> Iterator[pa.RecordBatch]:
            nonlocal pack, packed, open_fp, open_side
            n = sum(map(len, open_fp))
            if n > PACK or (n and open_key[1] != open_key[2]):
                yield from emit(edges_of(open_fp, open_side, open_key[1] != open_key[2]))
            elif n > 1:
                pack += open_fp
                packed += n
            open_fp, open_side = [], []
            if packed > PACK or (force and packed):
                values = np.unique(np.concatenate(pack).view(np.uint64))
                every = np.arange(len(values))
                yield from emit(forest(values, (every, every), radius))
                pack, packed = [], 0

        for batch in batches:
            key, i, j, sub, fp = (batch.column(c).to_numpy() for c in ("key", "i", "j", "sub", "fp"))
            cuts = np.flatnonzero((np.diff(key) != 0) | (np.diff(i) != 0) | (np.diff(j) != 0)) + 1
            for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), len(key)]):
                if lo == hi:
                    continue
                this = (key[lo], i[lo], j[lo])
                if this != open_key:
                    yield from close(False)
                    open_key = this
                open_fp.append(fp[lo:hi])
                open_side.append((sub[lo:hi] != i[lo]).astype(np.int8))
        yield from close(True)

    return run


def _files(fp: Column, radius: int) -> Column:
    """The file keys of a fingerprint: each pair of its ``radius + 2`` blocks."""
    blocks = radius + 2
    edge = [64 * b // blocks for b in range(blocks + 1)]
    part = [F.shiftrightunsigned(fp, edge[b]).bitwiseAND(F.lit((1 << (edge[b + 1] - edge[b])) - 1))
            for b in range(blocks)]
    pairs = [(a, b) for a in range(blocks) for b in range(a)]
    return F.array(*[F.xxhash64(F.lit(n), part[a], part[b]) for n, (a, b) in enumerate(pairs)])


def links(distinct: DataFrame, radius: int) -> DataFrame:
    """Edges (a, b) that join all fingerprints ``fp`` (distinct longs) within the radius."""
    filed = distinct.select(F.explode(_files(F.col("fp"), radius)).alias("key"), "fp")
    large = (filed.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > TILE)
             .select("key", F.ceil(F.col("n") / TILE).cast("int").alias("parts")))
    sub = F.pmod(F.xxhash64("fp"), F.coalesce("parts", F.lit(1))).cast("int")
    spread = (filed.join(large, "key", "left").withColumn("sub", sub)
              .select("key", "fp", "sub", F.explode(F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1)).alias("t"))
              .select("key", F.least("sub", "t").alias("i"), F.greatest("sub", "t").alias("j"), "sub", "fp"))
    return (spread.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
            .mapInArrow(_linker(radius), "a long, b long"))


def groups(marked: DataFrame, id_col: str, radius: int) -> DataFrame:
    """(fp, component_id) for every distinct ``fp`` of the written table ``marked``."""
    reps = staged(marked.groupBy("fp").agg(F.min(id_col).alias("least")), "fingerprints")
    roots = components(links(reps.select("fp"), radius))
    rooted = reps.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn(
        "root", F.coalesce("root", "fp"))
    whole = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return rooted.join(whole, "root").select("fp", "component_id", "root")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle: int = 3, radius: int = 3) -> DataFrame:
    """One row per document: id, ``fingerprint`` (16 hex digits) and ``component_id``,
    the smallest id among the documents that links reach."""
    marked = staged(with_fingerprint(documents(docs, id_col, text_col), text_col, shingle)
                    .select(id_col, "fp"), "simhash")
    return marked.join(groups(marked, id_col, radius), "fp").select(
        id_col, F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             shingle: int = 3, radius: int = 3) -> DataFrame:
    """The documents, one of each component: that with the smallest id (of rows with
    that id any one); a component of NULL ids keeps one of its rows."""
    columns = docs.columns
    row, print_ = unused(docs, "__row", "__fp")
    marked = staged(with_fingerprint(docs.withColumn(row, F.monotonically_increasing_id()),
                                     text_col, shingle, print_), "simhash-docs")
    fps = marked.select(F.col(print_).alias("fp"), F.col(f"`{id_col}`").alias("__id"), F.col(row).alias("__row"))
    stay = (fps.join(groups(fps, "__id", radius), "fp").groupBy("root")
            .agg(F.min(F.struct(F.col("__id").isNull(), F.col("__id"), F.col("__row"))).alias("s"))
            .select(F.col("s.__row").alias(row)))
    return marked.join(stay, row, "left_semi").select(*[F.col(f"`{c}`") for c in columns])
