"""MinHash near-duplicates: circulant signatures, banding, exact Jaccard similarity.

A document's set holds the 64-bit hashes of its distinct word shingles.  Two
permutations make a whole signature: the first scatters the set over a circle
of ``CIRCLE`` places, the second is a table of ranks round that circle, and
coordinate ``k`` is the least rank that the set meets when the table is turned
by ``k`` places.  The ranks that one shingle meets at all turns are one
contiguous slice of the table, so a signature is the element-wise minimum of
as many slices as the set has shingles.

Documents with equal sets are one node.  Nodes that agree on all rows of a
band share a bucket; with the default bands, sets of the threshold's similarity
miss each other in all of them with a probability of 2e-7.  Buckets with the
same members are compared once.  In a bucket, sets are intersected in full, and
only links that join what is not joined yet are reported, so a group of near
copies gives a spanning tree and not its pairs.

A bucket over ``BLOCK`` nodes is cut into blocks, compared inside and with the
bucket's first node, which every block gets.  Where that leaves a bucket in
more than one component, the nodes outside its largest ("strays") are compared
with all of its other blocks, block by block, each pair of blocks a group of
its own.  Work is thus linear for a group held together by its first
node, however large, and no pair is left out.

Defined cases: a text of fewer words than a shingle has its whole word sequence
as its one shingle; a text without words (NULL and empty texts too) has an
empty set, which is linked with nothing, not even with its like; repeated rows
are linked, if not empty; a NULL id is never a component's id unless the
component has no other, and is kept only there; whole texts are read, the set
of one text being held at a time; an empty table gives an empty result; columns
other than the two named are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventloom.llm.common import documents, gram_hashes, runs, staged, text_bytes, word_hashes, word_spans
from eventloom.llm.components import components

CIRCLE = 1 << 20
#: Nodes and shingles that a block of a large bucket is meant to have.
BLOCK = 400
BLOCK_SHINGLES = 400_000
#: Shingles whose slices are gathered at once.
SLICES = 4096
#: A-Z to lower case, the white space that parts words to blanks.
WORDS = bytes(b + 32 if 65 <= b <= 90 else 32 if 9 <= b <= 13 else b for b in range(256))
_SCATTER = np.uint64(0xD6E8FEB86659FD93)


@dataclass(frozen=True)
class Sketch:
    """Shingle length in words, least similarity in percent, and the signature's shape."""
    shingle: int = 4
    percent: int = 80
    bands: int = 50
    rows: int = 6


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of the 64-bit numbers (xor-shifts and odd factors)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def ranks(turns: int) -> np.ndarray:
    """The second permutation: the rank of each place of the circle, and the first
    ``turns`` places once more behind, so that turning it is slicing."""
    order = np.argsort(_mixed(np.arange(1, CIRCLE + 1, dtype=np.uint64)), kind="stable")
    rank = np.empty(CIRCLE, dtype=np.int32)
    rank[order] = np.arange(CIRCLE, dtype=np.int32)
    return np.concatenate([rank, rank[:turns]])


def places(shingles: np.ndarray) -> np.ndarray:
    """The first permutation: a bijection of the hashes, whose top bits are the place."""
    return (_mixed(shingles * _SCATTER) >> np.uint64(64 - CIRCLE.bit_length() + 1)).astype(np.int64)


def signature(shingles: np.ndarray, slices: np.ndarray) -> np.ndarray:
    """Least rank at each turn; ``slices[p]`` has the ranks at place ``p`` of all turns."""
    at = places(shingles)
    parts = [slices[at[i:i + SLICES]].min(axis=0) for i in range(0, len(at), SLICES)]
    return parts[0] if len(parts) == 1 else np.min(parts, axis=0)


def sets_of(values: pa.Array, shingle: int) -> Iterator[np.ndarray]:
    """Each text's sorted distinct shingle hashes."""
    raw, offsets = text_bytes(values)
    data = np.frombuffer(raw.translate(WORDS), dtype=np.uint8)
    starts, ends, first = word_spans(data, offsets)
    words = word_hashes(data, starts, ends)
    grams, at = gram_hashes(words, first, shingle)
    bound = np.searchsorted(at, first)
    for t in range(len(values)):
        if first[t + 1] - first[t] >= shingle:
            yield np.unique(grams[bound[t]:bound[t + 1]])
        elif first[t + 1] > first[t]:
            own = words[first[t]:first[t + 1]]
            yield gram_hashes(own, np.array([0, len(own)]), len(own))[0]
        else:
            yield np.empty(0, dtype=np.uint64)


def digest(shingles: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(shingles.astype("<u8").tobytes())


_MARKED = "id {id}, size long, digest binary, bands array<long>"
_SETS = "digest binary, shingles array<long>"


def marked(named: DataFrame, sketch: Sketch) -> DataFrame:
    """(id, size, digest, bands) of (id, text): the set's size and 128-bit digest and one
    hash for each band of its signature (NULL for an empty set)."""
    turns = sketch.bands * sketch.rows
    kind = named.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slices = np.lib.stride_tricks.sliding_window_view(ranks(turns), turns)
        salt = _mixed(np.arange(1, sketch.bands + 1, dtype=np.uint64))
        for batch in runs(batches, "text"):
            sizes, digests, bands = [], [], []
            for one in sets_of(batch.column("text"), sketch.shingle):
                sizes.append(len(one))
                digests.append(digest(one) if len(one) else None)
                if not len(one):
                    bands.append(None)
                    continue
                rows = signature(one, slices).astype(np.uint64).reshape(sketch.bands, sketch.rows)
                key = salt.copy()
                for r in range(sketch.rows):
                    key = _mixed(key ^ rows[:, r])
                bands.append(key.view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()),
                 pa.array(bands, pa.list_(pa.int64()))], names=["id", "size", "digest", "bands"])

    return named.mapInArrow(run, _MARKED.format(id=kind))


def sets(named: DataFrame, shingle: int) -> DataFrame:
    """(digest, shingles) of (id, text)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in runs(batches, "text"):
            found = list(sets_of(batch.column("text"), shingle))
            yield pa.RecordBatch.from_arrays(
                [pa.array([digest(s) for s in found], pa.binary()),
                 pa.array([s.view(np.int64) for s in found], pa.list_(pa.int64()))], names=["digest", "shingles"])

    return named.select("id", "text").mapInArrow(run, _SETS)


def joining(nodes: np.ndarray, values: list[np.ndarray], percent: int,
            label: np.ndarray, left: np.ndarray, right: np.ndarray) -> list[tuple[int, int]]:
    """Links between the sets of ``left`` and those of ``right`` (indices), less those that
    join what has one ``label`` already.  ``label`` is updated."""
    size = np.fromiter(map(len, values), np.int64, len(values))
    ends = np.cumsum(size)
    first = ends - size
    _, local = np.unique(np.concatenate(values), return_inverse=True)
    there = np.zeros(len(local), dtype=bool)
    out: list[tuple[int, int]] = []
    for x in left.tolist():
        n = size[x]
        others = right[(label[right] != label[x]) & (100 * np.minimum(size[right], n) >= percent * np.maximum(size[right], n))]
        if not len(others):
            continue
        own = local[first[x]:ends[x]]
        there[own] = True
        flat = np.repeat(first[others] - (np.cumsum(size[others]) - size[others]), size[others]) + np.arange(int(size[others].sum()))
        both = np.add.reduceat(there[local[flat]], np.cumsum(size[others]) - size[others], dtype=np.int64)
        there[own] = False
        for y in others[100 * both >= percent * (size[others] + n - both)].tolist():
            if label[y] != label[x]:
                out.append((int(nodes[x]), int(nodes[y])))
                label[label == label[y]] = label[x]
    return out


def _linker(percent: int):
    """Rows come sorted by (bucket, i, j).  Sets of a group with j = i are compared with each
    other; otherwise those of side 0 with those of side 1."""
    def links(group: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(group).combine_chunks()
        node, side, part = (rows.column(c).to_numpy() for c in ("node", "side", "part"))
        lists = rows.column("shingles").combine_chunks()
        flat, cut = lists.values.to_numpy().view(np.uint64), lists.offsets.to_numpy()
        values = [flat[a:b] for a, b in zip(cut[:-1].tolist(), cut[1:].tolist())]
        every = np.arange(len(node))
        sides = (every, every) if not side.any() else (every[side == 0], every[side == 1])
        _, label = np.unique(part, return_inverse=True)
        found = joining(node, values, percent, label, *sides) if len(values) > 1 and len(sides[0]) else []
        if found:
            ab = np.array(found, dtype=np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(ab[:, 0]), pa.array(ab[:, 1])], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, group = None, []
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.stack([batch.column(c).to_numpy() for c in ("bucket", "i", "j")])
            cuts = np.flatnonzero((np.diff(keys, axis=1) != 0).any(axis=0)) + 1
            for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows]):
                key = tuple(keys[:, lo].tolist())
                if key != now and group:
                    yield from links(group)
                    group = []
                now = key
                group.append(batch.slice(lo, hi - lo))
        if group:
            yield from links(group)

    return run


def _compared(rows: DataFrame, shingles: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) among rows (bucket, i, j, side, part, node)."""
    return (rows.join(shingles, "node").select("bucket", "i", "j", "side", "part", "node", "shingles")
            .repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j")
            .mapInArrow(_linker(percent), "a long, b long"))


def _blocks(count: str, shingles: str) -> Column:
    return F.greatest(F.ceil(F.col(count) / BLOCK), F.ceil(F.col(shingles) / BLOCK_SHINGLES), F.lit(1)).cast("int")


def buckets(reps: DataFrame) -> DataFrame:
    """(bucket, node, size, parts, block, lead): the members of every bucket of two or more,
    of buckets with the same members one; ``lead`` is the bucket's first node."""
    filed = reps.select(F.explode("bands").alias("bucket"), "node", "size")
    many = (filed.groupBy("bucket").agg(
        F.count("*").alias("count"), F.sum("size").alias("shingles"), F.min("node").alias("lead"),
        F.bit_xor(F.xxhash64("node")).alias("x"), F.bit_xor(F.xxhash64("node", F.lit(1))).alias("y"))
        .where("count > 1"))
    once = many.groupBy("count", "shingles", "lead", "x", "y").agg(F.min("bucket").alias("bucket"))
    parts = once.select("bucket", "lead", _blocks("count", "shingles").alias("parts"))
    return filed.join(parts, "bucket").withColumn("block", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))


def _strays(members: DataFrame, roots: DataFrame) -> DataFrame:
    """Rows that compare, in buckets of several blocks, the nodes outside the bucket's largest
    component with the other blocks.  Nodes of one component share ``part``."""
    large = members.where("parts > 1").select("bucket", "node", "parts", "block")
    known = large.join(roots, "node", "left").withColumn("part", F.coalesce("root", "node")).drop("root")
    share = known.groupBy("bucket", "part").agg(F.count("*").alias("n"))
    main = (share.groupBy("bucket").agg(F.count("*").alias("kinds"), F.max(F.struct("n", "part")).alias("m"))
            .where("kinds > 1").select("bucket", F.col("m.part").alias("main")))
    torn = known.join(main, "bucket")
    stray = torn.where("part <> main")
    # Side 0: the strays of block i, for each other block j; side 1: all of block j.
    meets = stray.select("bucket", F.col("block").alias("i"), "parts").distinct()
    pairs = (meets.select("bucket", "i", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("j"))
             .where("i <> j"))
    asked = (stray.select("bucket", F.col("block").alias("i"), "part", "node", "parts")
             .select("*", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("j")).where("i <> j"))
    told = torn.join(pairs.withColumnRenamed("j", "block"), ["bucket", "block"])
    row = ("bucket", "i", "j", "side", "part", "node")
    return asked.withColumn("side", F.lit(0)).select(*row).unionByName(
        told.withColumn("j", F.col("block")).withColumn("side", F.lit(1)).select(*row))


def classes(marks: DataFrame, named: DataFrame, sketch: Sketch) -> DataFrame:
    """(digest, component_id, root) for every non-empty set of the written table ``marks``."""
    reps = staged(marks.where("digest is not null").groupBy("digest").agg(
        F.min("id").alias("least"), F.first("size").alias("size"), F.first("bands").alias("bands"))
        .withColumn("node", F.monotonically_increasing_id()), "minhash-nodes")
    members = staged(buckets(reps), "minhash-buckets")
    wanted = reps.join(members.select("node").distinct(), "node", "left_semi")
    ids = wanted.select(F.col("least").alias("id")).distinct()
    one_each = (sets(named.join(ids, named["id"].eqNullSafe(ids["id"]), "left_semi"), sketch.shingle)
                .dropDuplicates(["digest"]))
    shingles = staged(wanted.select("node", "digest").join(one_each, "digest").select("node", "shingles"), "minhash-sets")
    inside = members.select("bucket", F.col("block").alias("i"), F.col("block").alias("j"), "node")
    lead = (members.where("node = lead").select("bucket", "block", "node", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("i"))
            .where("i <> block").select("bucket", "i", F.col("i").alias("j"), "node"))
    first = staged(_compared(inside.unionByName(lead).withColumns({"side": F.lit(0), "part": F.col("node")}),
                             shingles, sketch.percent), "minhash-links")
    roots = staged(components(first), "minhash-roots")
    second = staged(_compared(_strays(members, roots), shingles, sketch.percent), "minhash-links")
    if second.take(1):
        roots = components(first.unionByName(second))
    rooted = reps.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")).select("digest", "least", "root")
    return rooted.join(rooted.groupBy("root").agg(F.min("least").alias("component_id")), "root").select(
        "digest", "component_id", "root")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    sketch: Sketch = Sketch()) -> DataFrame:
    """One row per document: id, ``n_shingles``, ``component_id`` (the smallest id among the
    documents that links reach) and ``kept`` (whether that is its own)."""
    named = documents(docs, id_col, text_col).select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    marks = staged(marked(named, sketch), "minhash-marks")
    found = marks.join(classes(marks, named, sketch).select("digest", "component_id"), "digest", "left")
    component = F.when(F.col("digest").isNull(), F.col("id")).otherwise(F.col("component_id"))
    return found.select(F.col("id").alias(id_col), F.col("size").alias("n_shingles"), component.alias("component_id"),
                        component.eqNullSafe(F.col("id")).alias("kept"))
