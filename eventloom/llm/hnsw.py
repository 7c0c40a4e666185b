"""Approximate nearest neighbours by inner product: one HNSW graph per shard.

Equal vectors are collapsed before indexing (with as many of their smallest ids
as an answer can hold), so that copies neither crowd the graph nor hide each
other.  Distinct vectors are dealt into shards of about ``shard_size`` by a hash;
each shard is a group of bounded size and becomes one row of a written table:
the flat neighbour arrays of its layers beside its vectors.  A shard then asks
itself for the neighbours of some of its own vectors and keeps the beam width
that finds them (all of its nodes, if no width does).  Queries meet every shard
in groups of bounded size, and the shards' best answers are merged by score and
id.

Within a shard vectors get one more component that makes their lengths equal,
which turns the largest inner product into the smallest distance.  A vector's
top layer is drawn geometrically from a fixed seed; nodes are numbered by
falling layer, so a layer is a prefix of the nodes.  Layers are built from the
top, nodes in batches: beam search in what is there, candidates from the batch
itself, neighbour selection that prefers diverse directions, and links back
under the same selection.  All searches of a batch advance together in numpy.

Defined cases: vectors that are NULL, empty, zero, or hold NULL or non-finite
components take no part, as queries or candidates, nor do NULL ids; vectors of
another length are no candidates; rows that repeat id and vector count once;
other columns are not looked at; a query without candidates has no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventloom.llm.common import staged

GRAPH = "dim int, shard int, ef int, vectors binary, ids array<long>, first array<int>, sizes array<int>, neighbours array<binary>"
#: Beam widths tried, vectors asked and neighbours wanted when a shard measures its own recall.
WIDTHS, ASKED, WANTED = (96, 192, 384, 768), 128, 20
#: Queries that advance together.
CHUNK = 256


def _beam(data: np.ndarray, links: np.ndarray, queries: np.ndarray, entry: np.ndarray, ef: int, step: int) -> tuple[np.ndarray, np.ndarray]:
    """Beam search of one layer: for each query the ids (-1: none) and similarities of the
    ``ef`` best nodes met, best first.  ``entry`` has start nodes (-1: none) for each query."""
    q = len(queries)
    rows = np.arange(q)[:, None]
    met = np.zeros((q, len(links) + 1), dtype=bool)
    met[:, -1] = True  # index -1: no node
    met[rows, entry] = True
    ids = np.full((q, ef), -1, dtype=np.int32)
    sims = np.full((q, ef), -np.inf, dtype=np.float32)
    done = np.zeros((q, ef), dtype=bool)
    near = np.where(entry >= 0, np.einsum("qd,qwd->qw", queries, data[entry]), -np.inf)
    width = min(ef, entry.shape[1])
    order = np.argsort(-near, axis=1)[:, :width]
    ids[:, :width], sims[:, :width] = np.take_along_axis(entry, order, 1), np.take_along_axis(near, order, 1)
    while True:
        waiting = np.where(done | (ids < 0), -np.inf, sims)
        best = np.argpartition(-waiting, min(step, ef) - 1, axis=1)[:, :step]
        open_ = np.take_along_axis(waiting, best, 1) > -np.inf
        live = open_.any(axis=1)
        if not live.any():
            return ids, sims
        at = np.flatnonzero(live)
        node = np.where(open_[at], ids[at[:, None], best[at]], -1)
        done[at[:, None], best[at]] = True
        new = links[node].reshape(len(at), -1)
        new[np.repeat(node < 0, links.shape[1], axis=1)] = -1
        new[met[at[:, None], new]] = -1
        met[at[:, None], new] = True
        value = np.einsum("qd,qwd->qw", queries[at], data[new])
        value[new < 0] = -np.inf
        all_ids, all_sims = np.concatenate([ids[at], new], 1), np.concatenate([sims[at], value], 1)
        all_done = np.concatenate([done[at], np.zeros(new.shape, dtype=bool)], 1)
        order = np.argsort(-all_sims, axis=1, kind="stable")[:, :ef]
        ids[at], sims[at], done[at] = (np.take_along_axis(x, order, 1) for x in (all_ids, all_sims, all_done))
        twin = (ids[at, 1:] == ids[at, :-1]) & (ids[at, 1:] >= 0)  # met twice in one step
        row, column = np.nonzero(twin)
        ids[at[row], column + 1], sims[at[row], column + 1] = -1, -np.inf


def _select(data: np.ndarray, ids: np.ndarray, sims: np.ndarray, most: int) -> np.ndarray:
    """Up to ``most`` neighbours of each row's candidates (best first): first those nearer to the
    node than to any neighbour chosen before, then the best of the others."""
    out = np.full((len(ids), most), -1, dtype=np.int32)
    for at in range(0, len(ids), CHUNK):
        own, near = ids[at:at + CHUNK], sims[at:at + CHUNK]
        vectors = data[own]
        between = np.einsum("qad,qbd->qab", vectors, vectors, optimize=True)
        kept = np.zeros(own.shape, dtype=bool)
        for j in range(own.shape[1]):
            rival = np.where(kept, between[:, j], -np.inf).max(axis=1)
            kept[:, j] = (own[:, j] >= 0) & (near[:, j] > rival) & (kept.sum(axis=1) < most)
        rank = np.where(own < 0, 2, np.where(kept, 0, 1))
        order = np.argsort(rank, axis=1, kind="stable")[:, :most]
        out[at:at + CHUNK, :order.shape[1]] = np.take_along_axis(own, order, 1)
    return out


def _link_back(data: np.ndarray, links: np.ndarray, first: int, last: int) -> None:
    """Adds the reverse of the links of nodes first..last, keeping the diverse ones where full."""
    source = np.repeat(np.arange(first, last, dtype=np.int32), links.shape[1])
    target = links[first:last].ravel()
    source, target = source[target >= 0], target[target >= 0]
    order = np.argsort(target, kind="stable")
    source, target = source[order], target[order]
    nodes, start, count = np.unique(target, return_index=True, return_counts=True)
    for at in range(0, len(nodes), CHUNK):
        node, begin, n = nodes[at:at + CHUNK], start[at:at + CHUNK], count[at:at + CHUNK]
        width = int(n.max())
        column = np.arange(width)
        new = np.where(column < n[:, None], source[np.minimum(begin[:, None] + column, len(source) - 1)], -1)
        old = links[node]
        new[(new[:, :, None] == old[:, None, :]).any(axis=2)] = -1
        both = np.concatenate([old, new], axis=1)
        sims = np.where(both >= 0, np.einsum("qd,qwd->qw", data[node], data[both]), -np.inf)
        best = np.argsort(-sims, axis=1, kind="stable")[:, :2 * links.shape[1]]
        links[node] = _select(data, np.take_along_axis(both, best, 1), np.take_along_axis(sims, best, 1), links.shape[1])


class Graph:
    def __init__(self, data: np.ndarray, layers: list[np.ndarray]):
        self.data, self.layers = data, layers

    def entries(self, queries: np.ndarray, below: int) -> np.ndarray:
        """Start nodes for layer ``below``: a narrow search down the layers above it."""
        entry = np.zeros((len(queries), 1), dtype=np.int32)
        for layer in self.layers[:below:-1]:
            ids, _ = _beam(self.data, layer, queries, entry, 4, 1)
            entry = ids
        return entry

    def search(self, queries: np.ndarray, ef: int, step: int = 4) -> np.ndarray:
        """For each query up to ``ef`` nodes, best first, -1 where there is none."""
        parts = [_beam(self.data, self.layers[0], q, self.entries(q, 0), ef, step)[0]
                 for q in (queries[at:at + CHUNK] for at in range(0, len(queries), CHUNK))]
        return np.concatenate(parts) if parts else np.empty((0, ef), dtype=np.int32)


def level(vectors: np.ndarray) -> np.ndarray:
    """With one more component, so that all rows have the length of the longest (then scaled to one)."""
    norm = np.einsum("nd,nd->n", vectors, vectors)
    top = max(float(norm.max()), np.finfo(float).tiny)
    return (np.column_stack([vectors, np.sqrt(np.maximum(top - norm, 0))]) / np.sqrt(top)).astype(np.float32)


def build(data: np.ndarray, m: int = 16, ef: int = 64, seed: int = 1) -> tuple[Graph, np.ndarray]:
    """A graph over ``data`` (rows of equal length), and the row that each node stands for."""
    n = len(data)
    draw = np.random.default_rng(seed).random(n)
    top = np.minimum((-np.log1p(-draw) / np.log(m)).astype(int), 12)
    row = np.argsort(-top, kind="stable")
    data, top = data[row], top[row]
    size = [int(np.searchsorted(-top, -k, side="right")) for k in range(int(top[0]) + 1)]
    graph = Graph(data, [np.empty((0, 2 * m if k == 0 else m), dtype=np.int32) for k in range(len(size))])
    for k in range(len(size) - 1, -1, -1):
        most = 2 * m if k == 0 else m
        links = np.full((size[k], most), -1, dtype=np.int32)
        head = min(size[k], max(CHUNK, size[k + 1] if k + 1 < len(size) else 1))
        at = 0
        while at < size[k]:
            to = head if at == 0 else min(size[k], at + min(at, 4 * CHUNK))
            own = data[at:to]
            near = own @ own.T  # candidates from the batch itself
            np.fill_diagonal(near, -np.inf)
            few = min(ef, to - at)
            best = np.argsort(-near, axis=1)[:, :few]
            ids, sims = (best + at).astype(np.int32), np.take_along_axis(near, best, 1)
            ids[sims == -np.inf] = -1
            if at:
                graph.layers[k] = links[:at]
                found = [_beam(data, links[:at], q, graph.entries(q, k), ef, 4)
                         for q in (own[c:c + CHUNK] for c in range(0, len(own), CHUNK))]
                ids = np.concatenate([ids, np.concatenate([f[0] for f in found])], 1)
                sims = np.concatenate([sims, np.concatenate([f[1] for f in found])], 1)
                order = np.argsort(-sims, axis=1, kind="stable")[:, :ef]
                ids, sims = np.take_along_axis(ids, order, 1), np.take_along_axis(sims, order, 1)
            links[at:to] = _select(data, ids, sims, most)
            _link_back(data, links, at, to)
            at = to
        graph.layers[k] = links
    return graph, row


def width(graph: Graph, target: float) -> int:
    """The least beam width whose recall, measured on some of the graph's own vectors against
    all of it, reaches ``target``; the number of nodes (an exact search) if none does."""
    n = len(graph.data)
    asked = graph.data[np.linspace(0, n - 1, min(n, ASKED)).astype(int)].copy()
    asked[:, -1] = 0  # as queries come: without the component that levels the lengths
    few = min(WANTED, n)
    scores = asked @ graph.data.T
    best = np.argpartition(-scores, few - 1, axis=1)[:, :few]
    for ef in WIDTHS:
        if ef >= n:
            break
        found = graph.search(asked, ef)[:, :few]
        if (found[:, :, None] == best[:, None, :]).any(axis=1).mean() >= target:
            return ef
    return n


def distinct_vectors(rows: DataFrame, keep: int) -> DataFrame:
    """(vector, ids): each distinct vector with its ``keep`` smallest ids, ascending."""
    own = Window.partitionBy("vector").orderBy("id")
    return (rows.select("vector", "id").distinct().withColumn("__n", F.row_number().over(own)).where(F.col("__n") <= keep)
            .groupBy("vector").agg(F.array_sort(F.collect_list("id")).alias("ids")))


def usable(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, vector: array<double>, with every other column) of the rows that take part."""
    vector = F.col(vector_col).cast("array<double>")
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    some = F.exists(vector, lambda x: x != 0)
    return df.select(F.col(id_col).cast("long").alias("id"), vector.alias("vector"), "__query").where(
        F.col("id").isNotNull() & F.coalesce(~bad & some, F.lit(False)))


def index(vectors: DataFrame, shard_size: int, m: int, ef: int, recall: float) -> DataFrame:
    """One row (GRAPH) for each shard of the distinct vectors, written, with the beam width
    that a search of the shard needs for ``recall``."""
    shards = max(1, -(-vectors.count() // shard_size))

    def run(table: pa.Table) -> pa.Table:
        dim, shard = table["dim"][0].as_py(), table["shard"][0].as_py()
        ids = table["ids"].to_pylist()
        raw = np.array(table["vector"].combine_chunks().flatten(), dtype=np.float64).reshape(-1, dim)
        order = sorted(range(len(ids)), key=ids.__getitem__)
        graph, row = build(level(raw[order]), m, ef)
        row = [order[i] for i in row]
        ids = [ids[i] for i in row]
        return pa.table({
            "dim": pa.array([dim], pa.int32()), "shard": pa.array([shard], pa.int32()),
            "ef": pa.array([width(graph, recall)], pa.int32()), "vectors": pa.array([raw[row].tobytes()], pa.binary()),
            "ids": pa.array([[i for x in ids for i in x]], pa.list_(pa.int64())),
            "first": pa.array([np.cumsum([0, *map(len, ids)]).tolist()], pa.list_(pa.int32())),
            "sizes": pa.array([[len(x) for x in graph.layers]], pa.list_(pa.int32())),
            "neighbours": pa.array([[x.tobytes() for x in graph.layers]], pa.list_(pa.binary()))})

    dealt = vectors.select(F.size("vector").alias("dim"), F.pmod(F.xxhash64("vector"), F.lit(shards)).cast("int").alias("shard"), "vector", "ids")
    return staged(dealt.groupBy("dim", "shard").applyInArrow(run, GRAPH), "hnsw")


def unpacked(graph_row: dict) -> tuple[Graph, np.ndarray, np.ndarray, np.ndarray]:
    """A shard's graph, its vectors, and the ids of each node with where they start."""
    dim = graph_row["dim"]
    raw = np.frombuffer(graph_row["vectors"], dtype=np.float64).reshape(-1, dim)
    layers = [np.frombuffer(b, dtype=np.int32).reshape(s, -1) for s, b in zip(graph_row["sizes"], graph_row["neighbours"])]
    return Graph(level(raw), layers), raw, np.array(graph_row["ids"], dtype=np.int64), np.array(graph_row["first"], dtype=np.int64)


def _answers(shard: tuple[Graph, np.ndarray, np.ndarray, np.ndarray], queries: np.ndarray, keep: int,
             ef: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each query at most ``keep`` ids of a shard, by falling score and rising id: (query, id, score)."""
    graph, raw, ids, first = shard
    scale = np.sqrt(np.einsum("qd,qd->q", queries, queries))[:, None]
    asked = np.column_stack([queries / scale, np.zeros(len(queries))]).astype(np.float32)
    if max(ef, keep) < len(raw):
        found = graph.search(asked, max(ef, keep))
    else:
        few = min(len(raw), 2 * keep)  # more than are kept, as these scores are rounded
        found = np.argpartition(-(asked @ graph.data.T), few - 1, axis=1)[:, :few]
    who, node = np.nonzero(found >= 0)
    node = found[who, node]
    score = np.concatenate([np.einsum("nd,nd->n", queries[who[a:a + 4096]], raw[node[a:a + 4096]]) for a in range(0, len(who), 4096)] or [np.empty(0)])
    copies = first[node + 1] - first[node]
    at = np.repeat(first[node] - (np.cumsum(copies) - copies), copies) + np.arange(int(copies.sum()))
    who, own, score = np.repeat(who, copies), ids[at], np.repeat(score, copies)
    order = np.lexsort((own, -score, who))
    who, own, score = who[order], own[order], score[order]
    rank = np.arange(len(who)) - np.searchsorted(who, who)
    return who[rank < keep], own[rank < keep], score[rank < keep]


def search(df: DataFrame, is_query: Column, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding", shard_size: int = 8192,
           m: int = 16, ef_build: int = 64, recall: float = 0.97, group: int = 16384) -> DataFrame:
    """The ``k`` nearest rows found for each row where ``is_query`` holds: query_id, rank, vec_id, score.
    Each shard is searched as wide as it measured to need for ``recall``.  Queries go to every
    shard; a shard is repeated only for each ``group`` of queries."""
    rows = usable(df.select(F.col(f"`{id_col}`"), F.col(f"`{vector_col}`"), F.coalesce(is_query, F.lit(False)).alias("__query")), id_col, vector_col)
    vectors = staged(distinct_vectors(rows, k + 1), "vectors")
    graphs = index(vectors, shard_size, m, ef_build, recall)
    asked = rows.where("__query").select("id", "vector").distinct()
    named = staged(asked.join(vectors, "vector").select(F.col("id").alias("query_id"), F.col("ids")[0].alias("key"), "vector"), "queries")
    keys = named.select("key", "vector").distinct()
    groups = max(1, -(-keys.count() // group))
    part = F.pmod(F.xxhash64("key"), F.lit(groups)).cast("int")
    shards = graphs.select(F.col("dim").alias("dim"), F.col("shard").alias("shard"))
    met = (keys.select(F.size("vector").alias("dim"), "key", "vector", part.alias("part")).join(shards, "dim"))
    indexes = graphs.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not len(left) or not len(right):
            return pa.table({"key": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
        graph_row = left.slice(0, 1).to_pylist()[0]
        queries = np.array(right["vector"].combine_chunks().flatten(), dtype=np.float64).reshape(len(right), -1)
        keys, shard, parts = right["key"].combine_chunks(), unpacked(graph_row), []
        for at in range(0, len(queries), 2 * CHUNK):
            who, own, score = _answers(shard, queries[at:at + 2 * CHUNK], k + 1, graph_row["ef"])
            parts.append(pa.table({"key": keys.take(pa.array(who + at)), "vec_id": pa.array(own), "score": pa.array(score)}))
        return pa.concat_tables(parts)

    by = ["dim", "shard", "part"]
    found = indexes.groupBy(*by).cogroup(met.groupBy(*by)).applyInArrow(run, "key long, vec_id long, score double")
    best = Window.partitionBy("key").orderBy(F.desc("score"), "vec_id")
    merged = found.withColumn("__n", F.row_number().over(best)).where(F.col("__n") <= k + 1).drop("__n")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (named.select("query_id", "key").join(merged, "key").where("query_id <> vec_id")
            .withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
