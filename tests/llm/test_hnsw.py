import math

import numpy as np
from pyspark.sql import functions as F

from eventloom.llm import hnsw
from tests.llm.data import ROOT


def brute(rows, is_query, k):
    """Exact answers over (id, vector) rows."""
    good = {}
    for i, v in rows:
        if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v):
            good[(i, tuple(v))] = None
    good = list(good)
    ids, dims = np.array([i for i, _ in good]), np.array([len(v) for _, v in good])
    out = {}
    for i, v in good:
        if is_query(i):
            same = np.flatnonzero((dims == len(v)) & (ids != i))
            score = np.array([np.dot(good[j][1], v) for j in same]).reshape(-1)
            order = np.lexsort((ids[same], -score))[:k]
            out[i] = [(int(ids[same[j]]), float(score[j])) for j in order]
    return out


def recall(got, want):
    by = {}
    for r in got:
        by.setdefault(r.query_id, []).append(r)
    hit = total = 0
    for q, expected in want.items():
        own = sorted(by.get(q, []), key=lambda r: r.rank)
        assert [r.rank for r in own] == list(range(1, len(expected) + 1)), q
        assert all((-a.score, a.vec_id) <= (-b.score, b.vec_id) for a, b in zip(own, own[1:]))
        hit += len({r.vec_id for r in own} & {i for i, _ in expected})
        total += len(expected)
    assert set(by) <= set(want)
    return hit / max(total, 1)


def test_recall_on_embeddings_over_several_shards(spark):
    df = spark.read.parquet(f"{ROOT}/sf0.1/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    want = brute(rows, lambda i: i % 20 == 0, 20)
    got = hnsw.search(df, F.col("vec_id") % 20 == 0, shard_size=700, group=30).collect()
    assert recall(got, want) > 0.97
    vectors = dict(rows)
    for r in got[:200]:
        assert abs(r.score - np.dot(np.array(vectors[r.query_id], float), np.array(vectors[r.vec_id], float))) < 1e-12


def test_lengths_that_differ_and_hot_copies(spark):
    rng = np.random.default_rng(5)
    rows = [(i, (rng.normal(size=16) * rng.lognormal()).tolist()) for i in range(1500)]
    rows += [(2000 + i, [1.0] * 16) for i in range(900)]  # one vector in more than a third of the rows
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumns({"id": F.lit(1), "score": F.lit("x"), "vector": F.lit(2)})
    want = brute(rows, lambda i: i % 50 == 0, 20)
    got = hnsw.search(df, F.col("vec_id") % 50 == 0, shard_size=400).collect()
    assert recall(got, want) > 0.97
    hot = [r.vec_id for r in sorted(got, key=lambda r: r.rank) if r.query_id == 2000]
    assert set(hot) == {i for i, _ in want[2000]}


def test_odd_rows(spark):
    rows = [(0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, None), (3, []), (4, [0.0, 0.0]), (5, [None, 1.0]), (6, [float("nan"), 1.0]), (7, [float("inf"), 1.0]),
            (8, [1.0, 0.0]), (8, [1.0, 0.0]), (9, [1.0, 2.0, 3.0]), (None, [3.0, 3.0]), (10, [-1.0, -1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    want = brute(rows, lambda i: True, 3)
    got = hnsw.search(df, F.lit(True), k=3).collect()
    assert sorted((r.query_id, r.rank, r.vec_id, r.score) for r in got) == \
        sorted((q, n + 1, i, s) for q, v in want.items() for n, (i, s) in enumerate(v))
    assert hnsw.search(df.limit(0), F.lit(True)).count() == 0
    assert hnsw.search(df, F.lit(False)).count() == 0


def test_graph_is_flat_and_layered():
    data = hnsw.level(np.random.default_rng(2).normal(size=(3000, 8)))
    np.testing.assert_allclose(np.linalg.norm(data, axis=1), 1, rtol=1e-5)
    graph, row = hnsw.build(data)
    assert sorted(row) == list(range(3000)) and len(graph.layers) >= 3
    assert [len(x) for x in graph.layers] == sorted((len(x) for x in graph.layers), reverse=True)
    for layer in graph.layers:
        assert layer.max() < len(layer) and all(len(set(x[x >= 0])) == (x >= 0).sum() for x in layer)
    found = graph.search(graph.data, 8)
    assert (found[:, 0] == np.arange(3000)).mean() > 0.99


def test_recall_with_production_parameters_over_three_shards():
    """Shards of 8,192 clustered, and of Gaussian, vectors: each finds the width it needs."""
    rng = np.random.default_rng(11)
    centres = rng.normal(size=(200, 64)) * 3
    clustered = centres[rng.integers(0, 200, 3 * 8192)] + rng.normal(size=(3 * 8192, 64))
    for data, queries in ((clustered, clustered[::200]), (rng.normal(size=(3 * 8192, 64)), rng.normal(size=(120, 64)))):
        best = np.argsort(-(queries @ data.T), axis=1)[:, :20]
        found = [[] for _ in queries]
        for s in range(3):
            part = np.ascontiguousarray(data[s * 8192:(s + 1) * 8192])
            graph, row = hnsw.build(hnsw.level(part))
            shard = (graph, part[row], row + s * 8192, np.arange(8193))
            who, own, score = hnsw._answers(shard, queries, 20, hnsw.width(graph, 0.97))
            for q, i, v in zip(who, own, score):
                found[q].append((-v, i))
        assert np.mean([len({i for _, i in sorted(f)[:20]} & set(b)) / 20 for f, b in zip(found, best.tolist())]) > 0.93


def test_a_shard_without_a_wide_enough_beam_is_searched_whole(monkeypatch):
    data = hnsw.level(np.random.default_rng(3).normal(size=(500, 16)))
    graph, row = hnsw.build(data)
    assert hnsw.width(graph, 1.1) == 500
    raw = np.random.default_rng(3).normal(size=(500, 16))[row]
    queries = np.random.default_rng(4).normal(size=(30, 16))
    who, own, _ = hnsw._answers((graph, raw, row, np.arange(501)), queries, 10, 500)
    want = np.argsort(-(queries @ raw.T), axis=1)[:, :10]
    assert sorted(zip(who, own)) == sorted((q, row[i]) for q, w in enumerate(want) for i in w)
