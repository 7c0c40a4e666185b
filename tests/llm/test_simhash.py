import re

import numpy as np
import xxhash
from pyspark.sql import functions as F

from eventloom.llm import components as cc
from eventloom.llm import simhash
from tests.llm.data import documents_of


def brute_fp(text):
    t = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in (text or ""))
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    if not w:
        return 0
    s = [" ".join(w[i:i + 3]) for i in range(len(w) - 2)] or [" ".join(w)]
    h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in s]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(ids, fps, radius):
    arr = np.array(fps, dtype=np.uint64)
    root = list(range(len(fps)))

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for i in range(len(fps)):
        for j in np.flatnonzero(np.bitwise_count(arr ^ arr[i]) <= radius):
            a, b = find(i), find(int(j))
            root[max(a, b)] = min(a, b)
    least = {}
    for i, d in enumerate(ids):
        least.setdefault(find(i), []).append(d)
    return [min((x for x in least[find(i)] if x is not None), default=None) for i in range(len(ids))]


def check(rows, got, radius=3):
    fps = [brute_fp(t) for _, t in rows]
    want = brute_components([d for d, _ in rows], fps, radius)
    key = lambda x: (x[0] is None, x[0] or 0, *map(str, x))
    assert sorted([(d, f"{f:016x}", c) for (d, _), f, c in zip(rows, fps, want)], key=key) == \
        sorted([(r.doc_id, r.fingerprint, r.component_id) for r in got], key=key)


def test_documents_equal_brute_force(spark):
    docs = documents_of(spark, "sf0.01")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    check(rows, simhash.near_duplicates(docs).collect())


def test_defined_cases(spark):
    long = "word " * 30000 + "end"
    rows = [(5, None), (6, ""), (7, "\t\n"), (8, "One"), (3, "one"), (9, "one two"), (9, "one two"),
            (None, "null id text here now"), (10, long), (11, long.upper()), (None, None), (12, "é É Ñ x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("fp", F.lit("x")).withColumn("root", F.lit(1))
    check(rows, simhash.near_duplicates(docs).collect())
    kept = simhash.keep_one(docs).collect()
    assert sorted((r.doc_id for r in kept), key=str) == sorted([5, 3, 9, None, 10, 12], key=str)
    assert kept[0].fp == "x"
    assert simhash.near_duplicates(docs.limit(0)).count() == 0 and simhash.keep_one(docs.limit(0)).count() == 0


def test_crowded_files_lose_no_link(spark, monkeypatch):
    """A third of all fingerprints share all but a few bits; sub-blocks are compared pairwise."""
    rng = np.random.default_rng(3)
    base = rng.integers(0, 2**63, dtype=np.uint64)
    crowd = {int(base) ^ int(sum(1 << int(b) for b in rng.choice(20, rng.integers(1, 6), replace=False))) for _ in range(300)}
    fps = list(crowd | {int(x) for x in rng.integers(0, 2**63, 600, dtype=np.uint64)})
    monkeypatch.setattr(simhash, "TILE", 40)
    df = spark.createDataFrame([(f,) for f in fps], "fp long")
    roots = {r.node: r.root for r in cc.components(simhash.links(df, 3)).collect()}
    want = brute_components(fps, fps, 3)
    assert [roots.get(f, f) for f in fps] == want
    assert simhash.links(df, 3).count() < 40 * len(fps)


def test_bit_sliced_distances():
    rng = np.random.default_rng(1)
    a = rng.integers(0, 2**63, 70, dtype=np.uint64)
    b = np.concatenate([a ^ np.uint64(5), a ^ np.uint64(0b1111 << 40), rng.integers(0, 2**63, 61, dtype=np.uint64)])
    for radius in (0, 1, 2, 3, 4, 7):
        got = {(q, int(x)) for q, f in simhash.near_lanes(a, b, radius) for x in f}
        dist = np.bitwise_count(a[:, None] ^ b[None, :])
        assert got == {(int(i), int(j)) for i, j in zip(*np.where(dist <= radius))}


def test_components_of_a_path_and_a_hub(spark):
    path = [(i, i + 1) for i in range(60)]
    hub = [(1000, 2000 + i) for i in range(200)]
    got = {r.node: r.root for r in cc.components(spark.createDataFrame(path + hub + [(7, 7)], "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(1, 61)}, **{2000 + i: 1000 for i in range(200)}}
