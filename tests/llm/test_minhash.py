import random
import re

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from eventloom.llm import minhash, queries
from eventloom.llm.oracle import ORACLE
from tests.llm.data import ROOT


def brute_set(text, shingle=4):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    return {" ".join(w[i:i + shingle]) for i in range(len(w) - shingle + 1)} or ({" ".join(w)} if w else set())


def brute(rows, percent=80):
    sets = [brute_set(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= percent * len(a | sets[j]):
                root[find(i)] = find(j)
    ids = {}
    for i, (d, _) in enumerate(rows):
        ids.setdefault(find(i), []).append(d)
    out = []
    for i, (d, _) in enumerate(rows):
        own = d if not sets[i] else min((x for x in ids[find(i)] if x is not None), default=None)
        out.append((d, len(sets[i]), own, own == d))
    return sorted(out, key=str)


def result(df):
    return sorted([(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in df.collect()], key=str)


def near_copies(rng, n, words=60, edits=(0, 9)):
    """Copies of one text with a few words changed: similarities on both sides of the threshold."""
    base = [f"w{rng.randrange(10**6)}" for _ in range(words)]
    out = []
    for _ in range(n):
        copy = list(base)
        for _ in range(rng.randint(*edits)):
            copy[rng.randrange(words)] = f"x{rng.randrange(10**6)}"
        out.append(" ".join(copy))
    return out


def test_documents_equal_brute_force_and_sql(spark):
    sf_dir = f"{ROOT}/sf0.001"
    got = result(queries.op12_minhash_near_dedup(spark, sf_dir))
    assert got == brute([(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()])
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{sf_dir}/documents.parquet'")
    assert got == sorted(con.execute(
        f"select doc_id, n_shingles, component_id, kept from ({ORACLE['op12_minhash_near_dedup']})").fetchall(), key=str)


@pytest.mark.parametrize("block", [400, 7])
def test_near_copies_lose_no_link(spark, monkeypatch, block):
    """A third of all rows are near copies of one text, in buckets of many blocks."""
    monkeypatch.setattr(minhash, "BLOCK", block)
    rng = random.Random(block)
    texts = near_copies(rng, 120) + near_copies(rng, 60, edits=(3, 5)) + [" ".join(f"u{rng.randrange(10**6)}" for _ in range(50)) for _ in range(150)]
    rng.shuffle(texts)
    rows = [(i, t) for i, t in enumerate(texts + texts[:30])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert result(minhash.near_duplicates(docs)) == brute(rows)


def test_links_are_a_forest(spark, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK", 10)
    texts = near_copies(random.Random(1), 100, words=400, edits=(0, 3))
    sets = [minhash.sets_of(spark_array([t]), 4).__next__() for t in texts]
    found = minhash.joining(np.arange(100), sets, 80, np.arange(100), np.arange(100), np.arange(100))
    assert len(found) == 99


def spark_array(values):
    import pyarrow as pa

    return pa.array(values, pa.string())


def test_signature_estimates_similarity():
    rng = np.random.default_rng(5)
    turns = 2048
    slices = np.lib.stride_tricks.sliding_window_view(minhash.ranks(turns), turns)
    table = minhash.ranks(0)
    assert np.array_equal(np.sort(table), np.arange(minhash.CIRCLE))
    for share in (0.2, 0.5, 0.8):
        both = rng.integers(0, 2**63, 4000, dtype=np.uint64)
        k = int(4000 * share)
        own = (4000 - k) // 2
        a, b = both[:k + own], np.concatenate([both[:k], both[k + own:k + 2 * own]])
        x, y = minhash.signature(np.sort(a), slices), minhash.signature(np.sort(b), slices)
        assert abs((x == y).mean() - share) < 0.06
    one = minhash.signature(both, slices)
    at = minhash.places(both)
    assert all(one[t] == table[(at + t) % minhash.CIRCLE].min() for t in (0, 1, 77, turns - 1))


def test_defined_cases(spark):
    long = " ".join(f"l{i}" for i in range(40_000))
    rows = [(5, None), (6, ""), (7, "\t\n"), (8, "One  two"), (3, "one\x0btwo"), (9, "one two three four"), (9, "one two three four"),
            (None, "null id text here now"), (4, "Null id TEXT here now"), (None, "alone among its kind so far"), (10, long), (11, long.upper()),
            (12, long + " end"), (2, "É é one"), (1, "é É one"), (1, "b\x00 c d e"), (13, "one two one two one two one two")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"id": F.lit("x"), "node": F.lit(1), "digest": F.lit(2)})
    assert result(minhash.near_duplicates(docs)) == brute(rows)
    assert minhash.near_duplicates(docs.limit(0)).count() == 0
