import random
import re

import numpy as np
from pyspark.sql import functions as F

from eventloom.llm import decontam
from tests.llm.data import ROOT, documents_of

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall((text or "").lower())


def smith_waterman(item, text):
    """The textbook table, row by row."""
    best, above = 0, [0] * (len(text) + 1)
    for a in item:
        row = [0]
        for j, b in enumerate(text):
            row.append(max(0, above[j] + (2 if a == b else -1), above[j + 1] - 1, row[j] - 1))
        best = max(best, *row)
        above = row
    return best


def test_alignment_is_smith_waterman():
    rng = np.random.default_rng(4)
    for _ in range(60):
        a, b = rng.integers(0, 5, rng.integers(1, 12)), rng.integers(0, 5, rng.integers(1, 30))
        score, end = decontam.align(a, b)
        assert score == smith_waterman(a.tolist(), b.tolist())
        assert score == decontam.align(a, b[:end])[0]


def test_documents_equal_brute_force(spark):
    docs, bench = documents_of(spark, "sf0.001"), spark.read.parquet(f"{ROOT}/sf0.001/benchmark.parquet")
    items = {r.item_id: words(r.text) for r in bench.collect()}
    want = set()
    for r in docs.collect():
        own = words(r.text)
        for k, item in items.items():
            if len(set(own) & set(item)) * 2 >= len(set(item)):
                ids = {w: n for n, w in enumerate(dict.fromkeys(own + item))}
                score, _ = decontam.align(np.array([ids[w] for w in item]), np.array([ids[w] for w in own]))
                if score >= len(item):
                    want.add((r.doc_id, k))
    got = decontam.contaminated(docs, bench).collect()
    assert want and {(r.doc_id, r.item_id) for r in got} == want and len(got) == len(want)


def test_edited_copies_hot_passages_and_odd_rows(spark):
    rng = random.Random(9)
    vocabulary = ["w%d" % i for i in range(400)]
    prose = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    items = {i: prose(30) for i in range(6)}
    rows, want = [], set()
    for i in range(300):
        rows.append((i, " ".join(prose(120))))
    for i in range(300, 500):  # the same passage in 40 % of the documents
        rows.append((i, " ".join(prose(40) + items[0] + prose(40))))
        want.add((i, 0))
    for i in range(500, 520):
        k = rng.randint(1, 5)
        edited = [w for j, w in enumerate(items[k]) for w in ([] if j % 9 == 4 else ["new"] if j % 7 == 3 else [w])]
        rows.append((i, ", ".join(prose(10) + [w.upper() for w in edited] + prose(700))))
        want.add((i, k))
    rows += [(600, None), (601, ""), (None, " ".join(items[3])), (602, " ".join(items[4])), (602, " ".join(items[4]))]
    want |= {(None, 3), (602, 4)}
    bench = spark.createDataFrame([(k, " ".join(v)) for k, v in items.items()] + [(90, None), (91, ""), (92, "w1 w2"), (None, "zz yy xx")], "item_id long, text string")
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"seeds": F.lit(1), "item_id": F.lit("x"), "id": F.lit(2)})
    got = decontam.contaminated(docs, bench).collect()
    assert sorted(((r.doc_id, r.item_id) for r in got), key=str) == sorted(want, key=str)
    at = {r.doc_id: (r.first_word, r.last_word, r.similarity) for r in got}
    assert all(at[i] == (40, 69, 1.0) for i in range(300, 500))
    kept = decontam.without_leaks(docs, bench).collect()
    assert sorted((r.doc_id for r in kept), key=str) == sorted([*range(300), 600, 601], key=str) and kept[0].seeds == 1
    none = docs.limit(0)
    assert decontam.contaminated(none, bench).count() == 0 and decontam.without_leaks(none, bench).count() == 0
    assert decontam.contaminated(docs, bench.limit(0)).count() == 0
    assert decontam.without_leaks(docs, bench.limit(0)).count() == len(rows)


def test_a_long_part_of_a_long_item(spark):
    """450 words of an item of 1,000: less than half of it, and a leak."""
    rng = random.Random(12)
    item = [f"z{rng.randrange(10**5)}" for _ in range(1000)]
    prose = lambda n: [f"y{rng.randrange(10**5)}" for _ in range(n)]
    edited = [w if i % 8 else "other" for i, w in enumerate(item[600:700])]
    rows = [(1, prose(50) + item[100:550] + prose(50)), (2, prose(80)), (3, prose(40) + edited + prose(9)),
            (4, prose(40) + item[700:720] + prose(40)), (5, [w for p in zip(item[:60], prose(60)) for w in p])]
    docs = spark.createDataFrame([(i, " ".join(w)) for i, w in rows], "doc_id long, text string")
    bench = spark.createDataFrame([(9, " ".join(item))], "item_id long, text string")
    found = {r.doc_id: r for r in decontam.contaminated(docs, bench).collect()}
    assert set(found) == {1, 3} and (found[1].first_word, found[1].last_word) == (50, 499)
    assert [r.doc_id for r in decontam.without_leaks(docs, bench).orderBy("doc_id").collect()] == [2, 4, 5]
