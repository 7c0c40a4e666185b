import random
import re
import zlib
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

from eventloom.llm import queries, spelling
from eventloom.llm.oracle import ORACLE
from tests.llm.data import ROOT


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute_words(rows, drawn=199, min_chars=6, min_n=5):
    n = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            at = h % len(run)
            n[run[:at] + run[at + 1:] if h % drawn == 0 else run] += 1
    return {w: k for w, k in n.items() if len(w) >= min_chars and k >= min_n}


def brute_forms(words, ratio=5):
    near = {w: [v for v in words if one_edit(w, v)] for w in words}
    form = {}
    for w, vs in near.items():
        best = min(vs, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= ratio * words[w] else None
    out = set()
    for w in words:
        root = w
        while form[root] is not None:
            root = form[root]
        out.add((w, form[w], root, words[w], len(near[w]), words.get(form[w])))
    return out


def as_set(df):
    rows = [(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


@pytest.mark.parametrize("seed", range(3))
def test_neighbours_equal_every_pair(spark, seed):
    """Short words of few letters: runs of equal letters, and every kind of edit."""
    rng = random.Random(seed)
    words = sorted({"".join(rng.choices("abé", k=rng.randint(1, 6))) for _ in range(250)})
    df = spark.createDataFrame([(w, rng.randint(1, 9)) for w in words], "word string, n long")
    n = dict(df.collect())
    got = sorted((r.word, r.n, r.near, r.near_n) for r in spelling.neighbours(df).collect())
    assert got == sorted((a, n[a], b, n[b]) for a in words for b in words if one_edit(a, b))
    best = {r.word: (r.n_near, r.best.word) for r in spelling.nearest(df).collect()}
    want = {a: [b for b in words if one_edit(a, b)] for a in words}
    assert best == {a: (len(v), min(v, key=lambda b: (-n[b], b))) for a, v in want.items() if v}


def test_documents_equal_brute_force_and_sql(spark):
    sf_dir = f"{ROOT}/sf0.001"
    got = as_set(queries.op11_spelling_variants(spark, sf_dir))
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    assert got == brute_forms(brute_words(rows))
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{sf_dir}/documents.parquet'")
    assert got == {tuple(None if v != v else v for v in r) for r in con.execute(
        f"select word, form, root, n, n_near, form_n from ({ORACLE['op11_spelling_variants']})").fetchall()}


def test_defined_cases(spark, monkeypatch):
    monkeypatch.setattr(spelling, "HELD", 3)
    chain = ["aaaaaa"] * 3000 + ["aaaaab"] * 500 + ["aaaabb"] * 80 + ["aaabbb"] * 15 + ["ÀÉÎÕ×÷ÿ"] * 9 + ["àaaaaa"] * 7
    rows = [(1, None), (2, ""), (None, "Résumé RÉsumé " * 5), (3, "9_9"), (4, " ".join(chain)), (4, "Again' again" * 5), (4, "Again' again" * 5),
            (5, "z" * 200_000 + " " + "zzzzzz " * 5), (6, "short five5 seven77\n" * 9)]
    docs = (spark.createDataFrame(rows, "doc_id long, text string").withColumns({"word": F.lit("w"), "n": F.lit(1), "id": F.lit("x")}).repartition(3))
    for drawn in (199, 3, 1):
        got = as_set(spelling.variants(docs, drawn=drawn))
        assert got == brute_forms(brute_words(rows, drawn))
    roots = {w: root for w, _, root, *_ in as_set(spelling.variants(docs, drawn=10**12))}
    assert roots["aaabbb"] == "aaaaaa"
    assert spelling.variants(docs.limit(0)).collect() == []
    with pytest.raises(ValueError):
        spelling.variants(docs, ratio=1)
