import itertools
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from eventloom.llm import line_crf as crf
from tests.llm.data import ROOT, documents_of


def test_marginals_equal_all_paths():
    rng = np.random.default_rng(0)
    size = [1, 4, 2, 1, 5]
    first = np.cumsum([0, *size])[:-1]
    u, trans = rng.normal(size=sum(size)) * 2, rng.normal(size=(2, 2))
    forward, backward = crf.chain(u, first, trans)
    for a, n in zip(first, size):
        weight = np.zeros((n, 2))
        for path in itertools.product((0, 1), repeat=n):
            s = sum(u[a + t] for t in range(n) if path[t]) + sum(trans[p, q] for p, q in zip(path, path[1:]))
            for t in range(n):
                weight[t, path[t]] += np.exp(s)
        np.testing.assert_allclose(1 / (1 + np.exp(-(forward + backward)[a:a + n])), weight[:, 1] / weight.sum(1), rtol=1e-9)


def test_lines_and_features():
    values = ["", "one line", None, "a\nb\n", "\n", "", "WORD word word\né!"]
    x, length, first = crf.line_features(pa.array(values))
    want = [(v or "").split("\n") for v in values]
    assert np.diff([*first, len(x)]).tolist() == [len(w) for w in want]
    last = {i: len(w) - 1 for i, w in enumerate(want)}
    assert length.tolist() == [len(s.encode()) + (k < last[i]) for i, w in enumerate(want) for k, s in enumerate(w)]
    row = x[first[6]]
    assert row[1] == 4 / 15 and row[8] == 2 / 3 and row[-3:].tolist() == [1, 0, 1]
    np.testing.assert_array_equal(x[first[6]][2 * crf.OWN:3 * crf.OWN], x[first[6] + 1][:crf.OWN])


def test_training_gradient_learns_structure():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(400, crf.FEATURES))
    x[:, -1] = 1
    first = np.arange(0, 400, 4)
    label = (x[first, 0] + x[first + 1, 0] > 0).astype(int)
    model = crf.fit(x, first, label)
    f, b = crf.chain(x @ model.weights, first, model.trans)
    assert (((f + b)[first] > 0) == label).mean() > 0.8


def test_held_out_accuracy(spark):
    docs, labels = documents_of(spark, "sf0.01"), spark.read.parquet(f"{ROOT}/sf0.01/labels.parquet")
    got = {r.doc_id: r for r in crf.quality(docs, labels).collect()}
    assert len(got) == 1000 and all(r.held_out == (zlib.crc32(str(d).encode()) % 4 == 2) for d, r in got.items())
    known = [(r.quality, got[r.doc_id]) for r in labels.collect() if r.doc_id in got]
    held = [(q, r) for q, r in known if r.held_out]
    assert len(held) > 50 and np.mean([q == r.predicted for q, r in held]) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in got.values())
    # Labels of held-out rows teach nothing.
    flipped = labels.withColumn("quality", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, 1 - F.col("quality")).otherwise(F.col("quality")))
    again = {r.doc_id: r.score for r in crf.quality(docs, flipped).collect()}
    assert all(abs(again[d] - r.score) < 1e-9 for d, r in got.items())


def test_odd_rows(spark):
    rows = [(1, "good text here."), (2, None), (None, "no id"), (3, ""), (1, "good text here."), (4, "x" * 200000), (5, "a\n" * 20000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"score": F.lit("x"), "quality": F.lit(3), "label": F.lit(2)})
    labels = spark.createDataFrame([(1, 1), (3, 0), (None, 1), (4, None), (5, 0), (5, 1)], "doc_id long, quality int")
    got = crf.quality(docs, labels).collect()
    assert len(got) == 7 and all(0 <= r.score <= 1 for r in got) and not [r for r in got if r.doc_id is None][0].held_out
    assert {r.score for r in crf.quality(docs, labels.limit(0)).collect()} == {0.5}
    assert crf.quality(docs.limit(0), labels).count() == 0
    kept = crf.keep_good(docs, labels)
    assert kept.columns == docs.columns and kept.count() == sum(r.predicted for r in got)
