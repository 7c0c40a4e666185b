import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from eventloom.llm import langid
from tests.llm.data import documents_of


def brute_grams(text, max_n):
    t = " " + "".join(c if c.isalpha() else " " for c in text) + " " * max_n
    return Counter(t[i:i + n] for n in range(1, max_n + 1) for i in range(len(t) - n + 1)
                   if t[i].isalpha() or (n > 1 and t[i + 1:i + 2].isalpha()))


def test_buckets_are_functions_of_the_grams():
    values = ["der Hund!", "", "12 34", "ñé", "a", "der hund, der"]
    grams, borders, some = langid.buckets(values, 3, 14)
    assert some.tolist() == [True, False, False, True, True, True]
    alone = {}
    for i, v in enumerate(values):
        own = np.concatenate([g[b[i]:b[i + 1]] for g, b in zip(grams, borders)])
        assert len(own) == sum(brute_grams(v, 3).values())
        single, _, _ = langid.buckets([v], 3, 14)
        np.testing.assert_array_equal(np.sort(own), np.sort(np.concatenate(single)))
        alone[v] = Counter(own.tolist())
    assert not alone["a"] - (alone["a"] | Counter())


def test_model_is_naive_bayes(spark):
    rows = [(i, t, la) for i, (t, la) in enumerate([("aab", "x"), ("abb", "x"), ("bcc", "y"), ("ccc b", "y"), ("zzz", None)])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.train(docs, F.lit(True), max_n=2, bits=14, smoothing=0.5)
    assert model.languages == ["x", "y"]
    count = {la: Counter() for la in "xy"}
    for _, t, la in rows:
        if la:
            for g, b in zip(*langid.buckets([t], 2, 14)[:2]):
                count[la].update(g.tolist())
    for value in ("ab", "cb c", "aab"):
        own = np.concatenate(langid.buckets([value], 2, 14)[0])
        log = {la: np.log(0.5) + sum(np.log((c[b] + 0.5) / (sum(c.values()) + 0.5 * 2**14)) for b in own) for la, c in count.items()}
        (name,), (score,) = model.predict([value])
        assert name == max(log, key=log.get)
        np.testing.assert_allclose(score, np.exp(max(log.values())) / sum(map(np.exp, log.values())), rtol=1e-4)


def test_held_out_accuracy(spark):
    docs = documents_of(spark, "sf0.01")
    got = {r.doc_id: r for r in langid.identify(docs).collect()}
    lang = {r.doc_id: r.lang for r in docs.collect()}
    assert len(got) == 1000 and all(r.held_out == (zlib.crc32(str(d).encode()) % 4 == 2) for d, r in got.items())
    held = [(lang[d], r.lang_pred) for d, r in got.items() if r.held_out]
    assert np.mean([a == b for a, b in held]) > 0.95
    wrong = docs.withColumn("lang", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, "xx").otherwise(F.col("lang")))
    assert {r.doc_id: r.lang_pred for r in langid.identify(wrong).collect()} == {d: r.lang_pred for d, r in got.items()}


def test_odd_rows(spark):
    rows = [(1, None, "en"), (2, "", "en"), (3, "123 !?", "de"), (None, "hello there", "de"), (4, "hello there", None), (5, "hello", "en"), (5, "hello", "en"), (6, "x" * 100000, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumns({"score": F.lit("a"), "id": F.lit(1), "held_out": F.lit(2)})
    got = {r.doc_id: r for r in langid.identify(docs).collect()}
    assert [got[i].lang_pred for i in (1, 2, 3)] == ["und"] * 3 and got[1].score == 0
    assert not got[None].held_out and got[4].lang_pred in ("en", "de", "")
    assert {r.lang_pred for r in langid.identify(docs.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}
    assert langid.identify(docs.limit(0)).count() == 0
