
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from eventloom.llm import decontam, line_crf
from eventloom.llm.common import staged
from tests.llm.data import ROOT, documents_of
from tests.llm.test_decontam import words
from tests.llm.test_secrets import KINDS
from tests.llm.test_simhash import brute_components, brute_fp
from tests.llm.test_tokens import brute_bins, ids_of

SF = f"{ROOT}/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """Input and output of every stage."""
    docs, out = documents_of(spark, "sf0.001"), {}
    extra = spark.createDataFrame([(90001, "All of the text. " * 30), (90002, "All of the text. " * 30), (None, None)], "doc_id long, text string")
    docs = docs.unionByName(extra, allowMissingColumns=True)
    for name, f in corpus_pipeline.STAGES:
        after = staged(f(spark, docs, SF), "stage")
        out[name] = (docs.collect(), after.collect())
        assert name == "pack" or after.columns == docs.columns
        docs = after
    return out


def key(rows):
    return sorted(((str(r.doc_id), r.text) for r in rows), key=str)


def test_quality(spark, stages):
    before, after = stages["quality"]
    docs = spark.createDataFrame([tuple(r) for r in before], "doc_id long, text string, lang string, source string, n_chars long")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    model = line_crf.train(docs, labels, line_crf.learnable())
    import pyarrow as pa
    score = model.scores(pa.array([r.text for r in before], pa.string()))
    assert key(after) == key([r for r, s in zip(before, score) if s >= 0.7])
    assert 0 < len(after) < len(before)


def test_near_dedup(stages):
    before, after = stages["near_dedup"]
    ids = [r.doc_id for r in before]
    comp = brute_components(ids, [brute_fp(r.text) for r in before], 3)
    assert sorted(str(r.doc_id) for r in after) == sorted({str(c) for c in comp})


def test_decontaminate(spark, stages):
    before, after = stages["decontaminate"]
    items = [words(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]

    def leaks(text):
        own = words(text)
        for item in items:
            if len(set(own) & set(item)) * 2 >= len(set(item)):
                ids = {w: n for n, w in enumerate(dict.fromkeys(own + item))}
                if decontam.align(np.array([ids[w] for w in item]), np.array([ids[w] for w in own]))[0] >= len(item):
                    return True
        return False

    assert key(after) == key([r for r in before if not leaks(r.text)])


def test_mask_secrets(stages):
    before, after = stages["mask_secrets"]
    assert sorted(str(r.doc_id) for r in after) == sorted(str(r.doc_id) for r in before)
    by = {r.doc_id: r for r in after}
    for r in before:
        own = by[r.doc_id]
        found = any(ok(m) for _, p, ok in KINDS for m in p.finditer(r.text or ""))
        left = any(ok(m) for _, p, ok in KINDS for m in p.finditer(own.text or ""))
        assert not left and (own.text != r.text or not found)
        assert (own.text == r.text) or (own.n_chars == len(own.text) and "[SECRET]" in own.text)


def test_pack(stages):
    before, after = stages["pack"]
    text = {}
    for r in sorted(after, key=lambda r: (str(r.doc_id), r.piece)):
        text.setdefault(r.doc_id, []).extend(r.ids)
    assert {r.doc_id: ids_of(r.text, 2) for r in before} == text
    used = {}
    for r in after:
        used[r.sequence_id] = used.get(r.sequence_id, 0) + r.length
    assert sorted(1024 - n for n in used.values()) == brute_bins([r.length for r in after], 1024)


def test_run_equals_the_stages(spark, stages):
    got = corpus_pipeline.run(spark, SF)
    assert got.agg(F.sum("length")).first()[0] > 0 and set(got.columns) >= {"doc_id", "piece", "ids", "sequence_id", "offset"}
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_dedup", "decontaminate", "mask_secrets", "pack"]
