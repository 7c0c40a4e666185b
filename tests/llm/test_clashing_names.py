"""Stages keep columns that bear the names of their own helpers."""

import pytest
from pyspark.sql import functions as F

from eventloom.llm import decontam, line_crf, secrets, simhash
from tests.llm.data import ROOT, documents_of

NAMES = ["__row", "__ROW_", "__fp", "__key", "__score", "__hits", "__spans", "__last", "__clean", "root", "fp", "score"]


@pytest.fixture(scope="module")
def docs(spark):
    return documents_of(spark, "sf0.001").withColumns({n: F.concat(F.lit(n), F.col("doc_id")) for n in NAMES})


@pytest.mark.parametrize("stage", ["quality", "near_dedup", "decontaminate", "mask_secrets"])
def test_columns_stay(spark, docs, stage):
    table = lambda n: spark.read.parquet(f"{ROOT}/sf0.001/{n}.parquet")
    out = {"quality": lambda: line_crf.keep_good(docs, table("labels")), "near_dedup": lambda: simhash.keep_one(docs),
           "decontaminate": lambda: decontam.without_leaks(docs, table("benchmark")), "mask_secrets": lambda: secrets.redact(docs)}[stage]()
    assert out.columns == docs.columns
    rows = out.collect()
    assert rows and all(r[n] == f"{n}{r.doc_id}" for r in rows for n in NAMES)
