"""Inputs for the tests of the corpus operators."""

ROOT = "/root/testdata"


def documents_of(spark, scale):
    return spark.read.parquet(f"{ROOT}/{scale}/documents.parquet")
