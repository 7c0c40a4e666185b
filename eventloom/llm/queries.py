"""Registered queries of this subpackage: (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventloom.llm import (
    alignment, decontam, hnsw, langid, licenses, line_crf, minhash, packing, secrets, simhash, spelling, token_files, warc)
from eventloom.session import scratch_path

#: The installed public vocabularies; every operator takes their paths as parameters.
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
PIECE_TOKENIZER = public_tokenizers.path("piece_bpe_32k.model")

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token-files")
    token_files.write(table(spark, sf_dir, "documents"), path, TOKENIZER, added_tokens=True)
    return token_files.with_crc32(token_files.read(spark, path)).select(
        "doc_id", "start", "n_tokens", "ids_crc32")


def op2_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_warc_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    path = scratch_path(spark, "warc")
    records = warc.read(spark, path, warc.write(pages, path), with_payload=False)
    kind = pages.schema["page_id"].dataType
    return records.select(F.col("page_id").cast(kind).alias("page_id"), "payload_bytes", "payload_digest", "record_type",
                          F.col("refers_to").cast(kind).alias("refers_to"))


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_crf.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"))


def op6_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hnsw.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


def op7_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op8_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), TOKENIZER, added_tokens=True).drop("ids")


def op10_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest(secrets.scan(table(spark, sf_dir, "documents")))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))


def op12_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


def op13_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.alignments(table(spark, sf_dir, "documents"), TOKENIZER, PIECE_TOKENIZER)


QUERIES: dict[str, Query] = {
    "op1_token_files": op1_token_files,
    "op2_benchmark_decontamination": op2_benchmark_decontamination,
    "op3_warc_archives": op3_warc_archives,
    "op4_quality_classifier": op4_quality_classifier,
    "op5_language_id": op5_language_id,
    "op6_nearest_neighbours": op6_nearest_neighbours,
    "op7_license_scans": op7_license_scans,
    "op8_simhash_near_dedup": op8_simhash_near_dedup,
    "op9_best_fit_packing": op9_best_fit_packing,
    "op10_secret_scans": op10_secret_scans,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_minhash_near_dedup": op12_minhash_near_dedup,
    "op13_tokenizer_alignment": op13_tokenizer_alignment,
}
