"""Texts that hold the tokenizer's added token, against an untouched tokenizer."""

import random

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from eventloom.llm import bpe, queries
from tests.llm.test_tokens import ODD, crc

PATH = public_tokenizers.path("byte_bpe_50k.json")
PLAIN = Tokenizer.from_file(PATH)
MARK = "<|endoftext|>"
TEXTS = ["a<|endoftext|>b", MARK, MARK * 3, f" {MARK} ", f"a \n{MARK}\n b", f"<|endoftext|{MARK}|>", "<|endoftext |>", f"end.{MARK}Next", *ODD]


def want(text):
    return PLAIN.encode(text, add_special_tokens=False).ids


def test_added_tokens_get_their_id():
    assert want("a<|endoftext|>b") == [64, 50256, 65]
    rng = random.Random(3)
    mixed = ["".join(rng.choices([MARK, "a", " ", "\n", "<|", "|>", "é", "endoftext", "9."], k=12)) for _ in range(500)]
    one = bpe.WordBpe(PATH, max_words=30, added_tokens=True)
    for texts in (TEXTS, mixed, TEXTS):
        ids, size = one.encode(texts)
        assert [x.tolist() for x in np.split(ids, np.cumsum(size)[:-1])] == [want(t) for t in texts]


def test_queries_follow_the_library(spark, tmp_path):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    start = 0
    for r in sorted(queries.op1_token_files(spark, str(tmp_path)).collect(), key=lambda r: r.doc_id):
        ids = [*want(TEXTS[r.doc_id]), 0]
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), crc(ids))
        start += len(ids)
    for r in queries.op9_best_fit_packing(spark, str(tmp_path)).where("piece = 0 and start = 0").collect():
        ids = [*want(TEXTS[r.doc_id]), 2]
        assert len(ids) > 1024 or (r.length, r.ids_crc32) == (len(ids), crc(ids))
