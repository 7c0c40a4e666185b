import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from eventloom.llm import bpe, packing, token_files
from eventloom.session import scratch_path
from tests.llm.data import documents_of

PATH = public_tokenizers.path("byte_bpe_50k.json")
TOK = Tokenizer.from_file(PATH)
TOK.encode_special_tokens = True


def ids_of(text, end):
    return TOK.encode(text or "", add_special_tokens=False).ids + [end]


def crc(ids):
    return zlib.crc32(np.array(ids, dtype="<u4").tobytes())


ODD = ["", " ", "\n", "a  b", "a \n b", "\n\nx", "x\n", " x ", "it's don't I'LL we've", "foo.bar,baz!!! (x) ***",
       "Ñandú,é.x ²³x½ naïve9", "\x1c\x1dA\x85B C　 D", "<|endoftext|> x", "日本語。テスト", "é" * 300, "é.á x",
       "﻿word ​word", "a\tb\t\tc", "12,345.67 $5%", "x" * 3000]


def test_pieces_give_the_librarys_ids():
    one = bpe.WordBpe(PATH, max_words=30)
    for _ in range(2):
        ids, size = one.encode(ODD)
        assert np.split(ids, np.cumsum(size)[:-1])[0].tolist() == []
        assert [x.tolist() for x in np.split(ids, np.cumsum(size)[:-1])] == [TOK.encode(t, add_special_tokens=False).ids for t in ODD]
    assert [len(x) for x in one.encode([])] == [0, 0]


ONE = bpe.WordBpe(PATH)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from("ab Zé'st\n\t\r.,!9² \x1c_日́|*"), max_size=30), max_size=4))
def test_any_text(values):
    ids, size = ONE.encode(values)
    got, at = [], 0
    for n in size.tolist():
        got.append(ids[at:at + n].tolist())
        at += n
    assert got == [TOK.encode(t, add_special_tokens=False).ids for t in values]


@pytest.fixture(scope="module")
def rows():
    return [(i, t) for i, t in enumerate(ODD)] + [(None, "null id"), (3, None), (3, None), (500, "word " * 5000), (7, "again")]


def test_token_files_round_trip(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"first": F.lit("x"), "tokens": F.lit(1)}).repartition(3)
    path = scratch_path(spark, "tokens")
    token_files.write(docs, path, PATH)
    got = sorted(token_files.read(spark, path).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == sorted((d for d, _ in rows), key=lambda d: -1 if d is None else d)
    assert sorted((str(r.doc_id), list(r.tokens)) for r in got) == sorted((str(d), ids_of(t, 0)) for d, t in rows)
    assert [r.start for r in got] == np.cumsum([0] + [r.n_tokens for r in got])[:-1].tolist()
    some = token_files.read(spark, path, F.col("doc_id") == 500).collect()
    assert [(r.doc_id, r.start) for r in some] == [(r.doc_id, r.start) for r in got if r.doc_id == 500]
    for r in token_files.with_crc32(token_files.read(spark, path)).collect():
        assert r.ids_crc32 in {crc(ids_of(t, 0)) for d, t in rows if d == r.doc_id}


def test_token_files_layout(spark):
    path = scratch_path(spark, "tokens")
    token_files.write(documents_of(spark, "sf0.01"), path, PATH, row_group_bytes=64 << 10, page_bytes=8 << 10, page_rows=50)
    local = path.removeprefix("file:")
    meta = pq.ParquetDataset(local).fragments[0].metadata
    assert meta.num_row_groups > 1
    columns = {meta.row_group(0).column(c).path_in_schema: meta.row_group(0).column(c) for c in range(meta.num_columns)}
    tokens = next(v for k, v in columns.items() if k.startswith("tokens"))
    assert any("DICTIONARY" in e for e in tokens.encodings) and "DELTA_BINARY_PACKED" in columns["doc_id"].encodings
    assert tokens.has_offset_index and columns["doc_id"].has_column_index
    plan = token_files.read(spark, path).select("doc_id", "start")._jdf.queryExecution().executedPlan().toString()
    assert "tokens:array" not in plan


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    path = scratch_path(spark, "tokens")
    token_files.write(none, path, PATH)
    assert token_files.with_crc32(token_files.read(spark, path)).count() == 0
    assert packing.pack(none, PATH).count() == 0


def brute_bins(lengths, capacity):
    """Best-fit decreasing one piece at a time: number of bins left with each remaining room."""
    room = []
    for n in sorted(lengths, reverse=True):
        fit = [i for i, r in enumerate(room) if r >= n]
        if fit:
            room[min(fit, key=lambda i: room[i])] -= n
        else:
            room.append(capacity - n)
    return sorted(room)


def test_plan_is_best_fit_decreasing():
    rng = random.Random(2)
    for trial in range(120):
        capacity = rng.choice([5, 16, 40, 100])
        lengths = [rng.randint(1, capacity) if trial % 2 else min(capacity, 1 + int(rng.expovariate(4 / capacity))) for _ in range(rng.randint(0, 200))]
        counts = {n: lengths.count(n) for n in set(lengths)}
        used, seen = {}, {n: 0 for n in counts}
        for n, lo, hi, each, first, offset in packing.plan(counts, capacity):
            assert lo == seen[n]
            seen[n] = hi
            for r in range(lo, hi):
                used.setdefault(first + (r - lo) // each, []).append((offset + (r - lo) % each * n, n))
        assert seen == counts
        for parts in used.values():
            at = 0
            for o, n in sorted(parts):
                assert o == at
                at += n
            assert at <= capacity
        assert sorted(capacity - sum(n for _, n in p) for p in used.values()) == brute_bins(lengths, capacity)


def test_packing_documents(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"rank": F.lit("x"), "length": F.lit(1)}).repartition(4)
    packed = packing.pack(docs, PATH, capacity=64)
    got = packed.collect()
    by_doc = {}
    for r in got:
        assert r.length == len(r.ids) <= 64 and r.ids_crc32 == crc(r.ids)
        by_doc.setdefault((r.doc_id, r.piece), []).append(r)
    want = {}
    for d, t in rows:
        ids = ids_of(t, 2)
        head = len(ids) - (-(-len(ids) // 64) - 1) * 64
        for k, s in enumerate([0, *range(head, len(ids), 64)]):
            want.setdefault((d, k), []).append((s, ids[s:head if k == 0 else s + 64]))
    assert {k: sorted((r.start, list(r.ids)) for r in v) for k, v in by_doc.items()} == {k: sorted(v) for k, v in want.items()}
    lengths = [r.length for r in got]
    assert sorted(64 - len(r.ids) for r in packing.sequences(packed).collect()) == brute_bins(lengths, 64)
    where = sorted((r.sequence_id, r.offset, r.length) for r in got)
    for a, b in zip(where, where[1:]):
        assert b[1] == (a[1] + a[2] if a[0] == b[0] else 0)
