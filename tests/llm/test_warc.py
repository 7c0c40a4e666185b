import base64
import hashlib

import pyarrow.fs as pafs
import pytest
from pyspark.sql import functions as F

from eventloom.llm import warc
from eventloom.session import scratch_path
from tests.llm.data import ROOT


def brute(rows, min_bytes=0):
    by = {}
    for p, _, h in rows:
        by.setdefault(h or "", []).append(p)
    out = []
    for p, u, h in rows:
        raw = (h or "").encode()
        last = max((x for x in by[h or ""] if x is not None), default=None)
        other = len(raw) >= min_bytes and last is not None and p != last
        out.append((p, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), "revisit" if other else "response", last if other else None))
    return sorted(out, key=str)


def read_back(spark, pages, **options):
    path = scratch_path(spark, "warc")
    manifest = warc.write(pages, path, **options)
    return path, manifest, warc.read(spark, path, manifest)


def digest(df):
    return sorted(((None if r.page_id is None else int(r.page_id), r.payload_bytes, r.payload_digest, r.record_type,
                    None if r.refers_to is None else int(r.refers_to)) for r in df.collect()), key=str)


ROWS = [(1, "http://a/ b\r\nX: y", "<p>one</p>"), (2, None, "<p>one</p>"), (3, "u", None), (4, "u", ""), (None, "u", "<p>one</p>"), (None, "u", "alone"),
        (9, "u", "<p>one</p>"), (9, "u", "<p>one</p>"), (10, "é", "ñ" * 300000), (11, "u", "a\r\n\r\nb\r\n\r\n")]


def test_round_trip(spark):
    pages = spark.createDataFrame(ROWS, "page_id long, url string, html string").withColumns({"id": F.lit("x"), "sha1": F.lit(1), "size": F.lit(1), "payload": F.lit(2)})
    _, _, got = read_back(spark, pages, archive_bytes=1000)
    assert digest(got) == brute(ROWS)
    payloads = {r.page_id: bytes(r.payload).decode() for r in got.collect() if r.record_type == "response"}
    assert payloads["10"] == "ñ" * 300000 and payloads["11"] == "a\r\n\r\nb\r\n\r\n" and payloads["4"] == ""
    _, _, got = read_back(spark, pages, min_bytes=6)
    assert digest(got) == brute(ROWS, 6)


def test_pages(spark):
    pages = spark.read.parquet(f"{ROOT}/sf0.01/pages.parquet")
    rows = [(r.page_id, r.url, r.html) for r in pages.collect()]
    twice = pages.unionByName(pages.withColumn("page_id", F.col("page_id") + 1000))
    path, manifest, got = read_back(spark, twice, archive_bytes=200_000)
    assert digest(got) == brute(rows + [(p + 1000, u, h) for p, u, h in rows])
    assert manifest.agg(F.sum("records")).first()[0] == 2 * len(rows)
    fs, folder = warc._folder(path)
    name = manifest.first().file
    with fs.open_input_stream(f"{folder}/{name}", compression=None) as f:
        data = f.read()
    assert int.from_bytes(data[:4], "little") == 0x184D2A5D and data[8:12] == bytes.fromhex("37a430ec")
    assert len(list(warc.records_of(data))) == manifest.first().records
    with pytest.raises(Exception):
        list(warc.records_of(data[:-5]))
    # Files that the manifest does not name are not read.
    with fs.open_output_stream(f"{folder}/part-stray.warc.zst", compression=None) as f:
        f.write(b"junk")
    assert isinstance(fs, pafs.LocalFileSystem) and warc.read(spark, path, manifest).count() == 2 * len(rows)


def test_empty(spark):
    none = spark.createDataFrame([], "page_id long, url string, html string")
    _, manifest, got = read_back(spark, none)
    assert manifest.count() == 0 and got.count() == 0
