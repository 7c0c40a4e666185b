"""WARC archives, compressed record by record with a dictionary of their own.

Each archive is a file of Zstandard frames.  The first is a skippable frame
that holds the dictionary, built from records of that archive; every record
follows as a frame of its own, so that a reader can start at any record once
it has the dictionary.

A task fills archives of ``archive_bytes`` of records one after the other, so it
holds one archive and no more.  Archive names carry the task attempt; the
manifest, a table that Spark commits, names the files that count, and files of
failed attempts are never read.

Of pages with equal payloads of at least ``min_bytes`` the one with the largest id
is a response with its payload, the others are revisits that refer to it.

Defined cases: NULL html is an empty payload; a NULL url writes no target;
NULL ids refer to the largest id of their payload and are responses if there
is none; rows repeated under the largest id are all responses; other columns
are not looked at; an empty table writes no archive.
"""

from __future__ import annotations

import base64
import hashlib
import io
import re
from collections.abc import Iterator
from datetime import datetime, timezone

import pyarrow as pa
import pyarrow.fs as pafs
import zstandard as zstd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventloom.llm.common import documents, runs, staged

#: Skippable frame that announces a dictionary (fixed value of the public format).
DICTIONARY_MAGIC = 0x184D2A5D
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
WINDOW = 16 << 10
#: Long records train the dictionary in parts of this many bytes, all of them.
TRAINED = 128 << 10


def with_reference(pages: DataFrame, min_bytes: int, id_col: str, url_col: str, html_col: str) -> DataFrame:
    """(id, url, payload, sha1, size, refers_to): refers_to is set for revisits."""
    rows = documents(pages, id_col, url_col, html_col).select(
        F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.coalesce(html_col, F.lit("")).alias("payload"))
    rows = rows.withColumns({"sha1": F.sha1("payload"), "size": F.octet_length("payload").cast("long")})
    kept = (rows.where(F.col("size") >= min_bytes).groupBy("sha1").agg(F.max("id").alias("last")))
    other = (F.col("size") >= min_bytes) & F.col("last").isNotNull() & ~F.col("id").eqNullSafe(F.col("last"))
    return rows.join(kept, "sha1", "left").withColumn("refers_to", F.when(other, F.col("last"))).drop("last")


def record(page_id: str, url: str | None, payload: bytes, sha1: str, size: int, refers_to: str | None, date: str) -> bytes:
    """One WARC/1.1 record; a revisit keeps the HTTP head and leaves the payload out."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % size
    block = http if refers_to is not None else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: <urn:page:{page_id}>", f"WARC-Date: {date}"]
    if url is not None:
        head.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url))
    head.append("WARC-Payload-Digest: sha1:" + base64.b32encode(bytes.fromhex(sha1)).decode())
    if refers_to is not None:
        head += [f"WARC-Refers-To: <urn:page:{refers_to}>", f"WARC-Profile: {PROFILE}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(head).encode() + block + b"\r\n\r\n"


def dictionary(records: list[bytes], size: int) -> zstd.ZstdCompressionDict:
    """Trained on records spread evenly over the archive, up to 50 times its size."""
    total = sum(map(len, records))
    step = max(1, -(-total // (50 * size)))
    try:
        parts = [r[at:at + TRAINED] for r in records[::step] for at in range(0, len(r), TRAINED)]
        return zstd.train_dictionary(size, parts, k=1024, d=8)
    except zstd.ZstdError:  # too little to train on
        return zstd.ZstdCompressionDict(b"".join(records)[-size:] or b"WARC/1.1\r\n", dict_type=zstd.DICT_TYPE_RAWCONTENT)


def archive(records: list[bytes], dict_size: int, level: int) -> bytes:
    own = dictionary(records, dict_size)
    raw = own.as_bytes()
    pack = zstd.ZstdCompressor(level=level, dict_data=own, write_checksum=True)
    out = io.BytesIO()
    out.write(DICTIONARY_MAGIC.to_bytes(4, "little") + len(raw).to_bytes(4, "little") + raw)
    for r in records:
        out.write(pack.compress(r))
    return out.getvalue()


def records_of(data: bytes) -> Iterator[bytes]:
    """The records of an archive, in order."""
    if int.from_bytes(data[:4], "little") != DICTIONARY_MAGIC:
        raise ValueError("the archive does not begin with a dictionary frame")
    at = 8 + int.from_bytes(data[4:8], "little")
    unpack, view = zstd.ZstdDecompressor(dict_data=zstd.ZstdCompressionDict(data[8:at])), memoryview(data)
    while at < len(data):
        frame, parts = unpack.decompressobj(), []
        while not frame.eof:
            if at >= len(data):
                raise ValueError("the archive ends within a record")
            window = view[at:at + WINDOW]
            parts.append(frame.decompress(window))
            at += len(window) - len(frame.unused_data)
        yield b"".join(parts)


def _folder(path: str) -> tuple[pafs.FileSystem, str]:
    if path.startswith("file:"):
        path = "file:///" + path[5:].lstrip("/")
    return pafs.FileSystem.from_uri(path) if "://" in path else (pafs.LocalFileSystem(), path)


def write(pages: DataFrame, path: str, min_bytes: int = 0, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
          archive_bytes: int = 16 << 20, dict_size: int = 32 << 10, level: int = 6, date: str | None = None) -> DataFrame:
    """Write archives into the shared folder ``path``; returns the manifest (file, records, bytes)."""
    date = date or datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
    rows = with_reference(pages, min_bytes, id_col, url_col, html_col).select(
        F.coalesce(F.col("id").cast("string"), F.lit("")).alias("id"), F.col("url").cast("string").alias("url"),
        F.when(F.col("refers_to").isNull(), F.col("payload")).alias("payload"), "sha1", "size", F.col("refers_to").cast("string").alias("refers_to"))

    fields = rows.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, folder = _folder(path)
        task, number, waiting, size = TaskContext.get(), 0, [], 0

        def close() -> pa.RecordBatch:
            nonlocal number, waiting, size
            name = f"part-{task.partitionId():06d}-{task.taskAttemptId()}-{number:04d}.warc.zst"
            fs.create_dir(folder, recursive=True)
            data, n = archive(waiting, dict_size, level), len(waiting)
            with fs.open_output_stream(f"{folder}/{name}", compression=None) as f:
                f.write(data)
            number, waiting, size = number + 1, [], 0
            return pa.RecordBatch.from_arrays([pa.array([name]), pa.array([n]), pa.array([len(data)])], names=["file", "records", "bytes"])

        for batch in runs(batches, "payload"):
            for page_id, url, payload, sha1, length, refers_to in zip(*(batch.column(c).to_pylist() for c in fields)):
                waiting.append(record(page_id, url, (payload or "").encode(), sha1, length, refers_to, date))
                size += len(waiting[-1])
                if size >= archive_bytes:
                    yield close()
        if waiting:
            yield close()

    return staged(rows.mapInArrow(run, "file string, records long, bytes long"), "warc-manifest")


def parse(raw: bytes) -> tuple:
    """(id, url, payload or None, payload bytes, base-32 digest, type, refers_to) of a record."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    field = dict(line.split(": ", 1) for line in lines[1:])
    block = rest[:int(field["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(re.search(rb"Content-Length: (\d+)", http)[1])
    digest, kind = field["WARC-Payload-Digest"].removeprefix("sha1:"), field["WARC-Type"]
    urn = lambda v: None if v is None else v.removeprefix("<urn:page:").removesuffix(">") or None
    if kind == "response" and (len(payload) != size or base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest):
        raise ValueError(f"the payload of record {field['WARC-Record-ID']} does not match its digest")
    return (urn(field["WARC-Record-ID"]), field.get("WARC-Target-URI"), payload if kind == "response" else None, size, digest, kind,
            urn(field.get("WARC-Refers-To")))


def read(spark: SparkSession, path: str, manifest: DataFrame, with_payload: bool = True) -> DataFrame:
    """One row per record of the archives that the manifest names: page_id, url, payload (binary, of
    responses; left out without ``with_payload``), payload_bytes, payload_digest, record_type, refers_to."""
    names = ["page_id", "url", "payload", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    kinds = ["string", "string", "binary", "long", "string", "string", "string"]
    kept = [i for i, n in enumerate(names) if with_payload or n != "payload"]
    schema = ", ".join(f"{names[i]} {kinds[i]}" for i in kept)
    if not manifest.take(1):
        return spark.createDataFrame([], schema)
    types = {"string": pa.string(), "binary": pa.binary(), "long": pa.int64()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                records = records_of(content.as_py())
                while part := [r for _, r in zip(range(500), map(parse, records))]:
                    columns = list(zip(*part))
                    yield pa.RecordBatch.from_arrays([pa.array(columns[i], types[kinds[i]]) for i in kept], names=[names[i] for i in kept])

    # Spark lists the folder; archives of attempts that failed are not in the manifest.
    listed = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.zst").load(path)
    name = F.element_at(F.split("path", "/"), -1)
    return (listed.select(name.alias("file"), "content").join(manifest.select("file"), "file", "left_semi")
            .select("content").mapInArrow(run, schema))
