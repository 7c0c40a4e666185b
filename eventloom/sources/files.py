"""Named files in a shared folder, written line by line from Spark tasks.

Spark names its own output files; where a file's name carries meaning (an
hour's flat JSONL, an export archive) the rows of one name go to one task, which
streams them into the file.  Any file system that Arrow can open works
(local or mounted paths, ``hdfs://``, ``s3://``, ``gs://``).  A file is written
under a name of the task attempt and renamed when complete, so a retried task
replaces it whole.
"""

from __future__ import annotations

import gzip
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame


def open_folder(path: str) -> tuple[pafs.FileSystem, str]:
    """The Arrow file system and folder of a path or URI."""
    if path.startswith("file:"):
        path = "file:///" + path[5:].lstrip("/")
    return pafs.FileSystem.from_uri(path) if "://" in path else (pafs.LocalFileSystem(), path)


@contextmanager
def _plain(out, member: str | None):
    yield out


@contextmanager
def _zipped(out, member: str):
    """One gzip member inside a ZIP, both streamed."""
    with zipfile.ZipFile(out, "w", compression=zipfile.ZIP_STORED) as z, z.open(member, "w", force_zip64=True) as raw:
        with gzip.GzipFile(fileobj=raw, mode="wb", mtime=0) as f:
            yield f


def write_named(df: DataFrame, folder: str, zipped: bool = False) -> DataFrame:
    """Write ``value`` lines of ``df`` (file, value, and member if ``zipped``) into ``folder``/``file``.

    Returns (file, lines) lazily: the files are written when it is computed.
    Rows arrive sorted by file, so a task holds one Arrow batch, not a file.
    """
    layer = _zipped if zipped else _plain

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = open_folder(folder)
        fs.create_dir(base, recursive=True)
        attempt = TaskContext.get().taskAttemptId()
        name, stream, sink, lines = None, None, None, 0

        def close() -> pa.RecordBatch:
            sink.__exit__(None, None, None)
            stream.close()
            fs.move(f"{base}/_{name}.{attempt}", f"{base}/{name}")
            return pa.RecordBatch.from_arrays([pa.array([name]), pa.array([lines])], names=["file", "lines"])

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in batch.schema.names]
            for file, value, member in zip(columns[0], columns[1], columns[2] if zipped else columns[0]):
                if file != name:
                    if name is not None:
                        yield close()
                    name, lines = file, 0
                    stream = fs.open_output_stream(f"{base}/_{name}.{attempt}", compression=None)
                    sink = layer(stream, member)
                    out = sink.__enter__()
                out.write(value.encode() + b"\n")
                lines += 1
        if name is not None:
            yield close()

    columns = ["file", "value", *(["member"] if zipped else [])]
    return (df.select(*columns).repartition("file").sortWithinPartitions("file")
            .mapInArrow(run, "file string, lines long"))
