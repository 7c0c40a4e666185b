"""Helpers shared by the corpus operators: Arrow text access, word hashing, staged tables.

Text work runs in ``mapInArrow``: a task sees Arrow batches, never a whole
partition, and cuts them into runs of rows with a bounded number of text
bytes (one longer text forms a run of its own), so a task's memory depends on
its longest text and not on the partition.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventloom.session import scratch_path

#: Text bytes that a task handles at once.
RUN_BYTES = 1 << 19

#: Upper-case ASCII to lower case; every byte outside words to a space.
#: A word is a run of ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]`` after lower-casing A-Z.
WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32
    for b in range(256))

_MIX = np.random.default_rng(7).integers(1, 2**63 - 1, 256, dtype=np.int64).astype(np.uint64)
_P = np.uint64(0x9E3779B97F4A7C15)


def staged(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write ``df`` under the shared checkpoint folder and read it back (cuts lineage)."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.options(compression="zstd", **options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def documents(docs: DataFrame, *columns: str) -> DataFrame:
    """Only the named columns: other columns, whatever their names, cannot clash."""
    return docs.select(*[F.col(f"`{c}`") for c in columns])


def unused(df: DataFrame, *names: str) -> list[str]:
    """The names, each made longer until no column of ``df`` has it (in any case of letters)."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def crc_mod4(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 4 (NULL id: NULL)."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 4


_KEPT: dict[Any, Any] = {}


def _forget_other_stages() -> None:
    task = TaskContext.get()
    stage = task.stageId() if task else None
    if _KEPT.get("stage") != stage:
        _KEPT.clear()
        _KEPT["stage"] = stage


def per_stage(key: Any, make: Callable[[], Any]) -> Any:
    """An object that the tasks of one stage share in a Python worker; the worker drops
    it when it begins with another stage's texts."""
    _forget_other_stages()
    if key not in _KEPT:
        _KEPT[key] = make()
    return _KEPT[key]


def runs(batches: Iterable[pa.RecordBatch], column: str,
         limit: int = RUN_BYTES) -> Iterator[pa.RecordBatch]:
    """Rows in order, in runs of at most ``limit`` bytes of ``column`` (or one row)."""
    _forget_other_stages()
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        ends, at = np.cumsum(size.astype(np.int64)), 0
        while at < n:
            before = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, before + limit, side="right")))
            yield batch.slice(at, to - at)
            at = to


def texts(batch: pa.RecordBatch, column: str) -> list[str]:
    """The column as strings, NULL as the empty text."""
    return pc.fill_null(batch.column(column), "").to_pylist()


def text_bytes(values: pa.Array) -> tuple[bytes, np.ndarray]:
    """All texts joined as UTF-8, and where each starts (one more entry than texts)."""
    values = pc.fill_null(values, "").cast(pa.large_string())
    offsets = np.frombuffer(values.buffers()[1], dtype=np.int64)[values.offset:values.offset + len(values) + 1]
    data = values.buffers()[2]
    raw = b"" if data is None else data.slice(int(offsets[0]), int(offsets[-1] - offsets[0])).to_pybytes()
    return raw, offsets - offsets[0]


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of runs of non-space bytes that do not cross a text border,
    and for each text the index of its first word (one more entry than texts)."""
    inside = np.zeros(len(data) + 2, dtype=bool)
    inside[1:-1] = data != 32
    begin = inside[1:] & ~inside[:-1]
    border = offsets[(offsets > 0) & (offsets < len(data))]
    begin[border] |= inside[border + 1]
    starts = np.flatnonzero(begin[:-1])
    stop = inside[1:-1] & ~inside[2:]
    stop[border - 1] |= inside[border]
    ends = np.flatnonzero(stop) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit polynomial hash of each word, over its bytes only."""
    if not len(starts):
        return np.empty(0, dtype=np.uint64)
    length = ends - starts
    power = np.multiply.accumulate(np.full(int(length.max()), _P, dtype=np.uint64))
    first = np.repeat(starts, length)
    flat = np.arange(len(first)) - np.repeat(np.cumsum(length) - length, length)
    value = _MIX[data[first + flat]] * power[flat]
    total = np.add.reduceat(value, np.cumsum(length) - length)
    total ^= total >> np.uint64(29)
    return total * _P


def gram_hashes(words: np.ndarray, first: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of ``n`` consecutive words, and the index of each one's first word;
    ``first`` has the index of each text's first word, so none crosses texts."""
    if len(words) < n:
        return np.empty(0, dtype=np.uint64), np.empty(0, dtype=np.int64)
    total = words[:len(words) - n + 1].copy()
    for k in range(1, n):
        total *= _P
        total += words[k:len(words) - n + 1 + k]
    total ^= total >> np.uint64(31)
    keep = np.ones(len(total), dtype=bool)
    for k in range(1, n):
        last = first[1:] - k
        keep[last[(last >= 0) & (last < len(keep)) & (last >= first[:-1])]] = False
    return total[keep], np.flatnonzero(keep)

