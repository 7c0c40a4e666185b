"""Token files: ids as Parquet list columns that can be read selectively.

``write`` sorts documents by id over range partitions, encodes them and writes
one Parquet file per partition.  The id lists are dictionary-encoded, the
long columns delta-encoded (writer version 2), row groups and pages have the
sizes asked for, and pages carry column and offset indexes, so that a filter
on ``doc_id`` reads only the pages it needs and a read of the metadata
columns touches no ids.

Positions are running sums: each task numbers its own ids, and the files'
totals (one row each) are summed over the files in order.

Defined cases: NULL text counts as empty (its only id is the end id); NULL
ids come first; rows with equal ids are ordered by a hash of their text, then
as read; other columns are not looked at; an empty table has no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventloom.llm.bpe import append_id, tokenizer
from eventloom.llm.common import documents, runs


def _lists(ids: np.ndarray, size: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(size))), pa.int32()), pa.array(ids, pa.int32()))


def write(docs: DataFrame, path: str, tokenizer_path: str, end_id: int = 0, id_col: str = "doc_id",
          text_col: str = "text", row_group_bytes: int = 16 << 20, page_bytes: int = 256 << 10,
          page_rows: int = 2000, added_tokens: bool = False) -> None:
    """Columns written: file_no, the id, first (ids before it in the file), n_tokens, tokens.
    ``added_tokens``: special tokens in a text get their own id, as by the library's default."""
    id_field = docs.schema[id_col]
    schema = T.StructType([
        T.StructField("file_no", T.IntegerType()), T.StructField(id_col, id_field.dataType), T.StructField("first", T.LongType()),
        T.StructField("n_tokens", T.LongType()), T.StructField("tokens", T.ArrayType(T.IntegerType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, file_no, done = tokenizer(tokenizer_path, added_tokens), TaskContext.get().partitionId(), 0
        for batch in runs(batches, text_col):
            ids, size = append_id(*bpe.encode(batch.column(text_col)), end_id)
            ends = done + np.cumsum(size)
            done = int(ends[-1])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(size), file_no, np.int32)), batch.column(id_col), pa.array(ends - size), pa.array(size), _lists(ids, size)],
                names=schema.names)

    order = [F.col(id_col).asc_nulls_first(), F.col("__tie"), F.col("__row")]
    rows = (documents(docs, id_col, text_col)
            .withColumns({"__tie": F.xxhash64(text_col), "__row": F.monotonically_increasing_id()})
            .repartitionByRange(*order).sortWithinPartitions(*order).select(id_col, text_col))
    (rows.mapInArrow(run, schema).write
     .option("compression", "zstd")
     .option("parquet.writer.version", "PARQUET_2_0")
     .option("parquet.enable.dictionary", "false")
     .option("parquet.enable.dictionary#tokens.list.element", "true")
     .option("parquet.block.size", row_group_bytes)
     .option("parquet.page.size", page_bytes)
     .option("parquet.page.row.count.limit", page_rows)
     .parquet(path))


def read(spark: SparkSession, path: str, where: Column | None = None) -> DataFrame:
    """The files' rows with ``start``, the number of ids of all documents before each;
    ``where`` filters on the stored columns and reaches the scan."""
    rows = spark.read.parquet(path)
    totals = rows.groupBy("file_no").agg(F.sum("n_tokens").alias("n"))
    before = Window.orderBy("file_no").rowsBetween(Window.unboundedPreceding, -1)
    base = totals.select("file_no", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    kept = rows if where is None else rows.where(where)
    # One row for each file, as many as the driver's own file listing has.
    return (kept.join(F.broadcast(base), "file_no").withColumn("start", F.col("base") + F.col("first"))
            .drop("base", "first", "file_no"))


def with_crc32(rows: DataFrame, tokens_col: str = "tokens") -> DataFrame:
    """Replaces the id list by ``ids_crc32``, of the ids as little-endian unsigned 32 bits."""
    rest = [f for f in rows.schema.fields if f.name != tokens_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(tokens_col)
            raw = memoryview(lists.values.to_numpy(zero_copy_only=False).astype("<i4", copy=False)).cast("B")
            at = lists.offsets.to_numpy().astype(np.int64) * 4
            crc = np.fromiter((zlib.crc32(raw[a:b]) for a, b in zip(at[:-1].tolist(), at[1:].tolist())), np.int64, len(lists))
            yield pa.RecordBatch.from_arrays([*(batch.column(f.name) for f in rest), pa.array(crc)],
                                             names=[*(f.name for f in rest), "ids_crc32"])

    return rows.mapInArrow(run, T.StructType([*rest, T.StructField("ids_crc32", T.LongType())]))
