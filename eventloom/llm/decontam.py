"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment.

1. Words of the test items are counted in the whole corpus.  An n-gram of an
   item is a seed if its words' frequencies make it rare (their product is at
   most ``max_seed_rate``); an item keeps all its n-grams if fewer than half are rare.
   Rarity is judged by the words, not by the n-gram's own count: a leaked
   passage does not become unsearchable by having leaked many times.
2. Each document looks its n-grams up in a bit map of the seeds, whose size is
   fixed (a false positive costs time only), and passes on the passages around its
   hits with the seeds found.  Passages join items on the seeds.
3. Smith-Waterman over words scores each (passage, item); the best score for a
   text and item, divided by that of the whole item, is ``similarity``.  A text
   is contaminated from ``min_similarity`` on, if at least ``min_words`` words (or the
   whole item, if shorter) are equal.  A part of a long item counts too, whatever its
   share of the item: ``long_words`` or more words that score ``LONG_RATE`` each (about
   four in five equal).

Passages are keyed by the MD5 of their document's text, so copies of a
document are aligned once.

Words are runs of letters, digits and non-ASCII characters after lower-casing.
Defined cases: NULL and empty texts and items have no words and never match,
nor does an item of fewer words than a seed; items repeated under one id are
aligned each and the best counts; NULL ids are kept; rows that repeat both id
and text are reported once; texts of any length are searched whole, by passages; an
empty table of documents or items gives an empty result; other columns, whatever their
names, stay as they are.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.llm.common import WORD_BYTES, documents, gram_hashes, runs, staged, text_bytes, unused, word_hashes, word_spans

#: Bits of a membership map (8 MB), whatever is put in.
BITS = 1 << 26
MATCH, MISMATCH, GAP = 2, -1, 1
#: Of a long part of an item: the least score for each word spanned, over that of an equal word.
LONG_RATE = 0.7


def _words(column: pa.Array) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased bytes, word starts, ends, hashes, and each text's first word."""
    raw, offsets = text_bytes(pc.utf8_lower(pc.fill_null(column, "")))
    raw = raw.translate(WORD_BYTES)
    data = np.frombuffer(raw, dtype=np.uint8)
    starts, ends, first = word_spans(data, offsets)
    return raw, starts, ends, word_hashes(data, starts, ends), first


def items_of(benchmark: DataFrame, n: int, id_col: str, text_col: str) -> DataFrame:
    """(item, id, words: array of hashes, grams: array of hashes) of the test items, written."""
    rows = documents(benchmark, id_col, text_col).withColumn("__item", F.monotonically_increasing_id())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in runs(batches, text_col):
            _, _, _, words, first = _words(batch.column(text_col))
            ids = words.view(np.int64)
            cut = [ids[a:b] for a, b in zip(first[:-1], first[1:])]
            grams = [gram_hashes(words[a:b], np.array([0, b - a]), n)[0].view(np.int64) for a, b in zip(first[:-1], first[1:])]
            yield pa.RecordBatch.from_arrays(
                [batch.column("__item"), batch.column(id_col), pa.array(cut, pa.list_(pa.int64())), pa.array(grams, pa.list_(pa.int64()))],
                names=["item", "id", "words", "grams"])

    kind = benchmark.schema[id_col].dataType.simpleString()
    return staged(rows.mapInArrow(run, f"item long, id {kind}, words array<long>, grams array<long>"), "items")


def bit_map(hashes: DataFrame) -> np.ndarray:
    """Membership map of the long column ``h``: two bits for each value, BITS in all."""
    at = F.explode(F.array(F.col("h").bitwiseAND(F.lit(BITS - 1)), F.shiftrightunsigned("h", 32).bitwiseAND(F.lit(BITS - 1))))
    cells = (hashes.select(at.alias("b")).select(F.shiftright("b", 6).alias("cell"), F.expr("shiftleft(1L, cast(b & 63 as int))").alias("bit"))
             .groupBy("cell").agg(F.bit_or("bit").alias("bits"))).toPandas()
    out = np.zeros(BITS // 64, dtype=np.uint64)
    out[cells["cell"].to_numpy(dtype=np.int64)] = cells["bits"].to_numpy(dtype=np.int64).view(np.uint64)
    return out.view(np.uint8)


def _members(bits: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Indices of the hashes that are in the map."""
    at = (h & np.uint64(BITS - 1)).astype(np.int64)
    some = np.flatnonzero(bits[at >> 3] >> (at & 7).astype(np.uint8) & 1)
    at = (h[some] >> np.uint64(32) & np.uint64(BITS - 1)).astype(np.int64)
    return some[(bits[at >> 3] >> (at & 7).astype(np.uint8) & 1) == 1]


def word_counts(docs: DataFrame, text_col: str, vocabulary: np.ndarray) -> DataFrame:
    """(h, n) over all documents for words in the map; at h = 0 the count of all words."""
    bits = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, total = np.empty(0, np.uint64), 0
        counts = np.empty(0, np.int64)
        for batch in runs(batches, text_col):
            _, _, _, words, _ = _words(batch.column(text_col))
            total += len(words)
            own, number = np.unique(words[_members(bits.value, words)], return_counts=True)
            seen, back = np.unique(np.concatenate([seen, own]), return_inverse=True)
            counts = np.bincount(back, weights=np.concatenate([counts, number]), minlength=len(seen)).astype(np.int64)
            if len(seen) > 500_000:
                yield pa.RecordBatch.from_arrays([pa.array(seen.view(np.int64)), pa.array(counts)], names=["h", "n"])
                seen, counts = np.empty(0, np.uint64), np.empty(0, np.int64)
        h = np.concatenate([seen.view(np.int64), [0]])
        yield pa.RecordBatch.from_arrays([pa.array(h), pa.array(np.concatenate([counts, [total]]))], names=["h", "n"])

    return documents(docs, text_col).mapInArrow(run, "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))


def seeds_of(items: DataFrame, counts: DataFrame, n: int, max_seed_rate: float) -> DataFrame:
    """(gram, item): the seeds of each item."""
    counts = staged(counts, "word-counts")
    total = counts.where("h = 0").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    grams = items.select("item", "words", F.posexplode("grams").alias("at", "gram"))
    words = grams.select("item", "at", "gram", F.explode(F.slice("words", F.col("at") + 1, F.lit(n))).alias("h"))
    rate = (F.coalesce("n", F.lit(0)) + 0.5) / (total + 1.0)
    scored = (words.join(counts.where("h <> 0"), "h", "left").groupBy("item", "at", "gram")
              .agg(F.sum(F.log(rate)).alias("log_rate")).withColumn("rare", F.col("log_rate") <= math.log(max_seed_rate)))
    some = scored.groupBy("item").agg((F.avg(F.col("rare").cast("int")) < 0.5).alias("few_rare"))
    return scored.join(some, "item").where("rare or few_rare").select("gram", "item").distinct()


def passages_of(docs: DataFrame, seed_bits: np.ndarray, n: int, reach: int, id_col: str, text_col: str) -> DataFrame:
    """(id, text_key, first_word, passage, seeds): the words around each cluster of hits,
    ``reach`` words to either side; hits at most ``reach`` words apart form one cluster."""
    bits = docs.sparkSession.sparkContext.broadcast(seed_bits)
    kind = docs.schema[id_col].dataType.simpleString()
    names = ["id", "text_key", "first_word", "passage", "seeds"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in runs(batches, text_col):
            raw, starts, ends, words, first = _words(batch.column(text_col))
            grams, at = gram_hashes(words, first, n)
            hit = _members(bits.value, grams)
            if not len(hit):
                continue
            grams, at = grams[hit].view(np.int64), at[hit]
            doc = np.searchsorted(first, at, side="right") - 1
            cuts = np.flatnonzero((np.diff(at) > reach) | (np.diff(doc) != 0)) + 1
            rows, keys, out = batch.column(text_col), {}, ([], [], [], [], [])
            for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), len(at)]):
                d = int(doc[lo])
                if d not in keys:
                    keys[d] = hashlib.md5(rows[d].as_py().encode()).hexdigest()
                a = max(int(first[d]), int(at[lo]) - reach)
                b = min(int(first[d + 1]), int(at[hi - 1]) + n + reach)
                passage = b" ".join(raw[int(starts[a]):int(ends[b - 1])].split()).decode()
                for column, value in zip(out, (d, keys[d], a - int(first[d]), passage, np.unique(grams[lo:hi]))):
                    column.append(value)
            yield pa.RecordBatch.from_arrays(
                [batch.column(id_col).take(pa.array(out[0])), pa.array(out[1]), pa.array(out[2], pa.int32()), pa.array(out[3]),
                 pa.array(out[4], pa.list_(pa.int64()))], names=names)

    return documents(docs, id_col, text_col).mapInArrow(
        run, f"id {kind}, text_key string, first_word int, passage string, seeds array<long>")


def align(item: np.ndarray, passage: np.ndarray) -> tuple[int, int]:
    """Smith-Waterman score, and the number of passage words up to the alignment's end."""
    slope = GAP * np.arange(len(passage) + 1)
    row, best, end = np.zeros(len(passage) + 1, dtype=np.int64), 0, 0
    for word in item:
        new = np.maximum(row - GAP, 0)
        np.maximum(new[1:], row[:-1] + np.where(passage == word, MATCH, MISMATCH), out=new[1:])
        row = np.maximum.accumulate(new + slope) - slope
        top = int(row.argmax())
        if row[top] > best:
            best, end = int(row[top]), top
    return best, end


def _aligned(min_similarity: float, min_words: int, long_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for key, base, passage, number, words in zip(*(batch.column(c).to_pylist() for c in ("text_key", "first_word", "passage", "item", "words"))):
                data = np.frombuffer(passage.encode(), dtype=np.uint8)
                starts, ends, _ = word_spans(data, np.array([0, len(data)]))
                found, item = word_hashes(data, starts, ends).view(np.int64), np.array(words, dtype=np.int64)
                score, end = align(item, found)
                whole = score >= min_similarity * MATCH * len(item)
                if not end or not (whole or score >= LONG_RATE * MATCH * long_words):
                    continue
                back, length = align(item[::-1], found[:end][::-1])
                part = found[end - length:end]
                if not whole:
                    # Part of a long item: judged by the words it spans in the item and in the text.
                    _, stop = align(part, item)
                    _, of_item = align(part[::-1], item[:stop][::-1])
                    span = max(of_item, length)
                    whole = span >= long_words and score >= LONG_RATE * MATCH * span
                if whole and np.isin(part, item).sum() >= min(min_words, len(item)):
                    out.append((key, number, score / (MATCH * len(item)), base + end - length, base + end - 1))
            if out:
                columns = list(zip(*out))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(columns[0]), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.float64()), pa.array(columns[3], pa.int32()), pa.array(columns[4], pa.int32())],
                    names=["text_key", "item", "similarity", "first_word", "last_word"])

    return run


def leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id",
          item_text_col: str = "text", n: int = 3, max_seed_rate: float = 1e-8, min_similarity: float = 0.5,
          min_words: int = 8, long_words: int = 30) -> tuple[DataFrame, DataFrame]:
    """(text_key, item_id, similarity, first_word, last_word) for contaminated texts, the best
    alignment for each item, and (id, text_key) of the documents with candidate passages."""
    items = items_of(benchmark, n, item_id_col, item_text_col)
    vocabulary = bit_map(items.select(F.explode("words").alias("h")).distinct())
    seeds = staged(seeds_of(items, word_counts(docs, text_col, vocabulary), n, max_seed_rate), "seeds")
    reach = items.agg(F.coalesce(F.max(F.size("words")), F.lit(0))).first()[0]
    passages = staged(passages_of(docs, bit_map(seeds.select(F.col("gram").alias("h"))), n, reach, id_col, text_col), "passages")
    own = passages.drop("id").dropDuplicates(["text_key", "first_word"])
    pairs = (own.select("text_key", "first_word", F.explode("seeds").alias("gram")).join(seeds, "gram")
             .select("text_key", "first_word", "item").distinct())
    both = (pairs.join(own.drop("seeds"), ["text_key", "first_word"]).join(items.select("item", "words"), "item")
            .select("text_key", "first_word", "passage", "item", "words"))
    found = both.mapInArrow(_aligned(min_similarity, min_words, long_words),
                            "text_key string, item long, similarity double, first_word int, last_word int")
    best = (found.join(items.select("item", F.col("id").alias("item_id")), "item").groupBy("text_key", "item_id")
            .agg(F.max(F.struct("similarity", F.negative("first_word").alias("back"), "last_word")).alias("b"))
            .select("text_key", "item_id", "b.similarity", F.negative("b.back").alias("first_word"), "b.last_word"))
    return best, passages.select("id", "text_key")


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """One row for each document and item it contains: the id, item_id, similarity and the
    words of the document that align, first_word to last_word (from 0)."""
    best, rows = leaks(docs, benchmark, id_col, **options)
    return rows.distinct().join(best, "text_key").select(
        F.col("id").alias(id_col), "item_id", "similarity", "first_word", "last_word")


def without_leaks(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", id_col: str = "doc_id", **options) -> DataFrame:
    """The documents whose text contains no test item; columns and rows stay as they are."""
    best, _ = leaks(docs, benchmark, id_col, text_col, **options)
    gone = staged(best.select("text_key").distinct(), "leaks")
    (key,) = unused(docs, "__key")
    return docs.withColumn(key, F.md5(F.coalesce(F.col(f"`{text_col}`"), F.lit("")).cast("binary"))).join(
        gone.withColumnRenamed("text_key", key), key, "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])
