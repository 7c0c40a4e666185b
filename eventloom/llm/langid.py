"""Language identification: multinomial naive Bayes over hashed character n-grams.

Texts are lower-cased and everything but letters becomes a blank; the n-grams
of one to ``max_n`` characters that begin with a letter, or with a blank before a
letter, are hashed into ``2**bits`` buckets.  Training counts them over all usable
documents: each task counts its own, the sparse counts are summed in Spark, and
the matrix of log-probabilities (languages x buckets) goes to every task.  Its
size does not depend on the documents; more than ``max_languages`` languages
raise an error.

Scoring treats a batch as a sparse matrix in compressed rows (row borders: the
texts; column indices: the buckets; values: one) and multiplies it with the
log-probabilities by gathering and summing along the rows.

Defined cases: a text without a letter (NULL and empty too) is ``und`` with score 0,
as is every text if nothing could be learned; equal scores go to the language
that sorts first; a NULL language or id never teaches; NULL ids are predicted
and not held out; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventloom.llm.common import crc_mod4, documents, runs

UNKNOWN = "und"
_MULTIPLY = (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F, 0x165667B1)


@cache
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000)


def buckets(values: list[str], max_n: int, bits: int) -> tuple[list[np.ndarray], list[np.ndarray], np.ndarray]:
    """For each n the buckets of all n-grams and the border of each text in them (one more
    than texts); and whether each text has a letter."""
    gap = max_n + 1
    code = np.frombuffer((" " + (" " * gap).join([*values, ""])).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    size = np.fromiter(map(len, values), np.int64, len(values))
    border = np.concatenate([[0], np.cumsum(size + gap)])
    letter = _letters()[code]
    code = np.where(letter, code, np.uint32(32))
    seen = np.concatenate([[0], np.cumsum(letter)])
    begins = letter.copy()
    begins[:-1] |= letter[1:]
    out, borders = [], []
    h = np.full(len(code), 7, dtype=np.uint32)
    for n in range(1, max_n + 1):
        m = len(code) - n + 1
        if m <= 0:
            out.append(np.empty(0, np.int64))
            borders.append(np.zeros_like(border))
            continue
        h = (h[:m] ^ code[n - 1:]) * np.uint32(_MULTIPLY[(n - 1) % len(_MULTIPLY)])
        h ^= h >> np.uint32(15)
        at = np.flatnonzero((letter if n == 1 else begins)[:m])
        out.append(((h[at] * np.uint32(0x2C1B3C6D)) >> np.uint32(32 - bits)).astype(np.int64))
        borders.append(np.searchsorted(at, border))
    return out, borders, seen[border[1:]] > seen[border[:-1]]


def gram_counts(docs: DataFrame, text_col: str, lang_col: str, max_n: int, bits: int) -> DataFrame:
    """(lang, bucket, n): n-gram counts of each language; at bucket -1 its documents."""
    width = 1 << bits

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        for batch in runs(batches, text_col):
            lower = pc.utf8_lower(pc.fill_null(batch.column(text_col), "")).to_pylist()
            langs = np.array(batch.column(lang_col).to_pylist(), dtype=object)
            names, number = np.unique(langs.astype(str), return_inverse=True)
            grams, borders, _ = buckets(lower, max_n, bits)
            own = np.zeros((len(names), width + 1), dtype=np.int64)
            for g, b in zip(grams, borders):
                row = np.repeat(number, np.diff(b))
                own[:, :width] += np.bincount(row * width + g, minlength=len(names) * width).reshape(-1, width)
            own[:, width] = np.bincount(number, minlength=len(names))
            for name, line in zip(names.tolist(), own):
                total[name] = total[name] + line if name in total else line
        for name, line in total.items():
            at = np.flatnonzero(line)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(at)), pa.array(np.where(at == width, -1, at).astype(np.int32)), pa.array(line[at])], names=["lang", "bucket", "n"])

    return (documents(docs, lang_col, text_col).mapInArrow(run, "lang string, bucket int, n long")
            .groupBy("lang", "bucket").agg(F.sum("n").alias("n")))


class Model:
    def __init__(self, languages: list[str], prior: np.ndarray, matrix: np.ndarray, max_n: int, bits: int):
        self.languages, self.prior, self.matrix, self.max_n, self.bits = languages, prior, matrix, max_n, bits

    def predict(self, values: list[str]) -> tuple[list[str], np.ndarray]:
        if not values or not self.languages:
            return [UNKNOWN] * len(values), np.zeros(len(values))
        grams, borders, some = buckets(values, self.max_n, self.bits)
        total = np.tile(self.prior[:, None], (1, len(values)))
        for g, b in zip(grams, borders):
            full = np.flatnonzero(np.diff(b))
            if len(full):
                for k in range(len(self.languages)):
                    total[k, full] += np.add.reduceat(self.matrix[k][g], b[full], dtype=np.float64)
        best = total.argmax(axis=0)
        share = np.exp(total - total.max(axis=0))
        score = np.where(some, share.max(axis=0) / share.sum(axis=0), 0.0)
        return [self.languages[k] if s else UNKNOWN for k, s in zip(best.tolist(), some.tolist())], score


def train(docs: DataFrame, usable: Column, text_col: str = "text", lang_col: str = "lang", max_n: int = 3,
          bits: int = 14, smoothing: float = 0.5, max_languages: int = 500) -> Model:
    """Count over every row for which ``usable`` holds and that has a language."""
    counts = gram_counts(docs.where(usable & F.col(f"`{lang_col}`").isNotNull()).select(
        F.col(f"`{lang_col}`").cast("string").alias(lang_col), F.col(f"`{text_col}`")), text_col, lang_col, max_n, bits)
    # A row holds one language's counts: at most max_languages rows of 2**bits cells reach the driver.
    rows = (counts.groupBy("lang").agg(F.map_from_entries(F.collect_list(F.struct("bucket", "n"))).alias("cells"))
            .limit(max_languages + 1).collect())
    if len(rows) > max_languages:
        raise ValueError(f"more than {max_languages} languages; raise max_languages if the matrix may grow")
    rows.sort(key=lambda r: r.lang)
    if not rows:
        return Model([], np.empty(0), np.empty((0, 0)), max_n, bits)
    number = np.zeros((len(rows), 1 << bits))
    for line, r in zip(number, rows):
        for bucket, n in r.cells.items():
            if bucket >= 0:
                line[bucket] = n
    number += smoothing
    known = np.array([r.cells[-1] for r in rows], dtype=float)
    matrix = np.log(number / number.sum(axis=1, keepdims=True)).astype(np.float32)
    return Model([r.lang for r in rows], np.log(known / known.sum()), matrix, max_n, bits)


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", **options) -> DataFrame:
    """One row per document: the id, held_out, lang_pred and score (the posterior)."""
    held_out = F.coalesce(crc_mod4(F.col(f"`{id_col}`")) == 2, F.lit(False))
    learnable = F.coalesce(crc_mod4(F.col(f"`{id_col}`")) != 2, F.lit(False))
    model = docs.sparkSession.sparkContext.broadcast(train(docs, learnable, text_col, lang_col, **options))
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in runs(batches, text_col):
            lower = pc.utf8_lower(pc.fill_null(batch.column(text_col), "")).to_pylist()
            name, score = model.value.predict(lower)
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("held_out"), pa.array(name), pa.array(score)],
                                             names=["id", "held_out", "lang_pred", "score"])

    rows = docs.select(F.col(f"`{id_col}`").alias("id"), held_out.alias("held_out"), F.col(f"`{text_col}`").alias(text_col))
    return rows.mapInArrow(run, f"id {kind}, held_out boolean, lang_pred string, score double").withColumnRenamed("id", id_col)
