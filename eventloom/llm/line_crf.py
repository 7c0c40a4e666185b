"""Quality by a linear-chain conditional random field over the lines of a document.

Every line of a text is good or bad.  A line's own features (shares of character
classes, word lengths, repeats) stand beside those of the line before and the
line after; the chain's transitions couple neighbouring states.  The forward-
backward marginals of "good", weighted by the lines' lengths, make the
document's score.

Only documents carry labels, so in training every line has its document's.
The model is fitted on a bounded sample: at most ``max_rows`` labelled rows, those
with the smallest hash of text and id, with all their lines.  Scoring reads every
line of every text.

Defined cases: a text always has a line (NULL and empty texts one empty line);
without any usable label the score is 0.5 everywhere; a label of a repeated id
counts for each row with that id, a NULL label or id never; NULL ids are scored
and are not held out; repeated rows are scored each for itself; texts of any
length are read whole; an empty table gives an empty result.  Other columns,
whatever their names, are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventloom.llm.common import WORD_BYTES, crc_mod4, documents, runs, text_bytes, unused, word_hashes, word_spans

#: Byte classes: 0 lower case, 1 upper case, 2 digit, 3 blank, 4 sentence sign, 5 other sign, 6 non-ASCII.
CLASSES = np.array([
    0 if 97 <= b <= 122 else 1 if 65 <= b <= 90 else 2 if 48 <= b <= 57 else 3 if b in (9, 10, 13, 32)
    else 4 if b in b".,;:'\"-?()" else 6 if b >= 128 else 5 for b in range(256)], dtype=np.int64)
OWN = 11
FEATURES = 3 * OWN + 3


def line_features(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features of all lines, their lengths in bytes, and the first line of each text."""
    raw, offsets = text_bytes(column)
    data = np.frombuffer(raw, dtype=np.uint8)
    breaks = np.flatnonzero(data == 10) + 1
    starts = np.sort(np.concatenate([offsets[:-1], breaks]), kind="stable")
    first = np.arange(len(column)) + np.searchsorted(breaks, offsets[:-1], side="right")
    ends = np.concatenate([starts[1:], offsets[-1:]])
    n = len(starts)
    length = ends - starts
    share = np.bincount(np.repeat(np.arange(n), length) * 7 + CLASSES[data], minlength=7 * n).reshape(n, 7) / np.maximum(length, 1)[:, None]

    words = np.frombuffer(raw.translate(WORD_BYTES), dtype=np.uint8)
    begin, stop, _ = word_spans(words, offsets)
    line = np.searchsorted(starts, begin, side="right") - 1
    count = np.bincount(line, minlength=n)
    letters = np.bincount(line, weights=stop - begin, minlength=n)
    same = np.zeros(n)
    if len(begin) > 1:
        h = word_hashes(words, begin, stop)
        twin = np.flatnonzero((h[1:] == h[:-1]) & (line[1:] == line[:-1]))
        same = np.bincount(line[twin], minlength=n).astype(float)
    own = np.column_stack([
        share, np.log1p(length) / 10, same / np.maximum(count, 1), letters / np.maximum(count, 1) / 10, count < 3])
    head = np.zeros(n, dtype=bool)
    head[first] = True
    last = np.concatenate([head[1:], [True]])
    before, after = np.vstack([own[:1] * 0, own[:-1]]), np.vstack([own[1:], own[:1] * 0])
    before[head], after[last] = 0, 0
    return np.column_stack([own, before, after, head, last, np.ones(n)]), length, first


def chain(u: np.ndarray, first: np.ndarray, trans: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Forward and backward log ratios good : bad of every line; all texts step together."""
    size = np.diff(np.concatenate([first, [len(u)]]))
    order = np.argsort(-size, kind="stable")
    head, size = first[order], size[order]
    alive = np.searchsorted(-size, -np.arange(1, int(size.max(initial=0)) + 1), side="right")
    forward, backward = np.empty(len(u)), np.zeros(len(u))
    (a00, a01), (a10, a11) = trans
    for t, n in enumerate(alive.tolist()):
        at = head[:n] + t
        if t:
            r = forward[at - 1]
            forward[at] = u[at] + np.logaddexp(r + a11, a01) - np.logaddexp(r + a10, a00)
        else:
            forward[at] = u[at]
    for t in range(len(alive) - 1, 0, -1):
        at = head[:alive[t]] + t
        v = backward[at] + u[at]
        backward[at - 1] = np.logaddexp(v + a11, a10) - np.logaddexp(v + a01, a00)
    return forward, backward


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 + 0.5 * np.tanh(x / 2)


@dataclass
class Model:
    weights: np.ndarray
    trans: np.ndarray

    def scores(self, column: pa.Array) -> np.ndarray:
        if not len(column):
            return np.empty(0)
        x, length, first = line_features(column)
        forward, backward = chain(x @ self.weights, first, self.trans)
        weight = np.maximum(length, 1)
        good = np.add.reduceat(_sigmoid(forward + backward) * weight, first)
        return np.clip(good / np.add.reduceat(weight, first), 0.0, 1.0)


def fit(x: np.ndarray, first: np.ndarray, label: np.ndarray, steps: int = 200, rate: float = 0.1, decay: float = 1e-3) -> Model:
    """Maximum conditional likelihood of the label sequences, by Adam, on standardised features."""
    if not len(first) or len(x) == 0:
        return Model(np.zeros(FEATURES), np.zeros((2, 2)))
    mean, spread = x.mean(axis=0), x.std(axis=0)
    mean[-1], spread = 0, np.where(spread > 1e-6, spread, 1)
    z = np.clip((x - mean) / spread, -6, 6)
    size = np.diff(np.concatenate([first, [len(x)]]))
    y = np.repeat(label, size).astype(float)
    inner = np.ones(len(x), dtype=bool)
    inner[first] = False
    at = np.flatnonzero(inner)
    theta = np.zeros(FEATURES + 4)
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, steps + 1):
        w, trans = theta[:FEATURES], theta[FEATURES:].reshape(2, 2)
        u = z @ w
        forward, backward = chain(u, first, trans)
        grad_w = z.T @ (y - _sigmoid(forward + backward))
        r, s = forward[at - 1], u[at] + backward[at]
        joint = np.stack([0 * r + trans[0, 0], s + trans[0, 1], r + trans[1, 0], r + s + trans[1, 1]])
        joint = np.exp(joint - joint.max(axis=0))
        joint /= joint.sum(axis=0)
        seen = np.array([(y[at] == 0).sum(), 0, 0, (y[at] == 1).sum()])
        grad = np.concatenate([grad_w, seen - joint.sum(axis=1)]) / len(x) - decay * theta
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad * grad
        theta = theta + rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    w = theta[:FEATURES] / spread
    w[-1] -= (w * mean).sum()
    return Model(w, theta[FEATURES:].reshape(2, 2))


def train(docs: DataFrame, labels: DataFrame, usable: Column, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "quality", max_rows: int = 3000) -> Model:
    """Fit on at most ``max_rows`` rows of ``docs`` whose label is 0 or 1 and for which ``usable`` holds."""
    known = labels.select(F.col(id_col).alias("__label_id"), F.col(label_col).alias("__label")).where("__label in (0, 1)").distinct()
    own = documents(docs, id_col, text_col).where(usable)
    rank = F.xxhash64(text_col, id_col)
    ids = own.select(F.col(id_col).alias("__label_id"), rank.alias("__rank")).join(known, "__label_id")
    few = ids.orderBy("__rank", "__label_id", "__label").limit(max_rows)
    sample = own.join(F.broadcast(few.distinct()), (F.col(id_col) == F.col("__label_id")) & (rank == F.col("__rank")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in runs(batches, text_col):
            x, _, first = line_features(batch.column(text_col))
            size = np.diff(np.concatenate([first, [len(x)]]))
            own = [x[a:a + n].astype(np.float32).ravel() for a, n in zip(first, size)]
            yield pa.RecordBatch.from_arrays([batch.column("__label"), batch.column("__rank"), pa.array(own, pa.list_(pa.float32()))], names=["label", "rank", "x"])

    rows = (sample.select(text_col, F.col("__label").cast("int").alias("__label"), "__rank")
            .mapInArrow(run, "label int, rank long, x array<float>").orderBy("rank", "label").limit(max_rows).toPandas())
    if not len(rows):
        return fit(np.empty((0, FEATURES)), np.empty(0, np.int64), np.empty(0))
    x = [np.asarray(v, dtype=np.float64).reshape(-1, FEATURES) for v in rows["x"]]
    size = np.array([len(v) for v in x])
    return fit(np.concatenate(x), np.cumsum(size) - size, rows["label"].to_numpy())


def learnable(id_col: str = "doc_id") -> Column:
    """Rows that may teach: those not held out."""
    return F.coalesce(crc_mod4(F.col(f"`{id_col}`")) != 2, F.lit(False))


def score(docs: DataFrame, model: Model, text_col: str = "text", name: str = "score", least: float | None = None) -> DataFrame:
    """``docs`` with the score as a further column; with ``least``, only the rows that reach it."""
    schema = T.StructType([*docs.schema.fields, T.StructField(name, T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in runs(batches, text_col):
            value = model.scores(batch.column(text_col))
            out = pa.RecordBatch.from_arrays([*batch.columns, pa.array(value)], names=[*batch.schema.names, name])
            yield out if least is None else out.filter(pa.array(value >= least))

    return docs.mapInArrow(run, schema)


def quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = 0.7) -> DataFrame:
    """One row per document: the id, held_out, score and predicted (1 from ``least`` on)."""
    model = train(docs, labels, learnable(id_col), id_col, text_col)
    scored = score(documents(docs, id_col, text_col), model, text_col, "__score")  # of two columns only
    return scored.select(id_col, F.coalesce(crc_mod4(F.col(id_col)) == 2, F.lit(False)).alias("held_out"),
                         F.col("__score").alias("score"), (F.col("__score") >= least).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = 0.7) -> DataFrame:
    """The documents that are not rejected; columns stay as they are."""
    model = train(docs, labels, learnable(id_col), id_col, text_col)
    (name,) = unused(docs, "__score")
    return score(docs, model, text_col, name, least).drop(name)
