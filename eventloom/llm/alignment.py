"""Cross-tokenizer alignment: which tokens of two vocabularies end together.

Both tokenizers read the same text; the byte lengths of their tokens add up to
the places where tokens end.  A dictionary from end to index is made for each,
the keys in both, in order, cut both id lists into groups that hold the same
bytes.  In a group the tokens whose byte ranges end together are linked: its
last ones (each with each, had a vocabulary tokens without bytes).

A link's id pair is counted over the corpus.  A task hands on one row for each
run of texts and distinct pair, so the shuffles that count the pairs and bring
the counts back grow with the pairs in runs and not with the tokens; a pair
that every text has is one row for each run, which adaptive skew joins split.

Defined cases: NULL and empty texts, and texts whose tokens' bytes are not
those of a space and the text under both tokenizers, have no tokens (zeros, and
an empty digest); special tokens' strings are plain text; repeated rows count
once each; NULL ids are kept; texts are aligned whole, one after the other, in
runs of bounded size (a longer text is one run); an empty table gives an empty
result; columns other than the two named are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventloom.llm.bpe import WordBpe, byte_letters
from eventloom.llm.common import documents, per_stage, runs, staged, text_bytes
from eventloom.llm.pieces import gather
from eventloom.llm.sentence_bpe import SentenceBpe

#: Text bytes of a run; the larger, the fewer times a pair is handed on.
RUN = 1 << 18
#: Pieces that a worker holds of each tokenizer, and bytes of a group of runs as written.
PIECES, RUN_GROUP = 200_000, 8 << 20


class Vocabulary:
    """Bytes of all tokens, one after the other, and where each starts."""

    def __init__(self, tokens: list[bytes]):
        self.size = np.fromiter(map(len, tokens), np.int64, len(tokens))
        self.start = np.cumsum(self.size) - self.size
        self.data = np.frombuffer(b"".join(tokens), dtype=np.uint8)

    def joined(self, ids: np.ndarray) -> np.ndarray:
        return self.data[gather(self.start[ids], self.size[ids])]


class Tokens:
    """Ids of all texts of a run, how many each text has, and the byte where each token ends."""

    def __init__(self, vocabulary: Vocabulary, ids: np.ndarray, count: np.ndarray, raw: np.ndarray, offsets: np.ndarray):
        self.ids, self.vocabulary = ids, vocabulary
        self.bound = np.concatenate(([0], np.cumsum(count)))
        self.ends = np.cumsum(vocabulary.size[ids])
        length = np.diff(np.concatenate(([0], self.ends))[self.bound])
        self.whole = length == np.diff(offsets)
        joined = vocabulary.joined(ids)
        if not (self.whole.all() and np.array_equal(joined, raw)):
            at = np.cumsum(length) - length
            for k in np.flatnonzero(self.whole).tolist():
                self.whole[k] = np.array_equal(joined[at[k]:at[k] + length[k]], raw[offsets[k]:offsets[k + 1]])

    def only(self, kept: np.ndarray) -> None:
        """Texts not ``kept`` have no tokens."""
        count = np.diff(self.bound)
        self.ids = self.ids[np.repeat(kept, count)]
        self.bound = np.concatenate(([0], np.cumsum(np.where(kept, count, 0))))
        self.ends = np.cumsum(self.vocabulary.size[self.ids])


class Pair:
    """The two tokenizers of an alignment: a byte-level JSON file and a SentencePiece model."""

    def __init__(self, a_path: str, b_path: str):
        self.a_encoder, self.b_encoder = WordBpe(a_path, PIECES), SentenceBpe(b_path, PIECES)
        inner = self.a_encoder.tokenizer
        names = {i: t for t, i in inner.get_vocab(with_added_tokens=True).items()}
        special = {i: t.content.encode() for i, t in inner.get_added_tokens_decoder().items()}
        byte = {c: b for b, c in byte_letters().items()}
        self.a = Vocabulary([special.get(i) or bytes(byte[c] for c in names.get(i, "")) for i in range(max(names) + 1)])
        self.b = Vocabulary(self.b_encoder.tokens)
        number = range(max(len(self.a.size), len(self.b.size)))
        #: Each id in digits with what follows it, as 8 bytes.
        self.written = np.stack([np.array([f"{i}{sign}" for i in number], dtype="S8").view(np.uint64) for sign in (",", "|", ";", "")])

    def encode(self, values: pa.Array) -> tuple[Tokens, Tokens]:
        """Tokens of a space and each text; none for a text that is empty or does not come back whole."""
        values = pc.fill_null(values, "").cast(pa.large_string())
        spaced = pc.if_else(pc.equal(values, ""), "", pc.binary_join_element_wise(pa.scalar("", pa.large_string()), values, pa.scalar(" ", pa.large_string())))
        raw, offsets = text_bytes(spaced)
        data = np.frombuffer(raw, dtype=np.uint8)
        a = Tokens(self.a, *self.a_encoder.encode(spaced), data, offsets)
        b = Tokens(self.b, *self.b_encoder.encode(spaced), data, offsets)
        if not (kept := a.whole & b.whole).all():
            a.only(kept)
            b.only(kept)
        return a, b


def groups(a_ends: list[int], b_ends: list[int]) -> tuple[list[int], list[int]]:
    """For each place where a token of both ends, in order: one past the indices of the last
    tokens that end there."""
    a_index = dict(zip(a_ends, range(1, len(a_ends) + 1)))
    b_index = dict(zip(b_ends, range(1, len(b_ends) + 1)))
    common = sorted(a_index.keys() & b_index.keys())
    return list(map(a_index.__getitem__, common)), list(map(b_index.__getitem__, common))


class Alignment:
    """The groups of a run's texts: ``a`` and ``b`` have one past each group's last tokens (in
    the run), ``n_groups`` and ``n_links`` are per text, ``links`` the codes
    ``a id << 32 | b id`` of all links."""

    def __init__(self, a: Tokens, b: Tokens):
        self.a_tokens, self.b_tokens = a, b
        a_cuts, b_cuts, count = [], [], []
        a_ends, b_ends = a.ends.tolist(), b.ends.tolist()
        for i, i_end, j, j_end in zip(a.bound.tolist(), a.bound[1:].tolist(), b.bound.tolist(), b.bound[1:].tolist()):
            s, t = groups(a_ends[i:i_end], b_ends[j:j_end])
            a_cuts.append(np.array(s, dtype=np.int64) + i)
            b_cuts.append(np.array(t, dtype=np.int64) + j)
            count.append(len(s))
        none = [np.empty(0, np.int64)]
        self.a, self.b = np.concatenate(a_cuts + none), np.concatenate(b_cuts + none)
        self.n_groups = np.array(count, dtype=np.int64)
        # Tokens without bytes end where the one before does; a slice links each with each.
        a_first = np.searchsorted(a.ends, a.ends[self.a - 1])
        b_first = np.searchsorted(b.ends, b.ends[self.b - 1])
        wide, high = self.a - a_first, self.b - b_first
        n = wide * high
        nth = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        i, j = np.repeat(a_first, n) + nth // np.repeat(high, n), np.repeat(b_first, n) + nth % np.repeat(high, n)
        self.links = a.ids[i].astype(np.int64) << 32 | b.ids[j]
        self.n_links = np.diff(np.concatenate(([0], np.cumsum(n)))[np.concatenate(([0], np.cumsum(self.n_groups)))])

    def written(self, table: np.ndarray) -> Iterator[bytes]:
        """Per text ``a1,a2|b1;a3|b2,b3``: the ids of each group."""
        size = (np.diff(self.a, prepend=0), np.diff(self.b, prepend=0))
        out = np.empty(len(self.a_tokens.ids) + len(self.b_tokens.ids), dtype=np.uint64)
        sign_a, sign_b = np.zeros(len(self.a_tokens.ids), dtype=np.int8), np.zeros(len(self.b_tokens.ids), dtype=np.int8)
        sign_a[self.a - 1] = 1
        sign_b[self.b - 1] = 2
        sign_b[self.b_tokens.bound[1:][np.diff(self.b_tokens.bound) > 0] - 1] = 3
        out[np.arange(len(sign_a)) + np.repeat(self.b - size[1], size[0])] = table[sign_a, self.a_tokens.ids]
        out[np.arange(len(sign_b)) + np.repeat(self.a, size[1])] = table[sign_b, self.b_tokens.ids]
        bound = (self.a_tokens.bound + self.b_tokens.bound).tolist()
        for lo, hi in zip(bound, bound[1:]):
            yield out[lo:hi].tobytes().translate(None, b"\0")


_RUN = ("run long, id array<{id}>, n_a array<long>, n_b array<long>, n_groups array<long>, n_links array<long>, "
        "groups_sha256 array<string>, links array<int>, pairs array<long>, times array<long>")
_PER_TEXT = "id {id}, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def aligned_runs(named: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """One row for each run of texts: per text its id, counts and digest; all texts' links
    as indices into ``pairs``, the run's distinct id pairs, which occur ``times`` times."""
    kind = named.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, number = None, TaskContext.get().partitionId() << 32  # one attempt of a task is committed
        for batch in runs(batches, "text", RUN):
            number += 1
            pair = per_stage(("pair", a_path, b_path), lambda: Pair(a_path, b_path))
            a, b = pair.encode(batch.column("text"))
            found = Alignment(a, b)
            sha = [hashlib.sha256(w).hexdigest() if w else "" for w in found.written(pair.written)]
            pairs, index, times = np.unique(found.links, return_inverse=True, return_counts=True)
            long = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays([
                pa.array([number], pa.int64()), pa.ListArray.from_arrays(pa.array([0, batch.num_rows], pa.int32()), batch.column("id")),
                pa.array([np.diff(a.bound)], long), pa.array([np.diff(b.bound)], long), pa.array([found.n_groups], long),
                pa.array([found.n_links], long), pa.array([sha], pa.list_(pa.string())), pa.array([index.astype(np.int32)], pa.list_(pa.int32())),
                pa.array([pairs], long), pa.array([times], long)],
                names=["run", "id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "links", "pairs", "times"])

    return named.mapInArrow(run, _RUN.format(id=kind))


def pair_counts(found: DataFrame) -> DataFrame:
    """(pair, count, best): the links of each id pair over the corpus, and whether no pair of
    its B id has more."""
    total = (found.select(F.explode(F.arrays_zip("pairs", "times")).alias("p"))
             .groupBy(F.col("p.pairs").alias("pair")).agg(F.sum("p.times").alias("count"))
             .withColumn("b_id", F.col("pair").bitwiseAND(F.lit(0xFFFFFFFF))))
    return total.select("pair", "count", (F.col("count") == F.max("count").over(Window.partitionBy("b_id"))).alias("best"))


def alignments(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: its token, group and link counts, ``n_best`` (links whose pair no
    other pair of its B id outnumbers), ``count_sum`` (the sum of its links' pair counts) and
    the SHA-256 of its groups."""
    named = documents(docs, id_col, text_col).select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    kind = named.schema["id"].dataType.simpleString()
    found = staged(aligned_runs(named, a_path, b_path), "alignment-runs", **{"parquet.block.size": str(RUN_GROUP)})
    counts = staged(pair_counts(found), "alignment-pairs")
    asked = found.select("run", F.posexplode("pairs").alias("at", "pair"))
    # One row for each run and pair of the run: no more than the run has links.
    told = (asked.join(counts, "pair").groupBy("run").agg(
        F.sort_array(F.collect_list(F.struct("at", "count", "best"))).alias("told"))
        .select("run", F.col("told.count").alias("count"), F.col("told.best").alias("best")))

    def per_text(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                value = {n: batch.column(n)[r].values for n in batch.schema.names if n != "run"}
                n = value["n_links"].to_numpy()
                links = value["links"].to_numpy()
                # A run without links has no pairs and so no row of counts.
                count = value["count"].to_numpy() if len(links) else np.empty(0, np.int64)
                best = value["best"].to_numpy(zero_copy_only=False) if len(links) else np.empty(0, bool)
                until = np.concatenate(([0], np.cumsum(n)))
                sums = np.concatenate(([0], np.cumsum(count[links])))[until]
                bests = np.concatenate(([0], np.cumsum(best[links])))[until]
                yield pa.RecordBatch.from_arrays(
                    [value["id"], value["n_a"], value["n_b"], value["n_groups"], value["n_links"],
                     pa.array(np.diff(bests).astype(np.int64)), pa.array(np.diff(sums).astype(np.int64)), value["groups_sha256"]],
                    names=["id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"])

    out = (found.drop("pairs", "times").join(told, "run", "left").mapInArrow(per_text, _PER_TEXT.format(id=kind)))
    return out.withColumnRenamed("id", id_col)
