"""Spelling variants: words one edit apart, found in permuterm rotations.

A word is marked with a terminator and rotated at every character.  Two words
that differ by one replaced character share, among their rotations, a prefix
that ends just before that character; a word with one character more has the
whole rotation of the shorter word as such a prefix.  Each rotation therefore
stands under two prefixes, all of it and all but the edited character, and the
words of one prefix are exactly each other's neighbours there.

A prefix holds one word for each character of the alphabet and one shorter
word, so its range is bounded by the alphabet whatever the corpus; ranges are
dealt by their prefix.  A character inside a run of equal ones can be left out
at several places with one result; only the first counts as a missing one.

Defined cases: NULL and empty texts have no words; a NULL id counts as the
empty text where runs are drawn for deletion; repeated rows count once each;
no documents or no frequent words give an empty result; texts of any length are
read whole, a bounded number of distinct words being held at a time; columns
other than the two named are not read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventloom.llm.common import documents, runs, staged, texts

END = "$"
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
#: ``[A-Za-zÀ-ÿ]+`` in UTF-8, after A-Z went to lower case.
RUN = re.compile(rb"(?:[a-z]|\xc3[\x80-\xbf])+")
#: Distinct words that a task holds before it hands on their counts.
HELD = 200_000
#: A form has at least ``ratio`` times its word's count, so chains of forms are short:
#: with a ratio of 2 and 64-bit counts at most 63 steps, which this many doublings cover.
DOUBLINGS = 6


def counted(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", drawn: int = 199,
            min_chars: int = 6) -> DataFrame:
    """(word, n): occurrences of every word of at least ``min_chars`` code points.  A run of
    a document is drawn if ``drawn`` divides the crc32 h of ``<id>:<run>``; it then loses
    the code point at h modulo its length."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[str] = Counter()

        def hand_on() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays(
                [pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], names=["word", "n"])
            held.clear()
            return out

        for batch in runs(batches, text_col):
            for doc_id, text in zip(batch.column("id").to_pylist(), texts(batch, text_col)):
                found = Counter(RUN.findall(text.encode("utf-8", "surrogatepass").translate(LOWER)))
                begin = zlib.crc32(f"{doc_id or ''}:".encode())
                for raw, n in found.items():
                    h = zlib.crc32(raw, begin)
                    word = raw.decode()
                    if h % drawn == 0:
                        at = h % len(word)
                        word = word[:at] + word[at + 1:]
                    if len(word) >= min_chars:
                        held[word] += n
                if len(held) > HELD:
                    yield hand_on()
        if held:
            yield hand_on()

    named = documents(docs, id_col, text_col).select(F.col(f"`{id_col}`").cast("string").alias("id"), f"`{text_col}`")
    return named.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def rotations(words: DataFrame) -> DataFrame:
    """(prefix, word, n, role): each rotation of ``word`` + END under all of it (role
    'whole'), and under all but the character after it (role 'other', or 'first' where
    that character does not repeat the one before)."""
    at = F.col("at")
    left, here = F.substring("word", F.lit(1), at), F.expr("substring(word, at + 1, 1)")
    whole = F.concat(F.expr("substring(word, at + 1)"), F.lit(END), left)
    less = F.concat(F.expr("substring(word, at + 2)"), F.lit(END), left)
    repeats = (at > 0) & (here == F.expr("substring(word, at, 1)"))
    size = F.char_length("word")
    return (words.select("word", "n", F.explode(F.sequence(F.lit(0), size)).alias("at"))
            .select("word", "n", F.explode(F.array(
                F.struct(whole.alias("prefix"), F.lit("whole").alias("role")),
                F.struct(F.when(at < size, less).alias("prefix"),
                         F.when(repeats, "other").otherwise("first").alias("role")))).alias("r"))
            .select("r.prefix", "word", "n", "r.role").where("prefix is not null"))


def ranges(words: DataFrame) -> DataFrame:
    """(prefix, members): the words of every prefix that has two or more, the most
    frequent first; at most one for each character of the alphabet and one more."""
    member = F.struct((-F.col("n")).alias("minus_n"), "word", "role")
    return (rotations(words).groupBy("prefix").agg(F.sort_array(F.collect_list(member)).alias("members"))
            .where(F.size("members") > 1))


def _near(me: Column, other: Column) -> Column:
    """Whether two members of one prefix are neighbours there: both lack the character
    after it, or the one with a character more lacks it in the one counted place."""
    roles = F.concat(me["role"], other["role"])
    return (me["word"] != other["word"]) & ~roles.isin("wholeother", "otherwhole")


def neighbours(words: DataFrame) -> DataFrame:
    """(word, n, near, near_n): every pair of words one edit apart, in both directions."""
    each = ranges(words).select(F.explode("members").alias("me"), "members")
    return (each.select("me", F.explode("members").alias("other")).where(_near(F.col("me"), F.col("other")))
            .select("me.word", (-F.col("me.minus_n")).alias("n"),
                    F.col("other.word").alias("near"), (-F.col("other.minus_n")).alias("near_n")))


def nearest(words: DataFrame) -> DataFrame:
    """(word, n_near, best): for words with a neighbour their number and the most frequent
    one (ties: the smallest), as a struct (minus_n, word).  Each range is scanned once;
    pairs are not written out."""
    found = ranges(words).select(F.explode(F.transform("members", lambda me: F.struct(
        me["word"].alias("word"),
        F.filter("members", lambda o: _near(me, o)).alias("others")))).alias("m"))
    return (found.where("size(m.others) > 0")
            .select("m.word", F.size("m.others").alias("k"), F.struct(
                F.expr("m.others[0].minus_n").alias("minus_n"), F.expr("m.others[0].word").alias("word")).alias("best"))
            .groupBy("word").agg(F.sum("k").alias("n_near"), F.min("best").alias("best")))


def variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", drawn: int = 199,
             min_chars: int = 6, min_n: int = 5, ratio: int = 5) -> DataFrame:
    """One row per word: n, ``n_near``, its ``form`` (the most frequent neighbour, if that has
    ``ratio`` (2 or more) times its count) with ``form_n``, and the ``root`` its forms lead to."""
    if ratio < 2:
        raise ValueError("a form has at least twice its word's count")
    words = staged(counted(docs, id_col, text_col, drawn, min_chars).where(F.col("n") >= min_n), "spelling-words")
    has_form = -F.col("best.minus_n") >= F.col("n") * ratio
    formed = staged(words.join(nearest(words), "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(has_form, F.col("best.word")).alias("form"),
        F.when(has_form, -F.col("best.minus_n")).alias("form_n")), "spelling-forms")
    up = formed.where("form is not null").select("word", F.col("form").alias("root"))
    for _ in range(DOUBLINGS):
        above = up.select(F.col("word").alias("root"), F.col("root").alias("above"))
        further = up.join(above, "root", "left")
        if not further.where("above is not null").take(1):
            break
        up = staged(further.select("word", F.coalesce("above", "root").alias("root")), "spelling-roots")
    return formed.join(up, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
