"""Licence scans: Aho-Corasick over words, and licence expressions by a shunting-yard.

Texts become lower-case words with one blank between them, and one automaton
finds all phrases at once, overlapping ones too, at word borders only.  Where
it meets the words of the SPDX tag, the expressions after such tags in the text
are read: a shunting-yard parser (WITH before AND before OR, parentheses) turns
each into postfix order, which is evaluated twice: as the set of identifiers
named, and as openness, where OR lets the reader choose the most open part, AND
binds to the least open one, and WITH an exception lifts a licence.

``score`` is the certainty that the text states a licence: each kind of
evidence found counts once, as independent evidence.  ``openness`` is that of the
least open expression, NULL if none can be read.

Defined cases: NULL text counts as empty; no words give zero counts, NULL
positions, empty labels and score 0; a malformed expression is no evidence but
for its tag; repeated rows are scanned each; NULL ids are kept; other columns
are not looked at.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.llm.common import WORD_BYTES, documents, runs, texts

#: Phrases whose places are counted, with their labels.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
#: Further notices: label and certainty.
NOTICES = {
    "mit license": ("mit", 0.9), "permission is hereby granted free of charge": ("mit", 0.95),
    "apache license": ("apache", 0.9), "bsd license": ("bsd", 0.9), "bsd 2 clause": ("bsd", 0.9), "bsd 3 clause": ("bsd", 0.9),
    "redistribution and use in source and binary forms": ("bsd", 0.95), "isc license": ("isc", 0.9), "zlib license": ("zlib", 0.9),
    "mozilla public license": ("mpl", 0.9), "eclipse public license": ("epl", 0.9), "boost software license": ("bsl", 0.9),
    "lesser general public license": ("lgpl", 0.9), "affero general public license": ("agpl", 0.9),
    "creative commons": ("cc", 0.7), "cc by sa": ("cc-by-sa", 0.9), "cc by nc": ("cc-by-nc", 0.9), "cc by nd": ("cc-by-nd", 0.9),
    "cc0": ("cc0", 0.8), "public domain": ("public-domain", 0.5), "unlicense": ("unlicense", 0.6), "proprietary and confidential": ("proprietary", 0.8),
}
BASE_CERTAINTY, TAG_CERTAINTY, EXPRESSION_CERTAINTY = 0.7, 0.5, 0.98
TAG = "spdx license identifier"
TAGGED = re.compile(r"spdx-license-identifier:[ \t]*([^\r\n]*)", re.IGNORECASE)
TOKEN = re.compile(r"[()]|[A-Za-z0-9.+-]+")
OPERATORS = {"WITH": 3, "AND": 2, "OR": 1}
#: Openness by the beginning of a lower-case identifier, the longest that fits.
OPENNESS = {"": 0.3, "mit": 1.0, "isc": 1.0, "bsd": 1.0, "apache": 1.0, "zlib": 1.0, "cc0": 1.0, "unlicense": 1.0, "bsl": 1.0, "cc-by": 0.9,
            "cc-by-sa": 0.6, "cc-by-nd": 0.2, "cc-by-nc": 0.2, "mpl": 0.7, "epl": 0.7, "lgpl": 0.6, "gpl": 0.4, "agpl": 0.3}
EXCEPTION_LIFT = 0.2


def postfix(expression: str) -> list[str]:
    """Shunting-yard: the identifiers and operators in postfix order.

    Reading stops at the first character that cannot belong to an expression; what was
    read must be one complete expression, else ValueError.
    """
    out, stack, operand, at = [], [], True, 0
    for m in TOKEN.finditer(expression):
        if expression[at:m.start()].strip():
            break
        at, token = m.end(), m[0]
        name = token.upper()
        if token == "(":
            if not operand:
                break
            stack.append(token)
        elif token == ")":
            if operand:
                raise ValueError("an operand is missing")
            if "(" not in stack:
                break
            while stack[-1] != "(":
                out.append(stack.pop())
            stack.pop()
        elif name in OPERATORS:
            if operand:
                raise ValueError("an operand is missing")
            while stack and stack[-1] != "(" and OPERATORS[stack[-1]] >= OPERATORS[name]:
                out.append(stack.pop())
            stack.append(name)
            operand = True
            continue
        else:
            if not operand or not any(c.isalnum() for c in token):
                break
            out.append(token)
        operand = token == "("
    if operand or "(" in stack:
        raise ValueError("the expression is not complete")
    return out + stack[::-1]


def openness(identifier: str) -> float:
    return OPENNESS[max((p for p in OPENNESS if identifier.lower().startswith(p)), key=len)]


def evaluate(expression: str) -> tuple[set[str], float]:
    """The identifiers named (lower case) and the openness of a licence expression."""
    stack: list[tuple[set[str], float]] = []
    for token in postfix(expression):
        if token not in OPERATORS:
            stack.append(({token.lower()}, openness(token)))
            continue
        (b, y), (a, x) = stack.pop(), stack.pop()
        if token == "WITH":
            stack.append((a, min(1.0, x + EXCEPTION_LIFT)))
        else:
            stack.append((a | b, max(x, y) if token == "OR" else min(x, y)))
    return stack[0]


class Scanner:
    def __init__(self) -> None:
        self.automaton = ahocorasick.Automaton()
        for phrase in {*BASE, *NOTICES, TAG}:
            self.automaton.add_word(f" {phrase} ", phrase)
        self.automaton.make_automaton()

    def scan(self, text: str) -> tuple:
        """(n_words, n_base, first_word, last_word, base labels, labels, score, openness)."""
        words = text.encode("utf-8", "surrogatepass").translate(WORD_BYTES).split()
        line = " " + b" ".join(words).decode("latin-1") + " "
        base: dict[str, int] = {}
        first = last = None
        notices: set[str] = set()
        at = blanks = 0
        for end, phrase in self.automaton.iter(line):
            if phrase not in BASE:
                notices.add(phrase)
                continue
            begin = end - len(phrase) - 1
            blanks += line.count(" ", at, begin) if begin >= at else -line.count(" ", begin, at)
            at = begin
            base[phrase] = base.get(phrase, 0) + 1
            first = blanks if first is None else min(first, blanks)
            last = blanks if last is None else max(last, blanks)
        labels, doubt, open_to = {BASE[p] for p in base}, 1.0, None
        base_labels = ",".join(sorted(labels))
        for label in {BASE[p] for p in base}:
            doubt *= 1 - BASE_CERTAINTY
        certain: dict[str, float] = {}
        for label, certainty in (NOTICES[p] for p in notices if p != TAG):
            certain[label] = max(certainty, certain.get(label, 0.0))
        if TAG in notices:
            certain["spdx"] = TAG_CERTAINTY
            for m in TAGGED.finditer(text):
                try:
                    named, value = evaluate(m[1])
                except ValueError:
                    continue
                certain |= dict.fromkeys(named, EXPRESSION_CERTAINTY)
                open_to = value if open_to is None else min(open_to, value)
        for label in sorted(certain):
            doubt *= 1 - certain[label]
        return len(words), sum(base.values()), first, last, base_labels, ",".join(sorted(labels | certain.keys())), 1 - doubt, open_to


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: the id, n_words, n_base, first_word, last_word, base_labels, labels, score, openness."""
    names = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "openness"]
    kinds = ["long", "long", "long", "long", "string", "string", "double", "double"]
    types = {"long": pa.int64(), "string": pa.string(), "double": pa.float64()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner()
        for batch in runs(batches, text_col):
            columns = zip(*map(scanner.scan, texts(batch, text_col)))
            yield pa.RecordBatch.from_arrays([batch.column("__id"), *(pa.array(c, types[k]) for c, k in zip(columns, kinds))], names=["__id", *names])

    rows = documents(docs, id_col, text_col).select(F.col(id_col).alias("__id"), text_col)
    schema = f"__id {docs.schema[id_col].dataType.simpleString()}, " + ", ".join(f"{n} {k}" for n, k in zip(names, kinds))
    return rows.mapInArrow(run, schema).withColumnRenamed("__id", id_col)
