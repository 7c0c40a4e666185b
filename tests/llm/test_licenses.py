import re

import pytest
from pyspark.sql import functions as F

from eventloom.llm import licenses
from tests.llm.data import documents_of

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute(text):
    words = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    hits = [(i, label) for phrase, label in licenses.BASE.items() for p in [phrase.split()]
            for i in range(len(words)) if words[i:i + len(p)] == p]
    return (len(words), len(hits), min((i for i, _ in hits), default=None), max((i for i, _ in hits), default=None),
            ",".join(sorted({la for _, la in hits})))


TEXTS = [None, "", "CC BY CC-BY\ncc   by", "cc by cc by nc", "All rights reserved. ALL RIGHTS RESERVED", "ccc by", "cc bý", "ALL-RIGHTS_reserved",
         "GNU General Public License general public license", "x" * 300000 + " cc by", "cc by " * 20000, "²cc by", "ÀCC BY", "cc\x7fby", "cc by"]


def test_base_equals_brute_force(spark):
    docs = spark.createDataFrame([(None if i == 1 else i, t) for i, t in enumerate(TEXTS)] + [(2, TEXTS[2])], "doc_id long, text string")
    docs = docs.withColumns({"n_words": F.lit("x"), "labels": F.lit(1)})
    got = licenses.scan(docs).collect()
    want = [(None if i == 1 else i, *brute(t)) for i, t in enumerate(TEXTS)] + [(2, *brute(TEXTS[2]))]
    assert sorted(map(str, want)) == sorted(str(tuple(r)[:6]) for r in got)
    assert all(0 <= r.score <= 1 for r in got) and licenses.scan(docs.limit(0)).count() == 0


def test_documents_equal_brute_force(spark):
    docs = documents_of(spark, "sf0.01")
    text = {r.doc_id: r.text for r in docs.collect()}
    got = licenses.scan(docs).collect()
    assert len(got) == len(text) and any(r.n_base for r in got)
    for r in got:
        assert tuple(r)[1:6] == brute(text[r.doc_id])
        assert set(r.base_labels.split(",")) - {""} <= set(r.labels.split(","))


@pytest.mark.parametrize(("text", "order"), [
    ("MIT", "MIT"), ("MIT OR Apache-2.0 AND ISC", "MIT Apache-2.0 ISC AND OR"), ("(MIT or GPL-2.0+) and ISC", "MIT GPL-2.0+ OR ISC AND"),
    ("GPL-2.0 WITH Classpath-exception-2.0 OR MIT", "GPL-2.0 Classpath-exception-2.0 WITH MIT OR"), ("a OR b OR c", "a b OR c OR"),
    ("MIT */ more words", "MIT"), ("((MIT))", "MIT"), ("MIT)", "MIT"), ("MIT other words", "MIT")])
def test_shunting_yard(text, order):
    assert " ".join(licenses.postfix(text)) == order


@pytest.mark.parametrize("text", ["", "AND", "MIT OR", "(MIT", "OR MIT", "()", "MIT AND OR ISC", "--"])
def test_malformed_expressions(text):
    with pytest.raises(ValueError):
        licenses.postfix(text)


def test_evaluation_and_tags():
    assert licenses.evaluate("MIT OR GPL-3.0") == ({"mit", "gpl-3.0"}, 1.0)
    assert licenses.evaluate("MIT AND GPL-3.0")[1] == 0.4 and licenses.evaluate("GPL-2.0 WITH X")[1] == pytest.approx(0.6)
    *_, labels, score, value = licenses.Scanner().scan("// SPDX-License-Identifier: (MIT OR LGPL-2.1) AND CC-BY-NC-4.0 */\ncode")
    assert labels == "cc-by,cc-by-nc,cc-by-nc-4.0,lgpl-2.1,mit,spdx" and value == 0.2 and score > 0.9
    *_, labels, score, value = licenses.Scanner().scan("SPDX-License-Identifier: OR\n")
    assert labels == "spdx" and value is None
    *_, base, labels, score, value = licenses.Scanner().scan("Licensed under CC BY-NC 4.0. Released under the MIT License.")
    assert base == "cc-by" and labels == "cc-by,cc-by-nc,mit"
