import hashlib
import random
import re
import string

import pytest
from pyspark.sql import functions as F

from eventloom.llm import secrets
from tests.llm.data import documents_of

KINDS = [
    ("assign", re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I), lambda m: len(m[2]) >= 12),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 18),
    ("hex", re.compile(r"[0-9a-f]+"), lambda m: len(m[0]) >= 16),
]


def brute(text):
    spans = []
    for k, (name, pattern, ok) in enumerate(KINDS):
        spans += [(m.start(), k, m.end(), name) for m in pattern.finditer(text or "") if ok(m)]
    return [f"{n}:{s}:{e}" for s, _, e, n in sorted(spans)]


RNG = random.Random(5)
TEXTS = [
    None, "", "nothing here", "token=secret: abcdefghijklmnop", "TOKEN = 'abcdefghijkl' é password:\"short\"",
    "ÀÉ𝒳 api_key=ABCDEFGHIJKLMNOP0123 and AKIAABCDEFGHIJKLMN AKIAAKIA AKIASHORT",
    "x deadbeefdeadbeef00 x " * 3, "a" * 5000 + " Passwd: zzzzzzzzzzzz", "secret==zzzzzzzzzzzzz",
    "apikey : \" q" + "w" * 20, "x deadbeefdeadbeef00 x " * 3,
]


@pytest.fixture(scope="module")
def fixture(spark):
    rows = [(None if i == 0 else i, t, "x") for i, t in enumerate(TEXTS)]
    return spark.createDataFrame(rows, "doc_id long, text string, spans string")


def test_base_spans_equal_brute_force(spark, fixture):
    got = secrets.digest(secrets.scan(fixture)).collect()
    want = {(None if i == 0 else i): brute(t) for i, t in enumerate(TEXTS)}
    assert len(got) == len(TEXTS)
    for r in got:
        base = want[r.doc_id]
        assert r.base_sha256 == hashlib.sha256(",".join(base).encode()).hexdigest()
        assert [x for x in r.spans.split(",") if x and not x.startswith("random")] == base
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(x.startswith(k) for x in base) for k, _, _ in KINDS]


def test_documents_equal_brute_force(spark):
    docs = documents_of(spark, "sf0.001")
    text = {r.doc_id: r.text for r in docs.collect()}
    for r in secrets.digest(secrets.scan(docs)).collect():
        assert r.base_sha256 == hashlib.sha256(",".join(brute(text[r.doc_id])).encode()).hexdigest()


def test_random_tokens_stay_and_structured_ones_go(spark):
    random_tokens = ["".join(RNG.choices(string.ascii_letters + string.digits, k=40)) for _ in range(60)]
    ordered = ["aB1" * 14, "abcdefghijklmnopqrstuvwxyzABCDEFGH0123456789", "A1a" + "a" * 40] * 20
    rows = [(i, f"see {t} here") for i, t in enumerate(random_tokens + ordered)]
    got = {r.doc_id: r.spans for r in secrets.digest(secrets.scan(spark.createDataFrame(rows, "doc_id long, text string"))).collect()}
    assert sum("random:4:44" in got[i] for i in range(60)) >= 57
    assert not any("random" in got[i] for i in range(60, 120))


def test_redaction(spark, fixture):
    out = {r.doc_id: r for r in secrets.redact(fixture.withColumn("n_chars", F.length("text"))).collect()}
    assert out[None].text is None and out[1].text == "" and out[2].text == "nothing here"
    assert out[6].text == "x [SECRET] x " * 3 and out[6].n_chars == len(out[6].text)
    assert out[4].text.startswith("[SECRET]' é") and out[2].spans == "x"
    assert len(out) == len(TEXTS)


def test_empty_table(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert secrets.digest(secrets.scan(none)).count() == 0
    assert secrets.redact(none).count() == 0
