"""Random tokens among natural identifiers of 16 to 32 characters."""

import random
import string

from eventloom.llm import secrets

NAMES = ["docs/Chapter3/Section12", "Windows10UpdateGuide", "iphone14promaxreview", "windows10update2024", "iPhone14ProMaxReview",
         "getUserName2FromDb", "src/main/java8/Handler", "test_utf8_decoder_v2", "HTTP2ConnectionPool", "user-profile-v2-Settings",
         "img/Banner2024Small", "release20240115notes", "covid19vaccination", "Base64EncoderTest", "MAX_BUFFER_SIZE_4096",
         "Python3Programming", "blog/2023/Best10Recipes", "sha256sumOfTheFile"]
PROSE = "the user can read this guide to update the phone and write a review of each section in the chapter "


def spans(spark, tokens, prose=PROSE):
    rows = [(i, f"{prose}see {t} here") for i, t in enumerate(tokens)]
    found = secrets.digest(secrets.scan(spark.createDataFrame(rows, "doc_id long, text string"))).collect()
    at = len(prose) + 4
    return [[x for x in r.spans.split(",") if x.startswith("random")] for r in sorted(found, key=lambda r: r.doc_id)], at


def test_identifiers_are_no_discoveries(spark):
    rng = random.Random(8)
    kinds = [string.ascii_letters + string.digits, string.ascii_lowercase + string.digits, "0123456789abcdef"]
    tokens = ["".join(rng.choices(k, k=n)) for k in kinds for n in (20, 24, 31) for _ in range(10)]
    for prose in (PROSE, ""):
        got, at = spans(spark, tokens + NAMES, prose)
        found = sum(f"random:{at}:{at + len(t)}" in s for t, s in zip(tokens, got))
        wrong = [t for t, s in zip(NAMES, got[len(tokens):]) if s]
        assert found >= 0.95 * len(tokens)
        assert not wrong


def test_a_corpus_of_identifiers_has_no_discoveries(spark):
    got, _ = spans(spark, NAMES * 5)
    assert not any(got)


def test_prefixes_and_separators_hide_nothing(spark):
    rng = random.Random(4)
    lower, upper = string.ascii_lowercase + string.digits, string.ascii_uppercase + string.digits
    pick = lambda k, n: "".join(rng.choices(k, k=n))
    cores = [pick(lower, 32) for _ in range(30)] + [pick(upper, 32) for _ in range(30)]
    prefixes = ["key-", "tok_", "path/", "a/b-c_"]
    tokens = [prefixes[i % 4] + c for i, c in enumerate(cores)]
    letters = [pick(string.ascii_letters, n) for n in (20, 28) for _ in range(15)]
    got, at = spans(spark, tokens + letters + NAMES)
    parts = sum(f"random:{at + len(t) - 32}:{at + len(t)}" in s for t, s in zip(tokens, got))
    whole = sum(f"random:{at}:{at + len(t)}" in s for t, s in zip(letters, got[len(tokens):]))
    assert parts >= 0.95 * len(tokens) and whole >= 0.95 * len(letters)
    assert not any(got[len(tokens) + len(letters):])


def test_prefixed_tokens_are_masked(spark):
    rng = random.Random(6)
    tokens = ["".join(rng.choices(string.ascii_lowercase + string.digits, k=32)) for _ in range(20)]
    docs = spark.createDataFrame([(i, f"{PROSE}key-{t} x/{t}/y end") for i, t in enumerate(tokens)], "doc_id long, text string")
    texts = {r.doc_id: r.text for r in secrets.redact(docs).collect()}
    assert sum(t in texts[i] for i, t in enumerate(tokens)) <= 1


def test_no_words_outside_the_runs(spark):
    rows = [(1, "a1B2" * 10), (2, "-" * 40), (3, "/_+-" * 9 + "x1"), (4, None)]
    got = secrets.digest(secrets.scan(spark.createDataFrame(rows, "doc_id long, text string"))).collect()
    assert len(got) == 4
