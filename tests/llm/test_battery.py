"""The randomness battery and its false-discovery step against plain versions."""

import math
import random
import string
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from eventloom.llm import secrets


def tail(z):
    return 0.5 * math.erfc(abs(z) / math.sqrt(2))


def plain(token, alphabet):
    """(chi-squared, runs, serial) p-values from their textbook formulas."""
    n, k = len(token), len(alphabet)
    place = [alphabet.index(c) for c in token]
    chi2 = sum((place.count(a) - n / k) ** 2 / (n / k) for a in range(k))
    z = (chi2 - (k - 1)) / math.sqrt(2 * (k - 1) * (n - 1) / n)
    p_chi = tail(z) if z > 0 else 1 - tail(z)
    high = [2 * x >= k for x in place]
    n1 = sum(high)
    runs = 1 + sum(a != b for a, b in zip(high, high[1:]))
    expected = 2 * n1 * (n - n1) / n + 1
    variance = (expected - 1) * (expected - 2) / (n - 1)
    p_runs = 2 * tail((runs - expected) / math.sqrt(variance)) if variance > 0 else 2.0 ** (1 - n)
    mean = sum(place) / n
    spread = sum((x - mean) ** 2 for x in place)
    cross = sum((a - mean) * (b - mean) for a, b in zip(place, place[1:]))
    p_serial = 2 * tail((cross / spread + 1 / n) * math.sqrt(n)) if spread else 2.0 ** (1 - n)
    return p_chi, p_runs, p_serial


def fisher(ps):
    half = -sum(math.log(max(min(p, 1.0), 1e-300)) for p in ps)
    return math.exp(-half) * (1 + half + half * half / 2)


TOKENS = {
    "random": ["".join(random.Random(s).choices(string.ascii_letters + string.digits, k=24 + s)) for s in range(12)],
    # each is odd in one way: few letters in chance order; halves in turn; a slow rise
    "chi": ["".join(random.Random(s).choices("qZ7", k=40)) for s in range(4)],
    "runs": ["".join(random.Random(s).choice((string.ascii_uppercase, string.digits)[i % 2]) for i in range(40)) for s in range(4)],
    "serial": ["".join(string.ascii_uppercase[(i * 3 // 2) % 26] if i % 9 else "e" for i in range(40)) + "5" for _ in range(2)],
}


@pytest.fixture(scope="module")
def p_of(spark):
    rows = [(t, "base64") for ts in TOKENS.values() for t in dict.fromkeys(ts)]
    return {r.token: r.p for r in secrets.randomness(spark.createDataFrame(rows, "token string, encoding string")).collect()}


def test_statistics_equal_plain_versions(p_of):
    for token, p in p_of.items():
        want = fisher(plain(token, secrets.ALPHABETS["base64"]))
        assert math.isclose(p, want, rel_tol=1e-3, abs_tol=1e-7), token


def test_each_test_decides_some_token(p_of):
    """Without one of the three the tokens that only it sees would pass at 1 %."""
    for which, name in enumerate(("chi", "runs")):
        for token in TOKENS[name]:
            ps = plain(token, secrets.ALPHABETS["base64"])
            rest = fisher([1.0 if i == which else x for i, x in enumerate(ps)])
            assert p_of[token] < 0.01 and p_of[token] < rest / 10
    for token in TOKENS["serial"]:
        ps = plain(token, secrets.ALPHABETS["base64"])
        assert p_of[token] < 0.01 and p_of[token] < fisher([*ps[:2], 1.0])
    assert sum(p_of[t] > 0.01 for t in TOKENS["random"]) >= 10


def test_false_discovery_step_equals_plain_benjamini_hochberg(spark):
    rng = random.Random(2)
    rows = [(e, d, rng.choice((1, 1, 1e-3, 1e-5)) * rng.random()) for e in ("hex", "base64") for d in (4, 5) for _ in range(rng.randrange(20, 200))]
    df = spark.createDataFrame(rows, "encoding string, doubling long, p double")
    got = {(r.encoding, r.doubling): r.p_limit for r in secrets._rejected_below(df, "p", 0.01).collect()}
    classes = defaultdict(list)
    for e, d, p in rows:
        classes[e, d].append(p)
    for key, ps in classes.items():
        # p-values count as the upper edge of their cell
        edges = sorted(10 ** (-math.floor(-math.log10(max(p, 1e-300)) * secrets.BINS) / secrets.BINS) for p in ps)
        limit = max((p for i, p in enumerate(edges, 1) if p <= 0.01 * sum(q <= p for q in edges) / len(edges)), default=None)
        assert (limit is None) == (key not in got) and (limit is None or math.isclose(limit, got[key], rel_tol=1e-9))
    assert spark.range(0).count() == 0 and secrets._rejected_below(df.where(F.lit(False)), "p", 0.01).count() == 0
