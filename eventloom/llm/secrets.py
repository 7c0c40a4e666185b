"""Secret scans: patterns plus a battery of randomness tests, in DataFrame functions only.

Three patterns find credentials by their form.  Beside them every run of
``[A-Za-z0-9+/_-]{16,}``, and every part of 16 or more characters between its
separators ``+ / _ -``, is a token (so a prefix hides nothing).  Its characters
infer an encoding: hexadecimal, base 36 in one case without or with
separators, base 64 if both cases occur.  Tokens of one case need a digit, and
those without a letter are numbers; these two are not tested.  The others are
put to three tests of the hypothesis "uniformly random in that encoding":

* chi-squared statistic of the alphabet counts (upper tail),
* Wald-Wolfowitz runs above and below the middle of the alphabet,
* serial correlation at lag one of the alphabet positions,

joined by Fisher's method into one p-value.  Tokens are then dismissed as
structured by the Benjamini-Hochberg procedure, run separately for every
(encoding, length doubling) over the whole corpus: a short token competes with
short tokens only.

At 16 characters those tests see little, so what they leave is no discovery
yet.  The discoveries, spans of kind ``random``, are the tokens that reject
the opposite hypothesis, "a natural identifier": words, numbers and separators
by a chain of character classes (``CHAIN``), the letters by pair counts of all
words of the corpus outside the runs.  The ratio of a token's uniform to its
natural probability, divided by the number of encodings to choose from, has a
mean of at most one for natural identifiers, so its inverse is a p-value.
Benjamini-Hochberg on these (1 for dismissed tokens), again for every encoding
and length doubling, keeps the expected share of natural identifiers among the
spans of a class below ``fdr``, however the tokens depend on each other, as far
as identifiers follow that model.

The procedure needs ranks; they come from a histogram of the p-values
(``BINS`` per decade, rounded upwards), so nothing is sorted or gathered whole.

Defined cases: NULL text counts as empty; an empty text or table has no spans;
a run and a part of it may both be found;
a NULL id stays NULL; repeated rows are scanned each for itself; spans count
code points, the end exclusive; other columns are not looked at.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from eventloom.llm.common import documents, staged, unused

#: Order of kinds at the same start.
KINDS = ("assign", "access", "hex", "random")
ASSIGN = (r"(?i)(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?"
          r"([A-Za-z0-9+/_.=-]+)")
#: ``AKIA[A-Z0-9]+`` of 18 characters or more, and ``[0-9a-f]+`` of 16 or more: a
#: run that is too short holds no long enough match further on, so the least
#: length can stand in the pattern.
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
TOKEN = r"[A-Za-z0-9+/_-]{16,}"

HITS = "array<struct<kind:int,i:int,gap:int,len:int,ok:boolean,token:string>>"
DIGITS = "0123456789"
LOWER = "abcdefghijklmnopqrstuvwxyz"
ALPHABETS = {
    "hex": DIGITS + "abcdef",
    "HEX": DIGITS + "ABCDEF",
    "base36": DIGITS + LOWER,
    "BASE36": DIGITS + LOWER.upper(),
    "base36+": DIGITS + LOWER + "+/-_",
    "BASE36+": DIGITS + LOWER.upper() + "+/-_",
    "base64": LOWER.upper() + LOWER + DIGITS + "+/-_",
}
SYMBOLS = ALPHABETS["base64"]
#: Classes of characters in identifiers (lower, upper, digit, other; ^ is the start):
#: the probability of each after each.
CHAIN = {"^": (0.50, 0.30, 0.15, 0.05), "l": (0.85, 0.05, 0.05, 0.05), "u": (0.60, 0.34, 0.03, 0.03),
         "d": (0.15, 0.10, 0.60, 0.15), "s": (0.50, 0.20, 0.25, 0.05)}
#: Letters a to z in English text, per thousand: what is known before any pair is counted,
#: with the weight of PRIOR words.
ENGLISH = (82, 15, 28, 43, 127, 22, 20, 61, 70, 2, 8, 40, 24, 67, 75, 19, 1, 60, 63, 91, 28, 10, 24, 2, 20, 1)
PRIOR = 20.0
#: Histogram cells of -log10(p) for each factor of ten.
BINS = 50
MASK = "[SECRET]"


def _hits(text: Column, kind: int, pattern: str, ok) -> Column:
    """Matches of a pattern, each with the length of the gap before it.

    Gaps and matches alternate, so a running sum of their lengths gives every
    position without a search for each match.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.slice(F.split(text, pattern, -1), F.lit(1), F.size(found))
    value = F.regexp_extract_all(text, F.lit(pattern), F.lit(2)) if kind == 0 else found
    hit = F.transform(
        F.arrays_zip(gaps.alias("g"), found.alias("m"), value.alias("v")),
        lambda x, i: F.struct(
            F.lit(kind).alias("kind"), i.alias("i"), F.length(x["g"]).alias("gap"),
            F.length(x["m"]).alias("len"), ok(x["v"]).alias("ok"),
            (x["m"] if kind == 3 else F.lit("")).alias("token")))
    # Most texts have no match and cost one search.
    return F.when(text.rlike(pattern), hit).otherwise(F.expr("array()").cast(HITS))


def _all_hits(text: Column) -> Column:
    yes = lambda v: F.lit(True)
    return F.concat(_hits(text, 0, ASSIGN, lambda v: F.length(v) >= 12),
                    _hits(text, 1, ACCESS, yes), _hits(text, 2, HEX, yes),
                    _hits(text, 3, TOKEN, yes))


def _encoding(token: Column) -> Column:
    digit, low, up = (token.rlike(p) for p in ("[0-9]", "[a-z]", "[A-Z]"))
    return (F.when(low & up, "base64").when(~digit, None)
            .when(token.rlike("^[0-9a-f]+$") & low, "hex")
            .when(token.rlike("^[0-9A-F]+$") & up, "HEX")
            .when(token.rlike("^[0-9a-z]+$") & low, "base36")
            .when(token.rlike("^[0-9A-Z]+$") & up, "BASE36")
            .when(low, "base36+").when(up, "BASE36+"))


def _with_parts(tokens: DataFrame) -> DataFrame:
    """The runs, and the parts of 16 or more characters of those that have separators."""
    split = tokens.where(F.col("token").rlike("[-_/+]") & F.col("token").rlike("[A-Za-z0-9]{16}"))
    before = Window.partitionBy("__row", "start").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    parts = (split.select("__row", "kind", "start", F.posexplode(F.split("token", "[-_/+]")).alias("pos", "token"))
             .withColumn("from", F.col("start") + F.coalesce(F.sum(F.length("token") + 1).over(before), F.lit(0)))
             .where(F.length("token") >= 16)
             .select("__row", "kind", F.col("from").alias("start"), (F.col("from") + F.length("token")).alias("end"), "token"))
    return tokens.unionByName(parts)


def _tail(z: Column) -> Column:
    """Upper tail of the standard normal at ``|z|`` (a rational approximation)."""
    x = F.abs(z)
    t = 1 / (1 + 0.2316419 * x)
    poly = F.lit(1.330274429)
    for c in (-1.821255978, 1.781477937, -0.356563782, 0.319381530):
        poly = poly * t + c
    return F.exp(-x * x / 2) * 0.3989422804014327 * poly * t


def randomness(tokens: DataFrame) -> DataFrame:
    """Adds ``p``: the battery's joint p-value of ``token`` in ``encoding``."""
    alphabet = F.element_at(F.create_map(*[F.lit(x) for kv in ALPHABETS.items() for x in kv]),
                            F.col("encoding"))
    idx = F.transform(F.split("token", ""), lambda c: F.instr(F.col("alphabet"), c) - 1)
    df = (tokens.withColumn("alphabet", alphabet)
          .withColumn("k", F.length("alphabet").cast("double"))
          .withColumn("n", F.length("token").cast("double"))
          .withColumn("idx", F.filter(idx, lambda x: x >= 0)))
    squares = F.aggregate(
        F.filter(F.split("alphabet", ""), lambda c: c != ""), F.lit(0.0),
        lambda a, c: a + F.pow(F.col("n") - F.length(F.replace(F.col("token"), c, F.lit(""))), F.lit(2.0)))
    high = lambda x: x * 2 >= F.col("k")
    pairs = F.sequence(F.lit(1), F.size("idx") - 1)
    at = lambda i: F.get(F.col("idx"), i)
    df = (df.withColumn("squares", squares)
          .withColumn("n1", F.size(F.filter("idx", high)).cast("double"))
          .withColumn("runs", 1.0 + F.size(F.filter(pairs, lambda i: high(at(i)) != high(at(i - 1)))))
          .withColumn("mean", F.aggregate("idx", F.lit(0.0), lambda a, x: a + x) / F.col("n"))
          .withColumn("cross", F.aggregate(pairs, F.lit(0.0), lambda a, i: a + (at(i) - F.col("mean")) * (at(i - 1) - F.col("mean"))))
          .withColumn("spread", F.aggregate("idx", F.lit(0.0), lambda a, x: a + F.pow(x - F.col("mean"), F.lit(2.0)))))
    n, k, n1 = F.col("n"), F.col("k"), F.col("n1")
    chi = (k / n * F.col("squares") - n - (k - 1)) / F.sqrt(2 * (k - 1) * (n - 1) / n)
    expected = 2 * n1 * (n - n1) / n + 1
    variance = (expected - 1) * (expected - 2) / (n - 1)
    p_chi = F.when(chi > 0, _tail(chi)).otherwise(1 - _tail(chi))
    p_runs = F.when(variance > 0, 2 * _tail((F.col("runs") - expected) / F.sqrt(variance))).otherwise(F.pow(F.lit(2.0), 1 - n))
    p_serial = F.when(F.col("spread") > 0, 2 * _tail((F.col("cross") / F.col("spread") + 1 / n) * F.sqrt(n))).otherwise(F.pow(F.lit(2.0), 1 - n))
    half = -sum((F.log(F.greatest(F.least(p, F.lit(1.0)), F.lit(1e-300))) for p in (p_chi, p_runs, p_serial)), F.lit(0.0))
    return df.withColumn("half", half).withColumn(
        "p", F.exp(-F.col("half")) * (1 + F.col("half") + F.col("half") * F.col("half") / 2)
    ).drop("alphabet", "k", "n", "idx", "squares", "n1", "runs", "mean", "cross", "spread", "half")


def letter_pairs(texts: DataFrame, text_col: str) -> DataFrame:
    """(pair, weight) over all words of letters outside the runs, ``^`` before the first
    letter; a word that occurs n times weighs log2(1 + n).  At most 27 x 26 rows."""
    text = F.col(f"`{text_col}`")
    outside = F.when(text.rlike(TOKEN), F.regexp_replace(text, TOKEN, " ")).otherwise(text)
    words = (texts.select(F.explode(F.regexp_extract_all(outside, F.lit("[A-Za-z]+"), F.lit(0))).alias("word"))
             .groupBy("word").agg(F.log2(1.0 + F.count("*")).alias("weight"))
             .withColumn("word", F.concat(F.lit("^"), F.lower("word"))))
    pairs = F.transform(F.sequence(F.lit(1), F.length("word") - 1), lambda i: F.substring("word", i, F.lit(2)))
    return words.select(F.explode(pairs).alias("pair"), "weight").groupBy("pair").agg(F.sum("weight").alias("weight"))


def natural_costs(spark: SparkSession, weight: dict[str, float]) -> DataFrame:
    """One row, ``costs``: -ln of the probability of each symbol of SYMBOLS in a natural
    identifier, at the start and then after each symbol."""
    known = {c: 0.9 * n / sum(ENGLISH) + 0.1 / 26 for c, n in zip(LOWER, ENGLISH)}
    whole = {a: sum(weight.get(a + c, 0.0) for c in LOWER) for a in "^" + LOWER}
    kind = lambda c: "l" if c in LOWER else "u" if c.lower() in LOWER else "d" if c in DIGITS else "s"

    def cost(before: str, c: str) -> float:
        p = CHAIN["^" if before == "^" else kind(before)]["luds".index(kind(c))]
        if kind(c) in "lu":
            a = before.lower() if before.lower() in LOWER else "^"
            p *= (weight.get(a + c.lower(), 0.0) + PRIOR * known[c.lower()]) / (whole[a] + PRIOR)
        else:
            p /= 10 if kind(c) == "d" else 4
        return -math.log(p)

    flat = ",".join(f"{cost(b, c):.4f}" for b in ("^", *SYMBOLS) for c in SYMBOLS)
    return spark.range(1).select(F.split(F.lit(flat), ",").cast("array<double>").alias("costs"))


def naturalness(tokens: DataFrame, costs: DataFrame) -> DataFrame:
    """Adds ``natural``: the p-value of ``token`` for the hypothesis of a natural identifier.
    In the encodings without small letters capitals count as these."""
    size = F.element_at(F.create_map(*[F.lit(x) for k, v in ALPHABETS.items() for x in (k, float(len(v)))]), F.col("encoding"))
    folded = F.when(F.col("encoding").isin("HEX", "BASE36", "BASE36+"), F.lower("token")).otherwise(F.col("token"))
    place = F.transform(F.filter(F.split(folded, ""), lambda c: c != ""), lambda c: F.instr(F.lit(SYMBOLS), c))
    step = lambda i: F.get("costs", F.when(i == 0, 0).otherwise(F.get("place", i - 1)) * len(SYMBOLS) + F.get("place", i) - 1)
    df = tokens.withColumn("place", place).crossJoin(F.broadcast(costs))
    df = df.withColumn("cost", F.aggregate(F.sequence(F.lit(0), F.size("place") - 1), F.lit(0.0), lambda a, i: a + step(i)))
    ratio = F.col("cost") - F.length("token") * F.log(size) - math.log(len(ALPHABETS))
    return df.withColumn("natural", F.exp(-F.greatest(F.least(ratio, F.lit(690.0)), F.lit(0.0)))).drop("place", "costs", "cost")


def _rejected_below(tokens: DataFrame, p: str, fdr: float) -> DataFrame:
    """For each class the largest p-value that Benjamini-Hochberg rejects.

    At most one row for each encoding and doubling of the length.
    """
    cells = (tokens.withColumn("cell", F.floor(-F.log10(F.greatest(p, F.lit(1e-300))) * BINS))
             .groupBy("encoding", "doubling", "cell").agg(F.count("*").alias("n")))
    own = Window.partitionBy("encoding", "doubling")
    edge = F.pow(F.lit(10.0), -F.col("cell") / BINS)
    return (cells.withColumn("rank", F.sum("n").over(own.orderBy(F.desc("cell"))))
            .withColumn("m", F.sum("n").over(own))
            .where(edge <= fdr * F.col("rank") / F.col("m"))
            .groupBy("encoding", "doubling").agg(F.max(edge).alias(f"{p}_limit")))


def spans_of(rows: DataFrame, texts: DataFrame, text_col: str, fdr: float = 0.01) -> DataFrame:
    """(__row, kind, start, end) of every secret; ``rows`` has __row and __hits, and is
    a written table (it is read twice); ``texts`` has the corpus' texts."""
    # At most 27 x 26 rows.
    costs = natural_costs(rows.sparkSession, {r.pair: r.weight for r in letter_pairs(texts, text_col).collect()})
    hits = rows.select("__row", F.explode("__hits").alias("h")).select("__row", "h.*")
    own = Window.partitionBy("__row", "kind").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    placed = (hits.withColumn("end", F.sum(F.col("gap").cast("long") + F.col("len")).over(own))
              .where("ok").select("__row", "kind", (F.col("end") - F.col("len")).alias("start"), "end", "token"))
    tokens = (_with_parts(placed.where("kind = 3")).withColumn("encoding", _encoding(F.col("token")))
              .where("encoding is not null")
              .withColumn("doubling", F.floor(F.log2(F.length("token")))))
    tested = staged(naturalness(randomness(tokens), costs).select("__row", "kind", "start", "end", "encoding", "doubling", "p", "natural"),
                    "secret-tokens")
    judged = (tested.join(F.broadcast(_rejected_below(tested, "p", fdr)), ["encoding", "doubling"], "left")
              .withColumn("natural", F.when(F.col("p") <= F.col("p_limit"), 1.0).otherwise(F.col("natural"))))
    random = (judged.join(F.broadcast(_rejected_below(judged, "natural", fdr)), ["encoding", "doubling"])
              .where("natural <= natural_limit"))
    same = ["__row", "kind", "start", "end"]
    return placed.where("kind < 3").select(same).unionByName(random.select(same))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", fdr: float = 0.01) -> DataFrame:
    """One row per document: id, and ``spans``, an array of (start, kind, end) in order."""
    rows = staged(documents(docs, id_col, text_col).select(
        F.monotonically_increasing_id().alias("__row"), F.col(id_col),
        _all_hits(F.coalesce(F.col(text_col), F.lit(""))).alias("__hits")), "secret-hits")
    spans = spans_of(rows, docs, text_col, fdr).groupBy("__row").agg(
        F.array_sort(F.collect_list(F.struct("start", "kind", "end"))).alias("spans"))
    return rows.select("__row", id_col).join(spans, "__row", "left").select(
        id_col, F.coalesce("spans", F.expr("array()").cast("array<struct<start:bigint,kind:int,end:bigint>>")).alias("spans"))


def redact(docs: DataFrame, text_col: str = "text", length_col: str | None = "n_chars",
           fdr: float = 0.01) -> DataFrame:
    """The documents with every secret replaced by ``[SECRET]`` (spans that touch or
    overlap: one mark); ``length_col``, where the table has it, follows the new text.
    NULL texts stay NULL, columns and rows stay as they are."""
    columns = docs.columns
    row, hits, marks, last, new = unused(docs, "__row", "__hits", "__spans", "__last", "__clean")
    rows = staged(docs.select(
        *[F.col(f"`{c}`") for c in columns], F.monotonically_increasing_id().alias(row),
        _all_hits(F.coalesce(F.col(f"`{text_col}`"), F.lit(""))).alias(hits)), "redact-hits")
    found = rows.select(F.col(row).alias("__row"), F.col(hits).alias("__hits"))
    before = Window.partitionBy("__row").orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1)
    spans = (spans_of(found, docs, text_col, fdr).withColumn("past", F.coalesce(F.max("end").over(before), F.lit(0)))
             .groupBy(F.col("__row").alias(row)).agg(F.array_sort(F.collect_list(F.struct("start", "end", "past"))).alias(marks),
                                                     F.max("end").alias(last)))
    text = F.col(f"`{text_col}`")
    pieces = F.transform(marks, lambda s: F.when(
        (s["start"] > s["past"]) | (s["start"] == 0),
        F.concat(F.substring(text, (s["past"] + 1).cast("int"), (s["start"] - s["past"]).cast("int")), F.lit(MASK))).otherwise(""))
    clean = F.when(F.col(marks).isNull(), text).otherwise(
        F.concat(F.array_join(pieces, ""), F.substring(text, (F.col(last) + 1).cast("int"), F.length(text))))
    out = rows.drop(hits).join(spans, row, "left").withColumn(new, clean)
    changed = {text_col: F.col(new)}
    if length_col in columns:
        changed[length_col] = F.when(F.col(marks).isNull(), F.col(f"`{length_col}`")).otherwise(
            F.length(new).cast(docs.schema[length_col].dataType))
    return out.select(*[changed.get(c, F.col(f"`{c}`")).alias(c) for c in columns])


def digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts, the digest of the patterns' spans and all spans as text."""
    name = F.array(*[F.lit(k) for k in KINDS])
    listed = lambda spans: F.array_join(F.transform(
        spans, lambda s: F.concat_ws(":", F.get(name, s["kind"]), s["start"], s["end"])), ",")
    base = F.filter("spans", lambda s: s["kind"] < 3)
    count = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long")
    return found.select(id_col, count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
                        F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))
