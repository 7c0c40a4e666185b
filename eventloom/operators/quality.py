"""Declarative data-quality checks (not_null, unique, relationships).

Each check has two forms: the failing rows (for inspection) and a
failure count (for the suite).  The suite reads each model once for all
of its checks: checked columns are unpivoted into ``(check, value)``
pairs and counted per value with map-side partial aggregation, so no
check moves raw rows through one task and a hot value (a third of the
rows on one key) is one row per map task before the shuffle.

* not_null: NULL rows emit a marker; failures = its count.
* unique: values counted more than once.
* relationships: counted child values absent from the parent's keys.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Check:
    model: str
    column: str
    kind: str                # "not_null" | "unique" | "relationships"
    to: str | None = None    # parent model (relationships)
    field: str | None = None  # parent column (relationships)

    @property
    def ref(self) -> str | None:
        return f"{self.to}.{self.field}" if self.kind == "relationships" else None


def _nn(model, *cols):
    return [Check(model, c, "not_null") for c in cols]


def _un(model, *cols):
    return [Check(model, c, "unique") for c in cols]


def _rel(model, col, to, field):
    return [Check(model, col, "relationships", to, field)]


# The 38 declared checks (25 not_null, 7 unique, 6
# relationships) on the raw source, staging and the six models.
CHECKS: list[Check] = [
    *_nn("raw_events", "json_data"),
    *_nn("stg_events", "uuid", "event_time", "event_type"),
    *_un("events", "event_id"),
    *_nn("events", "event_id", "session_id", "amplitude_id", "event_time", "event_type"),
    *_rel("events", "session_id", "sessions", "session_id"),
    *_rel("events", "amplitude_id", "users", "amplitude_id"),
    *_rel("events", "ip_address_id", "ip_addresses", "ip_address_id"),
    *_rel("events", "event_properties_id", "event_properties", "event_properties_id"),
    *_un("users", "amplitude_id"),
    *_nn("users", "amplitude_id", "last_seen"),
    *_rel("users", "ip_address_id", "ip_addresses", "ip_address_id"),
    *_un("sessions", "session_id"),
    *_nn("sessions", "session_id", "session_id_raw", "amplitude_id", "session_start",
         "session_end", "event_count", "location_id"),
    *_rel("sessions", "amplitude_id", "users", "amplitude_id"),
    *_un("ip_addresses", "ip_address_id", "ip_address"),
    *_nn("ip_addresses", "ip_address_id", "ip_address"),
    *_un("event_properties", "event_properties_id"),
    *_nn("event_properties", "event_properties_id", "properties_json"),
    *_un("companies", "company_id"),
    *_nn("companies", "company_id", "company", "ip_address"),
]

RESULT_COLUMNS = ["model", "column", "check", "ref", "failures", "status"]


# -- failing rows -----------------------------------------------------------

def not_null(df: DataFrame, *cols: str) -> DataFrame:
    """Rows where any of ``cols`` is NULL."""
    return df.where(reduce(lambda a, b: a | b, [F.col(c).isNull() for c in cols]))


def unique(df: DataFrame, col: str) -> DataFrame:
    """Non-NULL values of ``col`` seen more than once, with their counts."""
    return (df.where(F.col(col).isNotNull()).groupBy(col)
              .agg(F.count(F.lit(1)).alias("n_records"))
              .where(F.col("n_records") > 1))


def relationships(child: DataFrame, col: str, parent: DataFrame, field: str) -> DataFrame:
    """Non-NULL child values absent from ``parent.field``, with row counts."""
    per_value = (child.where(F.col(col).isNotNull()).groupBy(col)
                      .agg(F.count(F.lit(1)).alias("n_records")))
    keys = parent.select(F.col(field).alias(col)).where(F.col(col).isNotNull())
    return per_value.join(keys, col, "left_anti")


# -- failure counts ---------------------------------------------------------

def _with_status(df: DataFrame) -> DataFrame:
    status = F.when(F.col("failures") == 0, F.lit("pass")).otherwise(F.lit("fail"))
    return df.select(*RESULT_COLUMNS[:-1], status.alias("status"))


def model_check_counts(df: DataFrame, model: str, checks: list[Check],
                       parents: dict[str, DataFrame]) -> DataFrame:
    """Every check of one model from one scan of it and one of each parent's key.

    Each checked column is unpivoted into ``(check id, value)`` pairs: a
    not_null check emits a marker for NULL rows only, unique and
    relationships checks emit the non-NULL value.  Pairs are counted per
    value with map-side partial aggregation (a hot value is one row per map
    task) in one grouping that the parents' keys go into too, as pairs that
    count nothing, and one grouping by check id adds up what failed:
    * not_null: the marker's count;
    * unique: values counted more than once;
    * relationships: row counts of values without a parent key.
    Values are compared as strings, which is exact for the key types used
    (md5 text and integer ids).
    """
    return check_failures(checked_values(df, checks).withColumn("n", F.lit(1).cast("bigint")), model, checks, parents)


def checked_values(df: DataFrame, checks: list[Check], *by: str) -> DataFrame:
    """A (check id, value) pair for every row and checked column, with ``by`` if given."""
    def emitted(c: Check):
        col = F.col(c.column)
        return F.when(col.isNull(), F.lit("")) if c.kind == "not_null" else col.cast("string")

    pairs = F.array(*[F.struct(F.lit(i).alias("cid"), emitted(c).alias("val")) for i, c in enumerate(checks)])
    return df.select(*by, F.inline(pairs)).where(F.col("val").isNotNull())


def counted_values(df: DataFrame, checks: list[Check], *by: str) -> DataFrame:
    """(check id, value, n) of every checked column, for each ``by`` if given."""
    return checked_values(df, checks, *by).groupBy(*by, "cid", "val").agg(F.count(F.lit(1)).alias("n"))


def check_failures(counts: DataFrame, model: str, checks: list[Check], parents: dict[str, DataFrame]) -> DataFrame:
    """The failures of each check from a model's values with their counts; a value may have several rows."""
    ids = {k: [i for i, c in enumerate(checks) if c.kind == k] for k in ("not_null", "unique", "relationships")}
    counts = counts.select("cid", "val", "n", F.lit(False).alias("known"))
    if ids["relationships"]:
        by_parent: dict[tuple[str, str], list[int]] = {}
        for i in ids["relationships"]:
            by_parent.setdefault((checks[i].to, checks[i].field), []).append(i)
        keys = reduce(DataFrame.unionByName, [
            parents[to].where(F.col(field).isNotNull()).select(
                F.explode(F.array(*[F.lit(i) for i in cids])).alias("cid"), F.col(field).cast("string").alias("val"),
                F.lit(0).cast("bigint").alias("n"), F.lit(True).alias("known"))
            for (to, field), cids in by_parent.items()])
        counts = counts.unionByName(keys)
    # values and parents' keys meet in one grouping: one shuffle, no sort and no join
    counts = counts.groupBy("cid", "val").agg(F.sum("n").alias("n"), F.max("known").alias("known"))
    cid, n = F.col("cid"), F.col("n")
    failed = (F.when(cid.isin(ids["not_null"]), n)
              .when(cid.isin(ids["unique"]), (n > 1).cast("bigint"))
              .when(~F.col("known"), n).otherwise(F.lit(0)))
    found = counts.groupBy("cid").agg(F.sum(failed).alias("failures"))
    listing = counts.sparkSession.createDataFrame(
        [(i, c.column, c.kind, c.ref) for i, c in enumerate(checks)],
        "cid int, column string, check string, ref string")
    return (listing.join(found, "cid", "left")
                   .select(F.lit(model).alias("model"), "column", "check", "ref",
                           F.coalesce(F.col("failures"), F.lit(0)).cast("bigint").alias("failures")))


def run_suite(models: dict[str, DataFrame], checks: list[Check] = CHECKS,
              kinds: tuple[str, ...] = ("not_null", "unique", "relationships")) -> DataFrame:
    """All checks as one DataFrame ``(model, column, check, ref, failures, status)``.

    One scan per model for all of its checks (see :func:`model_check_counts`).
    Checks on models missing from ``models`` (or whose parent is missing)
    are skipped.
    """
    by_model: dict[str, list[Check]] = {}
    for c in checks:
        if c.kind not in kinds or c.model not in models:
            continue
        if c.kind == "relationships" and c.to not in models:
            continue
        by_model.setdefault(c.model, []).append(c)
    if not by_model:
        raise ValueError("no checks apply to the given models")
    parts = [model_check_counts(models[m], m, cs, models) for m, cs in by_model.items()]
    return _with_status(reduce(DataFrame.unionByName, parts))
