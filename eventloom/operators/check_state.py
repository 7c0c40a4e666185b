"""Data-quality checks that follow the loads of a versioned table.

Beside each load of a :class:`KeyedTable` lie its counted check values, for each
partition: (check id, value, how often).  Counts add up, so the state of a table
is the sum over its live (partition, load) pairs, and bringing it up to date
after a load reads that load's rows only; replaced partitions fall out with
their manifest entries.  The suite then reads the state: a few narrow columns in
place of the tables, among them the parents' keys of relationship checks.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.operators.incremental import _exists
from eventloom.operators.keyed_table import LOAD, Entry, KeyedTable
from eventloom.operators.quality import CHECKS, Check, _with_status, check_failures, counted_values, model_check_counts

STATE = f"part string, cid int, val string, n bigint, {LOAD} string"


def checks_of(model: str, checks: list[Check]) -> list[Check]:
    return [c for c in checks if c.model == model]


def uncounted(table: KeyedTable) -> list[Entry]:
    """The live entries whose load has no stored counts yet."""
    entries = table.manifest().entries
    without = {x for x in {e.load for e in entries} if not _exists(table.spark, f"{table.path}/checks/{LOAD}={x}/_counted")}
    return [e for e in entries if e.load in without]


def update(table: KeyedTable, model: str, checks: list[Check] = CHECKS) -> int:
    """Count the loads that have not been counted; their number.  A count that dies is made anew."""
    entries = uncounted(table)
    loads = sorted({e.load for e in entries})
    if not entries:
        return 0
    rows = table._rows(table.manifest(), entries, with_load=True).withColumn("part", F.col(table.partition_by).cast("string"))
    (counted_values(rows, checks_of(model, checks), LOAD, "part").write.partitionBy(LOAD).mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").parquet(f"{table.path}/checks"))
    for load in loads:
        file = table.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{table.path}/checks/{LOAD}={load}/_counted")
        file.getFileSystem(table.spark.sparkContext._jsc.hadoopConfiguration()).create(file, True).close()
    return len(loads)


def state(table: KeyedTable) -> DataFrame:
    """(cid, val, n) of the table as it stands; raises where a load has not been counted."""
    if missing := uncounted(table):
        raise ValueError(f"{len(missing)} partitions of {table.path} are not counted; call update first")
    entries = table.manifest().entries
    if not entries:
        return table.spark.createDataFrame([], "cid int, val string, n bigint")
    # One row for each live partition and load.
    live = table.spark.createDataFrame([(e.part, e.load) for e in entries], "live_part string, live_load string")
    stored = table.spark.read.schema(STATE).option("basePath", f"{table.path}/checks").parquet(
        *[f"{table.path}/checks/{LOAD}={x}" for x in sorted({e.load for e in entries})])
    own = stored.join(live, F.col("part").eqNullSafe(F.col("live_part")) & (F.col(LOAD) == F.col("live_load")), "left_semi")
    return own.groupBy("cid", "val").agg(F.sum("n").alias("n"))


def run_suite(tables: dict[str, KeyedTable], models: dict[str, DataFrame] | None = None, checks: list[Check] = CHECKS) -> DataFrame:
    """All checks, those of ``tables`` from their stored counts, those of ``models`` from their rows."""
    models = dict(models or {})
    states = {name: state(t) for name, t in tables.items()}
    parents = {n: df for n, df in models.items() if n not in tables}
    for name, counts in states.items():
        for i, c in enumerate(checks_of(name, checks)):
            if c.kind == "unique":  # its counted values are the column's keys
                keys = counts.where(F.col("cid") == i).select(F.col("val").alias(c.column))
                parents[name] = keys if name not in parents else parents[name].unionByName(keys, allowMissingColumns=True)
    parts = []
    for name in dict.fromkeys(c.model for c in checks):
        known = [c for c in checks_of(name, checks) if c.kind != "relationships" or c.to in parents]
        if name in states:
            every = checks_of(name, checks)
            if known != every:
                raise ValueError(f"the parents of {name} are missing")
            parts.append(check_failures(states[name], name, every, parents))
        elif name in models and known:
            parts.append(model_check_counts(models[name], name, known, parents))
    if not parts:
        raise ValueError("no checks apply to the given tables")
    return _with_status(reduce(DataFrame.unionByName, parts))
