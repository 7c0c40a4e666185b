"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints one JSON line:
{"metric": "total_sec", "value": N, "unit": "sec", "queries": {...}, "sf": ...,
 "shuffle_bytes": {...}, "rows": {...}}

Timing model (what a daily build does): the raw events are parsed once
into typed staging Parquet ("staging"), then each model / check / ledger
query runs to completion from it (``noop`` sink, so the time is the
Spark work, not result transfer).  Shuffle bytes per query come from
Spark's event log, written to a fresh scratch folder.
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "ip_addresses", "companies", "event_properties", "users", "sessions", "events",
    "dq_suite", "coverage_report", "hour_batches_capped", "resume_points",
    "events_incremental", "sessions_incremental_merge", "events_incremental_table",
    "sessions_incremental_table", "raw_landed_hours", "archive_unpack",
    "stream_events_upsert", "stream_sessions_upsert",
]


def _shuffle_bytes(log_dir: str) -> dict[str, int]:
    files = [f for f in glob.glob(os.path.join(log_dir, "**", "*"), recursive=True)
             if os.path.isfile(f) and not os.path.basename(f).startswith(".")]
    stage_group: dict[int, str] = {}
    out: dict[str, int] = {}
    for f in files:
        with open(f) as fh:
            for line in fh:
                if '"SparkListenerJobStart"' in line:
                    ev = json.loads(line)
                    grp = (ev.get("Properties") or {}).get("spark.jobGroup.id")
                    for sid in ev.get("Stage IDs", []):
                        if grp:
                            stage_group[sid] = grp
                elif '"SparkListenerTaskEnd"' in line:
                    ev = json.loads(line)
                    grp = stage_group.get(ev.get("Stage ID"))
                    if not grp:
                        continue
                    m = (ev.get("Task Metrics") or {}).get("Shuffle Write Metrics") or {}
                    out[grp] = out.get(grp, 0) + int(m.get("Shuffle Bytes Written", 0))
    return out


def _plan_shape(df) -> dict:
    """Shuffle exchanges and broadcasts in the final (AQE) plan of the
    returned DataFrame (steps run earlier by the query, e.g. staging
    writes, are not included)."""
    import re

    qe = df._jdf.queryExecution()
    txt = qe.executedPlan().toString()
    return {"shuffles": len(re.findall(r"(?<![A-Za-z])Exchange hashpartitioning|Exchange (?:rangepartitioning|RoundRobinPartitioning|SinglePartition)", txt)),
            "broadcasts": txt.count("BroadcastExchange"),
            "python": any(k in txt for k in ("PythonUDF", "BatchEvalPython", "ArrowEvalPython"))}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    scratch = tempfile.mkdtemp(prefix="eventloom-bench-")
    log_dir = os.path.join(scratch, "eventlog")
    os.makedirs(log_dir)
    os.environ.setdefault("EVENTLOOM_SCRATCH", os.path.join(scratch, "ckpt"))

    from eventloom.plans.catalog import STEPS, Workspace
    from eventloom.session import get_spark

    spark = get_spark(f"local[{cpus}]", app="eventloom-bench", shuffle_partitions=2 * cpus,
                      extra={"spark.eventLog.enabled": "true", "spark.eventLog.dir": log_dir,
                             "spark.eventLog.compress": "false",
                             "spark.eventLog.rolling.enabled": "false",
                             "spark.driver.memory": "8g"})
    sc = spark.sparkContext

    # JVM warm-up on an unrelated table (not timed)
    spark.read.parquet(f"{sf_dir}/events.parquet").selectExpr("count(*)").collect()

    times: dict[str, float] = {}
    rows: dict[str, int] = {}
    sc.setJobGroup("staging", "staging")
    t0 = time.time()
    w = Workspace(spark, sf_dir)
    stg = w.stg
    times["staging"] = round(time.time() - t0, 3)
    rows["staging"] = stg.count()

    plans: dict[str, dict] = {}
    for name in HEADLINE:
        sc.setJobGroup(name, name)
        t0 = time.time()
        df = STEPS[name](w)
        df.write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t0, 3)
        plans[name] = _plan_shape(df)
    sc.setJobGroup("rows", "rows")
    for name in ("sessions", "events", "users", "dq_suite"):
        rows[name] = STEPS[name](w).count()
    spark.stop()

    sb = _shuffle_bytes(log_dir)
    sf = os.path.basename(sf_dir).replace("sf", "")
    print(json.dumps({
        "metric": "total_sec", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
        "cpus": cpus, "shuffle_bytes": {k: sb.get(k, 0) for k in times}, "rows": rows,
        "plans": plans,
    }))


if __name__ == "__main__":
    main()
