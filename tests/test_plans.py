import pytest
from pyspark.sql import functions as F

from conftest import oracle, rows_of
from eventloom.plans import catalog as C
from eventloom.plans import dag

MODEL_QUERIES = ["ip_addresses", "companies", "event_properties", "users", "sessions", "events",
                 "coverage_report", "hour_batches_capped"]


def plan_text(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", MODEL_QUERIES)
def test_no_python_udf_no_cartesian_no_global_window(w, name):
    p = plan_text(C.STEPS[name](w))
    for bad in ("PythonUDF", "BatchEvalPython", "ArrowEvalPython", "CartesianProduct",
                "BroadcastNestedLoopJoin", "SinglePartition"):
        assert bad not in p, f"{name}: {bad}"


def test_top1_uses_window_group_limit(w):
    assert "WindowGroupLimit" in plan_text(C.q_events(w))


def test_properties_are_serialised_once(w):
    """Staging carries their text and keys; no model renders them again."""
    for name in ("events", "event_properties"):
        assert "to_json" not in plan_text(C.STEPS[name](w)).lower(), name


def test_suite_scans_each_table_once_per_use(w):
    """One scan of a model's own files and one of each parent's key."""
    from eventloom.operators import quality

    models = w.built()
    for model in ("events", "users", "sessions"):
        own = [c for c in quality.CHECKS if c.model == model]
        parents = {(c.to, c.field) for c in own if c.kind == "relationships"}
        p = plan_text(quality.model_check_counts(models[model], model, own, models))
        assert p.count("FileScan parquet") == 1 + len(parents), model


def test_ledger_reads_the_hours_once(w):
    for name in ("coverage_report", "resume_points", "hours_missing"):
        assert plan_text(C.STEPS[name](w)).count("FileScan parquet") == 1, name


def test_scan_prunes_columns_and_pushes_filters(w):
    stg = w.stg
    df = stg.where(F.col("event_time") > F.lit("2024-01-20 00:00:00").cast("timestamp_ntz")).select("uuid")
    p = plan_text(df)
    assert "PushedFilters: [IsNotNull(event_time), GreaterThan(event_time" in p
    assert "ReadSchema: struct<event_time:timestamp_ntz,uuid:string>" in p


def test_runner_incremental_equals_full_build(spark, w, tmp_path_spark):
    stg = w.stg
    mark = F.lit(C.SEED_MARK).cast("timestamp_ntz")
    out = tmp_path_spark("dag")
    dag.run(spark, out, inputs={"stg_events": stg.where(F.col("event_time") <= mark)})
    t = dag.run(spark, out, inputs={"stg_events": stg})   # events, sessions incremental
    full = dag.run(spark, tmp_path_spark("dag-full"), inputs={"stg_events": stg})
    for name in ("sessions", "events", "users"):
        # a stored event keeps the company known when it was loaded
        a, b = (x[name].drop("company_name") for x in (t, full))
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0, name
    # full refresh rebuilds from scratch and equals the incremental result
    fr = dag.run(spark, out, inputs={"stg_events": stg}, models=["events"], full_refresh=True)
    assert fr["events"].exceptAll(full["events"]).count() == 0
    # column comments travel with the table
    fields = {f.name: f.metadata for f in t["events"].schema.fields}
    assert "comment" in fields["event_id"]


def test_runner_selection_reads_parents(spark, w, tmp_path_spark):
    stg = w.stg
    n = C.q_users(w).count()
    out = tmp_path_spark("dag-sel")
    with pytest.raises(ValueError):
        dag.run(spark, out, inputs={"stg_events": stg}, models=["users"])
    t = dag.run(spark, out, inputs={"stg_events": stg}, models=["users"], with_parents=True)
    assert t["users"].count() == n
    t2 = dag.run(spark, out, inputs={"stg_events": stg}, models=["users"])
    assert t2["users"].count() == n
    assert dag.expand(["staging", "users"]) == ["stg_events", "users"] and set(dag.expand(["silver"])) == set(dag.REGISTRY) - {"stg_events"}
    # catalog tables over the built folders, with the models' descriptions
    assert dag.publish(spark, out, "t_") == [f"t_silver.{m}" for m in ("ip_addresses", "companies", "users")]
    assert spark.table("t_silver.users").count() == n
    assert spark.catalog.getTable("t_silver.users").description


def test_entry_contract(spark):
    import __spark_entry__ as E

    assert rows_of(E.entry(spark)) == rows_of(oracle("sessions"))
    qs, ors = E.queries(), E.oracle_sql()
    assert set(ors) <= set(qs)
