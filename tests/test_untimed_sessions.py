"""Session loads by merged partials over staging with events that have no time."""

import pytest
from pyspark.sql import functions as F

from conftest import oracle, rows_of
from eventloom.operators import facts
from eventloom.plans import catalog as C
from eventloom.plans import dag


@pytest.mark.parametrize("name", ["sessions_incremental_merge_whole", "sessions_merge_whole_late_untimed"])
def test_whole_staging_equals_the_model(w, name):
    assert w.stg.where("event_time is null and session_id_raw is not null").count() > 0
    assert rows_of(C.STEPS[name](w)) == rows_of(oracle(name))


def test_runner_merges_untimed_rows(w, tmp_path):
    first = C._seed_split(w.stg).where(F.col("event_time").isNotNull())
    dag.run(w.spark, str(tmp_path), inputs={"stg_events": first}, models=["sessions"])
    t = dag.run(w.spark, str(tmp_path), inputs={"stg_events": w.stg}, models=["sessions"], session_mode="merge_partials")
    got, want = t["sessions"].drop("session_date"), facts.sessions(w.stg)
    assert rows_of(got.select(*sorted(got.columns))) == rows_of(want.select(*sorted(got.columns)))
