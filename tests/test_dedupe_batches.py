"""A batch is parsed once, however often its keys are looked up."""

from eventloom.operators.keyed_table import KeyedTable
from eventloom.sources import landing as land
from eventloom.streaming import keyed, stream


def test_dedupe_looks_up_keys_of_a_written_batch(spark, raw_from_json, tmp_path_spark, monkeypatch):
    out, ckpt, src = (tmp_path_spark(n) for n in ("out", "ckpt", "src"))
    seen = []
    monkeypatch.setattr(KeyedTable, "lookup", lambda self, keys, *a, real=KeyedTable.lookup, **k: seen.append(keys.inputFiles()) or real(self, keys, *a, **k))
    for hour in ("00", "01"):
        raw = raw_from_json([f'{{"uuid": "u{i}", "event_time": "2024-01-01 {hour}:00:00"}}' for i in ("same", hour)])
        land.land_hours(land.with_hour_key(raw), src)
        keyed.start_dedupe(stream.stream_staging(spark, src), out, ckpt).awaitTermination()
    assert keyed.unique_table(spark, out).read().count() == 3
    assert len(seen) == 1 and seen[0] and all(f.endswith(".parquet") for f in seen[0])
