"""Dimensions after several loads equal the models over all rows."""

import pytest
from pyspark.sql import functions as F

from conftest import oracle, rows_of
from eventloom.operators import dimensions as dims
from eventloom.operators.maintained import Dimensions
from eventloom.plans import catalog as C


@pytest.mark.parametrize("name", ["users_maintained", "companies_maintained", "ip_addresses_maintained", "event_properties_maintained"])
def test_loads_equal_their_oracle(w, name):
    assert rows_of(C.STEPS[name](w)) == rows_of(oracle(name))


def test_a_load_touches_changed_keys_only(spark, w, tmp_path_spark):
    kept = Dimensions(spark, tmp_path_spark("dims"), buckets=16)
    first = w.stg.where("event_time < timestamp_ntz'2024-01-10 00:00:00'")
    kept.load(first)
    kept.load(first)                                   # nothing is new: nothing is written
    before = {n: getattr(kept, n).manifest() for n in ("ips", "pairs", "properties", "latest", "users")}
    assert {m.version for m in before.values()} == {1}
    # one user's newest row moves to an IP that gets its first company by it
    mail = first.where("amplitude_id is not null and ip_address is not null").limit(1).withColumns(
        {"user_id": F.lit("x@newcorp.example"), "event_time": F.lit("2030-01-01 00:00:00").cast("timestamp_ntz"), "uuid": F.lit("zz")})
    mail = spark.createDataFrame(mail.drop("event_properties", "user_properties").collect(), mail.drop("event_properties", "user_properties").schema).withColumns(
        {c: F.lit(None).cast("variant") for c in ("event_properties", "user_properties")}).select(*[c for c in first.columns if c in mail.columns])
    mail = mail.withColumns({f.name: F.lit(None).cast(f.dataType) for f in first.schema.fields if f.name not in mail.columns}).select(*first.columns)
    kept.load(mail)
    both = first.unionByName(mail)
    ips = dims.ip_addresses(both)
    want = dims.users(both, ips, dims.companies(both, ips))
    assert rows_of(kept.tables()["users"].select(*want.columns)) == rows_of(want)
    assert kept.ips.manifest() == before["ips"] and kept.properties.manifest() == before["properties"]
    old, new = {e.part: e.load for e in before["latest"].entries}, {e.part: e.load for e in kept.latest.manifest().entries}
    assert sum(old[p] != new[p] for p in old) == 1     # the bucket of that one user
