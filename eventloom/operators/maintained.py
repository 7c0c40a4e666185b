"""Dimensions kept up to date by loads, in versioned tables.

A load brings new staging rows, late and untimed ones among them, in any order:

* IP addresses, property objects and (company, IP) pairs only ever grow: keys of the
  load that the stored table has not are appended, found by its key filters;
* the latest row of each user is stored beside the users themselves; the load's
  latest rows are compared with the stored ones of the same users;
* a user row is computed anew if the user's latest row changed, or if the IP it
  was last seen at got a company that was not known there.

After every load the tables equal the models over all rows loaded so far.  Keys
are dealt into ``buckets`` partitions by hash, of which a load rewrites those
it touches; appends rewrite nothing.  The one column read whole in a load is the
latest IP of the users, and only if new companies came.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventloom.operators import dimensions as dims
from eventloom.operators.incremental import matching
from eventloom.operators.keyed_table import KeyedTable
from eventloom.operators.latest import latest_per_key
from eventloom.session import scratch_path

BUCKET = "bucket"
LATEST = ["amplitude_id", "user_id", "device_id", "ip_address", "event_time", "uuid"]


class Dimensions:
    """The four dimension tables under ``path``."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = 64):
        self.spark, self.buckets = spark, buckets
        keyed = lambda name, key: KeyedTable(spark, f"{path.rstrip('/')}/{name}", key, BUCKET)
        self.ips, self.pairs = keyed("ip_addresses", "ip_address"), keyed("companies", "ip_address")
        self.properties = keyed("event_properties", "event_properties_id")
        self.latest, self.users = keyed("latest_user_rows", "amplitude_id"), keyed("users", "amplitude_id")

    def _written(self, rows: DataFrame, name: str) -> DataFrame:
        path = scratch_path(self.spark, f"maintained-{name}")
        rows.write.parquet(path)
        return self.spark.read.schema(rows.schema).parquet(path)

    def _dealt(self, table: KeyedTable, rows: DataFrame) -> DataFrame:
        return rows.withColumn(BUCKET, F.pmod(F.xxhash64(*table.keys), F.lit(self.buckets)).cast("int"))

    def _add(self, table: KeyedTable, rows: DataFrame, unique: list[str], name: str) -> DataFrame:
        """Append the rows whose ``unique`` columns are not stored; these rows."""
        new = self._written(rows, name)
        if table.manifest().version:
            new = self._written(matching(new, table.lookup(new.select(*table.keys)), unique, "left_anti"), name)
        if new.take(1) or not table.manifest().version:
            table.append(self._dealt(table, new))
        return new

    def load(self, stg: DataFrame) -> None:
        """Bring the tables up to date with the new rows ``stg``."""
        own_ips = dims.ip_addresses(stg)
        self._add(self.ips, own_ips, ["ip_address"], "ips")
        new_pairs = self._add(self.pairs, dims.companies(stg, own_ips), ["company", "ip_address"], "pairs")
        self._add(self.properties, dims.event_properties(stg), ["event_properties_id"], "properties")

        seen = self._written(dims.latest_user_rows(stg).select(*LATEST), "latest")
        first = not self.latest.manifest().version
        if not first:
            stored = self.latest.lookup(seen.select("amplitude_id")).select(*LATEST)
            newest = latest_per_key(stored.unionByName(seen), ["amplitude_id"], "event_time", tiebreak=["uuid"])
            seen = self._written(matching(newest, stored, LATEST, "left_anti"), "latest")
        if first or seen.take(1):
            self.latest.upsert(self._dealt(self.latest, seen))

        rows = seen
        if not first and new_pairs.take(1):
            at_new_companies = matching(self.latest.read().select(*LATEST), new_pairs.select("ip_address").distinct(), ["ip_address"])
            rows = seen.unionByName(matching(at_new_companies, seen, ["amplitude_id"], "left_anti"))
        rows = self._written(rows, "users")
        if first or rows.take(1):
            places = rows.where("ip_address is not null").select("ip_address").distinct()
            users = dims.users(rows, self.ips.lookup(places), self.pairs.lookup(places))
            self.users.upsert(self._dealt(self.users, users))

    def tables(self) -> dict[str, DataFrame]:
        """The models as they stand."""
        names = {"ip_addresses": self.ips, "companies": self.pairs, "event_properties": self.properties, "users": self.users}
        return {n: t.read().drop(BUCKET) for n, t in names.items() if t.manifest().version}
