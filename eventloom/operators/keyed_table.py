"""Versioned Parquet tables: loads that readers see whole, keys found by filters.

A table is a folder with three parts:

* ``data/load=<id>/<partition>=<value>/``: rows, sorted by key within files;
* ``filters/load=<id>/``: for each partition of a load a blocked Bloom filter of
  its keys, 256 bits for about eight keys, built by ``bit_or`` aggregation;
* ``manifests/<version>.json``: which loads make up each partition, one line for
  each live pair of them, and the stored schema.

A load writes new folders, then one manifest, which appears by a rename; a
reader takes the newest manifest.  So a load that dies at any step leaves the
old table whole, and readers of the old version keep their files until
:meth:`KeyedTable.vacuum`.  Two loads at once cannot both name the next version:
the later one raises and may be repeated.

An upsert probes the filters with the increment's keys, which names candidate
partitions; the exact NULL-safe match reads the key columns of those only, and
partitions that hold no key of the increment keep their files.  Work that
grows with the table is the reading of filters, about four bytes a row.

Only the live (partition, load) pairs reach the driver: as many as there are
partitions, times the loads since a partition was last compacted.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import asdict, dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventloom.operators.incremental import NULL_PARTITION, _delete, _exists, _fs, matching, upsert_frames
from eventloom.session import scratch_path

KEYS_PER_BLOCK = 8
#: Rows for each core that an upsert rewrites at once; its shuffles hold them twice.
ROWS_PER_CORE = 1 << 19
WORDS = 4
LOAD = "load"
_FILTER = T.StructType([T.StructField("part", T.StringType()), T.StructField("blocks", T.LongType()), T.StructField("block", T.LongType()),
                        *(T.StructField(f"w{i}", T.LongType()) for i in range(WORDS)), T.StructField(LOAD, T.StringType())])


@dataclass(frozen=True)
class Entry:
    """The rows that one load holds of one partition (``part``: its value as text)."""
    part: str | None
    load: str
    blocks: int
    rows: int
    tag: str | None = None


@dataclass(frozen=True)
class Manifest:
    version: int = 0
    schema: str = ""
    entries: tuple[Entry, ...] = field(default=())

    def dumps(self) -> str:
        return json.dumps(asdict(self))

    @staticmethod
    def loads(text: str) -> Manifest:
        raw = json.loads(text)
        return Manifest(raw["version"], raw["schema"], tuple(Entry(**e) for e in raw["entries"]))


class KeyedTable:
    def __init__(self, spark: SparkSession, path: str, key: str | list[str], partition_by: str):
        self.spark, self.path = spark, path.rstrip("/")
        self.keys = [key] if isinstance(key, str) else list(key)
        self.partition_by = partition_by

    # ---------------------------------------------------------------- versions

    def _versions(self) -> list[int]:
        folder, fs = _fs(self.spark, f"{self.path}/manifests")
        if not fs.exists(folder):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(folder)]
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and n[:1].isdigit())

    def manifest(self, version: int | None = None) -> Manifest:
        """The newest manifest, or that of ``version``; an empty one if there is no table."""
        versions = self._versions()
        if version is None and not versions:
            return Manifest()
        name = f"{versions[-1] if version is None else version:012d}.json"
        file, fs = _fs(self.spark, f"{self.path}/manifests/{name}")
        size = fs.getFileStatus(file).getLen()
        stream = fs.open(file)
        try:
            return Manifest.loads(bytes(stream.readNBytes(int(size))).decode())
        finally:
            stream.close()

    def _commit(self, old: Manifest, schema: T.StructType, entries: list[Entry]) -> Manifest:
        new = Manifest(old.version + 1, schema.json(), tuple(sorted(entries, key=lambda e: (e.part is not None, e.part or "", e.load))))
        draft, fs = _fs(self.spark, f"{self.path}/manifests/draft-{uuid.uuid4().hex}")
        stream = fs.create(draft)
        stream.write(new.dumps().encode())
        stream.close()
        final, _ = _fs(self.spark, f"{self.path}/manifests/{new.version:012d}.json")
        if fs.exists(final) or not fs.rename(draft, final):
            fs.delete(draft, False)
            raise RuntimeError(f"another load has written version {new.version} of {self.path}")
        return new

    # ---------------------------------------------------------------- reading

    def _schema(self, m: Manifest) -> T.StructType:
        return T.StructType.fromJson(json.loads(m.schema))

    def _rows(self, m: Manifest, entries: list[Entry] | tuple[Entry, ...], with_load: bool = False) -> DataFrame:
        schema = self._schema(m)
        extra = [T.StructField(LOAD, T.StringType())]
        wide = T.StructType([*schema.fields, *extra])
        if not entries:
            out = self.spark.createDataFrame([], wide)
        else:
            folders = [f"{self.path}/data/{LOAD}={e.load}/{self.partition_by}={NULL_PARTITION if e.part is None else e.part}" for e in entries]
            out = self.spark.read.schema(wide).option("basePath", f"{self.path}/data").parquet(*folders)
        return out.select(*schema.names, *([LOAD] if with_load else []))

    def read(self, version: int | None = None) -> DataFrame | None:
        """All rows of a version (default: the newest), or None if there is no table."""
        m = self.manifest(version)
        return self._rows(m, m.entries) if m.version else None

    # ---------------------------------------------------------------- filters

    def _words(self) -> list[Column]:
        """Two bits of a key in each of the words."""
        h = F.xxhash64(F.lit(1), *self.keys)
        bit = lambda k: F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftrightunsigned(h, 6 * k).bitwiseAND(F.lit(63)).cast("int"))
        return [bit(2 * i).bitwiseOR(bit(2 * i + 1)) for i in range(WORDS)]

    def _block(self, blocks: Column) -> Column:
        return F.pmod(F.xxhash64(*self.keys), blocks)

    def _write(self, rows: DataFrame, tag: str | None = None) -> list[Entry]:
        """``rows`` as a load of its own: data, then filters.  Its entries."""
        load, p = uuid.uuid4().hex, self.partition_by
        rows = rows.hint("rebalance", p).sortWithinPartitions(p, *self.keys)
        rows.withColumn(LOAD, F.lit(load)).write.partitionBy(LOAD, p).mode("append").parquet(f"{self.path}/data")
        if not _exists(self.spark, f"{self.path}/data/{LOAD}={load}"):
            return []
        schema = T.StructType([*rows.schema.fields, T.StructField(LOAD, T.StringType())])
        stored = self.spark.read.schema(schema).option("basePath", f"{self.path}/data").parquet(f"{self.path}/data/{LOAD}={load}")
        keyed = stored.select(F.col(p).cast("string").alias("part"), *self.keys)
        # One row for each partition.
        counted = [Entry(r.part, load, 1 << max(0, (r.rows - 1) // KEYS_PER_BLOCK).bit_length(), r.rows, tag)
                   for r in keyed.groupBy("part").agg(F.count("*").alias("rows")).collect()]
        blocks = self.spark.createDataFrame([(e.part, e.blocks) for e in counted], "p string, blocks long")
        (keyed.join(F.broadcast(blocks), F.col("part").eqNullSafe(F.col("p")))
         .select("part", "blocks", self._block(F.col("blocks")).alias("block"), *[w.alias(f"w{i}") for i, w in enumerate(self._words())])
         .groupBy("part", "blocks", "block").agg(*[F.bit_or(f"w{i}").alias(f"w{i}") for i in range(WORDS)])
         .withColumn(LOAD, F.lit(load)).write.partitionBy(LOAD).mode("append").parquet(f"{self.path}/filters"))
        return counted

    def _hits(self, keys: DataFrame, entries: list[Entry]) -> DataFrame:
        """The filter blocks of the entries' loads that have some key of ``keys``; joined by a shuffle,
        as both sides grow with the data and are larger than their files say."""
        loads = sorted({e.load for e in entries})
        filters = (self.spark.read.schema(_FILTER).option("basePath", f"{self.path}/filters")
                   .parquet(*[f"{self.path}/filters/{LOAD}={x}" for x in loads]))
        # At most one row for each power of two up to the largest partition.
        sizes = F.array(*[F.lit(b).cast("long") for b in sorted({e.blocks for e in entries})])
        probe = (keys.select(*self.keys).distinct().withColumn("k_blocks", F.explode(sizes))
                 .select("k_blocks", self._block(F.col("k_blocks")).alias("k_block"), *[w.alias(f"k{i}") for i, w in enumerate(self._words())]))
        on = reduce(lambda a, b: a & b, [F.col(f"w{i}").bitwiseAND(F.col(f"k{i}")) == F.col(f"k{i}") for i in range(WORDS)])
        return probe.join(filters.hint("merge"), (F.col("k_blocks") == F.col("blocks")) & (F.col("k_block") == F.col("block")) & on)

    def candidates(self, keys: DataFrame, m: Manifest | None = None, entries: list[Entry] | None = None) -> list[Entry]:
        """The entries whose filter has some key of ``keys``: all that hold one, and few others."""
        m = m or self.manifest()
        entries = list(m.entries) if entries is None else entries
        if not entries:
            return []
        found = {(r.part, r.load) for r in self._hits(keys, entries).select("part", LOAD).distinct().collect()}
        return [e for e in entries if (e.part, e.load) in found]

    def lookup(self, keys: DataFrame, m: Manifest | None = None, without_tag: str | None = None) -> DataFrame:
        """The table's rows with a key in ``keys``, read from candidate partitions only."""
        m = m or self.manifest()
        live = [e for e in m.entries if without_tag is None or e.tag != without_tag]
        return matching(self._rows(m, self.candidates(keys, m, live)), keys, self.keys)

    # ---------------------------------------------------------------- loads

    def append(self, rows: DataFrame, tag: str | None = None) -> Manifest:
        """Add ``rows``.  A load with a ``tag`` replaces the load that had it before, so that a
        batch applied again after a crash counts once."""
        m = self.manifest()
        added = self._write(rows, tag)
        kept = [e for e in m.entries if tag is None or e.tag != tag]
        return self._commit(m, rows.schema, [*kept, *added])

    def upsert(self, increment: DataFrame, order_by: str | None = None) -> dict:
        """Rows of ``increment`` (unique on the key) replace those with the same key, wherever
        they lie; with ``order_by`` the later of the two stays.  Only partitions that
        hold a key of the increment, or get one, are rewritten."""
        m = self.manifest()
        if not m.version:
            self._commit(m, increment.schema, self._write(increment))
            return {"mode": "create", "searched": [], "touched": None}
        schema = self._schema(m)
        stage = scratch_path(self.spark, "upsert-increment")

        def staged(rows: DataFrame, name: str, schema: T.StructType | None = None) -> DataFrame:
            rows.write.mode("append").parquet(f"{stage}/{name}")
            return self.spark.read.schema(schema or rows.schema).parquet(f"{stage}/{name}")

        new = staged(increment.select(*schema.names), "new", schema)
        searched = self.candidates(new, m)
        hits = staged(matching(self._rows(m, searched).select(*self.keys, self.partition_by), new, self.keys), "hits")
        p = F.col(self.partition_by).cast("string").alias("part")
        touched = {r.part: r.rows for r in hits.select(p, F.lit(0).alias("n")).union(new.select(p, F.lit(1)))
                   .groupBy("part").agg(F.sum("n").alias("rows")).collect()}
        within = [e for e in m.entries if e.part in touched]
        groups = self._groups(within, touched)
        if len(groups) == 1:
            written = self._write(upsert_frames(self._rows(m, within), new, self.keys, order_by))
        else:
            # Group by group, so that the shuffles hold one group's rows; first the rows that
            # stay of all keys on both sides, as a key may move from one group's partitions to another's.
            rows = [self._rows(m, [e for e in within if e.part in g]) for g in groups]
            own = [hits.where(self._in(g)) for g in groups]
            if order_by is not None:
                for r, h in zip(rows, own):
                    met = staged(matching(r, h, self.keys), "met")
                new = staged(upsert_frames(met, new, self.keys, order_by), "latest")
                for name in ("new", "met"):
                    _delete(self.spark, f"{stage}/{name}")
            written = [e for g, r, h in zip(groups, rows, own)
                       for e in self._write(matching(r, h, self.keys, "left_anti").unionByName(new.where(self._in(g))))]
        self._commit(m, schema, [*(e for e in m.entries if e.part not in touched), *written])
        _delete(self.spark, stage)
        order = lambda v: (v is not None, v or "")
        return {"mode": "partitions", "searched": sorted({e.part for e in searched}, key=order), "touched": sorted(touched, key=order)}

    def _groups(self, within: list[Entry], added: dict[str | None, int]) -> list[set[str | None]]:
        """The partitions named in ``added`` (rows to come, by partition), dealt in order to groups of
        about as many rows as the cluster's cores may rewrite at once; a larger partition is one by itself."""
        size = dict(added)
        for e in within:
            size[e.part] += e.rows
        most, rows, groups = ROWS_PER_CORE * self.spark.sparkContext.defaultParallelism, 0, [set()]
        for part in sorted(size, key=lambda v: (v is not None, v or "")):
            if groups[-1] and rows + size[part] > most:
                groups.append(set())
                rows = 0
            groups[-1].add(part)
            rows += size[part]
        return groups

    def _in(self, parts: set[str | None]) -> Column:
        p = F.col(self.partition_by).cast("string")
        return F.when(p.isNull(), F.lit(None in parts)).otherwise(p.isin(*[v for v in parts if v is not None]))

    def replace(self, rows: DataFrame) -> Manifest:
        """The whole table anew; ``rows`` may read it, and may have other columns."""
        m = self.manifest()
        return self._commit(m, rows.schema, self._write(rows))

    def compact(self, max_loads: int = 8, keep: set[str] = frozenset()) -> int:
        """Rewrite the partitions that more than ``max_loads`` loads make up; their number.
        Rewritten rows lose their loads' tags; loads with a tag in ``keep``, whose batches
        may come once more, are left out."""
        m = self.manifest()
        parts: dict[str | None, list[Entry]] = {}
        for e in m.entries:
            if e.tag not in keep:
                parts.setdefault(e.part, []).append(e)
        old = [e for entries in parts.values() if len(entries) > max_loads for e in entries]
        if old:
            written = self._write(self._rows(m, old))
            self._commit(m, self._schema(m), [*(e for e in m.entries if e not in set(old)), *written])
        return len({e.part for e in old})

    def vacuum(self, keep: int = 2, strays: bool = True) -> int:
        """Drop all but the newest ``keep`` versions and the loads that only they had (or that
        no version ever had); the number of loads dropped.  Not while a load runs, unless ``strays``
        is false: then loads that no version has stay, as they may be on their way."""
        versions = self._versions()
        kept = versions[-keep:]
        live = {e.load for v in kept for e in self.manifest(v).entries}
        old = None if strays else {e.load for v in versions[:-keep] for e in self.manifest(v).entries}
        dropped = set()
        for part in ("data", "filters"):
            folder, fs = _fs(self.spark, f"{self.path}/{part}")
            for s in fs.listStatus(folder) if fs.exists(folder) else ():
                name = s.getPath().getName()
                load = name.removeprefix(f"{LOAD}=")
                if name.startswith(f"{LOAD}=") and load not in live and (old is None or load in old):
                    fs.delete(s.getPath(), True)
                    dropped.add(name)
        for v in versions[:-keep]:
            _delete(self.spark, f"{self.path}/manifests/{v:012d}.json")
        return len(dropped)
