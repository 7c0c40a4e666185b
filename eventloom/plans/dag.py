"""Model registry and build runner.

Models are pure ``DataFrame -> DataFrame`` functions with declared inputs.
``run`` builds a selection of them in dependency order and writes each as
a Parquet table under ``out_dir``; later models read the written tables,
so every model is planned over typed columns and a short lineage.
Incremental models (events, sessions) load only rows after their
high-water mark and upsert, unless ``full_refresh`` or their table does
not exist yet.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventloom.operators import dimensions as dims
from eventloom.operators import facts
from eventloom.operators import incremental as inc
from eventloom.operators.staging import parse_events, with_property_keys
from eventloom.plans.docs import MODEL_DOCS, with_comments

STAGING_LAYER, CORE_LAYER = "staging", "silver"


@dataclass(frozen=True)
class Incremental:
    key: str
    target_ts: str                       # high-water-mark column of the table
    partition_by: str
    sessions: bool = False               # touched sessions are rebuilt from staging
    on_schema_change: str = "ignore"


@dataclass(frozen=True)
class Model:
    name: str
    inputs: tuple[str, ...]
    build: Callable[..., DataFrame]
    incremental: Incremental | None = None
    layer: str = CORE_LAYER


def _events(stg_events, users):
    return facts.events(stg_events, users).withColumn("event_date", F.to_date("event_time"))


def _dated(sessions):
    return sessions.withColumn("session_date", F.to_date("session_start"))


REGISTRY: dict[str, Model] = {m.name: m for m in [
    Model("stg_events", ("raw_events",), lambda raw_events: with_property_keys(parse_events(raw_events)), layer=STAGING_LAYER),
    Model("ip_addresses", ("stg_events",), lambda stg_events: dims.ip_addresses(stg_events)),
    Model("companies", ("stg_events", "ip_addresses"),
          lambda stg_events, ip_addresses: dims.companies(stg_events, ip_addresses)),
    Model("users", ("stg_events", "ip_addresses", "companies"),
          lambda stg_events, ip_addresses, companies: dims.users(stg_events, ip_addresses, companies)),
    Model("event_properties", ("stg_events",), lambda stg_events: dims.event_properties(stg_events)),
    Model("sessions", ("stg_events",), lambda stg_events: _dated(facts.sessions(stg_events)),
          Incremental("session_id", "session_end", "session_date", sessions=True, on_schema_change="sync_all_columns")),
    Model("events", ("stg_events", "users"), _events,
          Incremental("event_id", "event_time", "event_date")),
]}


def upstream(names: list[str]) -> list[str]:
    """``names`` plus everything they depend on (the ``+model`` selector)."""
    seen: list[str] = []

    def visit(n):
        if n in seen or n not in REGISTRY:
            return
        for i in REGISTRY[n].inputs:
            visit(i)
        seen.append(n)

    for n in names:
        visit(n)
    return seen


def topo_order(names: list[str] | None = None) -> list[str]:
    order = upstream(list(REGISTRY))
    return [n for n in order if names is None or n in names]


def expand(names: list[str]) -> list[str]:
    """Model names, with every layer name replaced by the layer's models."""
    out: list[str] = []
    for n in names:
        members = [m.name for m in REGISTRY.values() if m.layer == n] or [n]
        out += [m for m in members if m not in out]
    return out


def _path(out_dir: str, name: str) -> str:
    return f"{out_dir.rstrip('/')}/{name}"


def _load(spark: SparkSession, m: Model, path: str, existing: DataFrame, ins: dict[str, DataFrame], session_mode: str,
          lookback: _dt.timedelta | None) -> None:
    """One incremental load of ``m`` into its table."""
    spec = m.incremental
    stg = ins["stg_events"]
    change = stg if m.name != "sessions" else facts.session_rows(stg)
    new = inc.since_high_water_mark(change, existing, target_ts=spec.target_ts, lookback=lookback,
                                    untimed=session_mode == "rebuild" or not spec.sessions)
    if not spec.sessions:
        increment = m.build(**{**ins, "stg_events": new})
    elif session_mode == "rebuild":
        increment = _dated(inc.rebuild_sessions(change, new, existing))
    else:
        known, _ = inc.sync_schema(existing, _dated(facts.sessions(stg.limit(0))))
        if session_mode == "merge_partials":
            increment = _dated(inc.merge_or_rebuild_sessions(known, stg))
        else:
            part = inc.since_high_water_mark(stg, existing, target_ts=spec.target_ts, untimed=False)
            increment = _dated(inc.merge_sessions(known, part, session_mode))
    target, increment = inc.sync_schema(existing, increment, spec.on_schema_change)
    if dict(target.dtypes) != dict(existing.dtypes):
        # columns or types changed: the stored table takes the new ones first
        inc.replace_table(target, path, spec.partition_by)
    inc.upsert(spark, path, with_comments(increment), spec.key, spec.partition_by)


def run(spark: SparkSession, out_dir: str, inputs: dict[str, DataFrame] | None = None,
        models: list[str] | None = None, with_parents: bool = False, full_refresh: bool = False,
        session_mode: str = "rebuild", lookback: _dt.timedelta | None = None) -> dict[str, DataFrame]:
    """Build ``models`` (names of models or layers) into ``out_dir``; return every table by name.

    ``inputs`` supplies relations that are not built here (``raw_events``,
    or an already materialised ``stg_events``).  By default every registry
    model not in ``inputs`` is built.  Models neither given nor selected
    are read from ``out_dir`` when a selected model needs them, as a
    warehouse run of one model reads its parents' tables.

    ``lookback`` makes incremental models read that much before their mark
    again, for late rows.  ``session_mode``: ``rebuild`` (default, exact for
    any data) rebuilds the sessions that the new rows touch from staging;
    ``merge_partials`` and ``overwrite`` combine only rows after the mark
    (see :func:`inc.merge_sessions`) and take no lookback; with
    ``merge_partials`` sessions with rows without a time are rebuilt, with
    ``overwrite`` such rows come in by a first run only.
    """
    if lookback and session_mode != "rebuild":
        raise ValueError("a lookback reads events again, which only session_mode='rebuild' counts once")
    tables: dict[str, DataFrame] = dict(inputs or {})
    if models is None:
        selected = [n for n in REGISTRY if n not in tables]
    else:
        models = expand(models)
        selected = upstream(models) if with_parents else models
        selected = [n for n in selected if n not in tables or n in models]
    order = topo_order(selected)

    def table(name: str) -> DataFrame:
        if name not in tables:
            t = inc.read_table(spark, _path(out_dir, name))
            if t is None:
                raise ValueError(f"model {name!r} is neither built in this run nor present in {out_dir}")
            tables[name] = t
        return tables[name]

    for name in order:
        m = REGISTRY[name]
        path = _path(out_dir, name)
        ins = {i: table(i) for i in m.inputs}
        existing = None if (full_refresh or m.incremental is None) else inc.read_table(spark, path)
        if existing is None:
            inc.replace_table(with_comments(m.build(**ins)), path, m.incremental.partition_by if m.incremental else None)
        else:
            _load(spark, m, path, existing, ins, session_mode, lookback)
        tables[name] = spark.read.parquet(path)
    return tables


def register_views(tables: dict[str, DataFrame], prefix: str = "") -> list[str]:
    """Expose built tables as temporary views, so SQL users can query them with ``spark.sql``."""
    names = []
    for name, df in tables.items():
        df.createOrReplaceTempView(prefix + name)
        names.append(prefix + name)
    return names


def publish(spark: SparkSession, out_dir: str, prefix: str = "", models: list[str] | None = None) -> list[str]:
    """Register the built tables in the session catalog, one database per layer
    (``<prefix>staging``, ``<prefix>silver``): external tables over ``out_dir``, with
    the models' descriptions.  They outlive the session where the catalog does."""
    names = []
    for name in expand(models) if models else list(REGISTRY):
        path = _path(out_dir, name)
        if not inc._exists(spark, path):
            continue
        database = prefix + REGISTRY[name].layer
        full = f"{database}.{name}"
        spark.sql(f"create database if not exists `{database}`")
        spark.sql(f"drop table if exists `{database}`.`{name}`")
        spark.catalog.createTable(full, path=path, source="parquet", description=MODEL_DOCS.get(name, ""))
        if REGISTRY[name].incremental:
            spark.catalog.recoverPartitions(full)
        names.append(full)
    return names
