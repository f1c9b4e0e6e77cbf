"""The refresh chain: evidence files -> raw -> facts -> marts -> gates.

``refresh(spark, raw_dir, out_dir, as_of)`` runs the stages in dependency
order under one run id, stops at the first failing stage, appends one log
row per stage (and one per source/scope delivery outcome) and returns
0 (ok), 1 (a stage failed) or 2 (a quality gate failed).

Raw, facts, marts and dimensions are snapshot tables (``sources.snapshots``).
The raw sync opens only files that no earlier load holds and publishes each
load by itself; facts and marts are written to new folders and published
together, with the loads they took up, in one swap. So readers see all marts
of one run or none of them, a run that fails half way leaves nothing behind
that counts, and of two runs on one folder only one can publish.
"""

from __future__ import annotations

import logging
import time
import uuid
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window
from pyspark.sql.types import StringType, StructField, StructType

from citymarts.operators.delivery import outcome_status
from citymarts.operators.key_index import INDEX, index_rows, new_by_index
from citymarts.operators.latest import dedupe_first, latest_by_key
from citymarts.operators.quality import MinRows, Rule, gate_report, key_repeats
from citymarts.plans import facts as FB
from citymarts.plans import marts as M
from citymarts.schemas import (
    DIM_CITY,
    DIM_SOURCE,
    FACT_AIR_QUALITY_HOURLY,
    FACT_ECONOMIC_INDICATOR,
    FACT_FX_DAILY,
    FACT_NEWS_INTENSITY,
    FACT_OSM_INFRASTRUCTURE,
    FACT_WEATHER_HOURLY,
    FACT_KEYS,
    INGESTION_LOG,
    QUARANTINE,
    RAW,
)
from citymarts.sources.dims import dim_city_seed, dim_source_seed
from citymarts.session import ensure_checkpoint_dir
from citymarts.sources import manifest
from citymarts.sources.compaction import TARGET_BYTES, compact
from citymarts.sources.sinks import append_rows, month_of, read_table, write_table
from citymarts.sources.snapshots import WRITE, Snapshot, SnapshotStore

LOG = logging.getLogger(__name__)

FACT_SCHEMAS = {
    "fact_weather_hourly": FACT_WEATHER_HOURLY,
    "fact_air_quality_hourly": FACT_AIR_QUALITY_HOURLY,
    "fact_fx_daily": FACT_FX_DAILY,
    "fact_news_intensity": FACT_NEWS_INTENSITY,
    "fact_economic_indicator": FACT_ECONOMIC_INDICATOR,
    "fact_osm_infrastructure": FACT_OSM_INFRASTRUCTURE,
}
# Partition column of each fact, derived from its key (an upsert of a key
# only ever touches that key's partition).
FACT_PARTITION = {
    "fact_weather_hourly": lambda: month_of("observed_at"),
    "fact_air_quality_hourly": lambda: month_of("observed_at"),
    "fact_fx_daily": lambda: month_of("rate_date"),
    "fact_news_intensity": lambda: month_of("observed_at"),
    "fact_economic_indicator": lambda: F.col("year").cast("string"),
    "fact_osm_infrastructure": lambda: month_of("snapshot_date"),
}
MARTS = ["mart_environment_daily", "mart_fx_daily", "mart_mobility_daily", "mart_city_intelligence_daily"]
MART_KEYS = {
    "mart_environment_daily": ["city_id", "date"],
    "mart_fx_daily": ["city_id", "currency", "date"],
    "mart_mobility_daily": ["city_id", "date"],
    "mart_city_intelligence_daily": ["city_id", "date"],
}


#: Snapshots a reader may still be reading; older ones and their folders are deleted.
KEEP_SNAPSHOTS = 4
RAW_KEYS = ["source", "scope_id", "checksum"]
#: Raw is split by load, source and month; each load's files and keys by load.
RAW_PARTITIONS = ["source", "ym"]
LOAD = "load_id"
#: A parsed load, before it is split into raw rows, outcomes and quarantine.
STAGED = StructType([*RAW.fields, StructField("rule", StringType()), StructField("value", StringType())])


class Paths:
    """Where a warehouse keeps what. ``raw``, ``fact`` and ``mart`` name the
    current version of a snapshot table, as one path pattern."""

    def __init__(self, out_dir: str):
        self.base = out_dir.rstrip("/")
        self.log = f"{self.base}/ingestion_log"
        self.quarantine = f"{self.base}/quarantine"
        self.gates = f"{self.base}/quality/gates"

    def store(self, spark: SparkSession | None = None) -> SnapshotStore:
        return SnapshotStore(spark or SparkSession.active(), self.base)

    @property
    def raw(self) -> str:
        return self.store().path("raw")

    @property
    def dims(self) -> str:
        """Folder of the current dimensions, one below it for each."""
        return self.store().path("dims")

    def fact(self, name: str) -> str:
        return self.store().path(name)

    def mart(self, name: str) -> str:
        return self.store().path(name)


# ------------------------------------------------------------------ stages


class RunState:
    """What one run reads and has written so far: the snapshot its facts and
    marts are made from (``read``), the same with the tables the run wrote but
    has not published (``work``), the loads it takes up, and the partitions of
    each fact that those touch (``None`` = everything, i.e. a full rebuild)."""

    def __init__(self, store: SnapshotStore, incremental: bool):
        self.store = store
        self.read = self.work = store.current()
        self.loads = self.read.pending
        known = any(t in self.read.tables for t in FACT_SCHEMAS)  # the first run builds everything
        self.touched: dict[str, list[str]] | None = {} if incremental and known else None
        self.id = uuid.uuid4().hex
        self.written: set[str] = set()

    def stage(self, table: str, df: DataFrame, partition_by=(), sort_by=()) -> list[str]:
        """Write a table of this run's; its leaf folders."""
        self.written.add(table)
        return self.store.stage(table, df, partition_by, sort_by, self.id)

    def stage_dims(self, dims: dict[str, DataFrame]) -> None:
        """Write the dimensions, all to one folder of this run's."""
        self.written.add("dims")
        for name, df in dims.items():
            write_table(df, f"{self.store.base}/dims/{WRITE}={self.id}/{name}")
        self.work = self.work.having("dims", [f"{WRITE}={self.id}"])

    def discard(self) -> None:
        """Delete what the run wrote and no snapshot holds."""
        now = self.store.current()
        for t in self.written:
            if not now.folders(t, WRITE, [self.id]):
                self.store.drop(t, f"{WRITE}={self.id}")


def read_raw(spark: SparkSession, paths: Paths, snapshot: Snapshot | None = None, loads: list[str] | None = None) -> DataFrame:
    """Raw rows of the snapshot (now, if not given), of the given loads only."""
    return paths.store(spark).read("raw", RAW, snapshot, LOAD, loads)


WHAT = StructType([StructField("what", StringType())])


def quarantine_new(spark: SparkSession, paths: Paths, rows: DataFrame) -> int:
    """Append quarantine rows that are not there yet; returns how many.

    Each row carries a digest of what it says, so the rows that are there are
    told apart by that narrow column, and only rows of the same sources are read."""
    parts = [F.coalesce(F.col(c), F.lit("\u0000")) for c in ("source_id", "city_id", "rule_violated", "raw_record", "raw_checksum")]
    new = rows.withColumn("what", F.sha2(F.concat_ws("\u0001", *parts), 256)).dropDuplicates(["what"]).checkpoint(eager=True)
    sources = [r.source_id for r in new.select("source_id").distinct().collect()]  # names of sources
    if not sources:
        return 0
    there = read_table(spark, paths.quarantine, StructType([*QUARANTINE.fields, *WHAT.fields]))
    if "what" in there.columns:
        same = F.col("source_id").isin([x for x in sources if x is not None]) | F.col("source_id").isNull()
        new = new.join(there.where(same).select("what").distinct(), "what", "left_anti").checkpoint(eager=True)
    append_rows(new.withColumn("ym", month_of("quarantined_at")), paths.quarantine, ["ym"])
    return new.count()


def _load(spark: SparkSession, store: SnapshotStore, read: Snapshot, files: list, load_id: str, rejected) -> tuple[Snapshot, DataFrame, DataFrame]:
    """One load of at most ``manifest.FILES_PER_LOAD`` files: parsed once to a
    staging table, from which raw rows, outcomes and rejects all come.
    ``rejected`` takes the staged rows before the load is published, with raw,
    its key index and the files. Returns (snapshot, staged, raw rows stored)."""
    store.stage("staging", manifest.open_files(spark, files).select(*STAGED.fieldNames()), write=load_id, column=LOAD)
    staged = spark.read.schema(STAGED).parquet(f"{store.base}/staging/{LOAD}={load_id}")
    rejected(staged)
    first = dedupe_first(staged.where("rule IS NULL").select(*RAW.fieldNames()), RAW_KEYS, [("ingested_at", True), ("raw_file_path", True)])

    def stored_keys(places: list[str]) -> DataFrame:
        months = sorted({p.split("/")[-1] for p in places})
        return store.read("raw", RAW, read, "ym", months).where(F.concat_ws("/", "source", "ym").isin(places))

    new = new_by_index(
        first, RAW_KEYS, lambda buckets: store.read("raw_keys", INDEX, read, "bucket", buckets).select("h", "place"), stored_keys
    )
    raw = store.stage("raw", new.withColumn("ym", month_of("ingested_at")), RAW_PARTITIONS, RAW_KEYS, load_id, LOAD)
    stored = store.read("raw", RAW, Snapshot().having("raw", raw))
    keys = index_rows(stored, RAW_KEYS, F.concat_ws("/", "source", "ym")) if raw else None
    added = {
        "raw": raw,
        "raw_keys": store.stage("raw_keys", keys, ["bucket"], ["h"], load_id, LOAD) if raw else [],
        "files": store.stage("files", spark.createDataFrame(files, manifest.FILES), write=load_id, column=LOAD),
    }
    # The listing was compared with the files of ``read``: if another run loaded some since, this load must not count.
    made = store.publish(read, {t: [*read.folders(t), *f] for t, f in added.items()}, arrived=[load_id] if raw else [])
    return made, staged, stored


def sync_raw(spark: SparkSession, raw_dir: str, paths: Paths, run_id: str, as_of: str) -> dict:
    """R1+R4+R7: load deliveries not yet stored (key source, scope, checksum),
    opening only files that are new; log per-(source, scope) outcomes;
    quarantine unusable files.

    Files are compared by listing alone; a file that an earlier load holds
    counts as a delivery that was a duplicate. A load is published once its raw
    rows are written and stays pending until the marts hold it, so a later run
    takes up what a failed one left; a load that was not published never was."""
    store = paths.store(spark)
    listed = manifest.list_files(spark, raw_dir)
    read = store.current()
    known = store.read("files", manifest.FILES, read)
    zero, no_rule = F.lit(0).cast("long"), F.lit(None).cast("string")
    outcomes = manifest.known_per_scope(listed, known).select(
        "source", "scope_id", F.col("files").alias("rows_received"), zero.alias("opened"), zero.alias("rows_loaded"),
        zero.alias("rows_quarantined"), no_rule.alias("rules"),
    )
    counts = {"rows_loaded": 0, "rows_quarantined": 0}

    def rejected(staged: DataFrame) -> None:
        counts["rows_quarantined"] += quarantine_new(spark, paths, _envelope_rejects(staged, as_of))

    staging = []
    for files in manifest.in_loads(manifest.new_files(listed, known)):
        load_id = f"{run_id}-{uuid.uuid4().hex[:8]}"
        read, staged, stored = _load(spark, store, read, files, load_id, rejected)
        staging.append(f"{LOAD}={load_id}")
        # the stored copy of a payload is the one delivery that was loaded; its twins are duplicates
        winner = [*RAW_KEYS, "raw_file_path"]
        made = staged.join(stored.select(*winner, F.lit(True).alias("created")), winner, "left")
        outcomes = outcomes.unionByName(
            made.groupBy("source", _scope_of_staged().alias("scope_id")).agg(
                F.count("*").alias("rows_received"), F.count("*").alias("opened"), F.count("created").alias("rows_loaded"),
                F.count("rule").alias("rows_quarantined"), F.array_join(F.array_sort(F.collect_set("rule")), ", ").alias("rules"),
            )
        )
        counts["rows_loaded"] += stored.count()
    logged = _delivery_log(outcomes, run_id, as_of).checkpoint(eager=True)
    try:
        append_rows(logged.withColumn("ym", month_of("started_at")), paths.log, ["ym"])
    except Exception as exc:  # noqa: BLE001 - a log failure never breaks the run
        LOG.warning("delivery outcomes not logged: %s", exc)
    for top in staging:
        store.drop("staging", top)
    return counts | {"rows_received": logged.agg(F.sum("rows_received")).first()[0] or 0}


def _scope_of_staged():
    """A delivery's scope; that of its folder where the envelope does not tell."""
    return F.coalesce("scope_id", F.nullif(manifest.scope_of("raw_file_path"), F.lit("")))


def _envelope_rejects(staged: DataFrame, as_of: str) -> DataFrame:
    return staged.where("rule IS NOT NULL").select(
        F.lit(as_of).cast("timestamp_ntz").alias("quarantined_at"), F.col("source").alias("source_id"), _scope_of_staged().alias("city_id"),
        F.col("rule").alias("rule_violated"), F.col("value").alias("raw_record"), F.col("checksum").alias("raw_checksum"),
    )


def _delivery_log(outcomes: DataFrame, run_id: str, as_of: str) -> DataFrame:
    """Log rows per (source, scope): ``error`` if deliveries came and all of
    them were unusable, else ``success`` if any was new, else ``duplicate``."""
    totals = ["rows_received", "opened", "rows_loaded", "rows_quarantined"]
    per = outcomes.groupBy("source", "scope_id").agg(*(F.sum(c).alias(c) for c in totals), F.max("rules").alias("rules"))
    none_usable = (F.col("opened") > 0) & (F.col("rows_quarantined") == F.col("opened"))
    error = F.when(none_usable, F.substring(F.concat(F.lit("unusable deliveries: "), "rules"), 1, 2000))
    now = F.lit(as_of).cast("timestamp_ntz")
    return per.select(
        F.lit(run_id).alias("run_id"), F.col("source").alias("source_id"), F.col("scope_id").alias("city_id"),
        now.alias("started_at"), now.alias("finished_at"),
        outcome_status(F.col("rows_received"), F.col("rows_loaded"), error).alias("status"),
        "rows_received", "rows_loaded", "rows_quarantined", F.lit(None).cast("string").alias("raw_checksum"), error.alias("error_message"),
    )


def upsert_partitions(state: RunState, name: str, delta: list[str]) -> list[str]:
    """Merge a staged delta (leaf folders) of a fact into the partitions it
    touches, newest version per key; the fact's folders after that. Other
    partitions are neither read nor written."""
    store, schema = state.store, FACT_SCHEMAS[name]
    touched = state.touched[name]
    old = store.read(name, schema, state.read, "part", touched)
    if "part" not in old.columns:
        old = old.withColumn("part", F.lit(None).cast("string"))
    new = store.read("delta_" + name, schema, Snapshot().having("delta_" + name, delta))
    merged = latest_by_key(old.unionByName(new.select(*old.columns)), FACT_KEYS[name], "ingested_at", ["raw_checksum"])
    made = state.stage(name, merged, ["part"], FACT_KEYS[name])
    gone = set(state.read.folders(name, "part", touched))
    return [f for f in state.read.folders(name) if f not in gone] + made


def build_facts(spark: SparkSession, paths: Paths, as_of: str, state: RunState) -> dict:
    """F1-F6. Full mode builds every fact from the whole raw table (idempotent:
    newest version per key). Incremental mode builds fact rows from the pending
    loads only and merges them into the partitions they touch; the folders of
    other partitions stay as they are. Nothing is published yet."""
    raw = FB.collapse_raw(read_raw(spark, paths, state.read, list(state.loads) if state.touched is not None else None))
    for name, df in FB.all_facts(raw).items():
        df = df.withColumn("part", FACT_PARTITION[name]())
        if state.touched is None:
            # range-partition on the full (unique) fact key: a hot city is split
            # across write tasks instead of landing in one
            folders = state.stage(name, df, ["part"], FACT_KEYS[name])
        else:
            delta = state.stage("delta_" + name, df, ["part"])
            # partition values of the new rows, a handful of months, from the folders written
            state.touched[name] = sorted({f.split("/")[-1].partition("=")[2] for f in delta})
            folders = upsert_partitions(state, name, delta) if delta else state.read.folders(name)
        state.work = state.work.having(name, folders)
    q = FB.fact_rejects(raw).select(
        F.lit(as_of).cast("timestamp_ntz").alias("quarantined_at"),
        F.col("source").alias("source_id"),
        F.col("scope_id").alias("city_id"),
        F.col("rule").alias("rule_violated"),
        F.coalesce(F.col("payload"), F.lit("")).alias("raw_record"),
        F.col("checksum").alias("raw_checksum"),
    ).select(*QUARANTINE.fieldNames())
    bad = quarantine_new(spark, paths, q)
    touched = state.touched
    return {"rows_loaded": sum(map(len, touched.values())) if touched is not None else len(FACT_SCHEMAS), "rows_quarantined": bad}


def read_fact(spark: SparkSession, paths: Paths, name: str, months: list[str] | None = None, snapshot: Snapshot | None = None) -> DataFrame:
    """A fact table; ``months`` names the partitions to read (``None`` = all)."""
    return paths.store(spark).read(name, FACT_SCHEMAS[name], snapshot, "part", months).select(*FACT_SCHEMAS[name].fieldNames())


_MART_SCHEMAS: dict[str, StructType] = {}


def mart_schema(spark: SparkSession, name: str) -> StructType:
    """Schema of a mart, from analysing the builders on empty inputs (no job, once a process)."""
    if not _MART_SCHEMAS:
        _MART_SCHEMAS.update(_mart_schemas(spark))
    return _MART_SCHEMAS[name]


def _mart_schemas(spark: SparkSession) -> dict[str, StructType]:
    empty = {n: spark.createDataFrame([], sch) for n, sch in FACT_SCHEMAS.items()}
    dim = spark.createDataFrame([], dim_city_seed(spark).schema)
    env = M.environment_daily(empty["fact_weather_hourly"], empty["fact_air_quality_hourly"])
    fx = M.fx_daily(empty["fact_fx_daily"], dim, max_dim_rows=None)
    mob = M.mobility_daily(env, empty["fact_osm_infrastructure"])
    frames = {
        "mart_environment_daily": env,
        "mart_fx_daily": fx,
        "mart_mobility_daily": mob,
        "mart_city_intelligence_daily": M.city_intelligence_daily(
            env, fx, mob, empty["fact_news_intensity"], dim, "1970-01-01 00:00:00", max_dim_rows=None
        ),
    }
    return {name: df.schema for name, df in frames.items()}


def read_mart(spark: SparkSession, paths: Paths, name: str, months: list[str] | None = None, snapshot: Snapshot | None = None) -> DataFrame:
    """A mart table; ``months`` names the ``ym`` partitions to read (``None`` = all)."""
    schema = mart_schema(spark, name)
    return paths.store(spark).read(name, schema, snapshot, "ym", months).select(*schema.fieldNames())


def _write_mart(state: RunState, name: str, df: DataFrame, months: list[str] | None) -> None:
    """Write a mart, or its ``months``, to new folders. The rebuilt months'
    old folders leave the run's snapshot, also those of months that the mart
    no longer has."""
    made = state.stage(name, df.withColumn("ym", month_of("date")), ["ym"], MART_KEYS[name])
    gone = set(state.work.folders(name, "ym", months))
    state.work = state.work.having(name, [f for f in state.work.folders(name) if f not in gone] + made)


def _with_next_month(spark: SparkSession, paths: Paths, state: RunState, months: list[str]) -> list[str]:
    """``months`` and, per currency, the month of its next observation after
    each: a revised last rate changes that observation's previous value. One
    row per currency and month is looked at."""
    fact = paths.store(spark).read("fact_fx_daily", FACT_SCHEMAS["fact_fx_daily"], state.work)
    if "part" not in fact.columns:
        return months
    per = fact.select("currency", "part").distinct()
    after = per.withColumn("after", F.lead("part").over(Window.partitionBy("currency").orderBy("part")))
    rows = after.where(F.col("part").isin(months) & F.col("after").isNotNull()).select("after").distinct().collect()
    return sorted({*months, *(r.after for r in rows)})


def _union(*groups):
    if any(g is None for g in groups):
        return None
    return sorted({m for g in groups for m in g})


def build_marts(spark: SparkSession, paths: Paths, as_of: str, state: RunState) -> dict:
    """M1-M4 in dependency order; each mart is read back once written
    because later marts consume it. Facts and marts are read as this run wrote
    them; nothing is published yet.

    After an incremental fact merge only the affected months are recomputed
    (only those partitions of facts and marts are read and replaced). A new infrastructure snapshot
    changes every day of the mobility and composite marts (the latest
    snapshot is repeated on each day), so those are then rebuilt in full.
    """
    t, at = state.touched, state.work
    full = t is None
    m_env = None if full else _union(t["fact_weather_hourly"], t["fact_air_quality_hourly"])
    m_fx = None if full else _with_next_month(spark, paths, state, t["fact_fx_daily"])
    infra_changed = full or bool(t["fact_osm_infrastructure"])
    m_mob = None if infra_changed else m_env
    m_ci = None if infra_changed else _union(m_env, m_fx, t["fact_news_intensity"])

    dim = dim_city_seed(spark)
    state.stage_dims({"dim_city": dim, "dim_source": dim_source_seed(spark)})

    if m_env is None or m_env:
        env = M.environment_daily(
            read_fact(spark, paths, "fact_weather_hourly", m_env, at), read_fact(spark, paths, "fact_air_quality_hourly", m_env, at)
        )
        _write_mart(state, "mart_environment_daily", env, m_env)

    if m_fx is None or m_fx:
        # the whole FX fact is read (one row per currency-day): the first day
        # of a month needs the previous observation, wherever it is
        fx = M.fx_daily(read_fact(spark, paths, "fact_fx_daily", None, at), dim)
        if m_fx is not None:
            fx = fx.where(month_of("date").isin(m_fx))
        _write_mart(state, "mart_fx_daily", fx, m_fx)

    if m_mob is None or m_mob:
        mob = M.mobility_daily(read_mart(spark, paths, "mart_environment_daily", m_mob, state.work),
                               read_fact(spark, paths, "fact_osm_infrastructure", None, at))
        _write_mart(state, "mart_mobility_daily", mob, m_mob)

    if m_ci is None or m_ci:
        ci = M.city_intelligence_daily(
            read_mart(spark, paths, "mart_environment_daily", m_ci, state.work),
            read_mart(spark, paths, "mart_fx_daily", m_ci, state.work),
            read_mart(spark, paths, "mart_mobility_daily", m_ci, state.work),
            read_fact(spark, paths, "fact_news_intensity", m_ci, at),
            dim,
            as_of,
        )
        _write_mart(state, "mart_city_intelligence_daily", ci, m_ci)
    return {"rows_loaded": len(MARTS) if m_ci is None else len(m_ci)}


def compact_warehouse(spark: SparkSession, out_dir: str, target_bytes: int = TARGET_BYTES) -> dict[str, int]:
    """Pack the small files that loads leave in raw, its key index and the file
    list, each table in a commit of its own; folders rewritten per table. Raw
    rows of pending loads stay where they are: the next run asks for them by load."""
    store = Paths(out_dir).store(spark)
    done = {"raw": compact(store, "raw", RAW, RAW_PARTITIONS, RAW_KEYS, LOAD, target_bytes, store.current().pending)}
    done["raw_keys"] = compact(store, "raw_keys", INDEX, ["bucket"], ["h"], LOAD, target_bytes)
    done["files"] = compact(store, "files", manifest.FILES, [], ["path"], LOAD, target_bytes)
    return done


def publish_run(state: RunState) -> Snapshot:
    """Facts, marts, dimensions and the loads they hold become current, in one swap.

    Exactly the loads that the facts were made from are done: one that arrived
    meanwhile stays pending. Fails with ``Conflict``, and publishes nothing, if
    another run published any of these tables since this one began."""
    tables = [*FACT_SCHEMAS, *MARTS, "dims"]
    made = state.store.publish(state.read, {t: state.work.folders(t) for t in tables}, done=state.loads)
    try:
        state.discard()  # deltas
        state.store.expire(KEEP_SNAPSHOTS)
    except Exception as exc:  # noqa: BLE001 - the run is published; what is left is deleted by a later one
        LOG.warning("old versions not deleted: %s", exc)
    return made


def quality_gates(spark: SparkSession, paths: Paths) -> DataFrame:
    """Q1-Q5 over dims, facts and marts (one aggregate pass per table)."""
    dims = paths.dims
    dim, src = spark.read.schema(DIM_CITY).parquet(f"{dims}/dim_city"), spark.read.schema(DIM_SOURCE).parquet(f"{dims}/dim_source")
    checks = [
        (dim, [MinRows("min_cities", 4), Rule("city_id_missing", F.col("city_id").isNull() | (F.col("city_id") == ""))], "dim_city"),
        (key_repeats(dim, ["city_id"]), [Rule("city_id_repeated", F.col("repeats") > 1)], "dim_city"),
        (key_repeats(src, ["source_id"]), [Rule("source_id_repeated", F.col("repeats") > 1)], "dim_source"),
        (src, [MinRows("min_sources", 6), Rule("source_id_missing", F.col("source_id").isNull() | (F.col("source_id") == ""))], "dim_source"),
    ]
    for name in FACT_SCHEMAS:
        rules: list = [MinRows("non_empty", 1)]
        if name == "fact_weather_hourly":
            rules.append(Rule("temperature_range", (F.col("temperature_c") < -10) | (F.col("temperature_c") > 60)))
        if name == "fact_fx_daily":
            rules.append(Rule("rate_positive", ~(F.col("units_per_usd") > 0)))
        checks.append((read_fact(spark, paths, name), rules, name))
    scores = ["city_intelligence_score", "score_environment", "score_economic", "score_mobility", "score_vibrancy"]
    out_of_range = None
    for c in scores:
        cond = (F.col(c) < 0) | (F.col(c) > 100)
        out_of_range = cond if out_of_range is None else out_of_range | cond
    for name in MARTS:
        rules = [MinRows("non_empty", 1)]
        if name == "mart_city_intelligence_daily":
            rules.append(Rule("scores_in_range", out_of_range))
        checks.append((read_mart(spark, paths, name), rules, name))
    return gate_report(checks)


# ------------------------------------------------------------------- chain


def _log_stage(spark, paths, run_id, stage, started, finished, status, counts, error=None):
    try:
        row = (
            run_id, f"stage:{stage}", None, started, finished, status,
            int(counts.get("rows_received", 0) or 0), int(counts.get("rows_loaded", 0) or 0),
            int(counts.get("rows_quarantined", 0) or 0), None,
            (str(error)[:2000] if error else None),
        )
        df = spark.createDataFrame([row], INGESTION_LOG)
        append_rows(df.withColumn("ym", month_of("started_at")), paths.log, ["ym"])
    except Exception as exc:  # noqa: BLE001 - a log failure never breaks the run
        LOG.warning("run log row of stage %s not written: %s", stage, exc)


def refresh(
    spark: SparkSession,
    raw_dir: str,
    out_dir: str,
    as_of: str | None = None,
    run_id: str | None = None,
    incremental: bool = False,
) -> int:
    """Run raw sync -> facts -> marts -> gates; 0 ok, 1 stage failed, 2 gate failed.

    ``incremental=True`` merges only the new deliveries into the facts and
    recomputes only the affected mart months (the first run, with no fact
    tables yet, is always a full build).
    """
    if spark.conf.get("spark.sql.session.timeZone") not in ("UTC", "Etc/UTC", "GMT"):
        raise RuntimeError("day boundaries are defined in UTC: set spark.sql.session.timeZone=UTC")
    ensure_checkpoint_dir(spark)  # lineage is cut in the shared checkpoint folder: fail before any stage
    as_of = as_of or datetime.now(timezone.utc).strftime("%Y-%m-%d %H:%M:%S")
    run_id = run_id or str(uuid.uuid4())
    paths = Paths(out_dir)
    run: dict[str, RunState] = {}

    def facts() -> dict:
        run["state"] = RunState(paths.store(spark), incremental)
        return build_facts(spark, paths, as_of, run["state"])

    def marts() -> dict:
        counts = build_marts(spark, paths, as_of, run["state"])
        publish_run(run["state"])
        return counts

    stages = [
        ("raw_sync", lambda: sync_raw(spark, raw_dir, paths, run_id, as_of)),
        ("facts", facts),
        ("marts", marts),
    ]
    # The run's clock is ``as_of``: stage rows are stamped as_of + elapsed,
    # so a backfill for a past day logs (and later reads fresh) consistently.
    clock0 = datetime.strptime(as_of, "%Y-%m-%d %H:%M:%S")
    t_start = time.time()
    for name, fn in stages:
        started = clock0 + timedelta(seconds=time.time() - t_start)
        try:
            counts = fn()
        except Exception as exc:  # noqa: BLE001
            finished = clock0 + timedelta(seconds=time.time() - t_start)
            _log_stage(spark, paths, run_id, name, started, finished, "error", {}, exc)
            if "state" in run:
                run["state"].discard()
            return 1
        finished = clock0 + timedelta(seconds=time.time() - t_start)
        _log_stage(spark, paths, run_id, name, started, finished, "success", counts)
    report = quality_gates(spark, paths).withColumn("run_id", F.lit(run_id))
    append_rows(report, paths.gates)
    failed = spark.read.parquet(paths.gates).where((F.col("run_id") == run_id) & ~F.col("passed")).limit(1).count()
    return 2 if failed else 0
