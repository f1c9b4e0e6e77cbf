"""Registered queries over the shared test tables.

Each function takes ``(spark, folder)`` and returns a DataFrame; every one
reads whole tables and composes the library operators (see
``citymarts.plans.analogues`` for how events stand in for the facts).
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citymarts.functions.jsonhash import content_hash, strip_volatile
from citymarts.functions.scalar import per_100k, round_half_even
from citymarts.functions.timeparse import best_effort_ts
from citymarts.operators.delivery import delivery_outcomes, flag_first_delivery, load_new
from citymarts.operators.freshness import freshness_summary, freshness_verdict
from citymarts.operators.geo import poi_counts, radius_catchment
from citymarts.operators.latest import dedupe_first, last_non_null, latest_by_key, latest_snapshot
from citymarts.operators.quality import MinRows, Rule, gate_report, key_repeats, kpi_missing, split_quarantine
from citymarts.operators.rollup import daily_rollup
from citymarts.operators.scoring import pillar_contributions, standings
from citymarts.operators.timeseries import lag_pct_change
from citymarts.operators.unnest import record_array_unnest, wide_to_long, with_parsed, zip_arrays_unnest
from citymarts.plans import analogues as A
from citymarts.plans import facts as FB
from citymarts.plans import marts as M
from citymarts.plans import serving as S
from citymarts.operators.joins import bounded_broadcast
from citymarts.sources.dims import dim_city_seed
from citymarts.sources.tables import DRIVER_TABLES, load
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

NUDGE = A.NUDGE
ISO_SECONDS = "yyyy-MM-dd'T'HH:mm:ss"
BATCH_SIZE = 64  # events per synthetic delivery payload (bounds every array)


# --------------------------------------------------------------- shared marts


class Marts:
    """The analogue facts and marts of one dataset folder; each is planned on
    first use, so a query pays only for the marts it reads."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    @cached_property
    def ev(self) -> DataFrame:
        return A.events(self.spark, self.folder)

    @cached_property
    def dim(self) -> DataFrame:
        return A.dim_city(self.spark, self.folder)

    @cached_property
    def weather(self) -> DataFrame:
        return A.weather_fact(self.ev)

    @cached_property
    def air(self) -> DataFrame:
        return A.air_quality_fact(self.ev)

    @cached_property
    def news(self) -> DataFrame:
        return A.news_fact(self.ev)

    @cached_property
    def infra(self) -> DataFrame:
        return A.infra_fact(self.ev)

    @cached_property
    def fx(self) -> DataFrame:
        return A.fx_fact(self.ev, self.dim)

    @cached_property
    def env(self) -> DataFrame:
        return M.environment_daily(self.weather, self.air, nudge=NUDGE)

    @cached_property
    def fx_mart(self) -> DataFrame:
        return M.fx_daily(self.fx, self.dim, max_dim_rows=None, nudge=NUDGE)

    @cached_property
    def mobility(self) -> DataFrame:
        return M.mobility_daily(self.env, self.infra, nudge=NUDGE)

    def composite(self) -> DataFrame:
        return M.city_intelligence_daily(
            self.env,
            self.fx_mart,
            self.mobility,
            self.news,
            self.dim,
            as_of=A.AS_OF,
            econ_penalty=A.ECON_PENALTY,
            nudge=NUDGE,
            max_dim_rows=None,
        )


# ------------------------------------------------------------ raw-layer ops


def json_scalar_extract(spark, folder):
    """scalar fields of a JSON payload, snapshot date = day of delivery."""
    e = load(spark, folder, "events")
    return e.select("event_id", A.k_of().alias("k"), F.to_date("ts").alias("snapshot_date"))


def content_hash_q(spark, folder):
    """R2: SHA-256 of the canonical (key-sorted, compact) payload."""
    e = load(spark, folder, "events")
    return e.select("event_id", content_hash("props").alias("hash"))


def strip_volatile_hash(spark, folder):
    """A volatile generation-time field is added, stripped, then hashed;
    the hash equals the plain content hash."""
    e = load(spark, folder, "events")
    noisy = F.concat(F.lit('{"generationtime_ms": '), F.col("event_id").cast("string"), F.lit(", "), F.expr("substring(props, 2)"))
    return e.select("event_id", content_hash(strip_volatile(noisy, ["generationtime_ms"])).alias("hash"))


def _deliveries(spark, folder):
    # the checksum is a join key: as a generator output it is hashed once,
    # not again in the IS NOT NULL filter Spark infers for join keys
    e = load(spark, folder, "events")
    return with_parsed(e, ["event_id", "ts", "user_id", "event_type"], content_hash("props"), "checksum")


def _load_split(spark, folder):
    p = _deliveries(spark, folder)
    cut = F.lit(A.LOADED_BEFORE).cast("timestamp_ntz")
    loaded, incoming = p.where(F.col("ts") < cut), p.where(F.col("ts") >= cut)
    return load_new(incoming, loaded, ["event_type", "user_id", "checksum"], [("ts", True), ("event_id", True)])


def anti_join_load(spark, folder):
    """Payloads of the second half not already loaded by the first half
    (key = source, scope, checksum); first arrival kept."""
    new_rows, _ = _load_split(spark, folder)
    return new_rows.select("event_type", "user_id", "checksum", "event_id", "ts")


def anti_join_load_counts(spark, folder):
    """Received / inserted / skipped tallies of the same load."""
    _, counts = _load_split(spark, folder)
    return counts


def same_day_duplicate_flag(spark, folder):
    """created = first delivery of (user, type, UTC day)."""
    e = load(spark, folder, "events").withColumn("d", F.to_date("ts"))
    flagged = flag_first_delivery(e, ["user_id", "event_type", "d"], ["ts", "event_id"])
    return flagged.select("event_id", "created")


def delivery_outcomes_q(spark, folder):
    """Per (source, scope, day): received, loaded (payload never seen
    before for that scope), status success / duplicate / error."""
    ev = A.events(spark, folder)
    flagged = flag_first_delivery(ev, ["event_type", "user_id", "k"], ["ts", "event_id"])
    err = F.when((F.col("event_type") == "error") & (F.col("k") % 20 == 0), F.lit("upstream failure"))
    flagged = flagged.withColumn("err", err)
    return delivery_outcomes(flagged, ["event_type", "user_id", "d"], "created", "err")


def _batches(spark, folder):
    """Synthetic delivery payload groups: (user, batch of 64 event ids),
    records sorted by (ts, event_id). Arrays are bounded by the batch size."""
    e = load(spark, folder, "events")
    return e.groupBy("user_id", F.floor(F.col("event_id") / BATCH_SIZE).alias("batch")).agg(
        F.array_sort(F.collect_list(F.struct("ts", "event_id", "value"))).alias("recs")
    )


def zip_arrays_unnest_q(spark, folder):
    """payload ``{"hourly": {"time": [...], "value": [...]}}`` -> rows."""
    b = _batches(spark, folder)
    payload = F.to_json(
        F.struct(
            F.struct(
                F.transform("recs", lambda r: F.date_format(r["ts"], ISO_SECONDS)).alias("time"),
                F.transform("recs", lambda r: r["value"]).alias("value"),
            ).alias("hourly")
        )
    )
    rows = zip_arrays_unnest(
        b.select("user_id", payload.alias("payload")),
        "payload",
        "hourly",
        {"time": ("t_text", StringType()), "value": ("v", DoubleType())},
        keep=["user_id"],
    )
    return rows.select("user_id", best_effort_ts("t_text").alias("t"), "v")


def record_array_unnest_q(spark, folder):
    """payload ``{"timeline": [{"data": [{date, value}, ...]}]}`` -> rows."""
    b = _batches(spark, folder)
    recs = F.transform(
        "recs", lambda r: F.struct(F.date_format(r["ts"], ISO_SECONDS).alias("date"), r["value"].alias("value"))
    )
    payload = F.to_json(F.struct(F.array(F.struct(recs.alias("data"))).alias("timeline")))
    schema = StructType([StructField("date", StringType()), StructField("value", DoubleType())])
    rows = record_array_unnest(
        b.select("user_id", payload.alias("payload")), "payload", "$.timeline[0].data", schema, keep=["user_id"]
    )
    return rows.select("user_id", best_effort_ts("date").alias("t"), F.col("value").alias("v"))


def wide_to_long_q(spark, folder):
    """Two measures of each part as (id, name, value) rows."""
    p = load(spark, folder, "part")
    return wide_to_long(
        p.withColumnRenamed("p_partkey", "id"), ["id"], {"retailprice": "p_retailprice", "size": "p_size"}
    )


def latest_by_key_q(spark, folder):
    """L1: newest whole row per (user, type), ties by event id."""
    e = load(spark, folder, "events").select("user_id", "event_type", "event_id", "ts", "value")
    return latest_by_key(e, ["user_id", "event_type"], "ts", "event_id")


# ---------------------------------------------------------------- rollups


def daily_rollup_q(spark, folder):
    """M1a shape on raw events: per user and day avg/min/max/sum/count."""
    e = load(spark, folder, "events")
    return daily_rollup(
        e,
        ["user_id"],
        "ts",
        {
            "avg_v": round_half_even(F.avg("value"), 2, NUDGE),
            "min_v": F.min("value"),
            "max_v": F.max("value"),
            "sum_v": round_half_even(F.sum("value"), 2, NUDGE),
            "n": F.count(F.lit(1)),
        },
    )


def daily_quality_rollup(spark, folder):
    """Daily air-quality rollup of the analogue air fact."""
    return M.daily_air_quality(A.air_quality_fact(A.events(spark, folder)), nudge=NUDGE)


def environment_mart(spark, folder):
    """Environment mart (weather days LEFT JOIN air-quality days)."""
    return Marts(spark, folder).env


def prev_obs_pct_change(spark, folder):
    """Daily order value per priority, previous observation, % change."""
    o = load(spark, folder, "orders")
    daily = o.groupBy("o_orderpriority", F.to_date("o_orderdate").alias("date")).agg(
        round_half_even(F.sum("o_totalprice"), 2, NUDGE).alias("v")
    )
    return lag_pct_change(daily, "o_orderpriority", "date", "v", "prev", "pct", 4, NUDGE)


def rate_fanout(spark, folder):
    """M2: FX mart — rates per currency, lagged, fanned out to cities."""
    return Marts(spark, folder).fx_mart


def latest_snapshot_q(spark, folder):
    """Per customer, columns of the newest order."""
    o = load(spark, folder, "orders")
    return latest_snapshot(
        o,
        "o_custkey",
        ["o_orderdate", "o_orderkey"],
        ["o_orderkey", "o_totalprice", "o_orderstatus", "o_orderpriority"],
    )


def stress_bucket(spark, folder):
    """M3: mobility mart — precipitation stress + latest infrastructure."""
    return Marts(spark, folder).mobility


def score_env(spark, folder):
    return M.environment_scores(Marts(spark, folder).env)


def score_econ(spark, folder):
    return M.economic_scores(Marts(spark, folder).fx_mart, A.ECON_PENALTY)


def score_mob(spark, folder):
    return M.mobility_scores(Marts(spark, folder).mobility)


def score_vib(spark, folder):
    return M.vibrancy_scores(Marts(spark, folder).news, nudge=NUDGE)


def composite_score(spark, folder):
    """M4e: the composite city-intelligence mart (flagship)."""
    return Marts(spark, folder).composite()


# ---------------------------------------------------------------- serving


def standings_q(spark, folder):
    """S3: composite at the latest date, ranked."""
    c = Marts(spark, folder).composite()
    s = standings(c, "date", "city_intelligence_score", "city_id")
    return s.select("rank", "city_id", "city_name", "date", "city_intelligence_score")


PILLARS = {
    "score_environment": ("Environment", 0.30),
    "score_economic": ("Economic / FX", 0.25),
    "score_mobility": ("Mobility", 0.25),
    "score_vibrancy": ("News Vibrancy", 0.20),
}


def pillar_contributions_q(spark, folder):
    """Pillar scores melted with their weights and weighted points."""
    c = Marts(spark, folder).composite()
    return pillar_contributions(c, ["city_id", "date"], PILLARS, 2, NUDGE)


def dedupe_first_q(spark, folder):
    """First row per (user, day) ordered by value desc, event id asc."""
    e = load(spark, folder, "events").select("user_id", F.to_date("ts").alias("d"), "event_id", "value", "event_type")
    return dedupe_first(e, ["user_id", "d"], [("value", False), ("event_id", True)])


def services_per_population(spark, folder):
    """S18 (+S6): latest mobility values per city, per 100k people."""
    m = Marts(spark, folder)
    return S.services_per_population(m.mobility, m.dim, NUDGE)


def max_density(spark, folder):
    """Max transit density on the latest day, 1.0 when missing or <= 0."""
    mob = Marts(spark, folder).mobility
    latest = F.broadcast(mob.agg(F.max("date").alias("_d")))
    at = mob.join(latest, mob["date"] == latest["_d"], "inner")
    agg = at.agg(F.max("date").alias("latest_date"), F.max("transit_density_sqkm").alias("_m"))
    return agg.select(
        "latest_date",
        F.when(F.col("_m").isNull() | (F.col("_m") <= 0), F.lit(1.0)).otherwise(F.col("_m")).alias("max_transit_density"),
    )


def per_100k_q(spark, folder):
    """Transit and fuel per 100k on the latest mobility day."""
    m = Marts(spark, folder)
    mob = m.mobility
    latest = F.broadcast(mob.agg(F.max("date").alias("_d")))
    at = mob.join(latest, mob["date"] == latest["_d"], "inner").join(m.dim.select("city_id", "population"), "city_id")
    return at.select(
        "city_id",
        "date",
        per_100k("transit_nodes_total", "population", 2, NUDGE).alias("transit_per_100k"),
        per_100k("fuel_stations_total", "population", 2, NUDGE).alias("fuel_per_100k"),
    )


def last_non_null_q(spark, folder):
    """Per user, newest non-NULL value of each column (may come from
    different rows) and the newest timestamp."""
    ev = A.events(spark, folder)
    df = ev.select(
        "user_id",
        "ts",
        "event_id",
        F.when(F.col("k") % 10 == 0, F.lit(None)).otherwise(F.col("value")).alias("v"),
        F.when(F.col("k") % 7 == 0, F.lit(None)).otherwise(F.col("k")).alias("w"),
    )
    return last_non_null(df, "user_id", ["ts", "event_id"], ["v", "w"], order_alias="last_ts")


def fx_latest_per_currency(spark, folder):
    """S11 on the FX mart: dedupe to (currency, date), then the newest
    non-NULL rate and change per currency."""
    latest = S.fx_latest_per_currency(Marts(spark, folder).fx_mart)
    return latest.select("currency", "units_per_usd", "day_pct_change", "date")


def cross_weather_transit(spark, folder):
    """Mobility mart joined to city names."""
    m = Marts(spark, folder)
    return S.weather_transit(m.mobility, m.dim)


def three_way_join(spark, folder):
    """Composite x FX mart x mobility mart on (city, date)."""
    m = Marts(spark, folder)
    return S.fx_fuel(m.composite(), m.fx_mart, m.mobility)


def cross_env_pressure(spark, folder):
    """Environment x city x composite environment score."""
    m = Marts(spark, folder)
    return S.environmental_pressure(m.env, m.dim, m.composite())


def cross_vibrancy_commerce(spark, folder):
    """Composite vibrancy x mobility commerce and transit."""
    m = Marts(spark, folder)
    return S.vibrancy_commerce(m.composite(), m.mobility)


def freshness_summary_q(spark, folder):
    """Freshness aggregates of the run log at a fixed ``as_of``."""
    return freshness_summary(A.run_log(A.events(spark, folder)), A.AS_OF, 36)


def freshness_verdict_q(spark, folder):
    """Verdict label and gate flag."""
    return freshness_verdict(freshness_summary_q(spark, folder), 36)


def log_tail_50(spark, folder):
    """The 50 newest log rows (a top-k report)."""
    log = A.run_log(A.events(spark, folder))
    return log.orderBy(F.col("started_at").desc(), F.col("event_id").desc()).limit(50).select(
        "run_id", "source_id", "city_id", "started_at", "status"
    )


def table_counts(spark, folder):
    """Row count of every table, one union job."""
    return S.table_counts({name: load(spark, folder, name) for name in DRIVER_TABLES})


def economic_indicator(spark, folder):
    """F5 analogue / S13: yearly order value per (country, priority)."""
    o = load(spark, folder, "orders").select("o_custkey", "o_orderpriority", "o_orderdate", "o_totalprice")
    c = load(spark, folder, "customer").select("c_custkey", "c_nationkey")
    n = load(spark, folder, "nation").select("n_nationkey", "n_name")
    j = o.join(c, o["o_custkey"] == c["c_custkey"]).join(
        bounded_broadcast(n), F.col("c_nationkey") == F.col("n_nationkey")
    )
    return j.groupBy(
        F.lower(F.col("n_name")).alias("country_code"),
        F.col("o_orderpriority").alias("indicator"),
        F.year("o_orderdate").alias("year"),
    ).agg(round_half_even(F.sum("o_totalprice"), 2, NUDGE).alias("value"))


def recent_filter(spark, folder):
    """Indicator rows of recent years."""
    return economic_indicator(spark, folder).where(F.col("year") >= 1998)


def bucket_peak(spark, folder):
    """News buckets per city and peak intensity."""
    return S.news_buckets(A.news_fact(A.events(spark, folder)), 3, NUDGE)


def gates_report(spark, folder):
    """Q1-Q5: declarative gates over 2 dimensions, 6 facts and 4 marts, one aggregate
    pass per table; the keys of the dimensions must be unique. Suppliers stand
    for the source registry."""
    m = Marts(spark, folder)
    sources = load(spark, folder, "supplier").select(F.col("s_suppkey").alias("source_id"))
    score_cols = ["city_intelligence_score", "score_environment", "score_economic", "score_mobility", "score_vibrancy"]
    out_of_range = None
    for c in score_cols:
        cond = (F.col(c) < 0) | (F.col(c) > 100)
        out_of_range = cond if out_of_range is None else out_of_range | cond
    return gate_report(
        [
            (m.dim, [MinRows("min_cities", 4), Rule("city_id_missing", F.col("city_id").isNull())], "dim_city"),
            (key_repeats(m.dim, ["city_id"]), [Rule("city_id_repeated", F.col("repeats") > 1)], "dim_city_keys"),
            (sources, [MinRows("min_sources", 6), Rule("source_id_missing", F.col("source_id").isNull())], "dim_source"),
            (key_repeats(sources, ["source_id"]), [Rule("source_id_repeated", F.col("repeats") > 1)], "dim_source_keys"),
            (m.weather, [MinRows("non_empty"), Rule("temperature_range", (F.col("temperature_c") < -10) | (F.col("temperature_c") > 60))], "weather"),
            (m.air, [MinRows("non_empty")], "air_quality"),
            (m.fx, [MinRows("non_empty"), Rule("rate_positive", ~(F.col("units_per_usd") > 0))], "fx"),
            (m.news, [MinRows("non_empty")], "news"),
            (economic_indicator(spark, folder), [MinRows("non_empty")], "economic_indicator"),
            (m.infra, [MinRows("non_empty")], "infrastructure"),
            (m.env, [MinRows("non_empty")], "mart_environment"),
            (m.fx_mart, [MinRows("non_empty")], "mart_fx"),
            (m.mobility, [MinRows("non_empty")], "mart_mobility"),
            (m.composite(), [MinRows("non_empty"), Rule("scores_in_range", out_of_range)], "mart_composite"),
        ]
    )


def quarantine_split_q(spark, folder):
    """Q7: every event lands in valid or quarantine; counts per outcome."""
    ev = A.events(spark, folder)
    rules = [
        Rule("value_out_of_range", (F.col("value") < 0) | (F.col("value") > 300)),
        Rule("k_missing", F.col("k").isNull()),
        Rule("error_event", F.col("event_type") == "error"),
    ]
    valid, bad = split_quarantine(ev, rules, F.col("event_type"), "city_id", quarantined_at=F.lit(A.AS_OF).cast("timestamp_ntz"))
    v = valid.select(F.lit("valid").alias("outcome"))
    b = bad.select(F.col("rule_violated").alias("outcome"))
    return v.unionByName(b).groupBy("outcome").agg(F.count(F.lit(1)).alias("n"))


def kpi_missing_audit(spark, folder):
    """Q8: composite KPI cells that would render as missing."""
    c = Marts(spark, folder).composite()
    found = kpi_missing(c, ["city_id", "date"], ["avg_pm2_5", "units_per_usd", "city_intelligence_score"])
    return found.select("city_id", "date", "kpi", "problem")


def _poi_payloads(spark, folder):
    ev = A.events(spark, folder)
    et = F.col("event_type")
    highway = F.when(et == "signup", F.lit("bus_stop"))
    amenity = (
        F.when((et == "signup") & (F.col("k") % 2 == 0), F.lit("fuel"))
        .when(et == "purchase", F.lit("bus_station"))
        .when(et == "click", F.lit("fuel"))
        .when(et == "view", F.lit("bank"))
        .when((et == "error") & (F.col("k") % 3 != 0), F.lit("marketplace"))
    )
    tags = F.map_filter(F.create_map(F.lit("highway"), highway, F.lit("amenity"), amenity), lambda k, v: v.isNotNull())
    return ev.groupBy("user_id", "d", F.floor(F.col("event_id") / BATCH_SIZE).alias("batch")).agg(
        F.to_json(F.struct(F.collect_list(F.struct(tags.alias("tags"))).alias("elements"))).alias("payload")
    )


def poi_counts_q(spark, folder):
    """Tag counts of each payload's elements, summed per user-day."""
    counted = poi_counts(_poi_payloads(spark, folder), "payload", keep=["user_id", "d"])
    cols = [
        "bus_stops",
        "transit_stations",
        "fuel_stations_total",
        "commercial_banks",
        "commercial_marketplaces",
        "transit_nodes_total",
        "commercial_nodes_total",
    ]
    return counted.groupBy("user_id", "d").agg(*[F.sum(c).cast("bigint").alias(c) for c in cols])


def customer_points(spark, folder):
    c = load(spark, folder, "customer")
    return c.select(
        "c_custkey",
        (F.lit(4.0) + (F.col("c_custkey") % 600) / F.lit(100)).alias("lat"),
        (F.lit(-1.0) + ((F.col("c_custkey") * 7) % 900) / F.lit(100)).alias("lon"),
    )


def radius_catchment_q(spark, folder):
    """Customers within 100 km of each seed city centre."""
    pts = customer_points(spark, folder)
    hits = radius_catchment(pts, dim_city_seed(spark), 100_000.0)
    return hits.groupBy("city_id").agg(F.count(F.lit(1)).alias("n"))


def distinct_countries(spark, folder):
    """Distinct sorted country codes of the city dimension."""
    return S.distinct_countries(A.dim_city(spark, folder))


def score_history(spark, folder):
    """Composite history projection."""
    return S.score_history(Marts(spark, folder).composite())


def environment_view(spark, folder):
    """Environment mart with city names."""
    m = Marts(spark, folder)
    return S.environment_view(m.env, m.dim)


def fx_change_series(spark, folder):
    """FX change series deduped to (currency, date), NULL changes dropped."""
    return S.fx_change_series(Marts(spark, folder).fx_mart).select("currency", "date", "units_per_usd", "day_pct_change")


def city_directory(spark, folder):
    """The city dimension listing."""
    return S.city_directory(A.dim_city(spark, folder))


def news_daily(spark, folder):
    """Daily news mart."""
    return S.news_daily(A.news_fact(A.events(spark, folder)), NUDGE)



def _raw_rows(df, source: str, scope, payload, ingested_at, path_key):
    """Raw-table-shaped rows (``schemas.RAW``) from derived payload text.

    The payload text is built deterministically (fixed field order), so its
    SHA-256 is already a content key; it is materialised once and hashed.
    """
    staged = df.select(
        scope.cast("string").alias("scope_id"),
        payload.alias("payload"),
        ingested_at.alias("ingested_at"),
        F.concat(F.lit(f"{source}/"), path_key.cast("string")).alias("raw_file_path"),
    )
    return staged.select(
        F.lit(source).alias("source"),
        F.sha2(F.col("payload"), 256).alias("checksum"),
        "scope_id",
        "payload",
        "ingested_at",
        "raw_file_path",
    )


def _order_delivery_time():
    # one delivery per order: order day + order key in microseconds (unique)
    return F.timestamp_add("MICROSECOND", F.col("o_orderkey"), F.col("o_orderdate")).cast("timestamp_ntz")


HOURLY_IDS = 16_384  # consecutive event ids per delivery (bounds every array at any scale)


def _window_deliveries(ev):
    """Two polls over the events of a city, as deliveries of whole windows:
    ten-day windows, and the same moved by five days with revised values
    (``rev`` = 1). Every event stands in one delivery of each; of the two the one
    whose window ends later was delivered later. One event per city and second."""
    one = latest_by_key(
        ev.select("city_id", "d", "ts", "event_id", "value", "k", F.date_trunc("second", "ts").cast("timestamp_ntz").alias("t")),
        ["city_id", "t"], "ts", "event_id",
    )
    day = F.date_diff(F.col("d"), F.lit("2024-01-01").cast("date"))
    polls = F.array(
        F.struct(F.lit(0).alias("rev"), F.floor(day / 10).alias("win")), F.struct(F.lit(1).alias("rev"), F.floor((day + 5) / 10).alias("win"))
    )
    rows = one.select("*", F.inline(polls))
    part = F.floor(F.col("event_id") / HOURLY_IDS)
    grouped = rows.groupBy("city_id", "rev", "win", part.alias("part")).agg(F.array_sort(F.collect_list(F.struct("t", "value", "k"))).alias("recs"))
    delivered = F.timestamp_add("HOUR", F.col("win") * 2 - F.col("rev"), F.lit("2024-03-01 00:00:00").cast("timestamp_ntz"))
    return grouped.withColumn("delivered", delivered.cast("timestamp_ntz"))


def _hourly_raw(spark, folder, event_type: str, source: str, series: dict):
    w = _window_deliveries(A.events(spark, folder).where(F.col("event_type") == event_type))
    times = F.transform("recs", lambda r: F.date_format(r["t"], ISO_SECONDS))
    of_record = lambda f: lambda r: f(r["value"] + F.col("rev"), r["k"])
    arrays = [F.transform("recs", of_record(f)).alias(name) for name, f in series.items()]
    payload = F.to_json(F.struct(F.struct(times.alias("time"), *arrays).alias("hourly")))
    return _raw_rows(w, source, F.col("city_id"), payload, F.col("delivered"), F.concat_ws("/", "city_id", "rev", "win", "part"))


def weather_deliveries(spark, folder):
    """Weather payloads of parallel arrays (``view`` events; no wind was measured)."""
    none = F.lit(None).cast("double")
    series = {
        "temperature_2m": lambda v, k: v, "precipitation": lambda v, k: v / F.lit(20.0), "relative_humidity_2m": lambda v, k: k, "wind_speed_10m": lambda v, k: none,
    }
    return _hourly_raw(spark, folder, "view", "open_meteo_weather", series)


def air_quality_deliveries(spark, folder):
    """Pollutant payloads (``purchase`` events; PM2.5 missing when k % 10 = 0)."""
    series = {
        "pm2_5": lambda v, k: F.when(k % 10 != 0, v), "pm10": lambda v, k: v * F.lit(1.5), "nitrogen_dioxide": lambda v, k: k, "ozone": lambda v, k: v / F.lit(4.0),
    }
    return _hourly_raw(spark, folder, "purchase", "open_meteo_air_quality", series)


def news_deliveries(spark, folder):
    """News payloads: two series of records (``error`` events), of which the first counts."""
    w = _window_deliveries(A.events(spark, folder).where(F.col("event_type") == "error"))
    stamp = lambda r: F.date_format(r["t"], "yyyyMMdd'T'HHmmss'Z'")
    first = F.transform("recs", lambda r: F.struct(stamp(r).alias("date"), ((r["k"] + F.col("rev")) / F.lit(200.0)).alias("value")))
    other = F.transform("recs", lambda r: F.struct(stamp(r).alias("date"), F.lit(-1.0).alias("value")))
    payload = F.to_json(F.struct(F.array(F.struct(first.alias("data")), F.struct(other.alias("data"))).alias("timeline")))
    return _raw_rows(w, "gdelt_news", F.col("city_id"), payload, F.col("delivered"), F.concat_ws("/", "city_id", "rev", "win", "part"))


def weather_fact_builder(spark, folder):
    """F1 on evidence-shaped payloads; hours that two deliveries hold are taken from the newer."""
    return FB.weather_hourly(weather_deliveries(spark, folder)).drop("source_id", "raw_checksum")


def air_quality_fact_builder(spark, folder):
    """F2 on evidence-shaped payloads; hours that two deliveries hold are taken from the newer."""
    return FB.air_quality_hourly(air_quality_deliveries(spark, folder)).drop("source_id", "raw_checksum")


def news_fact_builder(spark, folder):
    """F4 on evidence-shaped payloads: records of the first series, newest delivery wins."""
    return FB.news_intensity(news_deliveries(spark, folder)).drop("source_id", "raw_checksum")


def fx_fact_builder(spark, folder):
    """F3 on evidence-shaped payloads: one FX response per order (status P
    = failed response; GHS missing when orderkey % 7 = 0); RFC-2822 update
    time; newest delivery per (currency, day) wins."""
    o = load(spark, folder, "orders")
    payload = F.to_json(
        F.struct(
            F.when(F.col("o_orderstatus") == "P", F.lit("error")).otherwise(F.lit("success")).alias("result"),
            F.date_format("o_orderdate", "EEE, dd MMM yyyy HH:mm:ss +0000").alias("time_last_update_utc"),
            F.struct(
                (F.col("o_totalprice") / F.lit(1000.0)).alias("NGN"),
                F.when(F.col("o_orderkey") % 7 == 0, F.lit(None)).otherwise(F.col("o_totalprice") / F.lit(50000.0)).alias("GHS"),
            ).alias("rates"),
        )
    )
    raw = _raw_rows(o, "fx_rates", F.lit("global"), payload, _order_delivery_time(), F.col("o_orderkey"))
    return FB.fx_daily(raw).select("currency", "rate_date", "units_per_usd", "ingested_at")



def fx_cross_check_q(spark, folder):
    """Second FX source checked against the F3 rates. One EUR-based
    quote per order (USD rate varies with the customer, GHS follows the
    order value); the newest quote per day wins; GHS cross rate = GHS / USD,
    joined to the builder's GHS rate of the day with the deviation in %."""
    o = load(spark, folder, "orders")
    payload = F.to_json(
        F.struct(
            F.lit(1.0).alias("amount"),
            F.lit("EUR").alias("base"),
            F.date_format("o_orderdate", "yyyy-MM-dd").alias("date"),
            F.struct(
                (F.col("o_totalprice") / F.lit(50000.0) * F.lit(1.08)).alias("GHS"),
                (F.lit(1.1) + (F.col("o_custkey") % 5) / F.lit(100.0)).alias("USD"),
            ).alias("rates"),
        )
    )
    cross_raw = _raw_rows(o, "fx_frankfurter", F.lit("global"), payload, _order_delivery_time(), F.col("o_orderkey"))
    checked = FB.fx_cross_check(cross_raw, fx_fact_builder(spark, folder), ["GHS"])
    return checked.select("currency", "rate_date", "units_per_usd", "cross_units_per_usd", "deviation_pct")

def indicator_records(spark, folder):
    """F5 on evidence-shaped payloads ``[{page}, [records]]``: one record per
    order (country = nation, indicator = priority, date = year); newest
    delivery per (country, indicator, year) wins."""
    o = load(spark, folder, "orders")
    o = o.select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority", "o_totalprice")
    c = load(spark, folder, "customer").select("c_custkey", "c_nationkey")
    n = load(spark, folder, "nation").select("n_nationkey", "n_name")
    j = o.join(c, o["o_custkey"] == c["c_custkey"]).join(
        bounded_broadcast(n), F.col("c_nationkey") == F.col("n_nationkey")
    )
    record = F.to_json(
        F.array(
            F.struct(
                F.struct(F.col("o_orderpriority").alias("id")).alias("indicator"),
                F.struct(F.upper("n_name").alias("id")).alias("country"),
                F.year("o_orderdate").cast("string").alias("date"),
                F.col("o_totalprice").alias("value"),
            )
        )
    )
    payload = F.concat(F.lit('[{"page": 1}, '), record, F.lit("]"))
    raw = _raw_rows(j, "world_bank", F.col("n_name"), payload, _order_delivery_time(), F.col("o_orderkey"))
    return FB.economic_indicator(raw).select("country_code", "indicator", "year", "value")


def infrastructure_snapshots(spark, folder):
    """F6 on evidence-shaped payloads: one count object per signup event;
    snapshot day = delivery day; newest delivery per (city, day) wins."""
    ev = A.events(spark, folder).where(F.col("event_type") == "signup")
    payload = F.to_json(
        F.struct(
            (F.col("k") * 10).alias("transit_nodes_total"),
            (F.col("k") * 6).alias("bus_stops"),
            (F.col("k") * 4).alias("transit_stations"),
            (F.col("k") * 3).alias("fuel_stations_total"),
            (F.col("k") * 2).alias("commercial_nodes_total"),
            F.col("k").alias("commercial_banks"),
            F.col("k").alias("commercial_marketplaces"),
        )
    )
    raw = _raw_rows(ev, "osm_infrastructure", F.col("city_id"), payload, F.col("ts"), F.col("event_id"))
    return FB.osm_infrastructure(raw).drop("source_id", "raw_checksum")



def pillar_breakdown(spark, folder):
    """S4 as served: pillars of the latest-date standings, weighted points."""
    b = S.pillar_breakdown(Marts(spark, folder).composite(), NUDGE)
    return b.select("city_id", "city_name", "rank", "pillar", "score", "weight", "points")


def mobility_view(spark, folder):
    """Mobility mart with city name and population."""
    m = Marts(spark, folder)
    return S.mobility_view(m.mobility, m.dim)


def mobility_metric_melt(spark, folder):
    """Density and per-100k metrics of the latest day as (metric, value) rows."""
    m = Marts(spark, folder)
    latest = S.latest_mobility_per_100k(m.mobility, m.dim, NUDGE)
    return S.mobility_metric_melt(latest)


def city_options(spark, folder):
    """Distinct city names present in the environment view."""
    m = Marts(spark, folder)
    return S.city_options(S.environment_view(m.env, m.dim))


QUERIES = {
    "json_scalar_extract": json_scalar_extract,
    "content_hash": content_hash_q,
    "strip_volatile_hash": strip_volatile_hash,
    "anti_join_load": anti_join_load,
    "anti_join_load_counts": anti_join_load_counts,
    "same_day_duplicate_flag": same_day_duplicate_flag,
    "delivery_outcomes": delivery_outcomes_q,
    "zip_arrays_unnest": zip_arrays_unnest_q,
    "record_array_unnest": record_array_unnest_q,
    "wide_to_long": wide_to_long_q,
    "latest_by_key": latest_by_key_q,
    "daily_rollup": daily_rollup_q,
    "daily_quality_rollup": daily_quality_rollup,
    "environment_mart": environment_mart,
    "prev_obs_pct_change": prev_obs_pct_change,
    "rate_fanout": rate_fanout,
    "latest_snapshot": latest_snapshot_q,
    "stress_bucket": stress_bucket,
    "score_env": score_env,
    "score_econ": score_econ,
    "score_mob": score_mob,
    "score_vib": score_vib,
    "composite_score": composite_score,
    "standings": standings_q,
    "pillar_contributions": pillar_contributions_q,
    "dedupe_first": dedupe_first_q,
    "services_per_population": services_per_population,
    "per_100k": per_100k_q,
    "max_density": max_density,
    "last_non_null": last_non_null_q,
    "fx_latest_per_currency": fx_latest_per_currency,
    "cross_weather_transit": cross_weather_transit,
    "three_way_join": three_way_join,
    "cross_env_pressure": cross_env_pressure,
    "cross_vibrancy_commerce": cross_vibrancy_commerce,
    "freshness_summary": freshness_summary_q,
    "freshness_verdict": freshness_verdict_q,
    "log_tail_50": log_tail_50,
    "table_counts": table_counts,
    "economic_indicator": economic_indicator,
    "recent_filter": recent_filter,
    "bucket_peak": bucket_peak,
    "gates_report": gates_report,
    "quarantine_split": quarantine_split_q,
    "kpi_missing_audit": kpi_missing_audit,
    "poi_counts": poi_counts_q,
    "radius_catchment": radius_catchment_q,
    "distinct_countries": distinct_countries,
    "score_history": score_history,
    "environment_view": environment_view,
    "fx_change_series": fx_change_series,
    "city_directory": city_directory,
    "news_daily": news_daily,
    "weather_fact_builder": weather_fact_builder,
    "air_quality_fact_builder": air_quality_fact_builder,
    "news_fact_builder": news_fact_builder,
    "fx_fact_builder": fx_fact_builder,
    "fx_cross_check": fx_cross_check_q,
    "indicator_records": indicator_records,
    "infrastructure_snapshots": infrastructure_snapshots,
    "pillar_breakdown": pillar_breakdown,
    "mobility_view": mobility_view,
    "mobility_metric_melt": mobility_metric_melt,
    "city_options": city_options,
}
