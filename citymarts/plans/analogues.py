"""Fact-shaped inputs derived from the shared test tables.

The test datasets carry no weather, FX or news payloads, so each fact gets an
analogue built from ``events`` (and ``nation``/``region``/``customer`` for the
city dimension). The analogues have the fact tables' column names, so the
very same mart builders run on them as on facts loaded from evidence files.

Mapping (events at any scale span 2024-01-01 .. 2024-01-30):

* city            ``user_id % 25`` -> ``nation.n_nationkey`` (dimension)
* weather         ``view`` events: temperature = value, precipitation = value/20,
                  humidity = props.k
* air quality     ``purchase`` events: PM2.5 = value, NULL when k % 10 = 0;
                  PM10 = 1.5 * value; NO2 = k
* FX              ``click`` events: one rate per (region, day) = mean value;
                  currency = region key, fanned out to the region's nations
* news            ``error`` events: mention intensity = k / 200
* infrastructure  ``signup`` events: counts proportional to k, one snapshot per
                  (city, day), newest delivery wins
* run log         event type -> status (error -> error; signup/purchase ->
                  success; click -> duplicate; view -> not logged)
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citymarts.functions.scalar import round_half_even
from citymarts.operators.joins import bounded_broadcast
from citymarts.operators.latest import latest_by_key
from citymarts.sources.tables import load

N_CITIES = 25
AS_OF = "2024-01-31 00:30:00"
LOADED_BEFORE = "2024-01-16 00:00:00"
NUDGE = 1e-9  # tie-breaking nudge used for every rounding in the analogue queries
ECON_PENALTY = 1.0  # the reference's 10 would floor almost every analogue day at 0


def k_of(props: str = "props"):
    """Integer ``k`` of the events' JSON ``props``."""
    return F.try_variant_get(F.try_parse_json(F.col(props)), "$.k", "bigint")


def events(spark: SparkSession, folder: str) -> DataFrame:
    """Events with ``k``, ``city_id`` and the UTC day ``d``."""
    e = load(spark, folder, "events")
    return e.select(
        "event_id",
        "ts",
        "user_id",
        "event_type",
        "value",
        k_of().alias("k"),
        (F.col("user_id") % N_CITIES).alias("city_id"),
        F.to_date("ts").alias("d"),
    )


def _lineage(source: str):
    return [
        F.lit(source).alias("source_id"),
        F.lit(None).cast("string").alias("raw_checksum"),
        F.col("ts").alias("ingested_at"),
    ]


def weather_fact(ev: DataFrame) -> DataFrame:
    return ev.where(F.col("event_type") == "view").select(
        "city_id",
        F.col("ts").alias("observed_at"),
        F.col("value").cast("float").alias("temperature_c"),
        (F.col("value") / F.lit(20)).cast("float").alias("precipitation_mm"),
        F.col("k").cast("float").alias("relative_humidity"),
        F.lit(None).cast("float").alias("wind_speed_kmh"),
        *_lineage("events:view"),
    )


def air_quality_fact(ev: DataFrame) -> DataFrame:
    return ev.where(F.col("event_type") == "purchase").select(
        "city_id",
        F.col("ts").alias("observed_at"),
        F.when(F.col("k") % 10 == 0, F.lit(None)).otherwise(F.col("value")).cast("float").alias("pm2_5_ugm3"),
        (F.col("value") * F.lit(1.5)).cast("float").alias("pm10_ugm3"),
        F.col("k").cast("float").alias("no2_ugm3"),
        F.lit(None).cast("float").alias("o3_ugm3"),
        *_lineage("events:purchase"),
    )


def news_fact(ev: DataFrame) -> DataFrame:
    return ev.where(F.col("event_type") == "error").select(
        "city_id",
        F.col("ts").alias("observed_at"),
        (F.col("k") / F.lit(200)).cast("float").alias("mention_intensity"),
        *_lineage("events:error"),
    )


def infra_fact(ev: DataFrame) -> DataFrame:
    """One snapshot per (city, day): the newest ``signup`` of the day wins."""
    raw = ev.where(F.col("event_type") == "signup").select(
        "city_id",
        F.col("d").alias("snapshot_date"),
        (F.col("k") * 10).alias("transit_nodes_total"),
        (F.col("k") * 6).alias("bus_stops"),
        (F.col("k") * 4).alias("transit_stations"),
        (F.col("k") * 3).alias("fuel_stations_total"),
        (F.col("k") * 2).alias("commercial_nodes_total"),
        F.col("k").alias("commercial_banks"),
        F.col("k").alias("commercial_marketplaces"),
        F.lit("events:signup").alias("source_id"),
        F.lit(None).cast("string").alias("raw_checksum"),
        F.col("ts").alias("ingested_at"),
        "event_id",
    )
    return latest_by_key(raw, ["city_id", "snapshot_date"], "ingested_at", "event_id").drop("event_id")


def dim_city(spark: SparkSession, folder: str) -> DataFrame:
    """Nations as cities: region = country and currency; population from
    the customer count of the nation (x 1000)."""
    nation = load(spark, folder, "nation")
    region = load(spark, folder, "region")
    pop = load(spark, folder, "customer").groupBy("c_nationkey").agg((F.count(F.lit(1)) * 1000).alias("population"))
    j = nation.join(region, nation["n_regionkey"] == region["r_regionkey"], "inner").join(
        pop, nation["n_nationkey"] == pop["c_nationkey"], "left"
    )
    dim = j.select(
        F.col("n_nationkey").cast("bigint").alias("city_id"),
        F.col("n_name").alias("city_name"),
        F.col("r_name").alias("country"),
        F.concat(F.lit("R"), F.col("n_regionkey").cast("string")).alias("country_code"),
        F.col("n_regionkey").alias("currency_code"),
        F.coalesce(F.col("population"), F.lit(0).cast("bigint")).alias("population"),
    )
    # one row per nation (inner join to a unique region key, left join to a
    # unique nation key): the nation table bounds the size, so one check on
    # it covers the whole dimension (region joins inside the broadcast side).
    return bounded_broadcast(dim, bound_by=nation)


def fx_fact(ev: DataFrame, dim: DataFrame) -> DataFrame:
    """Daily rate per currency (= region): mean ``click`` value of the
    region's cities, rounded to 4 decimals."""
    cur = dim.select(F.col("city_id").alias("_cid"), F.col("currency_code").alias("currency"))  # hinted dim
    clicks = ev.where(F.col("event_type") == "click")
    j = clicks.join(cur, clicks["city_id"] == cur["_cid"], "inner")
    return j.groupBy("currency", F.col("d").alias("rate_date")).agg(
        round_half_even(F.avg("value"), 4, NUDGE).alias("units_per_usd"),
        F.lit("events:click").alias("source_id"),
        F.lit(None).cast("string").alias("raw_checksum"),
        F.max("ts").alias("ingested_at"),
    )


def run_log(ev: DataFrame) -> DataFrame:
    """Events as an ingestion log (``view`` events are not logged)."""
    status = (
        F.when(F.col("event_type") == "error", F.lit("error"))
        .when(F.col("event_type").isin("signup", "purchase"), F.lit("success"))
        .when(F.col("event_type") == "click", F.lit("duplicate"))
    )
    return ev.select(
        F.col("event_id").cast("string").alias("run_id"),
        F.col("event_type").alias("source_id"),
        F.col("city_id").cast("string").alias("city_id"),
        F.col("ts").alias("started_at"),
        F.col("ts").alias("finished_at"),
        status.alias("status"),
        "event_id",
    ).where(F.col("status").isNotNull())
