"""Daily marts: environment, FX, mobility and the composite city score.

The builders take fact-shaped DataFrames (column names of the fact tables in
``citymarts.schemas``) and return mart-shaped DataFrames; thresholds,
weights and defaults are parameters.
"""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citymarts.functions.scalar import bucket, clamp, round_half_even
from citymarts.operators.joins import bounded_broadcast
from citymarts.operators.latest import latest_snapshot
from citymarts.operators.rollup import daily_rollup, null_ratio
from citymarts.operators.scoring import composite
from citymarts.operators.timeseries import lag_pct_change

# Fixed values of the reference scoring model.
PM25_UNHEALTHY = 35.4  # ug/m3, hourly PM2.5 above this counts as an unhealthy hour
STRESS_LEVELS = [(25.0, "Severe"), (5.0, "Moderate")]  # daily precipitation mm, else "Low"
CATCHMENT_AREA_SQKM = 706.86  # 15 km radius catchment, as the reference states it
WEIGHTS = {
    "score_environment": 0.30,
    "score_economic": 0.25,
    "score_mobility": 0.25,
    "score_vibrancy": 0.20,
}
DEFAULTS = {"score_economic": 80.0, "score_mobility": 50.0, "score_vibrancy": 50.0}
PM25_DEFAULT = 25.0  # assumed PM2.5 when a day has no air-quality average
ECON_PENALTY = 10.0  # points lost per 1 % daily FX move
MOBILITY_DIVISOR = 10.0  # transit nodes per score point
VIBRANCY_FACTOR = 200.0  # score points per unit of mean mention intensity

KEYS = ["city_id", "date"]


def _r(c: Column, digits: int, nudge: float) -> Column:
    return round_half_even(c, digits, nudge)


def daily_weather(weather: DataFrame, nudge: float = 0.0) -> DataFrame:
    """One row per (city_id, date) of hourly weather."""
    return daily_rollup(
        weather,
        ["city_id"],
        "observed_at",
        {
            "avg_temp_c": _r(F.avg("temperature_c"), 2, nudge),
            "min_temp_c": F.min("temperature_c").cast("double"),
            "max_temp_c": F.max("temperature_c").cast("double"),
            "total_precip_mm": _r(F.sum("precipitation_mm"), 2, nudge),
            "avg_humidity_pct": _r(F.avg("relative_humidity"), 2, nudge),
            "weather_samples": F.count(F.lit(1)),
        },
    )


def daily_air_quality(air: DataFrame, threshold: float = PM25_UNHEALTHY, nudge: float = 0.0) -> DataFrame:
    """Daily pollutant means, unhealthy hours and missingness."""
    return daily_rollup(
        air,
        ["city_id"],
        "observed_at",
        {
            "avg_pm2_5": _r(F.avg("pm2_5_ugm3"), 2, nudge),
            "max_pm2_5": F.max("pm2_5_ugm3").cast("double"),
            "avg_pm10": _r(F.avg("pm10_ugm3"), 2, nudge),
            "avg_no2": _r(F.avg("no2_ugm3"), 2, nudge),
            "hours_pm25_unhealthy": F.count_if(F.col("pm2_5_ugm3").cast("double") > F.lit(float(threshold))),
            "aq_missingness_ratio": null_ratio("pm2_5_ugm3", 4, nudge),
            "aq_samples": F.count(F.lit(1)),
        },
    )


def environment_daily(
    weather: DataFrame, air: DataFrame, threshold: float = PM25_UNHEALTHY, nudge: float = 0.0
) -> DataFrame:
    """Weather days LEFT JOIN air-quality days.

    A weather day without air quality reads as fully missing (ratio 1.0,
    0 hours, 0 samples, NULL pollutants).
    """
    w = daily_weather(weather, nudge)
    a = daily_air_quality(air, threshold, nudge)
    j = w.join(a, KEYS, "left")
    return j.select(
        "city_id",
        "date",
        "avg_temp_c",
        "min_temp_c",
        "max_temp_c",
        "total_precip_mm",
        "avg_humidity_pct",
        "avg_pm2_5",
        "max_pm2_5",
        "avg_pm10",
        "avg_no2",
        F.coalesce("hours_pm25_unhealthy", F.lit(0).cast("bigint")).alias("hours_pm25_unhealthy"),
        F.coalesce("aq_missingness_ratio", F.lit(1.0)).alias("aq_missingness_ratio"),
        "weather_samples",
        F.coalesce("aq_samples", F.lit(0).cast("bigint")).alias("aq_samples"),
    )


def fx_daily(
    fx: DataFrame, dim_city: DataFrame, max_dim_rows: int | None = 100_000, nudge: float = 0.0
) -> DataFrame:
    """M2: previous observed rate, guarded % change, fanned out to every city
    that uses the currency (broadcast dimension, size-checked;
    ``max_dim_rows=None`` when the caller already checked and hinted it)."""
    lagged = lag_pct_change(
        fx.select(F.col("rate_date").alias("date"), "currency", "units_per_usd", "ingested_at"),
        "currency",
        "date",
        "units_per_usd",
        prev_col="prev_day_units_per_usd",
        pct_col="day_pct_change",
        digits=4,
        nudge=nudge,
    )
    dim = bounded_broadcast(
        dim_city.select("city_id", "country", F.col("currency_code").alias("_ccy")), max_dim_rows
    )
    return lagged.join(dim, lagged["currency"] == dim["_ccy"], "inner").select(
        "date",
        "city_id",
        "country",
        "currency",
        "units_per_usd",
        "prev_day_units_per_usd",
        "day_pct_change",
        F.col("ingested_at").alias("last_updated"),
    )


INFRA_COUNTS = [
    "transit_nodes_total",
    "bus_stops",
    "transit_stations",
    "fuel_stations_total",
    "commercial_nodes_total",
]


def latest_infrastructure(infra: DataFrame) -> DataFrame:
    """Newest snapshot per city (ties broken by ingestion time)."""
    return latest_snapshot(infra, "city_id", ["snapshot_date", "ingested_at"], INFRA_COUNTS)


def mobility_daily(
    env: DataFrame, infra: DataFrame, area_sqkm: float = CATCHMENT_AREA_SQKM, nudge: float = 0.0
) -> DataFrame:
    """M3: precipitation stress per environment day, with the latest
    infrastructure snapshot of the city repeated on every day."""
    latest = latest_infrastructure(infra)
    days = env.select(
        "city_id",
        "date",
        F.col("total_precip_mm").alias("daily_precip_mm"),
        bucket("total_precip_mm", STRESS_LEVELS, "Low").alias("weather_stress_level"),
    )
    j = days.join(latest, "city_id", "left")
    counts = [F.coalesce(F.col(c), F.lit(0).cast("bigint")).alias(c) for c in INFRA_COUNTS]
    out = j.select("city_id", "date", *counts, "daily_precip_mm", "weather_stress_level")
    return out.withColumn(
        "transit_density_sqkm", _r(F.col("transit_nodes_total") / F.lit(area_sqkm), 4, nudge)
    ).withColumn("fuel_density_sqkm", _r(F.col("fuel_stations_total") / F.lit(area_sqkm), 4, nudge))


def environment_scores(env: DataFrame, pm25_default: float = PM25_DEFAULT) -> DataFrame:
    """``clamp(100 - coalesce(avg_pm2_5, default))`` per city-day."""
    return env.select(
        "city_id",
        "date",
        "avg_pm2_5",
        clamp(F.lit(100.0) - F.coalesce(F.col("avg_pm2_5"), F.lit(pm25_default))).alias("score_environment"),
    )


def economic_scores(fx_mart: DataFrame, penalty: float = ECON_PENALTY) -> DataFrame:
    """``clamp(100 - |daily % change| * penalty)``."""
    return fx_mart.select(
        "city_id",
        "date",
        "units_per_usd",
        clamp(F.lit(100.0) - F.abs(F.coalesce(F.col("day_pct_change"), F.lit(0.0))) * F.lit(penalty)).alias(
            "score_economic"
        ),
    )


def mobility_scores(mobility: DataFrame, divisor: float = MOBILITY_DIVISOR) -> DataFrame:
    """``clamp(transit_nodes / divisor)``."""
    return mobility.select(
        "city_id",
        "date",
        F.col("transit_nodes_total").alias("transit_nodes"),
        clamp(F.col("transit_nodes_total") / F.lit(divisor)).alias("score_mobility"),
    )


def vibrancy_scores(news: DataFrame, factor: float = VIBRANCY_FACTOR, nudge: float = 0.0) -> DataFrame:
    """M4d: per city-day mean mention intensity and its clamped score."""
    return daily_rollup(
        news,
        ["city_id"],
        "observed_at",
        {
            "news_intensity_pct": _r(F.avg("mention_intensity"), 4, nudge),
            "score_vibrancy": clamp(F.avg("mention_intensity") * F.lit(factor)),
        },
    )


def city_intelligence_daily(
    env: DataFrame,
    fx_mart: DataFrame,
    mobility: DataFrame,
    news: DataFrame,
    dim_city: DataFrame,
    as_of: datetime | str,
    weights: Mapping[str, float] = WEIGHTS,
    defaults: Mapping[str, float] = DEFAULTS,
    econ_penalty: float = ECON_PENALTY,
    nudge: float = 0.0,
    max_dim_rows: int | None = 100_000,
) -> DataFrame:
    """M4e: composite 0-100 score per city-day.

    Environment days INNER JOIN the city dimension (broadcast, size-checked),
    LEFT JOIN economic / mobility / vibrancy pillars on (city_id, date).
    """
    dim = bounded_broadcast(dim_city.select("city_id", "city_name", "country"), max_dim_rows)
    base = environment_scores(env).join(dim, "city_id", "inner")
    scored = composite(
        base,
        {
            "score_economic": economic_scores(fx_mart, econ_penalty),
            "score_mobility": mobility_scores(mobility),
            "score_vibrancy": vibrancy_scores(news, nudge=nudge),
        },
        weights,
        defaults,
        KEYS,
        base_score="score_environment",
        score_col="city_intelligence_score",
        digits=2,
        nudge=nudge,
    )
    return scored.select(
        "city_id",
        "city_name",
        "country",
        "date",
        "city_intelligence_score",
        "score_environment",
        "score_economic",
        "score_mobility",
        "score_vibrancy",
        "avg_pm2_5",
        "units_per_usd",
        F.coalesce("transit_nodes", F.lit(0).cast("bigint")).alias("transit_nodes"),
        F.coalesce("news_intensity_pct", F.lit(0.0)).alias("news_intensity_pct"),
        F.lit(str(as_of)).cast("timestamp_ntz").alias("calculated_at"),
    )
