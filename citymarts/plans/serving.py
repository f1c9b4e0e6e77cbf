"""Serving queries over the marts (the dashboard's data work, S1-S27).

Each function takes mart / dimension DataFrames and returns a DataFrame;
ordering is applied only where the order is the result (listings, top-k).
Every de-duplication uses a total order (key tie-break) so results are
deterministic.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citymarts.functions.scalar import round_half_even
from citymarts.operators.latest import dedupe_first, last_non_null, latest_snapshot
from citymarts.operators.scoring import pillar_contributions, standings
from citymarts.operators.unnest import wide_to_long

# Pillar labels and weights shown with the composite.
PILLARS = {
    "score_environment": ("Environment", 0.30),
    "score_economic": ("Economic / FX", 0.25),
    "score_mobility": ("Mobility", 0.25),
    "score_vibrancy": ("News Vibrancy", 0.20),
}


def _names(dim: DataFrame) -> DataFrame:
    return dim.select("city_id", "city_name", "country")


def score_history(ci: DataFrame) -> DataFrame:
    """Composite history, newest first, best first."""
    cols = ["city_id", "city_name", "country", "date", "city_intelligence_score", *PILLARS,
            "avg_pm2_5", "units_per_usd", "transit_nodes"]
    return ci.select(*cols).orderBy(F.col("date").desc(), F.col("city_intelligence_score").desc(), "city_id")


def latest_standings(ci: DataFrame) -> DataFrame:
    """S3: ranked rows of the latest date (cities without that date drop out)."""
    return standings(ci, "date", "city_intelligence_score", "city_id")


def pillar_breakdown(ci: DataFrame, nudge: float = 0.0) -> DataFrame:
    """Pillar scores of the latest standings with weights and points."""
    return pillar_contributions(latest_standings(ci), ["city_id", "city_name", "rank"], PILLARS, 2, nudge)


def mobility_view(mob: DataFrame, dim: DataFrame) -> DataFrame:
    """Mobility mart with city names and population."""
    return mob.join(dim.select("city_id", "city_name", "country", "population"), "city_id")


def latest_mobility_per_100k(mob: DataFrame, dim: DataFrame, nudge: float = 0.0) -> DataFrame:
    """Latest-date mobility rows, transit and fuel per 100k residents."""
    view = mobility_view(mob, dim)
    latest = F.broadcast(view.agg(F.max("date").alias("_d")))
    at = view.join(latest, view["date"] == latest["_d"]).drop("_d")
    per = lambda c: round_half_even(F.try_divide(F.col(c), F.col("population") / F.lit(100000.0)), 2, nudge)
    return at.withColumn("transit_per_100k", per("transit_nodes_total")).withColumn(
        "fuel_per_100k", per("fuel_stations_total")
    )


def max_transit_density(mob: DataFrame) -> DataFrame:
    """Largest transit density on the latest date; 1.0 if missing or <= 0."""
    latest = F.broadcast(mob.agg(F.max("date").alias("_d")))
    at = mob.join(latest, mob["date"] == latest["_d"])
    agg = at.agg(F.max("date").alias("latest_date"), F.max(F.col("transit_density_sqkm").cast("double")).alias("_m"))
    return agg.select(
        "latest_date",
        F.when(F.col("_m").isNull() | (F.col("_m") <= 0), F.lit(1.0)).otherwise(F.col("_m")).alias("max_transit_density"),
    )


def mobility_metric_melt(mob_latest: DataFrame) -> DataFrame:
    """Density pair and access pair as (metric, value) rows per city."""
    return wide_to_long(
        mob_latest,
        ["city_id", "city_name"],
        {
            "Transit density": "transit_density_sqkm",
            "Fuel density": "fuel_density_sqkm",
            "Transit per 100k": "transit_per_100k",
            "Fuel per 100k": "fuel_per_100k",
        },
        "metric",
        "value",
    )


def environment_view(env: DataFrame, dim: DataFrame) -> DataFrame:
    """Environment mart with city names."""
    return env.join(_names(dim), "city_id")


def city_options(view: DataFrame) -> DataFrame:
    """Distinct city names of a view."""
    return view.select("city_name").distinct()


def filter_city(view: DataFrame, city_name: str | None) -> DataFrame:
    """Optional equality filter (``None`` / "All Cities" keeps everything)."""
    if city_name in (None, "All Cities"):
        return view
    return view.where(F.col("city_name") == F.lit(city_name))


def fx_by_currency_day(fx_mart: DataFrame) -> DataFrame:
    """The FX mart repeats a rate for every city of the currency; one
    row per (currency, date), lowest city id kept."""
    cols = ["currency", "date", "city_id", "units_per_usd", "prev_day_units_per_usd", "day_pct_change", "last_updated"]
    return dedupe_first(fx_mart.select(*cols), ["currency", "date"], [("city_id", True)])


def fx_latest_per_currency(fx_mart: DataFrame) -> DataFrame:
    """Newest non-NULL value of each FX column per currency (values may
    come from different dates)."""
    return last_non_null(
        fx_by_currency_day(fx_mart),
        "currency",
        "date",
        ["units_per_usd", "prev_day_units_per_usd", "day_pct_change"],
        order_alias="date",
    )


def fx_change_series(fx_mart: DataFrame) -> DataFrame:
    """Daily change series without the days that have no change."""
    return fx_by_currency_day(fx_mart).where(F.col("day_pct_change").isNotNull())


def indicator_listing(econ: DataFrame) -> DataFrame:
    """Indicators by country, indicator, newest year first."""
    return econ.select("country_code", "indicator", "year", "value").orderBy(
        "country_code", "indicator", F.col("year").desc()
    )


def weather_transit(mob: DataFrame, dim: DataFrame) -> DataFrame:
    """S14 (Q1): precipitation stress against transit access."""
    return mob.join(_names(dim), "city_id").select(
        "city_name", "date", "daily_precip_mm", "weather_stress_level", "transit_nodes_total", "fuel_stations_total"
    )


def fx_fuel(ci: DataFrame, fx_mart: DataFrame, mob: DataFrame) -> DataFrame:
    """S15 (Q2): FX change against fuel access, 3-way join on (city, date)."""
    c = ci.select("city_id", "city_name", "date", "units_per_usd")
    f = fx_mart.select("city_id", "date", F.col("day_pct_change").alias("fx_24h_pct_change"))
    m = mob.select("city_id", "date", "fuel_stations_total", "fuel_density_sqkm")
    return c.join(f, ["city_id", "date"]).join(m, ["city_id", "date"]).select(
        "city_name", "date", "units_per_usd", "fx_24h_pct_change", "fuel_stations_total", "fuel_density_sqkm"
    )


def environmental_pressure(env: DataFrame, dim: DataFrame, ci: DataFrame) -> DataFrame:
    """S16 (Q3): pollution and the environment score."""
    c = ci.select("city_id", "date", "score_environment")
    return env.join(_names(dim), "city_id").join(c, ["city_id", "date"]).select(
        "city_name", "date", "avg_pm2_5", "hours_pm25_unhealthy", "avg_no2", "score_environment"
    )


def vibrancy_commerce(ci: DataFrame, mob: DataFrame) -> DataFrame:
    """S17 (Q4): news vibrancy against commercial and transit nodes."""
    c = ci.select("city_id", "city_name", "date", "score_vibrancy", "news_intensity_pct")
    m = mob.select("city_id", "date", "commercial_nodes_total", "transit_nodes_total")
    return c.join(m, ["city_id", "date"]).select(
        "city_name", "date", "score_vibrancy", "news_intensity_pct", "commercial_nodes_total", "transit_nodes_total"
    )


def services_per_population(mob: DataFrame, dim: DataFrame, nudge: float = 0.0) -> DataFrame:
    """S18 (Q5): newest mobility counts per city, per 100k residents."""
    latest = latest_snapshot(mob, "city_id", "date", ["transit_nodes_total", "commercial_nodes_total"])
    j = dim.select("city_id", "city_name", "population").join(latest, "city_id")
    per = lambda c: round_half_even(F.try_divide(F.col(c), F.col("population") / F.lit(100000.0)), 2, nudge)
    return j.select(
        "city_name",
        "population",
        "transit_nodes_total",
        "commercial_nodes_total",
        per("transit_nodes_total").alias("transit_nodes_per_100k"),
        per("commercial_nodes_total").alias("commercial_nodes_per_100k"),
    )


def source_registry(dim_source: DataFrame) -> DataFrame:
    """S21."""
    return dim_source.select("source_id", "source_name", "domain", "access_method", "terms_url", "refresh_rate")


def log_tail(log: DataFrame, n: int = 50, tiebreak: str = "run_id") -> DataFrame:
    """The ``n`` newest log rows (a top-k: partial top-k per task, then merge)."""
    return log.orderBy(F.col("started_at").desc(), F.col(tiebreak).desc()).limit(n)


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Row count per table, as one union job."""
    out = None
    for name, df in tables.items():
        part = df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("table_name"), "n")
        out = part if out is None else out.unionByName(part)
    return out


def city_directory(dim: DataFrame) -> DataFrame:
    """Cities ordered by country and name."""
    return dim.orderBy("country", "city_name")


def recent_indicators(econ: DataFrame, min_year: int = 2022) -> DataFrame:
    """Indicator rows from ``min_year`` on."""
    return econ.where(F.col("year") >= min_year).orderBy("country_code", "indicator", F.col("year").desc())


def news_buckets(news: DataFrame, digits: int = 3, nudge: float = 0.0) -> DataFrame:
    """News observations per city and their peak intensity."""
    return news.groupBy("city_id").agg(
        F.count(F.lit(1)).alias("buckets"),
        round_half_even(F.max("mention_intensity"), digits, nudge).alias("peak"),
    )


def news_daily(news: DataFrame, nudge: float = 0.0) -> DataFrame:
    """Daily news mart (mean intensity per city-day)."""
    return news.groupBy("city_id", F.to_date("observed_at").alias("date")).agg(
        round_half_even(F.avg("mention_intensity"), 4, nudge).alias("news_intensity_pct"),
        F.count(F.lit(1)).alias("observations"),
    )


def preview(df: DataFrame, order: list, n: int = 12) -> DataFrame:
    """First ``n`` rows under a total order (a preview is a top-k)."""
    return df.orderBy(*order).limit(n)


def distinct_countries(dim: DataFrame) -> DataFrame:
    """The sorted distinct country codes of the city dimension."""
    return dim.select("country_code").distinct().orderBy("country_code")
