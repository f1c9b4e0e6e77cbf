"""Seeded dimensions: cities and registered sources.

Both are small by construction (one row per configured city / source) and
unique on their key, so joins against them are broadcast after a size check.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citymarts.schemas import DIM_CITY, DIM_SOURCE

# The city seed rows
# (city_id, city_name, country, country_code, currency_code, latitude, longitude, timezone, population)
CITY_SEED = [
    ("ng_lagos", "Lagos", "Nigeria", "NG", "NGN", 6.5244, 3.3792, "Africa/Lagos", 16000000),
    ("ng_abuja", "Abuja", "Nigeria", "NG", "NGN", 9.0765, 7.3986, "Africa/Lagos", 3700000),
    ("ng_port_harcourt", "Port Harcourt", "Nigeria", "NG", "NGN", 4.8156, 7.0498, "Africa/Lagos", 3300000),
    ("gh_accra", "Accra", "Ghana", "GH", "GHS", 5.6037, -0.1870, "Africa/Accra", 2500000),
]
CITY_VALID_FROM = "2026-01-01 00:00:00"

# The source registry seed rows
# (source_id, source_name, domain, access_method, terms_url, refresh_rate)
SOURCE_SEED = [
    ("open_meteo_weather", "Open-Meteo Weather API", "weather", "api", "https://open-meteo.com/en/terms", "hourly"),
    ("open_meteo_air_quality", "Open-Meteo CAMS Air Quality", "air_quality", "api", "https://open-meteo.com/en/terms", "hourly"),
    ("fx_rates", "open.er-api.com USD Rates", "fx", "api", "https://www.exchangerate-api.com/terms", "daily"),
    ("fx_frankfurter", "Frankfurter ECB Rates Cross-Check", "fx", "api", "https://frankfurter.dev", "daily"),
    ("gdelt_news", "GDELT DOC 2.0 API", "news", "api", "https://www.gdeltproject.org", "15min"),
    ("world_bank", "World Bank Indicators API", "economic", "api", "https://data.worldbank.org", "annual"),
    ("osm_infrastructure", "OpenStreetMap Overpass API", "geospatial_mobility", "api", "https://www.openstreetmap.org/copyright", "weekly"),
    ("tomtom_traffic", "TomTom Traffic Flow API (Evaluated/Documented)", "mobility", "api", "https://developer.tomtom.com/terms", "ad_hoc"),
]


def dim_city_seed(spark: SparkSession, rows=None) -> DataFrame:
    """City dimension from seed rows (``valid_from`` and ``is_current`` defaulted)."""
    data = [(*r, None, 1) for r in (rows or CITY_SEED)]
    df = spark.createDataFrame(data, DIM_CITY)
    return df.withColumn("valid_from", F.lit(CITY_VALID_FROM).cast("timestamp_ntz")).dropDuplicates(["city_id"])


def dim_source_seed(spark: SparkSession, rows=None) -> DataFrame:
    return spark.createDataFrame(list(rows or SOURCE_SEED), DIM_SOURCE).dropDuplicates(["source_id"])
