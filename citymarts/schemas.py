"""Table schemas (Spark types) for raw, dimension, fact, mart and log tables.

Unsigned warehouse integers map to ``bigint``; Float32 measures of the facts
stay ``float``; mart averages are ``double``.
"""

from pyspark.sql.types import (
    DateType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)


def _s(*fields):
    return StructType([StructField(n, t, True) for n, t in fields])


S, D, F32, F64, L, I, TS = StringType(), DateType(), FloatType(), DoubleType(), LongType(), IntegerType(), TimestampNTZType()

RAW = _s(
    ("source", S), ("checksum", S), ("scope_id", S), ("payload", S), ("ingested_at", TS), ("raw_file_path", S)
)

DIM_CITY = _s(
    ("city_id", S), ("city_name", S), ("country", S), ("country_code", S), ("currency_code", S),
    ("latitude", F64), ("longitude", F64), ("timezone", S), ("population", L), ("valid_from", TS), ("is_current", I),
)
DIM_SOURCE = _s(
    ("source_id", S), ("source_name", S), ("domain", S), ("access_method", S), ("terms_url", S), ("refresh_rate", S)
)

_LINEAGE = (("source_id", S), ("raw_checksum", S), ("ingested_at", TS))

FACT_WEATHER_HOURLY = _s(
    ("city_id", S), ("observed_at", TS), ("temperature_c", F32), ("precipitation_mm", F32),
    ("relative_humidity", F32), ("wind_speed_kmh", F32), *_LINEAGE,
)
FACT_AIR_QUALITY_HOURLY = _s(
    ("city_id", S), ("observed_at", TS), ("pm2_5_ugm3", F32), ("pm10_ugm3", F32), ("no2_ugm3", F32),
    ("o3_ugm3", F32), *_LINEAGE,
)
FACT_FX_DAILY = _s(("currency", S), ("rate_date", D), ("units_per_usd", F64), *_LINEAGE)
FACT_NEWS_INTENSITY = _s(("city_id", S), ("observed_at", TS), ("mention_intensity", F32), *_LINEAGE)
FACT_ECONOMIC_INDICATOR = _s(("country_code", S), ("indicator", S), ("year", I), ("value", F64), *_LINEAGE)
FACT_OSM_INFRASTRUCTURE = _s(
    ("city_id", S), ("snapshot_date", D), ("transit_nodes_total", L), ("bus_stops", L), ("transit_stations", L),
    ("fuel_stations_total", L), ("commercial_nodes_total", L), ("commercial_banks", L),
    ("commercial_marketplaces", L), *_LINEAGE,
)

INGESTION_LOG = _s(
    ("run_id", S), ("source_id", S), ("city_id", S), ("started_at", TS), ("finished_at", TS), ("status", S),
    ("rows_received", L), ("rows_loaded", L), ("rows_quarantined", L), ("raw_checksum", S), ("error_message", S),
)
QUARANTINE = _s(
    ("quarantined_at", TS), ("source_id", S), ("city_id", S), ("rule_violated", S), ("raw_record", S),
    ("raw_checksum", S),
)

# Identity key and version of every keyed table (newest version wins).
FACT_KEYS = {
    "fact_weather_hourly": ["city_id", "observed_at"],
    "fact_air_quality_hourly": ["city_id", "observed_at"],
    "fact_fx_daily": ["currency", "rate_date"],
    "fact_news_intensity": ["city_id", "observed_at"],
    "fact_economic_indicator": ["country_code", "indicator", "year"],
    "fact_osm_infrastructure": ["city_id", "snapshot_date"],
}
