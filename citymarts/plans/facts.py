"""JSON payload -> fact builders (newest delivery wins per fact key).

Each builder takes the raw table (``schemas.RAW``), keeps its source, takes
the newest copy of each delivery (scope, checksum), turns payloads into
typed rows and collapses them on the fact key (version ``ingested_at``,
tie-break ``raw_checksum``). ``*_rejects`` return the rows that must go to
quarantine instead of silently disappearing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StringType, StructField, StructType

from citymarts.functions.timeparse import best_effort_ts
from citymarts.operators.geo import poi_counts
from citymarts.operators.latest import latest_by_key, newest_copies
from citymarts.operators.unnest import record_array_unnest, with_parsed, zip_arrays_rejects, zip_arrays_unnest
from citymarts.schemas import (
    FACT_AIR_QUALITY_HOURLY,
    FACT_ECONOMIC_INDICATOR,
    FACT_FX_DAILY,
    FACT_KEYS,
    FACT_NEWS_INTENSITY,
    FACT_OSM_INFRASTRUCTURE,
    FACT_WEATHER_HOURLY,
)

# Payload fields read by each hourly builder, source -> fact column.
WEATHER_FIELDS = {
    "time": "t",
    "temperature_2m": "temperature_c",
    "precipitation": "precipitation_mm",
    "relative_humidity_2m": "relative_humidity",
    "wind_speed_10m": "wind_speed_kmh",
}
AIR_QUALITY_FIELDS = {
    "time": "t",
    "pm2_5": "pm2_5_ugm3",
    "pm10": "pm10_ugm3",
    "nitrogen_dioxide": "no2_ugm3",
    "ozone": "o3_ugm3",
}
FX_CURRENCIES = ["NGN", "GHS"]
OSM_COUNTS = [
    "transit_nodes_total",
    "bus_stops",
    "transit_stations",
    "fuel_stations_total",
    "commercial_nodes_total",
    "commercial_banks",
    "commercial_marketplaces",
]
LINEAGE = ["scope_id", "checksum", "ingested_at"]


RAW_KEY = ["source", "scope_id", "checksum"]


class CollapsedRaw:
    """Raw rows of which no key has a second copy: the builders take them as they are."""

    def __init__(self, rows: DataFrame):
        self.rows = rows


def collapse_raw(raw: DataFrame) -> CollapsedRaw:
    """R5 for all sources at once: newest copy per (source, scope, checksum). The
    payload of a delivery without a second copy is not shuffled."""
    rows = raw.select(*RAW_KEY, "payload", "ingested_at", "raw_file_path")
    return CollapsedRaw(newest_copies(rows, RAW_KEY, "ingested_at", "raw_file_path"))


def raw_of(raw: DataFrame | CollapsedRaw, source: str) -> DataFrame:
    """One source's raw rows, newest copy per (scope, checksum)."""
    rows = raw.rows if isinstance(raw, CollapsedRaw) else raw
    r = rows.where(F.col("source") == source).select("scope_id", "checksum", "payload", "ingested_at", "raw_file_path")
    return r if isinstance(raw, CollapsedRaw) else latest_by_key(r, ["scope_id", "checksum"], "ingested_at", "raw_file_path")


def _lineage(source: str):
    return [F.lit(source).alias("source_id"), F.col("checksum").alias("raw_checksum"), "ingested_at"]


def _collapse(df: DataFrame, table: str, schema: StructType) -> DataFrame:
    out = latest_by_key(df, FACT_KEYS[table], "ingested_at", "raw_checksum")
    return out.select(*[F.col(f.name).cast(f.dataType) for f in schema.fields])


def _hourly(raw: DataFrame, source: str, fields: dict) -> DataFrame:
    spec = {src: (dst, StringType() if src == "time" else DoubleType()) for src, dst in fields.items()}
    rows = zip_arrays_unnest(raw_of(raw, source), "payload", "hourly", spec, keep=LINEAGE)
    measures = [F.col(dst).cast("float").alias(dst) for src, dst in fields.items() if src != "time"]
    return rows.select(
        F.col("scope_id").alias("city_id"),
        best_effort_ts("t").alias("observed_at"),
        *measures,
        *_lineage(source),
    )


def weather_hourly(raw: DataFrame, source: str = "open_meteo_weather") -> DataFrame:
    """``hourly`` parallel arrays -> one row per city-hour."""
    rows = _hourly(raw, source, WEATHER_FIELDS).where(F.col("observed_at").isNotNull())
    return _collapse(rows, "fact_weather_hourly", FACT_WEATHER_HOURLY)


def air_quality_hourly(raw: DataFrame, source: str = "open_meteo_air_quality") -> DataFrame:
    """same operator as F1 on the pollutant arrays."""
    rows = _hourly(raw, source, AIR_QUALITY_FIELDS).where(F.col("observed_at").isNotNull())
    return _collapse(rows, "fact_air_quality_hourly", FACT_AIR_QUALITY_HOURLY)


def hourly_rejects(raw: DataFrame, source: str, fields: dict) -> DataFrame:
    """Deliveries with unequal/missing arrays, and hours whose time does not
    parse: (scope_id, checksum, rule, payload)."""
    spec = {src: (dst, StringType() if src == "time" else DoubleType()) for src, dst in fields.items()}
    r = raw_of(raw, source)
    arrays = zip_arrays_rejects(r, "payload", "hourly", spec, keep=["scope_id", "checksum"], with_missing_root=True).select(
        "scope_id", "checksum", F.lit("unequal_arrays").alias("rule"), "payload"
    )
    times = _hourly(raw, source, fields).where(F.col("observed_at").isNull()).select(
        F.col("city_id").alias("scope_id"),
        F.col("raw_checksum").alias("checksum"),
        F.lit("unparsable_time").alias("rule"),
        F.lit(None).cast("string").alias("payload"),
    )
    return arrays.unionByName(times)


def fx_daily(raw: DataFrame, currencies: Sequence[str] = FX_CURRENCIES, source: str = "fx_rates") -> DataFrame:
    """successful responses -> one row per (currency, rate day).

    The currency list is a parameter; all currencies come out of a single
    scan (one ``inline`` of an array of structs, not a UNION of scans).
    Missing rates are dropped.
    """
    r = with_parsed(raw_of(raw, source), ["checksum", "ingested_at"], F.try_parse_json("payload"), "_v")
    v = F.col("_v")  # parsed once, read per field
    parsed = r.select(
        F.try_variant_get(v, "$.result", "string").alias("result"),
        F.to_date(best_effort_ts(F.try_variant_get(v, "$.time_last_update_utc", "string"))).alias("rate_date"),
        F.array(
            *[
                F.struct(F.lit(c).alias("currency"), F.try_variant_get(v, f"$.rates.{c}", "double").alias("units_per_usd"))
                for c in currencies
            ]
        ).alias("_rates"),
        "checksum",
        "ingested_at",
    ).where(F.col("result") == "success")
    rows = parsed.select("rate_date", F.inline("_rates"), *_lineage(source)).where(
        F.col("units_per_usd").isNotNull() & F.col("rate_date").isNotNull()
    )
    return _collapse(rows, "fact_fx_daily", FACT_FX_DAILY)


NEWS_RECORD = StructType([StructField("date", StringType()), StructField("value", DoubleType())])


def news_intensity(raw: DataFrame, source: str = "gdelt_news") -> DataFrame:
    """first timeline series' ``data[]`` records -> city-time rows."""
    rows = record_array_unnest(raw_of(raw, source), "payload", "$.timeline[0].data", NEWS_RECORD, keep=LINEAGE)
    out = rows.select(
        F.col("scope_id").alias("city_id"),
        best_effort_ts("date").alias("observed_at"),
        F.col("value").cast("float").alias("mention_intensity"),
        *_lineage(source),
    ).where(F.col("observed_at").isNotNull())
    return _collapse(out, "fact_news_intensity", FACT_NEWS_INTENSITY)


INDICATOR_RECORD = StructType(
    [
        StructField("indicator", StructType([StructField("id", StringType())])),
        StructField("country", StructType([StructField("id", StringType())])),
        StructField("date", StringType()),
        StructField("value", DoubleType()),
    ]
)


def economic_indicator(raw: DataFrame, source: str = "world_bank") -> DataFrame:
    """records of the second top-level element -> (country, indicator,
    year) rows with a value; NULL values dropped."""
    rows = record_array_unnest(raw_of(raw, source), "payload", "$[1]", INDICATOR_RECORD, keep=LINEAGE)
    out = rows.select(
        F.lower(F.col("country.id")).alias("country_code"),
        F.col("indicator.id").alias("indicator"),
        F.expr("try_cast(date AS INT)").alias("year"),
        "value",
        *_lineage(source),
    ).where(F.col("value").isNotNull() & F.col("year").isNotNull())
    return _collapse(out, "fact_economic_indicator", FACT_ECONOMIC_INDICATOR)


def osm_infrastructure(raw: DataFrame, source: str = "osm_infrastructure") -> DataFrame:
    """seven scalar counts per delivery; snapshot date = ingestion day."""
    parsed = with_parsed(raw_of(raw, source), LINEAGE, F.try_parse_json("payload"), "_v")
    v = F.col("_v")  # parsed once, read per field
    out = parsed.select(
        F.col("scope_id").alias("city_id"),
        F.to_date("ingested_at").alias("snapshot_date"),
        *[F.try_variant_get(v, f"$.{c}", "bigint").alias(c) for c in OSM_COUNTS],
        *_lineage(source),
    )
    return _collapse(out, "fact_osm_infrastructure", FACT_OSM_INFRASTRUCTURE)


def osm_from_poi_elements(raw: DataFrame, source: str = "osm_poi") -> DataFrame:
    """R9/R10 + F6: the infrastructure fact computed from raw POI responses
    (``elements[].tags``) instead of pre-counted payloads."""
    counted = poi_counts(raw_of(raw, source), "payload", keep=LINEAGE)
    out = counted.select(
        F.col("scope_id").alias("city_id"),
        F.to_date("ingested_at").alias("snapshot_date"),
        *OSM_COUNTS,
        *_lineage(source),
    )
    return _collapse(out, "fact_osm_infrastructure", FACT_OSM_INFRASTRUCTURE)


def zero_snapshot_rejects(infra: DataFrame) -> DataFrame:
    """A snapshot whose counts are all zero is a swallowed API failure."""
    total = None
    for c in OSM_COUNTS:
        term = F.coalesce(F.col(c), F.lit(0))
        total = term if total is None else total + term
    return infra.where(total == 0)


def fx_rejects(raw: DataFrame, source: str = "fx_rates") -> DataFrame:
    """Rate responses that give no day: not successful, or with an unreadable date."""
    r = with_parsed(raw_of(raw, source), ["scope_id", "checksum", "payload"], F.try_parse_json("payload"), "_v")
    good = F.coalesce(F.try_variant_get("_v", "$.result", "string") == "success", F.lit(False))
    day = F.to_date(best_effort_ts(F.try_variant_get("_v", "$.time_last_update_utc", "string")))
    rule = F.when(~good, "unsuccessful_response").when(day.isNull(), "unparsable_date")
    return r.withColumn("rule", rule).where("rule is not null").select("scope_id", "checksum", "rule", "payload")


def record_rejects(raw: DataFrame, source: str, path: str, record: StructType, bad: Column | str, rule: str) -> DataFrame:
    """Deliveries without a record array, and records that the condition ``bad`` catches (as JSON)."""
    r = raw_of(raw, source)
    found = F.from_json(F.get_json_object("payload", path), ArrayType(record))
    none = r.where(found.isNull()).select("scope_id", "checksum", F.lit("missing_records").alias("rule"), "payload")
    rows = record_array_unnest(r, "payload", path, record, keep=["scope_id", "checksum"]).where(bad)
    text = F.to_json(F.struct(*[F.col(f) for f in record.fieldNames()]))
    return none.unionByName(rows.select("scope_id", "checksum", F.lit(rule).alias("rule"), text.alias("payload")))


def fact_rejects(raw: DataFrame | CollapsedRaw) -> DataFrame:
    """What the six builders leave out: (source, scope_id, checksum, rule,
    payload). Records without a value (missing rates, NULL indicators) are
    absent, not bad; a snapshot of zeros stays in the fact and is reported."""
    zeros = zero_snapshot_rejects(osm_infrastructure(raw)).select(
        F.col("city_id").alias("scope_id"), F.col("raw_checksum").alias("checksum"), F.lit("zero_snapshot").alias("rule"),
        F.lit(None).cast("string").alias("payload"),
    )
    parts = {
        "open_meteo_weather": hourly_rejects(raw, "open_meteo_weather", WEATHER_FIELDS),
        "open_meteo_air_quality": hourly_rejects(raw, "open_meteo_air_quality", AIR_QUALITY_FIELDS),
        "fx_rates": fx_rejects(raw),
        "gdelt_news": record_rejects(
            raw, "gdelt_news", "$.timeline[0].data", NEWS_RECORD, best_effort_ts("date").isNull(), "unparsable_time"
        ),
        "world_bank": record_rejects(
            raw, "world_bank", "$[1]", INDICATOR_RECORD, "value IS NOT NULL AND try_cast(date AS INT) IS NULL", "unparsable_year"
        ),
        "osm_infrastructure": zeros,
    }
    out = None
    for source, part in parts.items():
        part = part.select(F.lit(source).alias("source"), "scope_id", "checksum", "rule", "payload")
        out = part if out is None else out.unionByName(part)
    return out


def all_facts(raw: DataFrame | CollapsedRaw) -> dict[str, DataFrame]:
    """The six facts from one raw table."""
    return {
        "fact_weather_hourly": weather_hourly(raw),
        "fact_air_quality_hourly": air_quality_hourly(raw),
        "fact_fx_daily": fx_daily(raw),
        "fact_news_intensity": news_intensity(raw),
        "fact_economic_indicator": economic_indicator(raw),
        "fact_osm_infrastructure": osm_infrastructure(raw),
    }


def fx_cross_check(
    raw: DataFrame,
    primary: DataFrame,
    currencies: Sequence[str] = ("GHS",),
    source: str = "fx_frankfurter",
    digits: int = 4,
) -> DataFrame:
    """Cross-rate consistency of the second FX source.

    The cross-check source quotes a EUR base; units per USD are
    ``rates[c] / rates.USD``. Joined to the primary FX fact on (currency,
    day), with the deviation in percent of the primary rate.
    """
    r = with_parsed(raw_of(raw, source), ["checksum", "ingested_at"], F.try_parse_json("payload"), "_v")
    v = F.col("_v")
    usd = F.try_variant_get(v, "$.rates.USD", "double")
    cross = r.select(
        "checksum",
        "ingested_at",
        F.to_date(F.try_variant_get(v, "$.date", "string")).alias("rate_date"),
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(c).alias("currency"),
                        F.try_divide(F.try_variant_get(v, f"$.rates.{c}", "double"), usd).alias("cross_units_per_usd"),
                    )
                    for c in currencies
                ]
            )
        ),
    ).where(F.col("cross_units_per_usd").isNotNull() & F.col("rate_date").isNotNull())
    # several deliveries quote the same day: the newest one wins (as for every fact)
    cross = latest_by_key(cross, ["currency", "rate_date"], "ingested_at", "checksum").drop("ingested_at", "checksum")
    j = primary.select("currency", "rate_date", "units_per_usd").join(cross, ["currency", "rate_date"])
    dev = F.try_divide(F.col("cross_units_per_usd") - F.col("units_per_usd"), F.col("units_per_usd")) * F.lit(100.0)
    return j.withColumn("deviation_pct", F.bround(dev, digits))
