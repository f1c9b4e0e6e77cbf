"""Evidence envelopes: one JSON document per delivery under
``<root>/<source>/<scope>/YYYY/MM/DD/HHMMSS_<digest12>.json``.

Each file is read whole (``wholetext``) and parsed once to VARIANT; the
payload is kept as canonical JSON text for the fact builders.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citymarts.functions.timeparse import best_effort_ts
from citymarts.operators.unnest import with_parsed
from citymarts.schemas import QUARANTINE, RAW

# The evidence sources and the raw table each one feeds.
SOURCES = [
    "open_meteo_weather",
    "open_meteo_air_quality",
    "fx_rates",
    "fx_frankfurter",
    "gdelt_news",
    "world_bank",
    "osm_infrastructure",
]


def _read_folder(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return (
            spark.read.option("recursiveFileLookup", "true")
            .option("pathGlobFilter", "*.json")
            .text(path, wholetext=True)
            .select("value", F.col("_metadata.file_path").alias("raw_file_path"))
        )
    except AnalysisException as exc:  # missing folder -> no rows
        if "PATH_NOT_FOUND" in str(exc) or "Path does not exist" in str(exc):
            return None
        raise


def read_envelope_files(spark: SparkSession, root: str, sources: Sequence[str] = SOURCES) -> DataFrame:
    """(source_folder, value, raw_file_path) for every ``*.json`` under the
    requested source folders; a missing folder contributes no rows."""
    out = None
    for source in sources:
        part = _read_folder(spark, f"{root.rstrip('/')}/{source}")
        if part is None:
            continue
        part = part.withColumn("source_folder", F.lit(source))
        out = part if out is None else out.unionByName(part)
    if out is None:
        return spark.createDataFrame([], "value string, raw_file_path string, source_folder string")
    return out


def parse_envelopes(files: DataFrame) -> DataFrame:
    """Parse each file once; adds ``_ok`` (valid JSON with checksum, scope,
    timestamp and payload)."""
    v = F.try_parse_json(F.col("value"))
    parsed = with_parsed(files, ["source_folder", "raw_file_path", "value"], v, "_v")
    env = parsed.select(
        F.coalesce(F.try_variant_get("_v", "$.source", "string"), F.col("source_folder")).alias("source"),
        F.try_variant_get("_v", "$.checksum", "string").alias("checksum"),
        F.try_variant_get("_v", "$.city_id", "string").alias("scope_id"),
        F.to_json(F.try_variant_get("_v", "$.payload", "variant")).alias("payload"),
        F.date_trunc("second", best_effort_ts(F.try_variant_get("_v", "$.ingested_at_utc", "string")))
        .cast("timestamp_ntz")
        .alias("ingested_at"),
        "raw_file_path",
        "value",
        F.col("_v").isNull().alias("_bad_json"),
    )
    ok = (
        ~F.col("_bad_json")
        & F.col("checksum").isNotNull()
        & F.col("scope_id").isNotNull()
        & F.col("ingested_at").isNotNull()
        & F.col("payload").isNotNull()
    )
    return env.withColumn("_ok", F.coalesce(ok, F.lit(False)))


def scan_envelopes(spark: SparkSession, root: str, sources: Sequence[str] = SOURCES) -> DataFrame:
    """Valid envelopes as raw rows (schema ``schemas.RAW``)."""
    env = parse_envelopes(read_envelope_files(spark, root, sources))
    return env.where("_ok").select(*RAW.fieldNames())


def envelope_rejects(spark: SparkSession, root: str, as_of: str, sources: Sequence[str] = SOURCES) -> DataFrame:
    """Unusable envelope files as quarantine rows (schema ``schemas.QUARANTINE``)."""
    env = parse_envelopes(read_envelope_files(spark, root, sources)).where(~F.col("_ok"))
    rule = F.when(F.col("_bad_json"), F.lit("invalid_json")).otherwise(F.lit("incomplete_envelope"))
    return env.select(
        F.lit(as_of).cast("timestamp_ntz").alias("quarantined_at"),
        F.col("source").alias("source_id"),
        F.col("scope_id").alias("city_id"),
        rule.alias("rule_violated"),
        F.col("value").alias("raw_record"),
        F.col("checksum").alias("raw_checksum"),
    ).select(*QUARANTINE.fieldNames())
