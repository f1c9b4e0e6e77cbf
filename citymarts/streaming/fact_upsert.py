"""Streaming newest-wins upsert of the facts.

New raw rows arrive as a stream over the raw table; each micro-batch is
turned into fact rows and merged into the affected partitions of each fact
table (``sinks.upsert_partitions``: existing rows of those partitions + new
rows -> newest version per key -> checkpoint -> dynamic overwrite). Later
deliveries must replace earlier ones (forecast hours become observations),
so deduplicate-first streaming semantics would be wrong here.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType

from citymarts.plans import facts as FB
from citymarts.schemas import FACT_KEYS, RAW
from citymarts.sources.sinks import upsert_partitions

RAW_WITH_PARTS = StructType(list(RAW.fields) + [StructField("ym", StringType(), True)])

BUILDERS: dict[str, tuple[Callable[[DataFrame], DataFrame], Callable[[], object]]] = {
    "fact_weather_hourly": (FB.weather_hourly, lambda: F.date_format("observed_at", "yyyyMM")),
    "fact_air_quality_hourly": (FB.air_quality_hourly, lambda: F.date_format("observed_at", "yyyyMM")),
    "fact_fx_daily": (FB.fx_daily, lambda: F.date_format("rate_date", "yyyyMM")),
    "fact_news_intensity": (FB.news_intensity, lambda: F.date_format("observed_at", "yyyyMM")),
    "fact_economic_indicator": (FB.economic_indicator, lambda: F.col("year").cast("string")),
    "fact_osm_infrastructure": (FB.osm_infrastructure, lambda: F.date_format("snapshot_date", "yyyyMM")),
}


def _merge(facts_dir: str, tables):
    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        raw = batch.select(*RAW.fieldNames())
        for name in tables:
            build, part = BUILDERS[name]
            rows = build(raw).withColumn("part", part()).checkpoint(eager=True)
            touched = [r.part for r in rows.select("part").distinct().collect()]  # a few months
            if not touched:
                continue
            schema = StructType(list(rows.schema.fields))
            upsert_partitions(
                spark, rows, f"{facts_dir}/{name}", FACT_KEYS[name], "ingested_at", ["raw_checksum"], "part", schema,
                partitions=touched,
            )

    return handle


def fact_upsert_stream(
    spark: SparkSession,
    raw_table: str,
    facts_dir: str,
    checkpoint: str,
    tables=tuple(BUILDERS),
    available_now: bool = True,
) -> StreamingQuery:
    """Start the streaming upsert of the listed facts from the raw table."""
    stream = spark.readStream.schema(RAW_WITH_PARTS).parquet(raw_table)
    writer = stream.writeStream.foreachBatch(_merge(facts_dir, tables)).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()
