"""Incremental raw sync with Structured Streaming.

The file source remembers which evidence files it has already read (in the
query checkpoint), so each trigger only parses new files, once. Every
micro-batch is deduplicated on (source, scope, checksum) and compared with the
raw table through an index of its keys (``operators.key_index``): only the
buckets the batch's keys fall into are read, and raw keys only where a hash is
found. Unusable files go to a dead-letter table with the rule they broke.

A batch that is run again after a failure adds nothing twice: its index rows
are written before its raw rows (an index row without a raw row is only a
hash to be looked up), and its dead letters replace their own partition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType

from citymarts.operators.key_index import INDEX, index_rows, new_by_index
from citymarts.operators.latest import dedupe_first
from citymarts.schemas import RAW
from citymarts.session import ensure_checkpoint_dir
from citymarts.sources.envelopes import parse_envelopes
from citymarts.sources.sinks import append_rows, month_of, read_table

RAW_KEYS = ["source", "scope_id", "checksum"]
# <root>/<source>/<scope>/YYYY/MM/DD/<file>.json -> <source>
SOURCE_FROM_PATH = r"/([^/]+)/[^/]+/[0-9]{4}/[0-9]{2}/[0-9]{2}/[^/]+$"


def _read_keys(spark: SparkSession, path: str, buckets: list[str]) -> DataFrame:
    found = read_table(spark, path, StructType([*INDEX.fields, StructField("bucket", StringType())]))
    return found.where(F.col("bucket").isin(buckets)).select("h", "place")


def _read_places(spark: SparkSession, path: str, places: list[str]) -> DataFrame:
    stored = read_table(spark, path, StructType([*RAW.fields, StructField("ym", StringType())]))
    months = sorted({p.split("/")[-1] for p in places})
    return stored.where(F.col("ym").isin(months) & F.concat_ws("/", "source", "ym").isin(places))


def _append_new(raw_path: str, dead_letters: str | None):
    keys_path = f"{raw_path.rstrip('/')}_keys"
    place = F.concat_ws("/", "source", "ym")

    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch = batch.persist()  # parsed once for raw rows and dead letters
        try:
            if dead_letters:
                bad = batch.where("rule IS NOT NULL").select("source", "scope_id", "checksum", "raw_file_path", "rule", "value")
                bad.withColumn("batch", F.lit(batch_id)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
                    "batch"
                ).parquet(dead_letters)
            rows = batch.where("rule IS NULL").select(*RAW.fieldNames())
            first = dedupe_first(rows, RAW_KEYS, [("ingested_at", True), ("raw_file_path", True)])
            first = first.withColumn("ym", month_of("ingested_at"))
            new = new_by_index(
                first, RAW_KEYS, lambda b: _read_keys(spark, keys_path, b), lambda p: _read_places(spark, raw_path, p)
            ).checkpoint(eager=True)
            append_rows(index_rows(new, RAW_KEYS, place), keys_path, ["bucket"])
            append_rows(new, raw_path, ["source", "ym"])
        finally:
            batch.unpersist()

    return handle


def envelope_stream(spark: SparkSession, raw_dir: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming frame of valid envelopes (``schemas.RAW``) under ``raw_dir``."""
    return tagged_stream(spark, raw_dir, max_files_per_trigger).where("rule IS NULL").select(*RAW.fieldNames())


def tagged_stream(spark: SparkSession, raw_dir: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """All envelopes under ``raw_dir``; ``rule`` says why one is unusable (else NULL), ``value`` is then its text."""
    reader = spark.readStream
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    files = reader.text(raw_dir, wholetext=True, pathGlobFilter="*.json", recursiveFileLookup=True)
    files = files.select("value", F.col("_metadata.file_path").alias("raw_file_path")).withColumn(
        "source_folder", F.regexp_extract("raw_file_path", SOURCE_FROM_PATH, 1)
    )
    env = parse_envelopes(files)
    rule = F.when(~F.col("_ok"), F.when(F.col("_bad_json"), "invalid_json").otherwise("incomplete_envelope"))
    return env.select(*RAW.fieldNames(), rule.alias("rule"), F.when(~F.col("_ok"), F.col("value")).alias("value"))


def raw_sync_stream(
    spark: SparkSession,
    raw_dir: str,
    raw_table: str,
    checkpoint: str,
    available_now: bool = True,
    processing_time: str | None = None,
    max_files_per_trigger: int | None = None,
    dead_letters: str | None = None,
) -> StreamingQuery:
    """Start the incremental raw sync; ``available_now`` processes what is
    there and stops (the batch-scheduled mode), otherwise runs continuously.
    ``dead_letters``: where unusable files go (default: beside the raw table)."""
    ensure_checkpoint_dir(spark)
    stream = tagged_stream(spark, raw_dir, max_files_per_trigger)
    writer = stream.writeStream.foreachBatch(_append_new(raw_table, dead_letters or f"{raw_table.rstrip('/')}_dead_letters")).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()
