"""Table sinks: partitioned keyed tables, full-refresh marts, append logs.

Writes go through Spark's commit protocol: task output is staged and only
published at job commit, so a lost executor means a retried task, and a
failed job leaves the previous table contents in place. Overwrites are
dynamic (per partition), so a refresh replaces only the partitions it
produces.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from citymarts.operators.latest import latest_by_key
from citymarts.session import ensure_checkpoint_dir


def month_of(c: Column | str) -> Column:
    """``yyyyMM`` partition value of a date/timestamp column."""
    return F.date_format(F.col(c) if isinstance(c, str) else c, "yyyyMM")


def read_table(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """Parquet table at ``path``; an empty frame of ``schema`` if absent."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as exc:
        if schema is not None and ("PATH_NOT_FOUND" in str(exc) or "Path does not exist" in str(exc)
                                   or "UNABLE_TO_INFER_SCHEMA" in str(exc)):
            return spark.createDataFrame([], schema)
        raise


def write_table(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    sort_by: Sequence[str] = (),
    mode: str = "overwrite",
) -> None:
    """Write parquet, range-partitioned on (partition, sort keys) so each task
    writes few partition folders with key-sorted row groups (min/max
    statistics then skip row groups on key filters). Pass the table's full
    unique key as ``sort_by``: range bounds can then split a hot key value
    across tasks, which a hash or a partial-key range cannot."""
    keys = [*partition_by, *sort_by]
    out = df.repartitionByRange(*keys).sortWithinPartitions(*keys) if keys else df
    writer = out.write.mode(mode).option("partitionOverwriteMode", "dynamic")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def append_rows(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Append-only sink (run log, quarantine)."""
    writer = df.write.mode("append")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def upsert_partitions(
    spark: SparkSession,
    new_rows: DataFrame,
    path: str,
    keys: Sequence[str],
    version: str,
    tiebreak: Sequence[str],
    partition_col: str,
    schema: StructType,
    partitions: Sequence[str] | None = None,
) -> DataFrame:
    """Merge ``new_rows`` into a keyed table, newest version per key wins.

    Only partitions that receive new rows are read and rewritten: existing
    rows of those partitions (``partitions`` as a literal list for static
    pruning, else a semi-join on the partition value) are unioned
    with the new rows, collapsed by key, checkpointed to the shared
    checkpoint folder (the job must not overwrite a path it is still
    reading) and written with dynamic partition overwrite.
    """
    ensure_checkpoint_dir(spark)
    existing = read_table(spark, path, schema)
    if partition_col not in existing.columns:
        existing = existing.withColumn(partition_col, F.lit(None).cast("string"))
    existing = existing.withColumn(partition_col, F.col(partition_col).cast("string"))
    new_rows = new_rows.withColumn(partition_col, F.col(partition_col).cast("string"))
    if partitions is not None:
        # literal partition list: static pruning, untouched partitions are never listed or read
        affected = existing.where(F.col(partition_col).isin([str(p) for p in partitions]))
    else:
        touched = new_rows.select(partition_col).distinct()
        affected = existing.join(touched, partition_col, "left_semi")
    merged = latest_by_key(affected.unionByName(new_rows), list(keys), version, list(tiebreak))
    merged = merged.checkpoint(eager=True)
    write_table(merged, path, [partition_col], list(keys))
    return merged
