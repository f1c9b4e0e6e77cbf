"""Delivery bookkeeping: first-delivery flags, outcomes, idempotent load."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citymarts.operators.latest import dedupe_first


def flag_first_delivery(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    flag_col: str = "created",
) -> DataFrame:
    """``flag_col`` is TRUE for the earliest row of each key, FALSE for repeats.

    The earliest order value per key is a map-side-combined aggregate joined
    back on the key (null-safe); AQE splits a skewed key on the big side.
    """
    first = df.groupBy(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]).agg(
        F.min(F.struct(*[F.col(c) for c in order])).alias("_first")
    )
    cond = None
    for i, k in enumerate(keys):
        c = df[k].eqNullSafe(first[f"_k{i}"])
        cond = c if cond is None else cond & c
    joined = df.join(first, cond, "inner")
    flag = F.struct(*[df[c] for c in order]) == F.col("_first")
    return joined.select(*[df[c] for c in df.columns], flag.alias(flag_col))


def outcome_status(received: Column, loaded: Column, error: Column | None = None) -> Column:
    """``error`` if there is one, ``success`` if anything was new or nothing came, else ``duplicate``."""
    status = F.when((loaded == 0) & (received > 0), F.lit("duplicate")).otherwise(F.lit("success"))
    return status if error is None else F.when(error.isNotNull(), F.lit("error")).otherwise(status)


def delivery_outcomes(
    df: DataFrame,
    group: Sequence[str],
    flag_col: str = "created",
    error_col: str | None = None,
    max_message: int = 2000,
) -> DataFrame:
    """Per group: rows received, rows loaded (flag true) and a status.

    status = error if any error message, else success if anything was new,
    else duplicate (everything already known).
    """
    aggs = [
        F.count(F.lit(1)).alias("rows_received"),
        F.count_if(F.coalesce(F.col(flag_col), F.lit(False))).alias("rows_loaded"),
    ]
    if error_col:
        aggs.append(F.max(F.col(error_col)).alias("_err"))
    out = df.groupBy(*group).agg(*aggs)
    status = outcome_status(F.col("rows_received"), F.col("rows_loaded"), F.col("_err") if error_col else None)
    if error_col:
        out = out.withColumn("error_message", F.substring(F.col("_err"), 1, max_message))
    out = out.withColumn("status", status)
    return out.drop("_err") if error_col else out


def load_new(
    incoming: DataFrame,
    target: DataFrame,
    keys: Sequence[str],
    order: Sequence[tuple[str, bool]] = (),
) -> tuple[DataFrame, DataFrame]:
    """Rows of ``incoming`` whose key is not yet in ``target`` (one per key),
    plus a one-row frame (received, inserted, skipped).

    Dedup inside the batch keeps the first row under ``order``; the
    existence test is one ``left_anti`` join instead of a lookup per row.
    """
    batch = dedupe_first(incoming, keys, order) if order else incoming.dropDuplicates(list(keys))
    new_rows = batch.join(target.select(*keys), list(keys), "left_anti")
    tally = incoming.select(F.lit(1).alias("_r"), F.lit(0).alias("_i")).unionByName(
        new_rows.select(F.lit(0).alias("_r"), F.lit(1).alias("_i"))
    )
    counts = tally.agg(
        F.sum("_r").cast("bigint").alias("received"), F.sum("_i").cast("bigint").alias("inserted")
    ).withColumn("skipped", F.col("received") - F.col("inserted"))
    return new_rows, counts
