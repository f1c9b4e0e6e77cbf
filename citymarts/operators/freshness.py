"""Freshness contract over an append-only run log."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citymarts.functions.scalar import hours_between

OK_STATUSES = ("success", "duplicate")
ERROR_STATUSES = ("error",)


def _as_of(as_of: datetime | str | Column) -> Column:
    if isinstance(as_of, Column):
        return as_of
    return F.lit(str(as_of)).cast("timestamp_ntz")


def freshness_summary(
    log: DataFrame,
    as_of: datetime | str | Column,
    budget_hours: int = 36,
    ts_col: str = "started_at",
    status_col: str = "status",
    ok_statuses: Sequence[str] = OK_STATUSES,
    error_statuses: Sequence[str] = ERROR_STATUSES,
) -> DataFrame:
    """One global aggregate row: newest trusted / error activity, their age in
    hour boundaries at ``as_of``, and counts inside the budget window."""
    ts, status, now = F.col(ts_col), F.col(status_col), _as_of(as_of)
    past = ts <= now  # a run for a past day does not see later log rows
    is_ok, is_err = status.isin(list(ok_statuses)) & past, status.isin(list(error_statuses)) & past
    window_start = now - F.make_dt_interval(F.lit(0), F.lit(budget_hours))
    agg = log.agg(
        F.max(F.when(is_ok, ts)).alias("latest_success_at"),
        F.max(F.when(is_err, ts)).alias("latest_error_at"),
        F.count_if(is_err & (ts > window_start)).alias("errors_in_window"),
        F.count_if(is_ok & (ts > window_start)).alias("successes_in_window"),
    )
    return agg.select(
        "latest_success_at",
        "latest_error_at",
        hours_between(F.col("latest_success_at"), now).alias("hours_since_success"),
        hours_between(F.col("latest_error_at"), now).alias("hours_since_error"),
        "errors_in_window",
        "successes_in_window",
    )


def freshness_verdict(summary: DataFrame, budget_hours: int = 36) -> DataFrame:
    """Add ``verdict`` (never / stale / current_with_errors / fresh) and the
    strict gate flag ``gate_passed`` (age < budget and no recent errors)."""
    hours = F.col("hours_since_success")
    verdict = (
        F.when(hours.isNull(), F.lit("never"))
        .when(hours > budget_hours, F.lit("stale"))
        .when(F.col("errors_in_window") > 0, F.lit("current_with_errors"))
        .otherwise(F.lit("fresh"))
    )
    gate = F.coalesce((hours < budget_hours) & (F.col("errors_in_window") == 0), F.lit(False))
    return summary.withColumn("verdict", verdict).withColumn("gate_passed", gate)
