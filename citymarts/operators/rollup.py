"""Daily rollups of hourly observations."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citymarts.functions.scalar import round_half_even


def daily_rollup(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    aggs: Mapping[str, Column],
    date_col: str = "date",
) -> DataFrame:
    """Group by ``keys`` + UTC calendar day of ``ts`` and apply named aggregates.

    A hash aggregate with a partial (map-side) phase: the shuffle carries one
    row per (key, day) per task, whatever the skew of the keys.
    """
    return (
        df.withColumn(date_col, F.to_date(F.col(ts)))
        .groupBy(*keys, date_col)
        .agg(*[expr.alias(name) for name, expr in aggs.items()])
    )


def null_ratio(c: str, digits: int = 4, nudge: float = 0.0) -> Column:
    """Share of rows where ``c`` is NULL, rounded (ties to even)."""
    return round_half_even(F.count_if(F.col(c).isNull()) / F.count(F.lit(1)), digits, nudge)
