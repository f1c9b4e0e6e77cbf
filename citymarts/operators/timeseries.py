"""Previous-observation comparisons."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from citymarts.functions.scalar import safe_pct_change


def lag_pct_change(
    df: DataFrame,
    partition: Sequence[str] | str,
    order: Sequence[str] | str,
    value: str,
    prev_col: str = "prev_value",
    pct_col: str = "pct_change",
    digits: int = 4,
    nudge: float = 0.0,
) -> DataFrame:
    """Add the previous observation (no calendar gap filling) and a guarded
    percent change. Run it on an already-aggregated grain (e.g. daily): the
    window keeps one series per partition key in one task."""
    partition = [partition] if isinstance(partition, str) else list(partition)
    order = [order] if isinstance(order, str) else list(order)
    w = Window.partitionBy(*partition).orderBy(*order)
    return df.withColumn(prev_col, F.lag(F.col(value)).over(w)).withColumn(
        pct_col, safe_pct_change(F.col(value), F.col(prev_col), digits, nudge)
    )
