"""Join helpers with an explicit size check before broadcasting."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Largest dimension we are willing to ship to every executor by hint.
DEFAULT_BROADCAST_ROWS = 100_000


def bounded_broadcast(
    df: DataFrame, max_rows: int | None = DEFAULT_BROADCAST_ROWS, bound_by: DataFrame | None = None
) -> DataFrame:
    """Return ``broadcast(df)`` if it has at most ``max_rows`` rows, else ``df``.

    Meant for dimensions: the check is a ``limit(max_rows + 1).count()`` job,
    which stops reading early. ``bound_by`` is a cheaper frame whose row
    count is an upper bound of ``df``'s (e.g. the base table of a dimension
    built with left joins on unique keys); it is counted instead.
    ``max_rows=None`` means the caller has already checked and hinted
    ``df`` (the hint survives later projections). Beyond the bound the join
    falls back to Spark's own choice (AQE still converts to broadcast when
    runtime sizes allow, otherwise sort-merge with skew splitting).
    """
    if max_rows is None:
        return df
    n = (bound_by if bound_by is not None else df).limit(max_rows + 1).count()
    return F.broadcast(df) if n <= max_rows else df


def fan_out(
    facts: DataFrame,
    dim: DataFrame,
    fact_key: str,
    dim_key: str,
    dim_cols: Sequence[str],
    max_dim_rows: int | None = DEFAULT_BROADCAST_ROWS,
) -> DataFrame:
    """Inner 1:N join that copies each fact row to every matching dim row."""
    d = dim.select(F.col(dim_key).alias("_fan_key"), *dim_cols)
    d = bounded_broadcast(d, max_dim_rows)
    return facts.join(d, facts[fact_key] == d["_fan_key"], "inner").drop("_fan_key")
