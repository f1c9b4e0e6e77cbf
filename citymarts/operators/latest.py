"""Keyed "newest version wins" operators.

All of them are expressed as a ``groupBy`` with ``max_by``/``min_by`` over a
struct, not as a ``row_number()`` window: the aggregate combines map-side
(each task ships one row per key), so a key that holds a large share of
the rows never lands in a single task the way a window partition would.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, IntegralType, NumericType, TimestampNTZType, TimestampType


def _as_list(x) -> list:
    if x is None:
        return []
    return [x] if isinstance(x, (str, Column)) else list(x)


def _order_struct(cols: Sequence[str]) -> Column:
    return F.struct(*[F.col(c) for c in cols])


def latest_by_key(
    df: DataFrame,
    keys: Sequence[str] | str,
    version: str,
    tiebreak: Sequence[str] | str = (),
) -> DataFrame:
    """Keep the whole newest row per key (NULL fields of that row included).

    Rows whose version is NULL never win. ``tiebreak`` columns make the choice
    deterministic when two deliveries share a version.
    """
    keys = _as_list(keys)
    order = [version] + _as_list(tiebreak)
    payload_cols = [c for c in df.columns if c not in keys]
    picked = (
        df.where(F.col(version).isNotNull())
        .groupBy(*keys)
        .agg(F.max_by(F.struct(*[F.col(c) for c in payload_cols]), _order_struct(order)).alias("_row"))
    )
    return picked.select(*keys, *[F.col("_row")[c].alias(c) for c in payload_cols]).select(*df.columns)


def newest_copies(
    df: DataFrame,
    keys: Sequence[str] | str,
    version: str,
    tiebreak: Sequence[str] | str = (),
    max_broadcast_rows: int = 1_000_000,
) -> DataFrame:
    """``latest_by_key`` for wide rows of which few keys repeat.

    Keys alone are counted first (a hash aggregate, combined map-side: no other
    column is read or shuffled). Without a repeated key every row with a version
    is the newest of its key and nothing more happens. Up to
    ``max_broadcast_rows`` repeated keys are broadcast, and only their rows are
    shuffled to be collapsed; the others stay where they are. Beyond that bound
    all rows go through ``latest_by_key``. The result is the same in each case.
    """
    keys = _as_list(keys)
    versioned = df.where(F.col(version).isNotNull())
    names = [f"_k{i}" for i in range(len(keys))]
    repeated = (
        versioned.groupBy(*(F.col(k).alias(n) for k, n in zip(keys, names))).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select(*names)
    )
    found = repeated.limit(max_broadcast_rows + 1).count()
    if not found:
        return versioned
    if found > max_broadcast_rows:
        return latest_by_key(df, keys, version, tiebreak)
    same = None
    for k, n in zip(keys, names):
        one = versioned[k].eqNullSafe(repeated[n])
        same = one if same is None else same & one
    small = F.broadcast(repeated)
    once = versioned.join(small, same, "left_anti")
    return once.unionByName(latest_by_key(versioned.join(small, same, "left_semi"), keys, version, tiebreak))


def latest_snapshot(
    df: DataFrame,
    keys: Sequence[str] | str,
    order: Sequence[str] | str,
    cols: Sequence[str],
    order_alias: str | None = None,
) -> DataFrame:
    """Per key, the listed columns taken from the row with the greatest order."""
    keys, order = _as_list(keys), _as_list(order)
    picked = df.groupBy(*keys).agg(
        F.max_by(F.struct(*[F.col(c) for c in cols]), _order_struct(order)).alias("_row"),
        *([F.max(F.col(order[0])).alias(order_alias)] if order_alias else []),
    )
    out = [*keys, *[F.col("_row")[c].alias(c) for c in cols]]
    if order_alias:
        out.append(order_alias)
    return picked.select(*out)


def last_non_null(
    df: DataFrame,
    keys: Sequence[str] | str,
    order: Sequence[str] | str,
    cols: Sequence[str],
    order_alias: str | None = None,
) -> DataFrame:
    """Per key and per column, the value of the newest row where it is not NULL.

    Values of one output row may come from different input rows (the
    ``groupby().last()`` rule); ``order_alias`` adds the newest order value.
    """
    keys, order = _as_list(keys), _as_list(order)
    ordering = _order_struct(order)
    aggs = [
        F.max_by(F.col(c), F.when(F.col(c).isNotNull(), ordering)).alias(c) for c in cols
    ]
    if order_alias:
        aggs.append(F.max(F.col(order[0])).alias(order_alias))
    return df.groupBy(*keys).agg(*aggs)


def _ascending_key(df: DataFrame, name: str, ascending: bool) -> Column:
    c = F.col(name)
    if ascending:
        return c
    dtype = df.schema[name].dataType
    if isinstance(dtype, IntegralType):
        return F.bitwise_not(c)  # reverses the order without overflow at the minimum
    if isinstance(dtype, NumericType):
        return -c
    if isinstance(dtype, (TimestampType, TimestampNTZType)):
        return -F.unix_micros(c.cast("timestamp"))
    if isinstance(dtype, DateType):
        return -F.unix_date(c)
    raise TypeError(f"descending order on {dtype.simpleString()} column {name!r} is not supported")


def dedupe_first(
    df: DataFrame,
    subset: Sequence[str] | str,
    order: Sequence[tuple[str, bool]],
) -> DataFrame:
    """Keep the first row per ``subset`` under ``order`` = [(column, ascending)].

    Equivalent to ``ORDER BY ... NULLS LAST`` followed by
    drop-duplicates-keep-first; the order must be total (end it with a unique
    column) to be deterministic. Text can be descending only where every
    column is.
    """
    subset = _as_list(subset)
    rest = [c for c in df.columns if c not in subset]
    row, fields = F.struct(*[F.col(c) for c in rest]), []
    backwards = bool(order) and not any(asc for _, asc in order)
    for i, (c, asc) in enumerate(order):
        missing = F.col(c).isNull()
        value = F.col(c) if backwards else _ascending_key(df, c, asc)
        fields += [(~missing if backwards else missing).alias(f"_n{i}"), value.alias(f"_o{i}")]
    pick = F.max_by if backwards else F.min_by
    picked = df.groupBy(*subset).agg(pick(row, F.struct(*fields)).alias("_row"))
    return picked.select(*subset, *[F.col("_row")[c].alias(c) for c in rest]).select(*df.columns)
