"""Numeric helpers shared by the marts, scores and serving queries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def round_half_even(c: Column | str, digits: int, nudge: float = 0.0) -> Column:
    """Round to ``digits`` decimals, ties to even (the warehouse's float rule).

    ``nudge`` is added first; a tiny positive nudge (1e-9) moves values that
    sit on a decimal tie only because of binary representation, which makes the
    result independent of the engine's rounding implementation.
    """
    c = _col(c).cast("double")
    if nudge:
        c = c + F.lit(float(nudge))
    return F.bround(c, digits)


def clamp(c: Column | str, lo: float = 0.0, hi: float = 100.0) -> Column:
    """``greatest(lo, least(hi, c))`` that keeps NULL as NULL.

    Spark's ``greatest``/``least`` skip NULL arguments, so a bare clamp would
    turn a missing input into ``hi``; the guard restores SQL NULL semantics.
    """
    c = _col(c).cast("double")
    return F.when(c.isNull(), F.lit(None).cast("double")).otherwise(
        F.greatest(F.lit(float(lo)), F.least(F.lit(float(hi)), c))
    )


def bucket(c: Column | str, thresholds: Sequence[tuple[float, str]], default: str) -> Column:
    """Label by the first ``c >= threshold`` in the given order; NULL -> default."""
    c = _col(c)
    expr = None
    for threshold, label in thresholds:
        cond = c >= F.lit(threshold)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return F.lit(default) if expr is None else expr.otherwise(F.lit(default))


def safe_pct_change(cur: Column | str, prev: Column | str, digits: int = 4, nudge: float = 0.0) -> Column:
    """Percent change vs. the previous value, NULL unless ``prev > 0``."""
    cur, prev = _col(cur).cast("double"), _col(prev).cast("double")
    pct = (cur - prev) / prev * F.lit(100.0)
    return F.when(prev.isNotNull() & (prev > 0), round_half_even(pct, digits, nudge)).otherwise(
        F.lit(None).cast("double")
    )


def hours_between(start: Column | str, end: Column | str) -> Column:
    """Number of hour boundaries crossed between two timestamps.

    00:59 -> 02:00 is 2 (boundaries), not 1 (elapsed whole hours).
    """
    return F.timestamp_diff(
        "HOUR", F.date_trunc("HOUR", _col(start)), F.date_trunc("HOUR", _col(end))
    )


def per_100k(n: Column | str, population: Column | str, digits: int = 2, nudge: float = 0.0) -> Column:
    """``n`` per 100,000 people; NULL when population is 0 or NULL."""
    rate = F.try_divide(_col(n).cast("double"), _col(population).cast("double") / F.lit(100000.0))
    return round_half_even(rate, digits, nudge)
