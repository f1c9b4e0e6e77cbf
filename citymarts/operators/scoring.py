"""Composite 0-100 score, standings and pillar contributions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from citymarts.functions.scalar import round_half_even


def composite(
    base: DataFrame,
    parts: Mapping[str, DataFrame],
    weights: Mapping[str, float],
    defaults: Mapping[str, float],
    keys: Sequence[str],
    base_score: str,
    score_col: str = "score",
    digits: int = 2,
    nudge: float = 0.0,
) -> DataFrame:
    """Weighted sum of pillar scores.

    ``base`` carries ``keys`` and the mandatory pillar ``base_score``; each
    entry of ``parts`` is a frame with ``keys``, the pillar column and any
    extra columns to carry, left-joined on ``keys`` (unique per key; a missing
    pillar -> ``defaults[pillar]``). Output keeps all columns, rounds every
    pillar and adds the composite ``score_col``.
    """
    out = base
    for frame in parts.values():
        out = out.join(frame, list(keys), "left")
    filled = {p: F.coalesce(F.col(p), F.lit(float(defaults.get(p, 0.0)))) for p in parts}
    filled[base_score] = F.col(base_score)
    total = None
    for pillar, weight in weights.items():
        term = F.lit(float(weight)) * filled[pillar]
        total = term if total is None else total + term
    out = out.withColumn(score_col, round_half_even(total, digits, nudge))
    for pillar, value in filled.items():
        out = out.withColumn(pillar, round_half_even(value, digits, nudge))
    return out


def standings(
    df: DataFrame,
    date_col: str,
    score_col: str,
    tiebreak: Sequence[str] | str,
    rank_col: str = "rank",
) -> DataFrame:
    """Rows at the global latest date, ranked by score (1 = best).

    The latest date is a one-row aggregate joined back (broadcast of one row);
    the rank window then partitions by that single date, so it holds only the
    rows of one day (bounded by the number of entities in the dimension).
    """
    tiebreak = [tiebreak] if isinstance(tiebreak, str) else list(tiebreak)
    latest = F.broadcast(df.agg(F.max(date_col).alias("_latest")))
    at_latest = df.join(latest, F.col(date_col) == F.col("_latest"), "inner").drop("_latest")
    w = Window.partitionBy(date_col).orderBy(F.col(score_col).desc(), *[F.col(c).asc() for c in tiebreak])
    return at_latest.withColumn(rank_col, F.row_number().over(w))


def pillar_contributions(
    df: DataFrame,
    id_cols: Sequence[str],
    pillars: Mapping[str, tuple[str, float]],
    digits: int = 2,
    nudge: float = 0.0,
) -> DataFrame:
    """Melt pillar score columns to (pillar, score, weight, points).

    ``pillars`` maps score column -> (label, weight); the label/weight lookup
    is a literal map, so no join is needed.
    """
    labels = F.create_map(*[x for col, (label, _) in pillars.items() for x in (F.lit(col), F.lit(label))])
    weights = F.create_map(*[x for col, (_, w) in pillars.items() for x in (F.lit(col), F.lit(float(w)))])
    long = df.unpivot(list(id_cols), list(pillars), "_pillar_col", "score")
    return long.select(
        *id_cols,
        labels[F.col("_pillar_col")].alias("pillar"),
        F.col("score").cast("double").alias("score"),
        weights[F.col("_pillar_col")].alias("weight"),
        round_half_even(F.col("score") * weights[F.col("_pillar_col")], digits, nudge).alias("points"),
    )
