"""Declarative data-quality gates, quarantine split and KPI audit."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """A row rule: ``violation`` is TRUE for a bad row (NULL counts as pass)."""

    name: str
    violation: Column | str

    def expr(self) -> Column:
        v = F.expr(self.violation) if isinstance(self.violation, str) else self.violation
        return F.coalesce(v, F.lit(False))


@dataclass(frozen=True)
class MinRows:
    """A table rule: at least ``min_rows`` rows."""

    name: str
    min_rows: int = 1


def run_gates(df: DataFrame, rules: Sequence[Rule | MinRows], table: str) -> DataFrame:
    """Evaluate all rules in one aggregate pass over ``df``.

    Returns (table, rule, checked, violations, passed); ``checked`` is the row
    count, a ``MinRows`` rule reports 1 violation when the table is too small.
    """
    aggs = [F.count(F.lit(1)).alias("_n")]
    for i, rule in enumerate(rules):
        if isinstance(rule, Rule):
            aggs.append(F.count_if(rule.expr()).alias(f"_v{i}"))
    counted = df.agg(*aggs)
    rows = []
    for i, rule in enumerate(rules):
        if isinstance(rule, Rule):
            violations = F.col(f"_v{i}")
        else:
            violations = F.when(F.col("_n") < F.lit(rule.min_rows), F.lit(1)).otherwise(F.lit(0)).cast("bigint")
        rows.append(
            F.struct(
                F.lit(table).alias("table"),
                F.lit(rule.name).alias("rule"),
                F.col("_n").alias("checked"),
                violations.alias("violations"),
                (violations == 0).alias("passed"),
            )
        )
    return counted.select(F.inline(F.array(*rows)))


def gate_report(checks: Sequence[tuple[DataFrame, Sequence[Rule | MinRows], str]]) -> DataFrame:
    """Union of :func:`run_gates` over several tables (one pass per table)."""
    out = None
    for df, rules, table in checks:
        part = run_gates(df, rules, table)
        out = part if out is None else out.unionByName(part)
    return out


def key_repeats(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``keys`` and ``repeats``, how many rows hold them (grouped, combined map-side):
    a key gate is ``Rule(name, F.col("repeats") > 1)`` on it."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("repeats"))


def flag_violations(df: DataFrame, rules: Sequence[Rule], flag_col: str = "rule_violated") -> DataFrame:
    """Add the name of the first violated rule (NULL when the row is valid)."""
    first = F.coalesce(*[F.when(r.expr(), F.lit(r.name)) for r in rules], F.lit(None).cast("string"))
    return df.withColumn(flag_col, first)


def split_quarantine(
    df: DataFrame,
    rules: Sequence[Rule],
    source_id: str | Column,
    scope_col: str | None = None,
    checksum_col: str | None = None,
    quarantined_at: Column | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Split into (valid rows, quarantine rows).

    Every input row lands in exactly one side: a rule that evaluates to NULL
    is treated as passed, so ``valid + bad == input``. Quarantine rows keep
    the whole input row as JSON in ``raw_record``.
    """
    flagged = flag_violations(df, rules, "_rule")
    valid = flagged.where(F.col("_rule").isNull()).drop("_rule")
    src = F.lit(source_id) if isinstance(source_id, str) else source_id
    bad = flagged.where(F.col("_rule").isNotNull()).select(
        (quarantined_at if quarantined_at is not None else F.localtimestamp()).alias("quarantined_at"),
        src.alias("source_id"),
        (F.col(scope_col).cast("string") if scope_col else F.lit(None).cast("string")).alias("city_id"),
        F.col("_rule").alias("rule_violated"),
        F.to_json(F.struct(*[F.col(c) for c in df.columns])).alias("raw_record"),
        (F.col(checksum_col) if checksum_col else F.lit(None).cast("string")).alias("raw_checksum"),
    )
    return valid, bad


# The text patterns a rendered KPI must not show.
MISSING_KPI_PATTERN = r"(?i)\bnan\b|\bnone\b|\binf(?:inity)?\b|^-+$"


def kpi_missing(df: DataFrame, id_cols: Sequence[str], kpi_cols: Sequence[str]) -> DataFrame:
    """Rendered KPI values that read as missing: empty, or nan/none/inf/infinity/dashes.

    Returns (id_cols..., kpi, value_text, problem) for the offending cells only.
    """
    long = df.select(
        *id_cols,
        F.inline(
            F.array(
                *[F.struct(F.lit(c).alias("kpi"), F.col(c).cast("string").alias("value_text")) for c in kpi_cols]
            )
        ),
    )
    text = F.trim(F.col("value_text"))
    problem = (
        F.when(F.col("value_text").isNull() | (text == ""), F.lit("empty"))
        .when(text.rlike(MISSING_KPI_PATTERN), F.lit("placeholder"))
    )
    return long.withColumn("problem", problem).where(F.col("problem").isNotNull())
