"""Reusable DataFrame operators (DataFrame in, DataFrame out)."""

from citymarts.operators.delivery import delivery_outcomes, flag_first_delivery, load_new
from citymarts.operators.freshness import freshness_summary, freshness_verdict
from citymarts.operators.geo import haversine_m, poi_counts, radius_catchment
from citymarts.operators.joins import bounded_broadcast, fan_out
from citymarts.operators.latest import dedupe_first, last_non_null, latest_by_key, latest_snapshot
from citymarts.operators.quality import (
    MinRows,
    Rule,
    flag_violations,
    gate_report,
    kpi_missing,
    run_gates,
    split_quarantine,
)
from citymarts.operators.rollup import daily_rollup, null_ratio
from citymarts.operators.scoring import composite, pillar_contributions, standings
from citymarts.operators.timeseries import lag_pct_change
from citymarts.operators.unnest import (
    parse_parallel_arrays,
    record_array_unnest,
    wide_to_long,
    with_parsed,
    zip_arrays_rejects,
    zip_arrays_unnest,
)
