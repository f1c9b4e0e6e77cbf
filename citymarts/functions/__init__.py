"""Column-level helpers. Every function returns a ``Column`` built only from
built-in Spark expressions, so it stays inside whole-stage codegen."""

from citymarts.functions.scalar import (
    bucket,
    clamp,
    hours_between,
    per_100k,
    round_half_even,
    safe_pct_change,
)
from citymarts.functions.jsonhash import canonical_json, content_hash, strip_volatile
from citymarts.functions.timeparse import best_effort_ts

__all__ = [
    "bucket",
    "clamp",
    "hours_between",
    "per_100k",
    "round_half_even",
    "safe_pct_change",
    "canonical_json",
    "content_hash",
    "strip_volatile",
    "best_effort_ts",
]
