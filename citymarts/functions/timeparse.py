"""Best-effort timestamp parsing for the payload time shapes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The three timestamp text shapes the sources deliver
#   ISO local        2026-09-23T00:00   (hourly series, news dates)
#   compact UTC      20260924T101500Z
#   RFC 2822         Thu, 24 Sep 2026 00:02:31 +0000   (FX update time)
COMPACT_UTC = "yyyyMMdd'T'HHmmssX"
RFC_2822_NO_WEEKDAY = "d MMM yyyy HH:mm:ss Z"
COMPACT_SHAPE = r"^[0-9]{8}T[0-9]{6}Z$"


def best_effort_ts(text: Column | str) -> Column:
    """Parse any known shape to a UTC wall-clock ``TIMESTAMP_NTZ``; junk -> NULL.

    Requires the session time zone to be UTC (``session.DEFAULT_CONF``), so the
    zone-aware parses land on UTC wall-clock time when made zone-less.
    """
    t = F.trim(F.col(text) if isinstance(text, str) else text)
    # Each format is only attempted on text of its shape: a failed parse is
    # far more expensive than the shape test, and most rows fail two of three.
    parsed = F.coalesce(
        F.when(~t.contains(", ") & ~t.rlike(COMPACT_SHAPE), F.try_to_timestamp(t)),
        F.when(t.rlike(COMPACT_SHAPE), F.try_to_timestamp(t, F.lit(COMPACT_UTC))),
        F.when(t.contains(", "), F.try_to_timestamp(F.substring_index(t, ", ", -1), F.lit(RFC_2822_NO_WEEKDAY))),
    )
    return parsed.cast("timestamp_ntz")
