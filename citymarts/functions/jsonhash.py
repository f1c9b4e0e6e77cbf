"""Payload canonicalisation and content hashing.

A payload is parsed to VARIANT, which stores object keys sorted at every
depth; ``to_json`` of it is therefore a canonical compact form, and its
SHA-256 is a content hash that ignores key order and whitespace.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def canonical_json(payload: Column | str) -> Column:
    """Canonical compact JSON text; NULL when the text is not valid JSON."""
    return F.to_json(F.try_parse_json(_col(payload)))


def content_hash(payload: Column | str) -> Column:
    """Hex SHA-256 of the canonical JSON; NULL for invalid JSON."""
    return F.sha2(canonical_json(payload), 256)


def strip_volatile(payload: Column | str, fields: Iterable[str]) -> Column:
    """Drop top-level keys that change on every poll (e.g. generation time).

    Objects lose the listed keys (JSON nulls elsewhere are kept); any other
    JSON value is returned canonicalised and unchanged.
    """
    drop = [str(f) for f in fields]
    parsed = F.try_parse_json(_col(payload))
    as_map = F.try_variant_get(parsed, "$", "map<string,variant>")
    kept = F.map_filter(as_map, lambda k, v: ~k.isin(drop)) if drop else as_map
    return F.when(parsed.isNull(), F.lit(None).cast("string")).otherwise(
        F.coalesce(F.to_json(kept), F.to_json(parsed))
    )
