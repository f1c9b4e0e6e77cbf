"""Evidence files for tests.

The loaders take a checksum as an opaque label, so these files carry a short
number padded to 64 digits: equal payloads, equal label. What a real checksum
must be is held by the literal constants in ``test_functions``.
"""

from __future__ import annotations

import json
import os
import zlib


def write_envelope(root: str, source: str, scope: str, payload, ingested_at: str, checksum: str | None = None) -> str:
    """One delivery under ``<source>/<scope>/<year>/<month>/<day>``; ``ingested_at`` is ISO text."""
    day, clock = ingested_at[:10], ingested_at[11:19]
    label = checksum or f"{zlib.crc32(repr(payload).encode()):064x}"
    fields = dict(source=source, city_id=scope, ingested_at_utc=ingested_at, checksum=label, payload=payload)
    name = f"{clock.replace(':', '')}_{zlib.crc32(label.encode()):08x}.json"
    return write_raw_text(root, source, scope, name, json.dumps(fields), day.replace("-", "/"))


def write_raw_text(root: str, source: str, scope: str, name: str, text: str, day: str = "2026/09/24") -> str:
    folder = os.path.join(root, source, scope, day)
    os.makedirs(folder, exist_ok=True)
    path = os.path.join(folder, name)
    with open(path, "w", encoding="utf-8") as fh:
        fh.write(text)
    return path


def hourly(times, **series):
    return {"hourly": {"time": list(times), **{k: list(v) for k, v in series.items()}}}
