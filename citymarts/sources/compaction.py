"""Compaction: small files of a snapshot table become files of a given size.

Every load adds a few files per partition. Compaction looks at file sizes
only (metadata), picks the partitions that hold more files than their bytes
ask for, rewrites those sorted by key and swaps the folders in one commit of
its own; loads that arrive meanwhile stay.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Collection, Sequence

from pyspark.sql.types import StructType

from citymarts.sources.snapshots import SnapshotStore

TARGET_BYTES = 128 * 1024 * 1024


def crowded(sizes: dict[str, list[int]], target_bytes: int, busy: Collection[str] = ()) -> tuple[list[str], int]:
    """(leaf folders to rewrite, files their rows should fill).

    A partition is what follows a folder's first part (the write). It is
    crowded if its files could be packed into fewer of ``target_bytes``. Folders
    of ``busy`` writes are left out.
    """
    per: dict[str, list[str]] = defaultdict(list)
    for folder in sizes:
        top, _, partition = folder.partition("/")
        if top.partition("=")[2] not in busy:
            per[partition].append(folder)
    chosen, files = [], 0
    for folders in per.values():
        small = [b for f in folders for b in sizes[f] if b < target_bytes]
        wanted = math.ceil(sum(small) / target_bytes)
        # folders of one whole file or more gain nothing from being rewritten
        rewrite = [f for f in folders if any(b < target_bytes for b in sizes[f]) or not sizes[f]]
        if len(small) > max(1, wanted) or len(rewrite) > max(1, wanted):
            chosen += rewrite
            files += max(1, math.ceil(sum(b for f in rewrite for b in sizes[f]) / target_bytes))
    return sorted(chosen), files


def compact(
    store: SnapshotStore,
    table: str,
    schema: StructType,
    partition_by: Sequence[str],
    keys: Sequence[str],
    column: str,
    target_bytes: int = TARGET_BYTES,
    busy: Collection[str] = (),
    write: str = "compacted",
) -> int:
    """Compact ``table`` (leaf folders ``<column>=<write>/<partition_by>…``); how many folders were rewritten.

    Rows are range-partitioned by partition and key, so each new file covers a
    key range: at most ``ceil(bytes / target_bytes)`` files plus one per
    partition. ``busy`` names writes (loads) that something still selects by
    name; they are not touched. Rows, duplicates included, stay as they are.
    """
    snapshot = store.current()
    folders, files = crowded(store.sizes(table, snapshot), target_bytes, busy)
    if not folders:
        return 0
    rows = store.read(table, schema, snapshot.having(table, folders)).drop(column)
    number = f"{write}-{snapshot.number:012d}"
    by = [*partition_by, *keys]
    made = store.stage(table, rows.repartitionByRange(files, *by).sortWithinPartitions(*by), partition_by, (), number, column)
    store.swap(table, folders, made)
    return len(folders)
