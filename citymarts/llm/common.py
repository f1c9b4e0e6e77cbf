"""Helpers shared by the operators of this folder."""

from __future__ import annotations

import ctypes
import os
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citymarts.session import ensure_checkpoint_dir

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


#: Bytes of one Arrow batch on its way to a Python worker: long texts come few at a time.
BATCH_BYTES = "8m"
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


#: Python workers live as long as their executor: what a task frees goes back to the system.
WORKER_MEMORY = {"ARROW_DEFAULT_MEMORY_POOL": "system", "MALLOC_TRIM_THRESHOLD_": "131072", "MALLOC_ARENA_MAX": "2"}


#: What short-lived arrays up to 1 MB may keep of a worker's heap, else each costs its page faults.
HEAP_KEPT, HEAP_ARRAYS = 16 << 20, 1 << 20


def roomy_heap(run, kept: int = HEAP_KEPT, arrays: int = HEAP_ARRAYS):
    """``run`` (a map over Arrow batches) with a heap that keeps ``kept`` bytes
    for arrays up to ``arrays`` bytes while it lasts; without glibc nothing changes."""

    def wrapped(batches):
        libc = ctypes.CDLL(None)
        if not (hasattr(libc, "mallopt") and hasattr(libc, "malloc_trim")):
            yield from run(batches)
            return
        trim, mmap = -1, -3  # M_TRIM_THRESHOLD, M_MMAP_THRESHOLD
        libc.mallopt(trim, kept)
        libc.mallopt(mmap, arrays)
        try:
            yield from run(batches)
        finally:
            libc.mallopt(trim, int(WORKER_MEMORY["MALLOC_TRIM_THRESHOLD_"]))
            libc.mallopt(mmap, 128 << 10)
            libc.malloc_trim(0)

    return wrapped


def prepare(spark: SparkSession) -> None:
    """Let Python workers import this package (same path on every node, or a
    ``--py-files`` archive, which wins), and bound Arrow batches by bytes
    unless the deployment does so itself."""
    if not spark.sparkContext.getConf().contains(_BATCH):
        spark.conf.set(_BATCH, BATCH_BYTES)
    env = spark.sparkContext.environment
    for name, value in WORKER_MEMORY.items():
        env.setdefault(name, value)
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if ROOT not in paths:
        env["PYTHONPATH"] = os.pathsep.join([*paths, ROOT])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A new path inside the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def save(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: write ``df`` as Parquet in the shared checkpoint
    folder and read it back (survives the loss of executors)."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def row_key(df: DataFrame, id_col: str, *order: str) -> DataFrame:
    """Add ``_rid``: a unique long per row that sorts as (``id_col``, ``order``),
    NULL ids first. A unique, non-null id is its own key; otherwise (repeated
    rows, NULL ids) the sorted rows are numbered and written, so that a lost
    task cannot number them anew."""
    bad = df.groupBy(id_col).count().where((F.col("count") > 1) | F.col(id_col).isNull())
    if not bad.limit(1).count():
        return df.withColumn("_rid", F.col(id_col).cast("long"))
    return save(df.orderBy(id_col, *order).withColumn("_rid", F.monotonically_increasing_id()), "keyed")


def byte_column(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of an Arrow string or binary column and its n+1 offsets;
    NULL counts as empty. No copy unless there are NULLs."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = col.fill_null(b"" if pa.types.is_binary(col.type) or pa.types.is_large_binary(col.type) else "")
    wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    _, offsets, data = col.buffers()
    n = len(col)
    if not n:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    off = np.frombuffer(offsets, np.int64 if wide else np.int32)[col.offset : col.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8)[off[0] : off[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, off - off[0]


def runs_of_rows(offsets: np.ndarray, limit: int):
    """(first, last) row ranges whose bytes stay near ``limit`` (one row at least)."""
    n, i = len(offsets) - 1, 0
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + limit, side="right")) - 1
        j = min(n, max(i + 1, j))
        yield i, j
        i = j


def texts(col: pa.Array, limit: int = 2_000_000):
    """Lists of texts (NULL as empty) with their first row, each about ``limit`` bytes."""
    _, off = byte_column(col)
    for i, j in runs_of_rows(off, limit):
        yield i, [t or "" for t in col.slice(i, j - i).to_pylist()]


def connected_components(edges: DataFrame, name: str = "components") -> DataFrame:
    """``(node, root)`` for every node of ``edges(a, b)``: ``root`` is the
    smallest node of its component.

    Alternating large-star and small-star rounds; a node's neighbours are only
    ever reduced to their minimum and joined back (map-side minima; a hub's
    join is split by the skew join), and every round is written to the shared
    checkpoint folder.
    """

    def star(df, keep_small):
        low = df.groupBy("a").agg(F.min("b").alias("m"))
        if keep_small:  # large star: larger neighbours move to the minimum around a
            low = low.select("a", F.least("a", "m").alias("m"))
            return df.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        moved = df.join(low, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        return moved.unionByName(low.select("a", F.col("m").alias("b")))

    def state(df):
        r = df.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        return tuple(r)

    cur = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    cur = save(cur, name)
    seen = state(cur)
    while seen[0]:
        both = cur.unionByName(cur.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = star(both, True).distinct()
        cur = save(star(large, False).distinct(), name)
        now = state(cur)
        if now == seen:
            break
        seen = now
    return cur.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        cur.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )
