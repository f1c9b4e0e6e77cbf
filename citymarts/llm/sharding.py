"""Weighted rendezvous sharding of records by a stable key (DataFrame functions only).

Every (key, shard) pair gets a pseudo-random score; a record goes to the shard
with its largest score, so adding a shard only moves the records that the new
shard wins, and a shard's share follows its weight.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

#: Rows of one shard are numbered in this many parts, each sorted on its own.
SLOT_PARTS = 4096
#: Rows alike in everything are numbered as one and written out in runs of this many.
RUN = 4096


def rendezvous_shard(key: Column, weights: Sequence[float]) -> Column:
    """Shard of ``key`` among ``len(weights)`` weighted shards.

    Score of shard s: ``-weight / ln(u)`` with u in (0, 1) from a 64-bit hash
    of (key, s). NULL keys hash like any value; equal scores go to the larger
    shard number; shards of weight 0 or less get nothing.
    """
    if not any(w > 0 for w in weights):
        raise ValueError("no shard has a positive weight")
    scores = []
    for s, w in enumerate(weights):
        if w > 0:
            h = F.shiftrightunsigned(F.xxhash64(key, F.lit(s)), 11).cast("double")
            u = (h + 0.5) / float(1 << 53)
            scores.append(F.struct((F.lit(-float(w)) / F.log(u)).alias("score"), F.lit(s).alias("shard")))
    best = F.greatest(*scores) if len(scores) > 1 else scores[0]
    return best["shard"]


def assign_shards(
    df: DataFrame,
    key: str,
    weights: Sequence[float],
    text: str | None = None,
    grown_weight: float | None = None,
    slot_parts: int = SLOT_PARTS,
) -> DataFrame:
    """``df``'s ``key`` with ``size``, ``text_crc32``, ``shard``, ``slot`` and ``grown_shard``.

    ``size`` is the UTF-8 length of ``text`` (NULL: 0) plus 8 for the key.
    ``slot`` numbers a shard's rows from 0 without gaps: rows of a shard are
    dealt to ``slot_parts`` parts by a hash of key, checksum and size, each part
    is numbered in key order, and parts are shifted by the counts of the parts
    before them (a table of at most shards x parts rows). Rows alike in key,
    checksum and size are counted map-side, numbered as one row and written out
    again in runs of ``RUN``, so neither a shard nor a repeated or NULL key that
    holds much of the table is ever sorted or written in one task.
    ``grown_shard``: the shard once one more shard of ``grown_weight`` exists.
    The key is hashed as text, so an INT and a BIGINT key shard alike. Equal
    keys meet in one shard; which of several rows alike takes which of their
    slots makes no difference. An empty table gives no rows; other columns of
    ``df`` are not read, so their names cannot clash.
    """
    body = F.coalesce(F.col(text).cast("string"), F.lit("")) if text else F.lit("")
    hashed = F.col("_key").cast("string")
    grown = rendezvous_shard(hashed, [*weights, grown_weight]) if grown_weight else F.lit(None).cast("int")
    part = F.pmod(F.xxhash64(hashed, "_crc", "_size"), F.lit(slot_parts)).cast("int")
    rows = df.select(F.col(key).alias("_key"), (F.octet_length(body) + 8).cast("long").alias("_size"), F.crc32(body.cast("binary")).alias("_crc"))
    alike = rows.groupBy("_key", "_size", "_crc").agg(F.count(F.lit(1)).alias("_rows"))
    placed = alike.select("*", rendezvous_shard(hashed, weights).alias("shard"), part.alias("_part"))
    counts = placed.groupBy("shard", "_part").agg(F.sum("_rows").alias("_rows"))
    before = Window.partitionBy("shard").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    shift = counts.select("shard", "_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("shard", "_part").orderBy("_key", "_crc", "_size").rowsBetween(Window.unboundedPreceding, -1)
    first = F.coalesce(F.sum("_rows").over(inside), F.lit(0))
    runs = (
        placed.withColumn("_first", first)
        .join(shift, ["shard", "_part"])
        .select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(_rows - 1) div {RUN}"))).alias("_run"))
        .repartition(F.xxhash64("_key", "_crc", "_size", "_run"))
    )
    last = F.least(F.col("_rows"), (F.col("_run") + 1) * RUN) - 1
    numbered = runs.select("*", F.explode(F.sequence(F.col("_run") * RUN, last)).alias("_n"))
    slot = F.col("_before") + F.col("_first") + F.col("_n")
    return numbered.select(
        F.col("_key").alias(key), F.col("_size").alias("size"), F.col("_crc").alias("text_crc32"), "shard", slot.alias("slot"), grown.alias("grown_shard")
    )
