"""A compact index of the keys of a large table, to load only what is new.

The index holds one 64-bit hash per stored key, in buckets by hash, with the
table's partition the key lies in. A load probes only the buckets its own keys
fall into; keys whose hash is not there are new for certain. The few others
are compared exactly with the keys of just those table partitions, so a hash
that collides costs a read and never a row.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

#: Buckets of the index; a load of m keys reads at most min(m, BUCKETS) of them.
BUCKETS = 256
INDEX = StructType([StructField("h", LongType()), StructField("place", StringType())])


def key_hash(keys: Sequence[str]) -> Column:
    """64-bit hash of the key; NULL parts are told from empty ones by their presence flags."""
    return F.xxhash64(*[c for k in keys for c in (F.col(k).isNull(), F.col(k).cast("string"))])


def bucket_of(h: Column, buckets: int = BUCKETS) -> Column:
    return F.lpad(F.pmod(h, F.lit(buckets)).cast("string"), 5, "0")


def index_rows(df: DataFrame, keys: Sequence[str], place: Column, hashed: Column | None = None, buckets: int = BUCKETS) -> DataFrame:
    """``h, place, bucket`` of every row of ``df``; ``place`` names the partition the row is stored in."""
    h = hashed if hashed is not None else key_hash(keys)
    return df.select(h.alias("h"), place.alias("place")).distinct().withColumn("bucket", bucket_of(F.col("h"), buckets))


def new_by_index(
    incoming: DataFrame,
    keys: Sequence[str],
    read_index: Callable[[list[str]], DataFrame],
    read_places: Callable[[list[str]], DataFrame],
    hashed: Column | None = None,
    buckets: int = BUCKETS,
) -> DataFrame:
    """Rows of ``incoming`` whose key the table does not hold; exactly.

    ``read_index(buckets)`` reads the index's buckets, ``read_places(places)``
    the keys of the table's partitions. ``incoming`` should be cheap to read
    twice (a staged table). At most ``buckets`` bucket names and the names of
    the places of probable duplicates reach the driver.
    """
    h = hashed if hashed is not None else key_hash(keys)
    asked = incoming.withColumn("_h", h)
    wanted = [r.b for r in asked.select(bucket_of(F.col("_h"), buckets).alias("b")).distinct().collect()]
    if not wanted:
        return incoming
    index = read_index(wanted)
    hits = index.join(asked.select(F.col("_h").alias("h")).distinct(), "h", "left_semi")
    places = [r.place for r in hits.select("place").distinct().collect()]
    if not places:
        return incoming
    stored = read_places(places).select(*keys).distinct()
    same = None
    for k in keys:
        one = asked[k].eqNullSafe(stored[k])
        same = one if same is None else same & one
    return asked.join(stored, same, "left_anti").drop("_h")
