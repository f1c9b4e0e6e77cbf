"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Two fingerprints differ in at most 2r bits exactly when their balls of radius r
share a point. Every distinct fingerprint emits its whole ball, one shuffle
brings equal points together, and whatever meets there is linked. A point
holds at most as many distinct fingerprints as a ball has points (65 for
r = 1), so no group grows with the data.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citymarts.llm.common import byte_column, connected_components, save

SHINGLE_WORDS = 3
MAX_BITS = 2
SEED = 42
#: Shingle hashes whose bits are counted at once.
CHUNK = 1 << 16


def shingle_hashes(text: bytes, words: int = SHINGLE_WORDS, seed: int = SEED) -> np.ndarray:
    """XXH64 of every shingle: A-Z lower-cased, words split at ASCII white
    space, ``words`` consecutive words joined by one space, repeats kept.
    Fewer words: one shingle of all; none: an empty array."""
    tokens = text.lower().split()
    n = len(tokens)
    if not n:
        return np.zeros(0, np.uint64)
    joined = b" ".join(tokens)
    if n <= words:
        return np.array([xxhash.xxh64_intdigest(joined, seed)], np.uint64)
    ends = np.cumsum(np.fromiter(map(len, tokens), np.int64, n) + 1)
    starts = np.concatenate(([0], ends[:-1]))[: n - words + 1].tolist()
    stops = (ends[words - 1 :] - 1).tolist()
    h = xxhash.xxh64_intdigest
    return np.array([h(joined[s:e], seed) for s, e in zip(starts, stops)], np.uint64)


def fingerprint(hashes: np.ndarray) -> int:
    """Bit i is 1 if it is set in over half of ``hashes``; 0 for none."""
    counts = np.zeros(64, np.int64)
    for i in range(0, len(hashes), CHUNK):
        octets = hashes[i : i + CHUNK].astype("<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (2 * counts > len(hashes)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def fingerprints(df: DataFrame, id_col: str, text_col: str, words: int = SHINGLE_WORDS) -> DataFrame:
    """``(id_col, fp)`` per row; ``fp`` holds the 64 bits as a signed long. NULL text: empty."""

    def run(batches):
        for b in batches:
            raw, off = byte_column(b.column(1))
            out = [fingerprint(shingle_hashes(raw[s:e].tobytes(), words)) for s, e in zip(off[:-1].tolist(), off[1:].tolist())]
            fp = np.array(out, np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp)], names=[id_col, "fp"])

    return df.select(F.col(id_col).cast("long").alias(id_col), F.col(text_col).cast("string").alias(text_col)).mapInArrow(
        run, f"`{id_col}` long, fp long"
    )


def ball(fp: str, radius: int):
    """All 64-bit values within ``radius`` (0 to 2) bits of column ``fp``, each once."""
    near = F.array(F.col(fp))
    if radius >= 1:
        near = F.concat(near, F.transform(F.sequence(F.lit(0), F.lit(63)), lambda i: F.col(fp).bitwiseXOR(_bit(i))))
    if radius >= 2:
        pairs = F.flatten(F.transform(F.sequence(F.lit(1), F.lit(63)), lambda i: F.transform(F.sequence(F.lit(0), i - 1), lambda j: F.col(fp).bitwiseXOR(_bit(i)).bitwiseXOR(_bit(j)))))
        near = F.concat(near, pairs)
    return near


def _bit(i):
    return F.call_function("shiftleft", F.lit(1).cast("long"), i.cast("int"))


def link_fingerprints(distinct: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Edges ``(a, b)`` that connect all distinct ``fp`` within ``max_bits`` of each other.

    Points of the balls are grouped to their count, smallest and largest
    fingerprint; where more than two meet, the others are fetched and linked to
    the smallest. Members of one point are pairwise within ``max_bits``; the
    distance is still checked before an edge is made.
    """
    if max_bits % 2 or not 0 <= max_bits <= 4:
        raise ValueError("max_bits must be 0, 2 or 4")
    points = distinct.select("fp", F.explode(ball("fp", max_bits // 2)).alias("point"))
    met = points.groupBy("point").agg(F.count("*").alias("n"), F.min("fp").alias("lo"), F.max("fp").alias("hi"))
    met = save(met.where("n > 1"), "simhash-points")
    two = met.select(F.col("lo").alias("a"), F.col("hi").alias("b"))
    rest = points.join(met.where("n > 2").select("point", "lo"), "point").select(F.col("lo").alias("a"), F.col("fp").alias("b"))
    pairs = two.unionByName(rest).where("a <> b").distinct()
    return pairs.where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits)


def simhash_groups(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS
) -> DataFrame:
    """One row per row of ``df``: ``id_col``, ``fingerprint`` (16 hex digits)
    and ``component_id``, the smallest id reachable over links.

    NULL and empty texts have fingerprint zero and link with each other; equal
    texts always link; repeated ids give repeated rows; a NULL id is never the
    smallest unless it is alone. Other columns are not read.
    """
    fps = save(fingerprints(df, id_col, text_col, words), "simhash-fp")
    distinct = fps.groupBy("fp").agg(F.min(id_col).alias("low"))
    roots = connected_components(link_fingerprints(distinct.select("fp"), max_bits), "simhash-cc")
    grouped = distinct.join(roots, distinct.fp == roots.node, "left").select("fp", "low", F.coalesce("root", "fp").alias("root"))
    grouped = save(grouped, "simhash-roots")
    least = grouped.groupBy("root").agg(F.min("low").alias("component_id"))
    named = grouped.join(least, "root").select("fp", "component_id")
    return fps.join(named, "fp").select(
        id_col, F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )
