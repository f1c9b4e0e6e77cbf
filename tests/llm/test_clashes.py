"""Columns of a table never clash with an operator's own; repeated keys are numbered without gaps."""

import zlib

import pytest
from pyspark.sql import functions as F

from citymarts.llm import quality, queries, sharding, stages
from citymarts.llm.common import prepare, table

SF = "/root/testdata/sf0.001"
CLASHES = ["_id", "score", "row_key", "kept", "n_bytes", "n_removed", "n_spans", "_rid", "fp", "_text", "language", "c0", "_quality"]


@pytest.fixture(scope="module")
def docs(spark):
    prepare(spark)
    plain = table(spark, SF, "documents")
    return plain.select("*", *(F.concat(F.lit(f"{c} of "), F.col("doc_id").cast("string")).alias(c) for c in CLASHES))


@pytest.mark.parametrize("name, stage", stages.STAGES, ids=[n for n, _ in stages.STAGES])
def test_stages_pass_clashing_columns_through(spark, docs, name, stage):
    plain = table(spark, SF, "documents")
    got, want = stage(spark, docs, SF), stage(spark, plain, SF)
    if name == "packing":
        assert got.columns == want.columns
        assert got.agg(F.sum("length")).first() == want.agg(F.sum("length")).first()
        return
    assert got.columns == docs.columns
    assert sorted(map(tuple, got.select(*plain.columns).collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)
    for c in CLASHES:
        assert not got.where(F.col(f"`{c}`") != F.concat(F.lit(f"{c} of "), F.col("doc_id").cast("string"))).count()


def test_quality_fit_with_a_column_called_id(spark, docs):
    labels = table(spark, SF, "labels")
    vectors, network = quality.fit(docs, labels.withColumn("_id", F.lit(1)))
    other, same = quality.fit(table(spark, SF, "documents"), labels)
    assert (vectors == other).all() and network.temperature == same.temperature


def test_rows_alike_take_their_slots_once(spark, monkeypatch):
    monkeypatch.setattr(sharding, "RUN", 8)
    rows = [(None, "same")] * 100 + [(1, "a")] * 30 + [(1, "b")] * 9 + [(1, None)] * 8 + [(i, "x") for i in range(2, 60)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = sharding.assign_shards(df, "doc_id", [1.0, 1.0, 1.0], "text", 1.0, slot_parts=4).collect()
    want = sorted(((d is not None, d or 0, zlib.crc32((t or "").encode())) for d, t in rows))
    assert sorted((r.doc_id is not None, r.doc_id or 0, r.text_crc32) for r in got) == want
    for s in {r["shard"] for r in got}:
        assert sorted(r.slot for r in got if r["shard"] == s) == list(range(sum(r["shard"] == s for r in got)))
    assert len({r["shard"] for r in got if r.doc_id is None}) == 1 and len({r["shard"] for r in got if r.doc_id == 1}) == 1


def test_int_and_long_keys_shard_alike(spark):
    ids = spark.range(500).withColumn("text", F.lit("x"))
    long = sharding.assign_shards(ids, "id", [1.0, 2.0]).select("id", "shard", "slot")
    short = sharding.assign_shards(ids.withColumn("id", F.col("id").cast("int")), "id", [1.0, 2.0]).select(F.col("id").cast("long"), "shard", "slot")
    assert not long.exceptAll(short).count()


def brute_shard(key, weights):
    """Rendezvous scores from Spark's own 64-bit hash of (key, shard), one row at a time."""
    import math

    return max(((-w / math.log((h + 0.5) / float(1 << 53)), s) for s, (w, h) in enumerate(zip(weights, key))))[1]


def test_op10_shards_equal_brute_force(spark):
    plain = table(spark, SF, "documents").select("doc_id", "text")
    hashes = plain.select("doc_id", F.array(*(F.shiftrightunsigned(F.xxhash64(F.col("doc_id").cast("string"), F.lit(s)), 11) for s in range(25))).alias("h"))
    want = {r.doc_id: (brute_shard(r.h[:24], [1.0] * 24), brute_shard(r.h, [1.0] * 25)) for r in hashes.collect()}
    got = queries.op10_rendezvous_sharding(spark, SF)
    assert got.columns == ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]
    texts = {r.doc_id: (r.text or "").encode() for r in plain.collect()}
    for r in got.collect():
        assert (r["shard"], r.grown_shard) == want[r.doc_id] and r.law == "key"
        assert (r["size"], r.text_crc32) == (len(texts[r.doc_id]) + 8, zlib.crc32(texts[r.doc_id]))
