import datetime as dt

from citymarts.functions import (
    best_effort_ts,
    bucket,
    clamp,
    content_hash,
    hours_between,
    per_100k,
    safe_pct_change,
    strip_volatile,
)


def _one(spark, expr, **cols):
    df = spark.createDataFrame([tuple(cols.values())], list(cols.keys())) if cols else spark.range(1)
    return df.select(expr.alias("x")).first()["x"]


def test_clamp_keeps_null_and_bounds(spark):
    df = spark.createDataFrame([(150.0,), (-3.0,), (42.5,), (None,)], "v double")
    got = [r.x for r in df.select(clamp("v").alias("x")).collect()]
    assert got == [100.0, 0.0, 42.5, None]


def test_bucket_thresholds(spark):
    df = spark.createDataFrame([(4.99,), (5.0,), (24.99,), (25.0,), (None,)], "p double")
    got = [r.x for r in df.select(bucket("p", [(25.0, "Severe"), (5.0, "Moderate")], "Low").alias("x")).collect()]
    assert got == ["Low", "Moderate", "Moderate", "Severe", "Low"]


def test_safe_pct_change(spark):
    df = spark.createDataFrame([(110.0, 100.0), (5.0, 0.0), (5.0, None), (90.0, 100.0)], "c double, p double")
    got = [r.x for r in df.select(safe_pct_change("c", "p").alias("x")).collect()]
    assert got == [10.0, None, None, -10.0]


def test_hours_between_counts_boundaries(spark):
    df = spark.createDataFrame(
        [(dt.datetime(2024, 1, 1, 0, 59), dt.datetime(2024, 1, 1, 2, 0))], "a timestamp_ntz, b timestamp_ntz"
    )
    assert df.select(hours_between("a", "b").alias("x")).first().x == 2


def test_per_100k(spark):
    df = spark.createDataFrame([(50, 2500000), (3, 0)], "n long, pop long")
    got = [r.x for r in df.select(per_100k("n", "pop").alias("x")).collect()]
    assert got == [2.0, None]


def test_best_effort_ts_shapes(spark):
    df = spark.createDataFrame(
        [("2026-09-23T00:00",), ("20260924T101500Z",), ("Thu, 24 Sep 2026 00:02:31 +0000",), ("junk",)], "t string"
    )
    got = [r.x for r in df.select(best_effort_ts("t").alias("x")).collect()]
    assert got == [
        dt.datetime(2026, 9, 23, 0, 0),
        dt.datetime(2026, 9, 24, 10, 15),
        dt.datetime(2026, 9, 24, 0, 2, 31),
        None,
    ]


#: SHA-256 of ``{"b":{"a":"x","z":1},"temperature_2m":[27.5],"time":["2026-09-23T00:00"]}``.
GOLDEN_CHECKSUM = "6d95a1ec22ffae413c3750b00f9690eb4797c1bdb21d49608c5a884d609c0869"


def test_content_hash_is_the_golden_checksum(spark):
    spaced = '{ "time": ["2026-09-23T00:00"],\n "temperature_2m": [27.5], "b": {"z": 1, "a": "x"} }'
    df = spark.createDataFrame([(spaced,)], "p string")
    assert df.select(content_hash("p").alias("x")).first().x == GOLDEN_CHECKSUM


def test_content_hash_same_and_different_payloads(spark):
    df = spark.createDataFrame([('{"a": 1}',), ('{ "a" :1 }',), ('{"a": 2}',), ("not json",)], "p string")
    got = [r.x for r in df.select(content_hash("p").alias("x")).collect()]
    assert got[0] == got[1] and got[0] != got[2] and got[3] is None


def test_strip_volatile_only_top_level_and_keeps_nulls(spark):
    df = spark.createDataFrame(
        [('{"generationtime_ms": 0.3, "x": null, "inner": {"generationtime_ms": 1}}',), ("[1,2]",)], "p string"
    )
    got = [r.x for r in df.select(strip_volatile("p", ["generationtime_ms"]).alias("x")).collect()]
    assert got == ['{"inner":{"generationtime_ms":1},"x":null}', "[1,2]"]
