import os

from citymarts.streaming import fact_upsert_stream, raw_sync_stream
from tests.envelopes import hourly, write_envelope, write_raw_text


def test_raw_sync_and_fact_upsert_streams(spark, workdir):
    root = os.path.join(workdir, "raw")
    raw_table = os.path.join(workdir, "wh", "raw")
    facts = os.path.join(workdir, "wh", "facts")
    ck1, ck2 = os.path.join(workdir, "ck_raw"), os.path.join(workdir, "ck_facts")

    write_envelope(root, "open_meteo_weather", "ng_lagos",
                   hourly(["2026-09-23T00:00", "2026-09-23T01:00"], temperature_2m=[27.0, 28.0],
                          precipitation=[0, 0], relative_humidity_2m=[1, 1], wind_speed_10m=[1, 1]),
                   "2026-09-23T06:00:00+00:00")
    raw_sync_stream(spark, root, raw_table, ck1).awaitTermination()
    fact_upsert_stream(spark, raw_table, facts, ck2, tables=["fact_weather_hourly"]).awaitTermination()
    assert spark.read.parquet(raw_table).count() == 1
    w = {r.observed_at.hour: r.temperature_c for r in spark.read.parquet(f"{facts}/fact_weather_hourly").collect()}
    assert w == {0: 27.0, 1: 28.0}

    # a newer delivery revises hour 1 (to NULL) and adds hour 2; the same
    # file content delivered again under another name must not duplicate
    p = hourly(["2026-09-23T01:00", "2026-09-23T02:00"], temperature_2m=[None, 30.0],
               precipitation=[0, 0], relative_humidity_2m=[1, 1], wind_speed_10m=[1, 1])
    write_envelope(root, "open_meteo_weather", "ng_lagos", p, "2026-09-24T06:00:00+00:00")
    write_envelope(root, "open_meteo_weather", "ng_lagos", p, "2026-09-24T07:00:00+00:00")
    raw_sync_stream(spark, root, raw_table, ck1).awaitTermination()
    fact_upsert_stream(spark, raw_table, facts, ck2, tables=["fact_weather_hourly"]).awaitTermination()
    assert spark.read.parquet(raw_table).count() == 2
    w = {r.observed_at.hour: r.temperature_c for r in spark.read.parquet(f"{facts}/fact_weather_hourly").collect()}
    assert w == {0: 27.0, 1: None, 2: 30.0}


def test_bad_files_become_dead_letters_and_a_repeated_batch_adds_nothing(spark, workdir):
    from citymarts.streaming.raw_sync import _append_new, tagged_stream

    root, raw, dead = (os.path.join(workdir, n) for n in ("raw", "wh/raw", "wh/dead"))
    p = hourly(["2026-09-23T00:00"], temperature_2m=[27.0])
    write_envelope(root, "open_meteo_weather", "ng_lagos", p, "2026-09-23T06:00:00+00:00")
    write_raw_text(root, "gdelt_news", "ng_lagos", "000000_a.json", "{no json")
    write_raw_text(root, "gdelt_news", "ng_lagos", "000000_b.json", '{"checksum": "x"}')
    raw_sync_stream(spark, root, raw, os.path.join(workdir, "ck"), dead_letters=dead).awaitTermination()
    letters = spark.read.parquet(dead).collect()
    assert sorted((r.source, r.rule) for r in letters) == [("gdelt_news", "incomplete_envelope"), ("gdelt_news", "invalid_json")]
    assert {r.value for r in letters} == {"{no json", '{"checksum": "x"}'}
    assert spark.read.parquet(raw).count() == 1
    # the same batch once more, as after a failure before its commit
    stream = tagged_stream(spark, root).writeStream.foreachBatch(_append_new(raw, dead)).option("checkpointLocation", os.path.join(workdir, "again"))
    stream.trigger(availableNow=True).start().awaitTermination()
    assert spark.read.parquet(raw).count() == 1 and spark.read.parquet(dead).count() == 2
    assert spark.read.parquet(f"{raw}_keys").count() == 1


def test_an_index_row_without_its_raw_row_loses_nothing(spark, workdir):
    """A batch that died between the two writes."""
    from pyspark.sql import functions as F

    from citymarts.operators.key_index import index_rows
    from citymarts.sources.envelopes import scan_envelopes
    from citymarts.sources.sinks import append_rows, month_of
    from citymarts.streaming.raw_sync import RAW_KEYS

    root, raw = os.path.join(workdir, "raw"), os.path.join(workdir, "wh", "raw")
    write_envelope(root, "open_meteo_weather", "ng_lagos", hourly(["2026-09-23T00:00"], temperature_2m=[27.0]), "2026-09-23T06:00:00+00:00")
    rows = scan_envelopes(spark, root).withColumn("ym", month_of("ingested_at"))
    append_rows(index_rows(rows, RAW_KEYS, F.concat_ws("/", "source", "ym")), f"{raw}_keys", ["bucket"])
    raw_sync_stream(spark, root, raw, os.path.join(workdir, "ck")).awaitTermination()
    assert spark.read.parquet(raw).count() == 1
