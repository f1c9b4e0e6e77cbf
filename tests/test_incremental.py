"""Incremental refresh must produce exactly what a full rebuild produces."""

import os

import pytest

from tests.envelopes import hourly, write_envelope
from citymarts.plans import refresh as chain
from citymarts.plans.refresh import FACT_SCHEMAS, MARTS, Paths, refresh

AS_OF = "2026-10-05 00:00:00"


def _batch_a(root):
    write_envelope(root, "open_meteo_weather", "ng_lagos",
                   hourly(["2026-09-29T00:00", "2026-09-29T01:00", "2026-09-30T00:00"], temperature_2m=[27.0, 28.0, 29.0],
                          precipitation=[1.0, 6.0, 30.0], relative_humidity_2m=[80, 81, 82], wind_speed_10m=[1, 2, 3]),
                   "2026-09-30T06:00:00+00:00")
    write_envelope(root, "open_meteo_air_quality", "ng_lagos",
                   hourly(["2026-09-29T00:00", "2026-09-30T00:00"], pm2_5=[40.0, 20.0], pm10=[1, 1],
                          nitrogen_dioxide=[1, 1], ozone=[1, 1]), "2026-09-30T06:00:00+00:00")
    write_envelope(root, "fx_rates", "global", {"result": "success", "time_last_update_utc": "Tue, 29 Sep 2026 00:02:31 +0000",
                                                 "rates": {"NGN": 1500.0, "GHS": 12.0}}, "2026-09-29T06:00:00+00:00")
    write_envelope(root, "fx_rates", "global", {"result": "success", "time_last_update_utc": "Wed, 30 Sep 2026 00:02:31 +0000",
                                                 "rates": {"NGN": 1515.0, "GHS": 12.1}}, "2026-09-30T06:00:00+00:00")
    write_envelope(root, "gdelt_news", "ng_lagos", {"timeline": [{"data": [{"date": "20260929T001500Z", "value": 0.3}]}]},
                   "2026-09-30T06:00:00+00:00")
    write_envelope(root, "world_bank", "ng_gdp", [{"page": 1}, [{"indicator": {"id": "GDP"}, "country": {"id": "NG"},
                                                                  "date": "2025", "value": 2.0}]], "2026-09-30T06:00:00+00:00")
    write_envelope(root, "osm_infrastructure", "ng_lagos",
                   {"bus_stops": 100, "transit_stations": 20, "transit_nodes_total": 120, "fuel_stations_total": 30,
                    "commercial_banks": 5, "commercial_marketplaces": 5, "commercial_nodes_total": 10},
                   "2026-09-30T06:00:00+00:00")


def _batch_b(root):
    # next poll: revises 2026-09-30 00:00 and adds October hours; new FX day in October
    write_envelope(root, "open_meteo_weather", "ng_lagos",
                   hourly(["2026-09-30T00:00", "2026-10-01T00:00", "2026-10-01T01:00"], temperature_2m=[None, 25.0, 26.0],
                          precipitation=[2.0, 0.0, 1.0], relative_humidity_2m=[70, 71, 72], wind_speed_10m=[1, 1, 1]),
                   "2026-10-01T06:00:00+00:00")
    write_envelope(root, "fx_rates", "global", {"result": "success", "time_last_update_utc": "Thu, 01 Oct 2026 00:02:31 +0000",
                                                 "rates": {"NGN": 1530.0, "GHS": 12.2}}, "2026-10-01T06:00:00+00:00")
    write_envelope(root, "gdelt_news", "gh_accra", {"timeline": [{"data": [{"date": "20261001T001500Z", "value": 0.5}]}]},
                   "2026-10-01T06:00:00+00:00")


def _snapshot(spark, out):
    p = Paths(out)
    tables = {n: p.fact(n) for n in FACT_SCHEMAS}
    tables.update({n: p.mart(n) for n in MARTS})
    snap = {}
    for name, path in tables.items():
        df = spark.read.parquet(path).drop("part", "ym")
        cols = sorted(df.columns)
        snap[name] = sorted((tuple(r) for r in df.select(*cols).collect()), key=repr)
    return snap


def test_incremental_equals_full_rebuild(spark, workdir):
    root = os.path.join(workdir, "raw")
    inc_out, full_out = os.path.join(workdir, "inc"), os.path.join(workdir, "full")
    _batch_a(root)
    refresh(spark, root, inc_out, as_of=AS_OF, run_id="a", incremental=True)
    _batch_b(root)
    refresh(spark, root, inc_out, as_of=AS_OF, run_id="b", incremental=True)
    refresh(spark, root, full_out, as_of=AS_OF, run_id="full")
    inc, full = _snapshot(spark, inc_out), _snapshot(spark, full_out)
    for name in full:
        assert inc[name] == full[name], name
    # the revision really happened: 09-30 00:00 temperature is now NULL
    w = spark.read.parquet(Paths(inc_out).fact("fact_weather_hourly"))
    assert w.where("observed_at = timestamp_ntz'2026-09-30 00:00:00'").first().temperature_c is None
    log = spark.read.parquet(Paths(inc_out).log)
    stages = {r.source_id: r.rows_loaded for r in log.where("run_id = 'b' AND source_id LIKE 'stage:%'").collect()}
    # weather {2026-09, 2026-10} + fx {2026-10} + news {2026-10} partitions merged; 2 mart months rebuilt
    assert stages["stage:facts"] == 4 and stages["stage:marts"] == 2


def _fx(root, day, rate, at):
    write_envelope(root, "fx_rates", "global", {"result": "success", "time_last_update_utc": f"{day} 00:02:31 +0000",
                                                 "rates": {"NGN": rate, "GHS": 12.0}}, at)


def _same(spark, a, b):
    left, right = _snapshot(spark, a), _snapshot(spark, b)
    for name in right:
        assert left[name] == right[name], name


@pytest.mark.parametrize("stage", ["upsert_partitions", "_write_mart"])
def test_a_failed_run_loses_nothing(spark, workdir, monkeypatch, stage):
    root, out, full = (os.path.join(workdir, n) for n in ("raw", "inc", "full"))
    _batch_a(root)
    assert refresh(spark, root, out, as_of=AS_OF, incremental=True) in (0, 2)
    _batch_b(root)
    real, calls = getattr(chain, stage), []

    def fails(*a, **k):
        calls.append(1)
        if len(calls) == (2 if stage in ("upsert_partitions", "_write_mart") else 1):
            raise OSError("lost")
        return real(*a, **k)

    monkeypatch.setattr(chain, stage, fails)
    assert refresh(spark, root, out, as_of=AS_OF, incremental=True) == 1
    monkeypatch.setattr(chain, stage, real)
    assert refresh(spark, root, out, as_of=AS_OF, incremental=True) in (0, 2)
    refresh(spark, root, full, as_of=AS_OF)
    _same(spark, out, full)


def test_month_end_revision_reaches_the_next_month(spark, workdir):
    root, out, full = (os.path.join(workdir, n) for n in ("raw", "inc", "full"))
    _batch_a(root)
    _batch_b(root)
    refresh(spark, root, out, as_of=AS_OF, incremental=True)
    _fx(root, "Wed, 30 Sep 2026", 1600.0, "2026-10-02T06:00:00+00:00")
    refresh(spark, root, out, as_of=AS_OF, incremental=True)
    refresh(spark, root, full, as_of=AS_OF)
    _same(spark, out, full)
    fx = spark.read.parquet(Paths(out).mart("mart_fx_daily")).where("date = date'2026-10-01' AND currency = 'NGN'")
    assert {r.units_per_usd for r in fx.collect()} == {1530.0}


def test_an_empty_fact_stays_incremental_and_quarantine_is_idempotent(spark, workdir):
    root, out = os.path.join(workdir, "raw"), os.path.join(workdir, "inc")
    _fx(root, "Tue, 29 Sep 2026", 1500.0, "2026-09-29T06:00:00+00:00")
    _fx(root, "no day at all", 1.0, "2026-09-29T07:00:00+00:00")
    write_envelope(root, "open_meteo_weather", "ng_lagos", {"error": True}, "2026-09-29T06:00:00+00:00")
    write_envelope(root, "gdelt_news", "ng_lagos", {"timeline": [{"data": [{"date": "junk", "value": 1}]}]}, "2026-09-29T06:00:00+00:00")
    write_envelope(root, "world_bank", "ng_gdp", [{}, [{"indicator": {"id": "G"}, "country": {"id": "NG"}, "date": "x", "value": 1}]],
                   "2026-09-29T06:00:00+00:00")
    refresh(spark, root, out, as_of=AS_OF, run_id="a", incremental=True)
    _fx(root, "Wed, 30 Sep 2026", 1515.0, "2026-09-30T06:00:00+00:00")
    refresh(spark, root, out, as_of=AS_OF, run_id="b", incremental=True)
    refresh(spark, root, out, as_of=AS_OF, run_id="c")
    bad = spark.read.parquet(Paths(out).quarantine)
    assert sorted((r.source_id, r.rule_violated) for r in bad.collect()) == [
        ("fx_rates", "unparsable_date"), ("gdelt_news", "unparsable_time"), ("open_meteo_weather", "unequal_arrays"), ("world_bank", "unparsable_year"),
    ]
    log = spark.read.parquet(Paths(out).log)
    assert log.where("run_id = 'b' AND source_id = 'stage:facts'").first().rows_loaded == 1  # one month of one fact, no full rebuild
    assert log.where("run_id = 'a' AND source_id = 'stage:facts'").first().rows_quarantined == 4
