"""Golden tests: evidence files -> raw -> facts -> marts (+ refresh chain)."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from citymarts.plans import facts as FB
from citymarts.plans import marts as M
from citymarts.plans.refresh import Paths, refresh
from citymarts.sources.dims import dim_city_seed
from citymarts.sources.envelopes import envelope_rejects, scan_envelopes
from tests.envelopes import hourly, write_envelope, write_raw_text

T0 = "2026-09-23T06:00:00.123456+00:00"
T1 = "2026-09-24T06:00:00+00:00"


def _weather(root):
    # first delivery: two hours; second (newer) delivery revises 01:00 to NULL
    write_envelope(root, "open_meteo_weather", "ng_lagos",
                   hourly(["2026-09-23T00:00", "2026-09-23T01:00"], temperature_2m=[27.5, 28.0],
                          precipitation=[1.0, 4.0], relative_humidity_2m=[80, 82], wind_speed_10m=[5, 6]), T0)
    write_envelope(root, "open_meteo_weather", "ng_lagos",
                   hourly(["2026-09-23T01:00", "2026-09-23T02:00"], temperature_2m=[None, 30.0],
                          precipitation=[0.5, 0.5], relative_humidity_2m=[70, 71], wind_speed_10m=[1, 2]), T1)
    # same payload as another scope: must stay two rows
    write_envelope(root, "open_meteo_weather", "gh_accra",
                   hourly(["2026-09-23T00:00", "2026-09-23T01:00"], temperature_2m=[27.5, 28.0],
                          precipitation=[1.0, 4.0], relative_humidity_2m=[80, 82], wind_speed_10m=[5, 6]), T0)
    # unequal arrays -> quarantine, no rows
    write_envelope(root, "open_meteo_weather", "ng_abuja",
                   hourly(["2026-09-23T00:00", "2026-09-23T01:00"], temperature_2m=[20.0],
                          precipitation=[0.0, 0.0], relative_humidity_2m=[1, 2], wind_speed_10m=[1, 2]), T0)
    # no hourly object -> no rows, not an error
    write_envelope(root, "open_meteo_weather", "ng_port_harcourt", {"error": True}, T0)


def _air(root):
    write_envelope(root, "open_meteo_air_quality", "ng_lagos",
                   hourly(["2026-09-23T00:00", "2026-09-23T01:00", "2026-09-23T02:00", "2026-09-23T03:00"],
                          pm2_5=[35.4, 35.3, None, 50.0], pm10=[1, 2, 3, 4], nitrogen_dioxide=[1, 1, 1, 1],
                          ozone=[0, 0, 0, 0]), T0)


def _fx(root):
    write_envelope(root, "fx_rates", "global", {"result": "success", "time_last_update_utc": "Mon, 21 Sep 2026 00:02:31 +0000",
                                                 "rates": {"NGN": 1500.0, "GHS": 0.0}}, "2026-09-21T06:00:00+00:00")
    write_envelope(root, "fx_rates", "global", {"result": "success", "time_last_update_utc": "Tue, 22 Sep 2026 00:02:31 +0000",
                                                 "rates": {"NGN": 1530.0, "GHS": 12.0}}, "2026-09-22T06:00:00+00:00")
    write_envelope(root, "fx_rates", "global", {"result": "success", "time_last_update_utc": "Wed, 23 Sep 2026 00:02:31 +0000",
                                                 "rates": {"NGN": 1500.0}}, "2026-09-23T06:00:00+00:00")
    write_envelope(root, "fx_rates", "global", {"result": "error", "time_last_update_utc": "Thu, 24 Sep 2026 00:02:31 +0000",
                                                 "rates": {"NGN": 1.0}}, "2026-09-24T06:00:00+00:00")


def _news(root):
    write_envelope(root, "gdelt_news", "ng_lagos",
                   {"timeline": [{"series": "x", "data": [{"date": "20260923T001500Z", "value": 0.2},
                                                           {"date": "20260923T003000Z", "value": 0.4}]}]}, T0)


def _world_bank(root):
    write_envelope(root, "world_bank", "ng_gdp",
                   [{"page": 1}, [{"indicator": {"id": "NY.GDP"}, "country": {"id": "NG"}, "date": "2024", "value": 1.5},
                                  {"indicator": {"id": "NY.GDP"}, "country": {"id": "NG"}, "date": "2023", "value": None}]],
                   T0)


def _osm(root):
    counts = {"bus_stops": 120, "transit_stations": 30, "transit_nodes_total": 150, "fuel_stations_total": 40,
              "commercial_banks": 10, "commercial_marketplaces": 5, "commercial_nodes_total": 15}
    write_envelope(root, "osm_infrastructure", "ng_lagos", counts, "2026-09-20T06:00:00+00:00")
    newer = dict(counts, transit_nodes_total=2000, bus_stops=1900)
    write_envelope(root, "osm_infrastructure", "ng_lagos", newer, "2026-09-22T06:00:00+00:00")


@pytest.fixture
def evidence(workdir):
    root = os.path.join(workdir, "raw")
    _weather(root)
    _air(root)
    _fx(root)
    _news(root)
    _world_bank(root)
    _osm(root)
    write_raw_text(root, "gdelt_news", "ng_lagos", "000000_broken.json", "{not json")
    write_raw_text(root, "gdelt_news", "ng_lagos", "000001_dupkeys.json",
                   '{"checksum": "a", "checksum": "b", "city_id": "x", "ingested_at_utc": "%s", "payload": {}}' % T0)
    return root


def test_scan_envelopes_and_rejects(spark, evidence):
    raw = scan_envelopes(spark, evidence)
    assert raw.count() == 14
    assert raw.where(F.col("ingested_at") == dt.datetime(2026, 9, 23, 6, 0, 0)).count() > 0  # sub-second dropped
    rej = envelope_rejects(spark, evidence, "2026-09-25 00:00:00").collect()
    assert sorted(r.rule_violated for r in rej) == ["invalid_json", "invalid_json"]


def test_missing_root_gives_no_rows(spark, workdir):
    assert scan_envelopes(spark, os.path.join(workdir, "nope")).count() == 0


def test_weather_newest_delivery_wins_and_keeps_null(spark, evidence):
    raw = scan_envelopes(spark, evidence)
    w = {(r.city_id, r.observed_at.hour): r for r in FB.weather_hourly(raw).collect()}
    assert set(w) == {("ng_lagos", 0), ("ng_lagos", 1), ("ng_lagos", 2), ("gh_accra", 0), ("gh_accra", 1)}
    assert w[("ng_lagos", 1)].temperature_c is None  # NULL over non-NULL
    assert w[("ng_lagos", 0)].temperature_c == pytest.approx(27.5)
    rej = FB.hourly_rejects(raw, "open_meteo_weather", FB.WEATHER_FIELDS).collect()
    # unequal arrays, and a payload without the arrays (an error answer)
    assert sorted((r.scope_id, r.rule) for r in rej) == [("ng_abuja", "unequal_arrays"), ("ng_port_harcourt", "unequal_arrays")]


def test_reingestion_is_idempotent(spark, evidence, workdir):
    raw = scan_envelopes(spark, evidence)
    doubled = raw.unionByName(raw)
    a = sorted(map(tuple, FB.weather_hourly(raw).collect()))
    b = sorted(map(tuple, FB.weather_hourly(doubled).collect()))
    assert a == b


def test_fx_fact_rules(spark, evidence):
    fx = FB.fx_daily(scan_envelopes(spark, evidence))
    got = sorted((r.currency, str(r.rate_date), r.units_per_usd) for r in fx.collect())
    # error response dropped; missing GHS on 23rd dropped; GHS 0.0 kept (gate catches it)
    assert got == [("GHS", "2026-09-21", 0.0), ("GHS", "2026-09-22", 12.0),
                   ("NGN", "2026-09-21", 1500.0), ("NGN", "2026-09-22", 1530.0), ("NGN", "2026-09-23", 1500.0)]
    mart = M.fx_daily(fx, dim_city_seed(spark))
    rows = {(r.city_id, str(r.date)): r for r in mart.collect()}
    assert len(rows) == 3 * 3 + 1 * 2  # 3 NGN cities x 3 days + Accra x 2 days
    first = rows[("ng_lagos", "2026-09-21")]
    assert first.prev_day_units_per_usd is None and first.day_pct_change is None
    assert rows[("ng_lagos", "2026-09-22")].day_pct_change == 2.0
    assert rows[("gh_accra", "2026-09-22")].day_pct_change is None  # prev = 0


def test_news_indicator_osm_facts(spark, evidence):
    raw = scan_envelopes(spark, evidence)
    news = FB.news_intensity(raw).collect()
    assert sorted((r.observed_at.minute, round(r.mention_intensity, 3)) for r in news) == [(15, 0.2), (30, 0.4)]
    ind = FB.economic_indicator(raw).collect()
    assert [(r.country_code, r.indicator, r.year, r.value) for r in ind] == [("ng", "NY.GDP", 2024, 1.5)]
    osm = FB.osm_infrastructure(raw)
    assert osm.count() == 2
    latest = M.latest_infrastructure(osm).first()
    assert latest.transit_nodes_total == 2000


def test_environment_mart(spark, evidence):
    raw = scan_envelopes(spark, evidence)
    env = M.environment_daily(FB.weather_hourly(raw), FB.air_quality_hourly(raw))
    rows = {r.city_id: r for r in env.collect()}
    lagos, accra = rows["ng_lagos"], rows["gh_accra"]
    assert lagos.weather_samples == 3 and lagos.avg_temp_c == pytest.approx(28.75)
    # 35.4 as Float32 is 35.4000015 -> counted; 35.3 not; NULL not but missing
    assert lagos.hours_pm25_unhealthy == 2
    assert lagos.aq_missingness_ratio == 0.25 and lagos.aq_samples == 4
    assert accra.aq_missingness_ratio == 1.0 and accra.hours_pm25_unhealthy == 0 and accra.aq_samples == 0
    assert accra.avg_pm2_5 is None


def test_composite_defaults_and_clamps(spark):
    from citymarts.operators.scoring import composite

    base = spark.createDataFrame([("a", 1, 60.0), ("b", 1, -5.0)], "city_id string, date int, score_environment double")
    econ = spark.createDataFrame([("b", 1, 100.0)], "city_id string, date int, score_economic double")
    empty = lambda name: spark.createDataFrame([], f"city_id string, date int, {name} double")
    out = composite(base, {"score_economic": econ, "score_mobility": empty("score_mobility"),
                           "score_vibrancy": empty("score_vibrancy")}, M.WEIGHTS, M.DEFAULTS,
                    ["city_id", "date"], "score_environment", "score")
    got = {r.city_id: r.score for r in out.collect()}
    assert got["a"] == pytest.approx(0.30 * 60 + 0.25 * 80 + 0.25 * 50 + 0.20 * 50)
    assert got["b"] == pytest.approx(0.30 * -5 + 0.25 * 100 + 0.25 * 50 + 0.20 * 50)


def test_scores(spark):
    env = spark.createDataFrame([("a", 1, 150.0), ("b", 1, None)], "city_id string, date int, avg_pm2_5 double")
    assert sorted(r.score_environment for r in M.environment_scores(env).collect()) == [0.0, 75.0]
    fx = spark.createDataFrame([("a", 1, 1.0, 20.0), ("b", 1, 1.0, -20.0)],
                               "city_id string, date int, units_per_usd double, day_pct_change double")
    assert [r.score_economic for r in M.economic_scores(fx).collect()] == [0.0, 0.0]
    mob = spark.createDataFrame([("a", 1, 2000)], "city_id string, date int, transit_nodes_total long")
    assert M.mobility_scores(mob).first().score_mobility == 100.0


def test_refresh_chain_end_to_end(spark, evidence, workdir):
    out = os.path.join(workdir, "warehouse")
    code = refresh(spark, evidence, out, as_of="2026-09-25 00:00:00", run_id="r1")
    paths = Paths(out)
    ci = spark.read.parquet(paths.mart("mart_city_intelligence_daily"))
    first = sorted(map(tuple, ci.drop("ym").collect()))
    assert len(first) > 0
    # the GHS 0.0 rate fails the positive-rate gate -> exit code 2
    assert code == 2
    gates = spark.read.parquet(paths.gates).where("run_id = 'r1' AND NOT passed").collect()
    assert {g.rule for g in gates} >= {"rate_positive"}
    # second run over the same evidence: nothing new, identical marts
    code2 = refresh(spark, evidence, out, as_of="2026-09-25 00:00:00", run_id="r2")
    assert code2 == 2
    raw = spark.read.parquet(paths.raw)
    assert raw.count() == 14
    again = sorted(map(tuple, spark.read.parquet(paths.mart("mart_city_intelligence_daily")).drop("ym").collect()))
    assert again == first
    log = spark.read.parquet(paths.log)
    dup = log.where("run_id = 'r2' AND source_id = 'open_meteo_weather'").collect()
    assert dup and all(r.status == "duplicate" and r.rows_loaded == 0 for r in dup)
    stages = log.where("source_id LIKE 'stage:%' AND run_id = 'r1'").collect()
    assert {s.source_id for s in stages} == {"stage:raw_sync", "stage:facts", "stage:marts"}


def test_fx_cross_check(spark, workdir):
    root = os.path.join(workdir, "raw")
    write_envelope(root, "fx_rates", "global", {"result": "success", "time_last_update_utc": "Tue, 22 Sep 2026 00:02:31 +0000",
                                                 "rates": {"GHS": 12.0}}, "2026-09-22T06:00:00+00:00")
    write_envelope(root, "fx_frankfurter", "global", {"base": "EUR", "date": "2026-09-22", "rates": {"USD": 1.2, "GHS": 15.0}},
                   "2026-09-22T06:00:00+00:00")
    raw = scan_envelopes(spark, root)
    r = FB.fx_cross_check(raw, FB.fx_daily(raw)).first()
    assert (r.currency, r.units_per_usd, r.cross_units_per_usd) == ("GHS", 12.0, pytest.approx(12.5))
    assert r.deviation_pct == pytest.approx(4.1667)


def test_fx_cross_check_newest_delivery_wins(spark, workdir):
    root = os.path.join(workdir, "raw")
    write_envelope(root, "fx_rates", "global", {"result": "success", "time_last_update_utc": "Tue, 22 Sep 2026 00:02:31 +0000",
                                                 "rates": {"GHS": 12.0}}, "2026-09-22T06:00:00+00:00")
    write_envelope(root, "fx_frankfurter", "global", {"base": "EUR", "date": "2026-09-22", "rates": {"USD": 1.2, "GHS": 15.0}},
                   "2026-09-22T06:00:00+00:00")
    # a later delivery for the same day revises the quote downwards: it must win, not the larger rate
    write_envelope(root, "fx_frankfurter", "global", {"base": "EUR", "date": "2026-09-22", "rates": {"USD": 1.25, "GHS": 15.0}},
                   "2026-09-22T18:00:00+00:00")
    raw = scan_envelopes(spark, root)
    rows = FB.fx_cross_check(raw, FB.fx_daily(raw)).collect()
    assert len(rows) == 1 and rows[0].cross_units_per_usd == pytest.approx(12.0)
    assert rows[0].deviation_pct == 0.0


def test_refresh_with_missing_sources_fails_gates_not_stages(spark, workdir):
    root = os.path.join(workdir, "raw")
    write_envelope(root, "open_meteo_weather", "ng_lagos",
                   hourly(["2026-09-23T00:00"], temperature_2m=[27.0], precipitation=[1.0],
                          relative_humidity_2m=[80], wind_speed_10m=[3]), T0)
    out = os.path.join(workdir, "wh")
    assert refresh(spark, root, out, as_of="2026-09-24 00:00:00", run_id="m1", incremental=True) == 2
    p = Paths(out)
    failed = {(g.table, g.rule) for g in spark.read.parquet(p.gates).where("NOT passed").collect()}
    assert ("fact_fx_daily", "non_empty") in failed and ("fact_weather_hourly", "non_empty") not in failed
    assert spark.read.parquet(p.mart("mart_city_intelligence_daily")).count() == 1
