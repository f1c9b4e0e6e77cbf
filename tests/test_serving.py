"""Serving queries over a warehouse produced by the refresh chain."""

import os

import pytest

from citymarts.operators.freshness import freshness_summary, freshness_verdict
from citymarts.plans import serving as S
from citymarts.plans.refresh import Paths, refresh
from tests.test_pipeline import _air, _fx, _news, _osm, _weather, _world_bank


@pytest.fixture(scope="module")
def warehouse(spark, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("serving"))
    root = os.path.join(base, "raw")
    for write in (_weather, _air, _fx, _news, _world_bank, _osm):
        write(root)
    out = os.path.join(base, "wh")
    refresh(spark, root, out, as_of="2026-09-25 00:00:00", run_id="s1")
    p = Paths(out)
    read = lambda path: spark.read.parquet(path).drop("ym", "part")
    return {
        "ci": read(p.mart("mart_city_intelligence_daily")),
        "env": read(p.mart("mart_environment_daily")),
        "fx": read(p.mart("mart_fx_daily")),
        "mob": read(p.mart("mart_mobility_daily")),
        "dim": read(f"{p.dims}/dim_city"),
        "src": read(f"{p.dims}/dim_source"),
        "econ": read(p.fact("fact_economic_indicator")),
        "news": read(p.fact("fact_news_intensity")),
        "log": read(p.log),
    }


def test_standings_and_pillars(warehouse):
    st = S.latest_standings(warehouse["ci"]).collect()
    assert st and [r.rank for r in sorted(st, key=lambda r: r.rank)] == list(range(1, len(st) + 1))
    pil = S.pillar_breakdown(warehouse["ci"]).collect()
    assert len(pil) == 4 * len(st)
    for r in pil:
        assert r.points == pytest.approx(round(r.score * r.weight, 2), abs=0.011)


def test_mobility_views(warehouse):
    per = S.latest_mobility_per_100k(warehouse["mob"], warehouse["dim"]).collect()
    lagos = [r for r in per if r.city_id == "ng_lagos"][0]
    assert lagos.transit_nodes_total == 2000 and lagos.transit_per_100k == 12.5  # 2000 / 160
    assert S.max_transit_density(warehouse["mob"]).first().max_transit_density == pytest.approx(round(2000 / 706.86, 4))
    melt = S.mobility_metric_melt(S.latest_mobility_per_100k(warehouse["mob"], warehouse["dim"]))
    assert melt.where("city_id = 'ng_lagos'").count() == 4
    q5 = {r.city_name: r for r in S.services_per_population(warehouse["mob"], warehouse["dim"]).collect()}
    assert q5["Lagos"].transit_nodes_per_100k == 12.5


def test_fx_views(warehouse):
    latest = {r.currency: r for r in S.fx_latest_per_currency(warehouse["fx"]).collect()}
    assert latest["NGN"].units_per_usd == 1500.0 and latest["NGN"].day_pct_change == pytest.approx(-1.9608)
    assert latest["GHS"].units_per_usd == 12.0 and latest["GHS"].day_pct_change is None
    series = S.fx_change_series(warehouse["fx"]).collect()
    assert all(r.day_pct_change is not None for r in series) and len(series) == 2


def test_listings_and_views(warehouse, spark):
    assert [r.city_name for r in S.city_directory(warehouse["dim"]).collect()][0] == "Accra"
    assert S.recent_indicators(warehouse["econ"], 2022).count() == 1
    env_view = S.environment_view(warehouse["env"], warehouse["dim"])
    assert S.filter_city(env_view, "Lagos").count() == 1 and S.filter_city(env_view, "All Cities").count() == 2
    assert S.city_options(env_view).count() == 2
    assert S.source_registry(warehouse["src"]).count() == 8
    nb = S.news_buckets(warehouse["news"]).first()
    assert (nb.buckets, nb.peak) == (2, 0.4)
    tail = S.log_tail(warehouse["log"], 50).collect()
    assert 0 < len(tail) <= 50
    counts = {r.table_name: r.n for r in S.table_counts({k: warehouse[k] for k in ("ci", "env", "fx")}).collect()}
    assert counts["env"] == 2
    assert S.weather_transit(warehouse["mob"], warehouse["dim"]).count() == 2
    assert S.fx_fuel(warehouse["ci"], warehouse["fx"], warehouse["mob"]).count() >= 1
    assert S.environmental_pressure(warehouse["env"], warehouse["dim"], warehouse["ci"]).count() == 2
    assert S.vibrancy_commerce(warehouse["ci"], warehouse["mob"]).count() == 2
    assert S.preview(S.news_daily(warehouse["news"]), ["city_id", "date"], 12).count() == 1


def test_freshness_from_run_log(warehouse):
    fresh = freshness_verdict(freshness_summary(warehouse["log"], "2026-09-25 00:00:00")).first()
    assert fresh.hours_since_success == 0 and fresh.verdict == "fresh" and fresh.gate_passed


def test_freshness_cases(spark):
    schema = "started_at timestamp_ntz, status string"
    import datetime as dt

    as_of = "2024-01-03 00:00:00"
    empty = spark.createDataFrame([], schema)
    assert freshness_verdict(freshness_summary(empty, as_of)).first().verdict == "never"
    exactly36 = spark.createDataFrame([(dt.datetime(2024, 1, 1, 12, 0), "success")], schema)
    r = freshness_verdict(freshness_summary(exactly36, as_of)).first()
    assert (r.hours_since_success, r.verdict, r.gate_passed) == (36, "fresh", False)
    h37 = spark.createDataFrame([(dt.datetime(2024, 1, 1, 11, 0), "success")], schema)
    assert freshness_verdict(freshness_summary(h37, as_of)).first().verdict == "stale"
    err = spark.createDataFrame([(dt.datetime(2024, 1, 2, 23, 0), "success"), (dt.datetime(2024, 1, 2, 22, 0), "error")], schema)
    r = freshness_verdict(freshness_summary(err, as_of)).first()
    assert (r.verdict, r.errors_in_window) == ("current_with_errors", 1)
