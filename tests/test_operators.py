"""Operators against brute-force pandas references on small fixtures."""

import datetime as dt
import math
import os
import random

import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from citymarts.operators import (
    MinRows,
    Rule,
    dedupe_first,
    delivery_outcomes,
    flag_first_delivery,
    kpi_missing,
    last_non_null,
    latest_by_key,
    latest_snapshot,
    load_new,
    poi_counts,
    radius_catchment,
    run_gates,
    split_quarantine,
    standings,
    wide_to_long,
)
from citymarts.operators.geo import haversine_m

rows_strategy = st.lists(
    st.tuples(
        st.integers(0, 3),  # key
        st.integers(0, 5),  # version
        st.integers(0, 10_000),  # unique-ish tiebreak (made unique below)
        st.one_of(st.none(), st.floats(-100, 100, allow_nan=False)),
    ),
    min_size=1,
    max_size=40,
)


def _unique_tiebreak(rows):
    return [(k, v, i, x) for i, (k, v, _, x) in enumerate(rows)]


@settings(max_examples=15, deadline=None)
@given(rows_strategy)
def test_latest_by_key_matches_bruteforce_and_is_order_free(spark, rows):
    rows = _unique_tiebreak(rows)
    schema = "k int, ver int, tb int, x double"
    got = sorted(map(tuple, latest_by_key(spark.createDataFrame(rows, schema), "k", "ver", "tb").collect()))
    shuffled = rows[:]
    random.Random(7).shuffle(shuffled)
    got2 = sorted(map(tuple, latest_by_key(spark.createDataFrame(shuffled, schema), "k", "ver", "tb").collect()))
    pdf = pd.DataFrame(rows, columns=["k", "ver", "tb", "x"]).sort_values(["k", "ver", "tb"])
    want = sorted(
        (int(r.k), int(r.ver), int(r.tb), None if pd.isna(r.x) else float(r.x))
        for r in pdf.groupby("k").tail(1).itertuples()
    )
    assert got == want == got2


@settings(max_examples=15, deadline=None)
@given(rows_strategy)
def test_dedupe_first_matches_pandas_drop_duplicates(spark, rows):
    rows = [(k, v, i, 0.0 if x is None else x) for i, (k, v, _, x) in enumerate(rows)]
    df = spark.createDataFrame(rows, "k int, ver int, tb int, x double")
    got = sorted(map(tuple, dedupe_first(df, ["k"], [("x", False), ("tb", True)]).collect()))
    pdf = pd.DataFrame(rows, columns=["k", "ver", "tb", "x"]).sort_values(["x", "tb"], ascending=[False, True])
    want = sorted(tuple(r) for r in pdf.drop_duplicates(["k"]).itertuples(index=False))
    assert got == [tuple(x) for x in want]


def test_last_non_null_takes_columns_from_different_rows(spark):
    df = spark.createDataFrame(
        [("usd", 1, 10.0, 1.5), ("usd", 2, 11.0, None), ("usd", 3, None, None), ("eur", 1, None, None)],
        "c string, d int, rate double, pct double",
    )
    got = {r.c: r for r in last_non_null(df, "c", "d", ["rate", "pct"], order_alias="latest").collect()}
    assert (got["usd"].rate, got["usd"].pct, got["usd"].latest) == (11.0, 1.5, 3)
    assert (got["eur"].rate, got["eur"].pct, got["eur"].latest) == (None, None, 1)


def test_latest_snapshot(spark):
    df = spark.createDataFrame([("a", 1, 5), ("a", 3, 7), ("a", 2, 9)], "c string, d int, n int")
    assert latest_snapshot(df, "c", "d", ["n"]).first().n == 7


def test_flag_first_delivery_and_outcomes(spark):
    df = spark.createDataFrame(
        [("s", "x", "h1", 1), ("s", "x", "h1", 2), ("s", "x", "h2", 3), ("s", "y", "h1", 4), (None, "z", "h", 5)],
        "src string, scope string, h string, t int",
    )
    flagged = flag_first_delivery(df, ["src", "scope", "h"], ["t"])
    assert sorted((r.t, r.created) for r in flagged.collect()) == [(1, True), (2, False), (3, True), (4, True), (5, True)]
    dup = spark.createDataFrame([("s", "x", False), ("s", "x", False)], "src string, scope string, created boolean")
    out = delivery_outcomes(dup, ["src", "scope"]).first()
    assert (out.rows_received, out.rows_loaded, out.status) == (2, 0, "duplicate")


def test_load_new_is_idempotent(spark):
    target = spark.createDataFrame([("a", "c1")], "scope string, checksum string")
    inc = spark.createDataFrame([("a", "c1", 1), ("a", "c2", 2), ("a", "c2", 3), ("b", "c1", 4)], "scope string, checksum string, t int")
    new, counts = load_new(inc, target, ["scope", "checksum"], [("t", True)])
    assert sorted((r.scope, r.checksum, r.t) for r in new.collect()) == [("a", "c2", 2), ("b", "c1", 4)]
    c = counts.first()
    assert (c.received, c.inserted, c.skipped) == (4, 2, 2)


def test_wide_to_long_drops_nulls(spark):
    df = spark.createDataFrame([(1, 2.0, None)], "id int, a double, b double")
    assert [tuple(r) for r in wide_to_long(df, ["id"], {"A": "a", "B": "b"}).collect()] == [(1, "A", 2.0)]


def test_poi_counts_tag_rules(spark):
    payload = (
        '{"elements": [{"tags": {"highway": "bus_stop", "amenity": "fuel"}}, {"tags": {"amenity": "bank"}},'
        ' {"tags": {"amenity": "marketplace"}}, {"tags": {"amenity": "bus_station"}}, {}, {"tags": {"shop": "x"}}]}'
    )
    r = poi_counts(spark.createDataFrame([(payload,), ('{"elements": []}',), ("{}",)], "p string"), "p").collect()
    assert (r[0].bus_stops, r[0].transit_stations, r[0].fuel_stations_total, r[0].commercial_banks,
            r[0].commercial_marketplaces, r[0].transit_nodes_total, r[0].commercial_nodes_total) == (1, 1, 1, 1, 1, 2, 2)
    assert r[1].transit_nodes_total == 0 and r[2].commercial_nodes_total == 0


def _hav(lat1, lon1, lat2, lon2):
    p1, p2 = math.radians(lat1), math.radians(lat2)
    a = math.sin(math.radians(lat2 - lat1) / 2) ** 2 + math.cos(p1) * math.cos(p2) * math.sin(math.radians(lon2 - lon1) / 2) ** 2
    return 2 * 6371000.0 * math.asin(math.sqrt(a))


@pytest.mark.parametrize("radius", [15_000.0, 100_000.0, 400_000.0])
def test_radius_catchment_matches_bruteforce(spark, radius):
    rng = random.Random(3)
    pts = [(i, rng.uniform(-2, 14), rng.uniform(-5, 12)) for i in range(1500)] + [(9999, 70.0, 10.0), (9998, 70.0, 25.0)]
    centres = [("a", 6.5244, 3.3792), ("b", 9.0765, 7.3986), ("c", 5.6037, -0.1870), ("polar", 70.0, 20.0)]
    p = spark.createDataFrame(pts, "pid int, lat double, lon double")
    c = spark.createDataFrame(centres, "city_id string, latitude double, longitude double")
    got = sorted((r.city_id, r.pid) for r in radius_catchment(p, c, radius).collect())
    want = sorted((cid, pid) for pid, la, lo in pts for cid, cla, clo in centres if _hav(la, lo, cla, clo) <= radius)
    assert got == want



@pytest.mark.parametrize("radius", [15_000.0, 100_000.0, 600_000.0])
def test_radius_catchment_across_the_antimeridian_and_poles(spark, radius):
    """Boxes that cross longitude +-180 (and near-pole boxes spanning all
    longitudes) still find every point, each pair exactly once."""
    rng = random.Random(5)
    pts = [(i, rng.uniform(-8, 8), rng.choice([-1, 1]) * rng.uniform(172, 180)) for i in range(1200)]
    pts += [(5000 + i, rng.uniform(84, 90), rng.uniform(-180, 180)) for i in range(300)]
    centres = [("east", 0.5, 179.95), ("west", -1.0, -179.9), ("date", 3.0, 180.0), ("pole", 88.5, -170.0)]
    p = spark.createDataFrame(pts, "pid int, lat double, lon double")
    c = spark.createDataFrame(centres, "city_id string, latitude double, longitude double")
    got = sorted((r.city_id, r.pid) for r in radius_catchment(p, c, radius).collect())
    want = sorted((cid, pid) for pid, la, lo in pts for cid, cla, clo in centres if _hav(la, lo, cla, clo) <= radius)
    assert got == want

def test_haversine_expression(spark):
    df = spark.createDataFrame([(6.5244, 3.3792, 5.6037, -0.1870)], "a double, b double, c double, d double")
    got = df.select(haversine_m(F.col("a"), F.col("b"), F.col("c"), F.col("d")).alias("x")).first().x
    assert got == pytest.approx(_hav(6.5244, 3.3792, 5.6037, -0.1870))


def test_gates_and_quarantine_split(spark):
    df = spark.createDataFrame([(1, 20.0), (2, 70.0), (3, None), (4, -20.0)], "id int, t double")
    rules = [Rule("temperature_range", (F.col("t") < -10) | (F.col("t") > 60))]
    rep = {r.rule: r for r in run_gates(df, [MinRows("min_rows", 5), *rules], "w").collect()}
    assert (rep["min_rows"].violations, rep["min_rows"].passed) == (1, False)
    assert (rep["temperature_range"].checked, rep["temperature_range"].violations) == (4, 2)
    valid, bad = split_quarantine(df, rules, "weather", checksum_col=None)
    assert valid.count() + bad.count() == df.count() == 4
    assert sorted(r.raw_record for r in bad.collect()) == ['{"id":2,"t":70.0}', '{"id":4,"t":-20.0}']


def test_kpi_missing(spark):
    df = spark.createDataFrame([("a", None, "1.0"), ("b", "NaN", "--"), ("c", "none", "ok")], "id string, x string, y string")
    got = sorted((r.id, r.kpi, r.problem) for r in kpi_missing(df, ["id"], ["x", "y"]).collect())
    assert got == [("a", "x", "empty"), ("b", "x", "placeholder"), ("b", "y", "placeholder"), ("c", "x", "placeholder")]


def test_standings_latest_date_only(spark):
    df = spark.createDataFrame(
        [("a", dt.date(2024, 1, 1), 90.0), ("a", dt.date(2024, 1, 2), 50.0), ("b", dt.date(2024, 1, 2), 60.0)],
        "city string, date date, score double",
    )
    got = [(r.rank, r.city) for r in standings(df, "date", "score", "city").orderBy("rank").collect()]
    assert got == [(1, "b"), (2, "a")]


def test_dedupe_first_puts_nulls_last_either_way(spark):
    from citymarts.operators.latest import dedupe_first

    rows = [("a", None, "x"), ("a", 30.0, "y"), ("a", 10.0, "z"), ("b", None, "w")]
    df = spark.createDataFrame(rows, "k string, v double, t string")
    down = {r.k: r.v for r in dedupe_first(df, "k", [("v", False)]).collect()}
    up = {r.k: r.v for r in dedupe_first(df, "k", [("v", True)]).collect()}
    assert down == {"a": 30.0, "b": None} and up == {"a": 10.0, "b": None}
    assert {r.k: r.t for r in dedupe_first(df, "k", [("t", False)]).collect()} == {"a": "z", "b": "w"}
    big = spark.createDataFrame([("a", -(2**63), 1), ("a", 5, 2)], "k string, v long, n int")
    assert dedupe_first(big, "k", [("v", False), ("n", True)]).first().v == 5


def test_kpi_audit_reports_infinity(spark):
    from citymarts.operators.quality import kpi_missing

    df = spark.createDataFrame([(1, float("inf")), (2, float("-inf")), (3, float("nan")), (4, 1.0), (5, None)], "id int, v double")
    got = {r.id: r.problem for r in kpi_missing(df, ["id"], ["v"]).collect()}
    assert got == {1: "placeholder", 2: "placeholder", 3: "placeholder", 5: "empty"}


@pytest.mark.parametrize("bound", [0, 3, 1000])
def test_newest_copies_equal_latest_by_key(spark, bound):
    from citymarts.operators.latest import latest_by_key, newest_copies

    rows = [("a", 1, 5, "p"), ("a", 1, 7, "q"), ("a", 1, 7, None), ("b", 1, 2, "x"), (None, 1, 3, "n"), (None, 1, 4, None), ("c", None, 9, "y"), ("d", 1, None, "gone")]
    rows += [("same", 2, 1, "twice")] * 2 + [(f"k{i}", i, i, "wide" * 50) for i in range(40)]
    df = spark.createDataFrame([(*r, i if r[0] != "same" else -1) for i, r in enumerate(rows)], "k string, j int, v int, payload string, n int")
    got = newest_copies(df, ["k", "j"], "v", "n", max_broadcast_rows=bound)
    want = latest_by_key(df, ["k", "j"], "v", "n")
    assert got.columns == want.columns
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)


def test_payload_of_single_copies_is_not_shuffled(spark, workdir):
    from citymarts.operators.latest import newest_copies

    path = os.path.join(workdir, "wide")
    spark.range(500).selectExpr("id AS k", "id AS v", "repeat('x', 100) AS payload").write.parquet(path)
    df = spark.read.parquet(path)
    plan = newest_copies(df, "k", "v")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    two = df.unionByName(df.where("k < 3").selectExpr("k", "v + 1 AS v", "payload"))
    plan = newest_copies(two, "k", "v")._jdf.queryExecution().toString()
    assert "BroadcastHashJoin" in plan and "LeftAnti" in plan
    assert newest_copies(two, "k", "v").agg(F.sum("v")).first()[0] == sum(range(500)) + 3
