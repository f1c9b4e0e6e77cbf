"""Every registered query against its DuckDB oracle on the smallest dataset."""

import duckdb
import pytest

import __spark_entry__ as E
from citymarts.plans.driver_queries import QUERIES
from citymarts.plans.oracle_sql import ORACLE_SQL
from citymarts.sources.tables import DRIVER_TABLES
from tools.check_oracle import _rows

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in DRIVER_TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_every_query_has_oracle_sql():
    """All of this library's own queries; the optional ones of the training-data operators are tested with those."""
    assert set(ORACLE_SQL) == set(QUERIES)
    assert set(QUERIES) <= set(E.queries()) and set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    sc, sr = _rows(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(E.oracle_sql()[name])
    dc, dr = _rows([d[0] for d in cur.description], cur.fetchall())
    assert sc == dc
    assert sr == dr


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "city_intelligence_score" in df.columns


def test_hourly_and_news_payloads_hold_arrays_tens_long(spark):
    from citymarts.plans import driver_queries as Q

    for rows in (Q.weather_deliveries, Q.air_quality_deliveries, Q.news_deliveries):
        raw = rows(spark, "/root/testdata/sf0.01")
        records = raw.selectExpr("length(payload) - length(replace(payload, '2024', '')) AS n").selectExpr("avg(n / 4) AS a").first().a
        assert records >= 10
        assert raw.select("scope_id", "checksum").distinct().count() == raw.count()
