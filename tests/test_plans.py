"""Plan-shape checks: the scale rules of the library, asserted on the plans
Spark actually builds (not only on results).

* no registered query forms pairs (cartesian / nested-loop join) or runs
  Python per row; every window is partitioned (no single-task global window);
  a row limit appears only where it is the feature (the top-50 log tail);
* keyed "newest wins" operators aggregate map-side instead of windowing;
* predicates and column pruning reach the parquet scan;
* every envelope and every payload is parsed once per row, even though
  later filters read its fields;
* a broadcast hint is placed only when the size check passes;
* results stay exact when one key holds a large share of the rows.
"""

import contextlib
import io
import json
import os
import re

import pandas as pd
import pytest

import __spark_entry__ as E
from citymarts.plans.driver_queries import QUERIES
from citymarts.operators.delivery import flag_first_delivery
from citymarts.operators.joins import bounded_broadcast
from citymarts.operators.latest import dedupe_first, latest_by_key
from citymarts.plans import analogues as A
from citymarts.plans import facts as FB
from citymarts.sources.envelopes import scan_envelopes
from citymarts.sources.tables import load
from tests import test_pipeline as P

SF = "/root/testdata/sf0.001"

PAIRS_OR_PYTHON = {
    "CartesianProductExec",
    "BroadcastNestedLoopJoinExec",
    "BatchEvalPythonExec",
    "ArrowEvalPythonExec",
    "FlatMapGroupsInPandasExec",
    "MapInPandasExec",
}
# Queries where a row limit is the feature itself (S22: the 50 newest log rows).
LIMIT_IS_FEATURE = {"log_tail_50"}


def _logical(df):
    return json.loads(df._jdf.queryExecution().optimizedPlan().toJSON())


def _physical(df):
    plan = df._jdf.queryExecution().executedPlan()
    if plan.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
        plan = plan.inputPlan()
    return json.loads(plan.toJSON())


def _classes(nodes):
    return {n["class"].rsplit(".", 1)[-1] for n in nodes}


def _formatted(df):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_registered_plan_has_no_pairs_python_or_global_window(spark, name):
    df = E.queries()[name](spark, SF)
    logical, physical = _logical(df), _physical(df)
    assert not (_classes(physical) & PAIRS_OR_PYTHON)
    for node in logical:
        if node["class"].endswith(".Window"):
            assert node["partitionSpec"], "a window without PARTITION BY runs in one task"
    if name not in LIMIT_IS_FEATURE:
        assert not ({"GlobalLimit", "LocalLimit", "Sample", "Tail"} & _classes(logical))


@pytest.mark.parametrize("name", ["latest_by_key", "latest_snapshot", "last_non_null", "dedupe_first", "same_day_duplicate_flag"])
def test_keyed_operators_combine_map_side_without_windows(spark, name):
    df = E.queries()[name](spark, SF)
    assert "Window" not in _classes(_logical(df))
    text = _formatted(df)
    assert "partial_" in text  # the aggregate is split into a map-side and a final part


def test_event_type_predicate_and_pruning_reach_the_scan(spark):
    air = A.air_quality_fact(A.events(spark, SF))
    text = _formatted(air)
    assert "EqualTo(event_type,purchase)" in text
    keyed = E.queries()["latest_by_key"](spark, SF)
    scan = [line for line in _formatted(keyed).splitlines() if line.startswith("ReadSchema")]
    assert scan and all("props" not in line for line in scan)



def test_fact_builders_parse_each_payload_once(spark, workdir):
    """Filters on parsed fields must not be pushed below the parse (which
    would repeat it once per referenced field): one envelope parse plus one
    payload parse per builder."""
    root = os.path.join(workdir, "raw")
    for write in (P._weather, P._air, P._fx, P._news, P._world_bank, P._osm):
        write(root)
    raw = scan_envelopes(spark, root)
    assert len(re.findall(r"parseJson\(", _formatted(raw).split("\n\n", 1)[1])) == 1
    for name, df in FB.all_facts(raw).items():
        body = _formatted(df).split("\n\n", 1)[1]
        variant_parses = len(re.findall(r"parseJson\(", body))
        text_parses = len(re.findall(r"from_json\(", body))
        assert variant_parses + text_parses <= 2, name

def test_broadcast_hint_only_behind_the_size_check(spark):
    prev = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        c = load(spark, SF, "customer").select("c_custkey", "c_nationkey")
        n = load(spark, SF, "nation").select("n_nationkey", "n_name")

        def joined(max_rows):
            return c.join(bounded_broadcast(n, max_rows), c["c_nationkey"] == n["n_nationkey"])

        assert "BroadcastHashJoinExec" in _classes(_physical(joined(100)))
        over = _classes(_physical(joined(5)))  # nation has 25 rows: no hint
        assert "BroadcastHashJoinExec" not in over and "SortMergeJoinExec" in over
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", prev)


# ----------------------------------------------------------- skewed keys


@pytest.fixture(scope="module")
def skewed(spark):
    """3,000 deliveries; key (1, 'a') holds 40% of them; versions collide."""
    rows = []
    for i in range(3000):
        if i % 5 < 2:
            key = (1, "a")
        else:
            key = (i % 37, "b" if i % 3 else "c")
        rows.append((key[0], key[1], i % 97, i, float(i % 13) if i % 11 else None))
    pdf = pd.DataFrame(rows, columns=["scope", "source", "version", "event_id", "value"])
    return pdf, spark.createDataFrame(pdf).repartition(6)


def _sorted(df, by):
    return df.sort_values(by).reset_index(drop=True)


def test_latest_by_key_exact_under_skew(skewed):
    pdf, sdf = skewed
    got = latest_by_key(sdf, ["scope", "source"], "version", "event_id").toPandas()
    want = (
        pdf.sort_values(["version", "event_id"])
        .groupby(["scope", "source"], as_index=False)
        .tail(1)[["scope", "source", "version", "event_id", "value"]]
    )
    g, w = _sorted(got, ["scope", "source"]), _sorted(want, ["scope", "source"])
    assert g[["scope", "source", "version", "event_id"]].equals(w[["scope", "source", "version", "event_id"]])
    assert g["value"].fillna(-1).tolist() == w["value"].fillna(-1).tolist()


def test_dedupe_first_exact_under_skew(skewed):
    pdf, sdf = skewed
    got = dedupe_first(sdf, ["scope", "source"], [("version", False), ("event_id", True)]).toPandas()
    want = (
        pdf.sort_values(["version", "event_id"], ascending=[False, True])
        .drop_duplicates(["scope", "source"], keep="first")
    )
    cols = ["scope", "source", "version", "event_id"]
    assert _sorted(got[cols], ["scope", "source"]).equals(_sorted(want[cols], ["scope", "source"]))


def test_first_delivery_flag_exact_under_skew(skewed):
    pdf, sdf = skewed
    got = flag_first_delivery(sdf, ["scope", "source"], ["version", "event_id"]).select("event_id", "created")
    got = got.toPandas().set_index("event_id")["created"].sort_index()
    first = pdf.sort_values(["version", "event_id"]).drop_duplicates(["scope", "source"])["event_id"]
    want = pdf["event_id"].isin(set(first)).set_axis(pdf["event_id"]).sort_index()
    assert got.tolist() == want.tolist()
    assert int(got.sum()) == pdf.groupby(["scope", "source"]).ngroups


def _aggregate_shuffle_records(df):
    """Records written by the shuffles that feed a final aggregate (run first)."""
    out = []

    def walk(node):
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            return walk(node.executedPlan())
        if name.endswith("QueryStageExec"):
            walk(node.plan())
        if name == "ShuffleExchangeExec" and "Aggregate" in node.child().getClass().getSimpleName():
            out.append(node.metrics().apply("shuffleRecordsWritten").value())
        children = node.children()
        for i in range(children.size()):
            walk(children.apply(i))

    walk(df._jdf.queryExecution().executedPlan())
    return out


def test_hot_key_is_combined_before_the_shuffle(skewed):
    """The partial aggregate ships at most one row per key per input task, so
    the hot key (1,200 rows) crosses the shuffle as at most 6 rows."""
    pdf, sdf = skewed
    picked = latest_by_key(sdf, ["scope", "source"], "version", "event_id")
    assert picked.where("scope = 1 AND source = 'a'").count() == 1
    picked.collect()
    records = _aggregate_shuffle_records(picked)
    groups = pdf.groupby(["scope", "source"]).ngroups
    assert records and sum(records) <= sdf.rdd.getNumPartitions() * groups < len(pdf)
