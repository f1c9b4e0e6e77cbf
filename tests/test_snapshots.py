"""Snapshot tables, new-files scan, key index and compaction."""

import os

import pytest
from pyspark.sql import functions as F

from citymarts.operators import key_index
from citymarts.plans import refresh as chain
from citymarts.plans.refresh import FACT_SCHEMAS, LOAD, MARTS, RAW_KEYS, RAW_PARTITIONS, Paths, compact_warehouse, read_raw, refresh, sync_raw
from citymarts.schemas import RAW
from citymarts.sources import manifest
from citymarts.sources.compaction import compact, crowded
from citymarts.sources.snapshots import Conflict, Snapshot, SnapshotStore
from tests.envelopes import hourly, write_envelope, write_raw_text
from tests.test_incremental import AS_OF, _batch_a, _batch_b, _same, _snapshot

KEYED = "k int, v string"


def _rows(spark, rows):
    return spark.createDataFrame(rows, "k int, v string, p string")


def _fx_only(root, days, month="09"):
    for d in days:
        write_envelope(root, "fx_rates", "global", {"result": "success", "time_last_update_utc": f"{d:02d} Sep 2026", "rates": {"NGN": float(d)}},
                       f"2026-{month}-{d:02d}T06:00:00+00:00")


# -- the store


def test_publish_is_one_swap_of_all_tables(spark, workdir):
    store = SnapshotStore(spark, workdir)
    schema = spark.createDataFrame([], KEYED).schema
    assert store.current() == Snapshot() and store.read("t", schema).count() == 0
    one = store.stage("t", _rows(spark, [(1, "a", "x"), (2, "b", "y")]), ["p"], ["k"])
    two = store.stage("u", _rows(spark, [(3, "c", "x")]), ["p"])
    assert store.read("t", schema).count() == 0  # written, not current
    first = store.publish(Snapshot(), {"t": one, "u": two}, arrived=["l1", "l2"])
    assert sorted(map(tuple, store.read("t", schema).collect())) == [(1, "a", "x"), (2, "b", "y")]
    assert store.read("t", schema, None, "p", ["y"]).collect()[0].k == 2
    assert store.read("t", schema, None, "p", []).count() == 0
    assert first.values("t", "p") == ["x", "y"] and store.current().pending == ("l1", "l2")
    assert sorted(r.k for r in spark.read.parquet(store.path("t")).collect()) == [1, 2]

    # a partition that is no longer produced vanishes, the old snapshot still reads as it was
    again = store.stage("t", _rows(spark, [(9, "z", "y")]), ["p"])
    store.publish(first, {"t": again}, arrived=["l3"], done=["l1", "l2"])
    assert [tuple(r) for r in store.read("t", schema).collect()] == [(9, "z", "y")]
    assert store.read("t", schema, first).count() == 2 and store.current().pending == ("l3",)
    with pytest.raises(Conflict):  # made from a version that is no longer current
        store.publish(first, {"t": one})
    store.publish(first, {"w": store.stage("w", _rows(spark, []))})  # other tables may have changed
    with pytest.raises(Conflict):
        store.publish(first, {"x": []}, unchanged=["t"])


def test_two_writers_of_one_number_and_a_cut_off_file(spark, workdir):
    store, other = SnapshotStore(spark, workdir), SnapshotStore(spark, workdir)
    made = store.publish(Snapshot(), {"t": ["snap=1"]})
    assert not other._create(Snapshot(made.number, {"t": ("snap=2",)}))  # that number is taken
    path = os.path.join(workdir, "_snapshots", f"{made.number + 1:012d}.json")
    with open(path, "w") as fh:
        fh.write('{"tables": {"t"')  # a writer that died
    assert other.current().tables == {"t": ("snap=1",)}
    assert other.publish(other.current(), {"t": ["snap=3"]}).number == made.number + 2
    assert store.current().folders("t") == ["snap=3"]


def test_expire_deletes_only_what_no_kept_snapshot_holds(spark, workdir):
    store = SnapshotStore(spark, workdir)
    at, made = Snapshot(), []
    for i in range(4):
        made.append(store.stage("t", _rows(spark, [(i, "a", "x")]), ["p"]))
        at = store.publish(at, {"t": made[-1], "same": ["snap=1"]})
    unpublished = store.stage("t", _rows(spark, [(7, "a", "x")]), ["p"])
    assert sorted(store.expire(keep=2)) == sorted(f"t/{f}" for f in made[0] + made[1])
    assert len(store.numbers()) == 2 and store.current() == at
    for f in made[2] + made[3] + unpublished:
        assert os.path.isdir(os.path.join(workdir, "t", f))


# -- the chain


def test_only_new_files_are_opened(spark, workdir, monkeypatch):
    root, paths = os.path.join(workdir, "raw"), Paths(os.path.join(workdir, "out"))
    opened, real = [], manifest.open_files

    def spy(spark, files):
        opened.append(sorted(os.path.basename(f["path"]) for f in files))
        out = real(spark, files)
        assert len(out.inputFiles()) == len(files)
        return out

    monkeypatch.setattr(manifest, "open_files", spy)
    _fx_only(root, [1, 2, 3])
    bad = write_raw_text(root, "gdelt_news", "ng_lagos", "000000_bad [1].json", "{no json")
    plan = manifest.list_files(spark, root)._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan
    assert sync_raw(spark, root, paths, "a", AS_OF) == {"rows_received": 4, "rows_loaded": 3, "rows_quarantined": 1}
    _fx_only(root, [4])
    twin = _rewritten(root)
    assert sync_raw(spark, root, paths, "b", AS_OF) == {"rows_received": 6, "rows_loaded": 1, "rows_quarantined": 0}
    assert [len(x) for x in opened] == [4, 2] and os.path.basename(twin) in opened[1]
    assert sync_raw(spark, root, paths, "c", AS_OF) == {"rows_received": 6, "rows_loaded": 0, "rows_quarantined": 0}
    assert len(opened) == 2
    write_raw_text(root, "gdelt_news", "ng_lagos", os.path.basename(bad), "{still no json")  # written anew: another file
    assert sync_raw(spark, root, paths, "d", AS_OF)["rows_quarantined"] == 1
    assert read_raw(spark, paths).count() == 4 and read_raw(spark, paths).select(*RAW_KEYS).distinct().count() == 4
    log = {(r.run_id, r.source_id): r for r in spark.read.parquet(paths.log).collect()}
    first, then = log["a", "gdelt_news"], log["b", "gdelt_news"]
    assert (first.city_id, first.status, first.rows_quarantined) == ("ng_lagos", "error", 1) and "invalid_json" in first.error_message
    assert (then.status, then.rows_received, then.rows_quarantined) == ("duplicate", 1, 0)
    assert (log["b", "fx_rates"].status, log["b", "fx_rates"].rows_received, log["b", "fx_rates"].rows_loaded) == ("success", 5, 1)
    assert sorted(r.city_id for r in spark.read.parquet(paths.quarantine).collect()) == ["ng_lagos", "ng_lagos"]


def _rewritten(root):
    """The third day's delivery once more, under another name."""
    return write_envelope(root, "fx_rates", "global", {"result": "success", "time_last_update_utc": "03 Sep 2026", "rates": {"NGN": 3.0}},
                          "2026-09-05T06:00:00+00:00")


def test_many_files_are_loaded_in_parts(spark, workdir, monkeypatch):
    root, paths = os.path.join(workdir, "raw"), Paths(os.path.join(workdir, "out"))
    _fx_only(root, range(1, 6))
    _rewritten(root)
    real = manifest.in_loads
    monkeypatch.setattr(manifest, "in_loads", lambda files: real(files, 2))
    assert sync_raw(spark, root, paths, "a", AS_OF) == {"rows_received": 6, "rows_loaded": 5, "rows_quarantined": 0}
    assert len(paths.store(spark).current().pending) == len(paths.store(spark).current().values("raw", LOAD)) >= 2
    assert read_raw(spark, paths).count() == 5


def test_a_run_that_dies_leaves_the_old_version_of_everything(spark, workdir, monkeypatch):
    root, out, full = (os.path.join(workdir, n) for n in ("raw", "inc", "full"))
    _batch_a(root)
    assert refresh(spark, root, out, as_of=AS_OF, incremental=True) in (0, 2)
    before = _snapshot(spark, out)
    _batch_b(root)
    real, calls = chain.RunState.stage, []

    def dies(self, *a, **k):
        calls.append(a[0])
        if calls.count("mart_fx_daily") == 1:  # facts and one mart are written
            raise OSError("lost")
        return real(self, *a, **k)

    monkeypatch.setattr(chain.RunState, "stage", dies)
    assert refresh(spark, root, out, as_of=AS_OF, incremental=True) == 1
    assert _snapshot(spark, out) == before  # all facts and all marts, not some of them
    monkeypatch.setattr(chain.RunState, "stage", real)
    assert refresh(spark, root, out, as_of=AS_OF, incremental=True) in (0, 2)
    refresh(spark, root, full, as_of=AS_OF)
    _same(spark, out, full)
    assert paths_pending(spark, out) == ()


def paths_pending(spark, out):
    return Paths(out).store(spark).current().pending


def test_a_load_that_arrives_during_a_run_stays_pending(spark, workdir, monkeypatch):
    root, out, full = (os.path.join(workdir, n) for n in ("raw", "inc", "full"))
    _batch_a(root)
    real = chain.build_marts

    def meanwhile(*a, **k):
        _batch_b(root)
        sync_raw(spark, root, Paths(out), "other", AS_OF)
        return real(*a, **k)

    monkeypatch.setattr(chain, "build_marts", meanwhile)
    assert refresh(spark, root, out, as_of=AS_OF, run_id="a", incremental=True) in (0, 2)
    monkeypatch.setattr(chain, "build_marts", real)
    assert [x.startswith("other") for x in paths_pending(spark, out)] == [True]
    assert refresh(spark, root, out, as_of=AS_OF, incremental=True) in (0, 2)
    refresh(spark, root, full, as_of=AS_OF)
    _same(spark, out, full)


def test_of_two_runs_on_one_folder_one_publishes(spark, workdir, monkeypatch):
    root, out, full = (os.path.join(workdir, n) for n in ("raw", "inc", "full"))
    _batch_a(root)
    real, codes = chain.build_marts, []

    def overtaken(*a, **k):
        monkeypatch.setattr(chain, "build_marts", real)
        codes.append(refresh(spark, root, out, as_of=AS_OF, run_id="fast", incremental=True))
        return real(*a, **k)

    monkeypatch.setattr(chain, "build_marts", overtaken)
    assert refresh(spark, root, out, as_of=AS_OF, run_id="slow", incremental=True) == 1
    assert codes[0] in (0, 2)
    refresh(spark, root, full, as_of=AS_OF)
    _same(spark, out, full)
    log = spark.read.parquet(Paths(out).log).where("status = 'error'").collect()
    assert [(r.run_id, r.source_id) for r in log] == [("slow", "stage:marts")] and "another run" in log[0].error_message
    written = {top for t in [*FACT_SCHEMAS, *MARTS] for top in os.listdir(os.path.join(out, t)) if not top.startswith(".")}
    assert len(written) == 1  # what the slower run wrote is gone


# -- compaction and the key index


def test_compaction_bounds_files_and_keeps_rows(spark, workdir):
    root, paths = os.path.join(workdir, "raw"), Paths(os.path.join(workdir, "out"))
    store = paths.store(spark)
    for day in range(1, 9):
        _fx_only(root, [day])
        write_envelope(root, "open_meteo_weather", "ng_lagos", hourly([f"2026-09-{day:02d}T00:00"], temperature_2m=[1.0]), f"2026-09-{day:02d}T06:00:00+00:00")
        sync_raw(spark, root, paths, f"r{day}", AS_OF)
    at = store.current()
    last = at.pending[-1]
    store.publish(at, {}, done=at.pending[:-1])  # the marts hold all but the last
    rows = sorted(map(tuple, read_raw(spark, paths).select(*RAW.fieldNames(), "ym").collect()))
    assert sum(map(len, store.sizes("raw", at).values())) >= 16
    assert compact_warehouse(spark, paths.base) == {"raw": 14, "raw_keys": 0, "files": 8}  # no two keys share a bucket
    now = store.current()
    assert sorted(map(tuple, read_raw(spark, paths).select(*RAW.fieldNames(), "ym").collect())) == rows
    assert len(now.folders("raw")) == 4 and now.folders("raw", LOAD, [last]) == at.folders("raw", LOAD, [last])
    assert sum(map(len, store.sizes("raw", now).values())) <= 4 + 2
    assert compact(store, "raw", RAW, RAW_PARTITIONS, RAW_KEYS, LOAD, busy=[last]) == 0  # nothing left to do
    # a delivery of an old payload is still known, a new one is not
    _rewritten(root)
    _fx_only(root, [20])
    assert sync_raw(spark, root, paths, "after", AS_OF) == {"rows_received": 18, "rows_loaded": 1, "rows_quarantined": 0}


def test_crowded_partitions_only():
    sizes = {"w=1/p=a": [10, 10], "w=2/p=a": [10], "w=1/p=b": [100], "w=2/p=c": [100, 100], "w=3/p=c": [5], "w=4/p=d": [60], "w=5/p=d": [60]}
    assert crowded(sizes, 100) == (["w=1/p=a", "w=2/p=a"], 1)  # c has one small file, d's two fill two
    assert crowded(sizes, 100, busy=["1"]) == ([], 0)
    assert crowded({}, 100) == ([], 0)


@pytest.mark.parametrize("same_hash", [False, True])
def test_key_index_is_exact_and_reads_few_buckets(spark, same_hash):
    keys = ["a", "b"]
    stored = spark.createDataFrame([(f"k{i}", None if i % 3 else "x", f"place{i % 4}") for i in range(400)], "a string, b string, place string")
    hashed = F.lit(7).cast("long") if same_hash else key_index.key_hash(keys)  # every key collides
    index = key_index.index_rows(stored, keys, F.col("place"), hashed)
    asked = {"buckets": [], "places": []}

    def read_index(buckets):
        asked["buckets"] += buckets
        return index.where(F.col("bucket").isin(buckets)).select("h", "place")

    def read_places(places):
        asked["places"] += places
        return stored.where(F.col("place").isin(places))

    incoming = [("k0", "x", 1), ("k0", None, 2), ("k1", None, 3), ("k1", "x", 4), (None, None, 5), ("new", "", 6), ("new", None, 7)]
    df = spark.createDataFrame(incoming, "a string, b string, n int")
    got = key_index.new_by_index(df, keys, read_index, read_places, hashed)
    assert got.columns == df.columns and sorted(r.n for r in got.collect()) == [2, 4, 5, 6, 7]
    assert len(asked["buckets"]) <= len(incoming) and len(set(asked["buckets"])) == len(asked["buckets"])
    assert len(asked["places"]) == (4 if same_hash else 2)
    assert key_index.new_by_index(df.limit(0), keys, read_index, read_places, hashed).count() == 0
