"""Removal of repeated byte strings across documents by suffix sorting.

A byte goes if a string of ``SPAN`` bytes that covers it also starts earlier
(smaller document, or earlier in the same one). Sorting every suffix of the
corpus is not needed for that, so the work narrows in steps:

1. Every ``SPAN``-byte window is cut into runs of windows that share the same
   leftmost least ``GRAM``-byte hash (their anchor). Equal windows have equal
   anchors, so they only need to meet others of their anchor. A run is some 130
   bytes of text, sent as a few numbers.
2. Runs of equal anchor and content are copies: all but the first are removed.
   Copies inside one chunk of a task go before the shuffle, so a passage that
   everyone shares sends one run per chunk.
3. Where an anchor has several contents, the texts of these runs are fetched
   once each, and a two-stage suffix sort of each group finds windows that
   several of them share; the first start stays.
4. The spans found are cut out of the documents.

An anchor with very many different contents (a frequent line between changing
neighbours) would gather them in one task. The contents of every anchor are
counted, and the runs of those with too many are split to single windows, keyed
by the window itself; this moves work, not results.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citymarts.llm.common import byte_column, prepare, row_key, runs_of_rows, save
from citymarts.llm.suffix_array import join_strings, repeated_prefixes

SPAN = 100
GRAM = 24
#: Bytes handled at once in a task.
CHUNK = 1 << 20
#: An anchor of more contents than the product of these is split: ``FREQUENT``
#: for every ``SAMPLE_ONE_IN`` of its contents (all are counted, none sampled).
SAMPLE_ONE_IN = 64
FREQUENT = 64
#: Runs split to single windows at once.
SPLIT_RUNS = 20_000
#: Bytes of fetched runs sorted at once (whole groups).
SORT_BYTES = 1 << 21

_rng = np.random.default_rng(23)
_LETTER = _rng.integers(1, 1 << 63, 256, dtype=np.uint64)
_STEP = {k: np.uint64(int(x) | 1) for k, x in zip((2, 4, 8, 16, 24, 32, 64, 96, 100), _rng.integers(1, 1 << 63, 9, dtype=np.uint64))}
RUN = np.dtype([("anchor", "<u8"), ("content", "<u8"), ("doc", "<i8"), ("pos", "<i8"), ("n", "<i4")])


def _mix(h):
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(29))


def _join(left, right, gap, total):
    """Hash of ``total`` bytes from that of the first ``gap`` and of the rest."""
    n = len(right) - gap
    return left[:n] * _STEP[total] + right[gap : gap + n]


def _hashes(x: np.ndarray, gram: int, span: int):
    """Hashes of every ``gram`` (24) and ``span`` (100) bytes of ``x``."""
    h = {1: _LETTER[x]}
    for k in (2, 4, 8, 16, 32, 64):
        h[k] = _join(h[k // 2], h[k // 2], k // 2, k)
    grams = _join(h[16], h[8], 16, 24)
    spans = _join(_join(h[64], h[32], 64, 96), h[4], 96, 100)
    return _mix(grams), _mix(spans)


def window_runs(raw: np.ndarray, off: np.ndarray, docs: np.ndarray) -> np.ndarray:
    """Runs of windows of joined texts, as an array of ``RUN``. Long texts are
    handled part by part; a part's end only ends a run."""
    out = []
    for i, j in runs_of_rows(off, CHUNK):
        lo, hi = int(off[i]), int(off[j])
        for a in range(lo, max(lo + 1, hi - SPAN + 1), 4 * CHUNK):
            b = min(hi, a + 4 * CHUNK + SPAN - 1)
            if b - a < SPAN:
                continue
            grams, spans = _hashes(raw[a:b], GRAM, SPAN)
            least, reach, wide = grams, 1, SPAN - GRAM + 1
            while 2 * reach <= wide:
                least = np.minimum(least[:-reach], least[reach:])
                reach *= 2
            if wide > reach:
                least = np.minimum(least[: -(wide - reach)], least[wide - reach :])
            starts = np.arange(a, a + len(least))
            row = np.searchsorted(off[i : j + 1], starts, side="right") - 1 + i
            valid = starts + SPAN <= off[row + 1]
            new = np.ones(len(least), bool)
            new[1:] = (least[1:] != least[:-1]) | (grams[: len(least) - 1] == least[:-1]) | (row[1:] != row[:-1]) | ~valid[:-1]
            at = np.flatnonzero(new & valid)
            if not len(at):
                continue
            stop = np.append(np.flatnonzero(new), len(least))
            end = stop[np.searchsorted(stop, at, side="right")]
            # an invalid tail of a document belongs to no run
            good = np.cumsum(np.append(0, valid))
            n = good[end] - good[at]
            r = np.empty(len(at), RUN)
            r["anchor"], r["n"] = least[at], n
            r["content"] = _mix(spans[at] * _STEP[2] + spans[at + n - 1] + n.astype(np.uint64))
            r["doc"], r["pos"] = docs[row[at]], starts[at] - off[row[at]]
            out.append(r)
    return np.concatenate(out) if out else np.zeros(0, RUN)


def single_windows(raw: np.ndarray, at: np.ndarray, n: np.ndarray, docs: np.ndarray, pos: np.ndarray) -> np.ndarray:
    """The windows of runs (``n`` of them from byte ``at`` on), each a run keyed by itself."""
    size = n + SPAN - 1
    first = np.cumsum(size) - size
    _, spans = _hashes(raw[np.arange(size.sum()) + np.repeat(at - first, size)], GRAM, SPAN)
    step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    key = spans[np.repeat(first, n) + step]
    r = np.empty(len(key), RUN)
    r["anchor"], r["content"], r["n"] = _mix(key), key, 1
    r["doc"], r["pos"] = np.repeat(docs, n), np.repeat(pos, n) + step
    return r


def _sorted(runs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs by (anchor, content, place), and which are the first of their content."""
    order = np.lexsort((runs["pos"], runs["doc"], runs["content"], runs["anchor"]))
    runs = runs[order]
    first = np.ones(len(runs), bool)
    first[1:] = (runs["anchor"][1:] != runs["anchor"][:-1]) | (runs["content"][1:] != runs["content"][:-1])
    return runs, first


def _spans(doc, start, stop):
    """Spans of equal documents joined where they touch."""
    order = np.lexsort((start, doc))
    doc, start, stop = doc[order], start[order], stop[order]
    if not len(doc):
        return doc, start, stop
    # ends only grow within a document as all spans here reach past their start evenly
    far = stop.copy()
    base = np.cumsum(np.append(True, doc[1:] != doc[:-1])).astype(np.int64) << 40
    far = np.maximum.accumulate(far + base) - base
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (start[1:] > far[:-1])
    last = np.append(np.flatnonzero(new)[1:], len(doc)) - 1
    return doc[new], start[new], far[last]


_FOUND = "doc long, start long, stop long, n int, anchor long"


def _found(doc, start, stop, n, anchor):
    return pa.RecordBatch.from_arrays(
        [pa.array(doc), pa.array(start), pa.array(stop), pa.array(np.asarray(n, np.int32)), pa.array(anchor.view(np.int64))],
        names=["doc", "start", "stop", "n", "anchor"],
    )


def _span_rows(doc, start, stop):
    doc, start, stop = _spans(doc, start, stop)
    return _found(doc, start, stop, np.zeros(len(doc)), np.zeros(len(doc), np.uint64))


def _pack(runs: np.ndarray) -> bytes:
    """Columns after each other: equal bytes lie together for the shuffle's compression."""
    return b"".join(np.ascontiguousarray(runs[c]).tobytes() for c in RUN.names)


def _unpack(data: bytes) -> np.ndarray:
    n = len(data) // RUN.itemsize
    out, at = np.empty(n, RUN), 0
    for c in RUN.names:
        size = n * RUN[c].itemsize
        out[c] = np.frombuffer(data, RUN[c], n, at)
        at += size
    return out


def _chunks_of_runs(batches):
    for b in batches:
        raw, off = byte_column(b.column(1))
        docs = b.column(0).to_numpy()
        for i, j in runs_of_rows(off, 16 * CHUNK):
            yield window_runs(raw[off[i] : off[j]], off[i : j + 1] - off[i], docs[i:j])


def _first_of_each(rows: DataFrame, runs_of, buckets: int) -> DataFrame:
    """Spans of copied runs (``n`` 0), and the first run of each anchor and
    content (``n`` windows), of the runs that ``runs_of`` makes of ``rows``.
    Runs are dealt by content, so an anchor of many contents is spread."""

    def cut(batches):
        for runs in runs_of(batches):
            runs, first = _sorted(runs)
            gone = runs[~first]
            names = ["bucket", "data", "spans"]
            kinds = [pa.int32(), pa.binary(), pa.binary()]
            if len(gone):
                spans = _spans(gone["doc"], gone["pos"], gone["pos"] + gone["n"] + SPAN - 1)
                home = [int(runs["content"][0] % np.uint64(buckets))]
                yield pa.RecordBatch.from_arrays([pa.array(home, kinds[0]), pa.array([b""], kinds[1]), pa.array([np.stack(spans).tobytes()], kinds[2])], names=names)
            runs = runs[first]
            home = (runs["content"] % np.uint64(buckets)).astype(np.int32)
            order = np.argsort(home, kind="stable")
            runs, home = runs[order], home[order]
            edges = np.flatnonzero(np.append(True, home[1:] != home[:-1])) if len(home) else np.zeros(0, int)
            parts = [_pack(p) for p in np.split(runs, edges[1:])] if len(edges) else []
            yield pa.RecordBatch.from_arrays([pa.array(home[edges], kinds[0]), pa.array(parts, kinds[1]), pa.array([b""] * len(parts), kinds[2])], names=names)

    def meet(part: pa.Table) -> pa.Table:
        out = []
        for raw in part["spans"].to_pylist():
            if raw:
                out.append(_span_rows(*np.frombuffer(raw, np.int64).reshape(3, -1)))
        runs = np.concatenate([np.zeros(0, RUN), *(_unpack(x) for x in part["data"].to_pylist() if x)])
        runs, first = _sorted(runs)
        gone = runs[~first]
        out.append(_span_rows(gone["doc"], gone["pos"], gone["pos"] + gone["n"] + SPAN - 1))
        ask = runs[first]
        out.append(_found(ask["doc"], ask["pos"], ask["pos"] + ask["n"] + SPAN - 1, ask["n"], ask["anchor"]))
        return pa.Table.from_batches(out)

    cut_runs = rows.mapInArrow(cut, "bucket int, data binary, spans binary")
    return cut_runs.groupBy("bucket").applyInArrow(meet, _FOUND)


def _asked_runs(batch):
    """Of documents (first column key, second text) with ``runs`` in the last
    column: the bytes, and first byte, document, start, stop and anchor of every run."""
    runs = batch.column(batch.num_columns - 1)
    raw, off = byte_column(batch.column(1))
    flat = runs.flatten()
    start, stop, anchor = (flat.field(k).to_numpy() for k in ("start", "stop", "anchor"))
    ends = runs.offsets.to_numpy() - runs.offsets[0].as_py()
    row = np.repeat(np.arange(len(runs)), np.diff(ends))
    return raw, off[row] + start, batch.column(0).to_numpy()[row], start, stop, anchor


def _split_runs(batches):
    for b in batches:
        raw, at, doc, start, stop, _ = _asked_runs(b)
        for i in range(0, len(at), SPLIT_RUNS):
            s = slice(i, i + SPLIT_RUNS)
            yield single_windows(raw, at[s], (stop - start)[s] - SPAN + 1, doc[s], start[s])


def _shared(fetched: DataFrame) -> DataFrame:
    """Step 3: spans of windows that fetched runs of one anchor share with an earlier one."""

    def solve(doc, pos, text):
        sym, starts = join_strings(text)
        at, group = repeated_prefixes(sym, SPAN)
        own = np.searchsorted(starts, at, side="right") - 1
        d, p = doc[own], pos[own] + at - starts[own]
        order = np.lexsort((p, d, group))
        d, p, group = d[order], p[order], group[order]
        later = np.zeros(len(group), bool)
        later[1:] = group[1:] == group[:-1]
        return _span_rows(d[later], p[later], p[later] + SPAN)

    def run(batches):
        anchors, docs, places, strings, held = [], [], [], [], 0
        for b in batches:
            cols = [b.column(i).to_pylist() for i in range(4)]
            for anchor, doc, pos, text in zip(*cols):
                if held >= SORT_BYTES and anchor != anchors[-1]:
                    yield solve(np.array(docs), np.array(places), strings)
                    anchors, docs, places, strings, held = [], [], [], [], 0
                anchors.append(anchor)
                docs.append(doc)
                places.append(pos)
                strings.append(text)
                held += len(text)
        if strings:
            yield solve(np.array(docs, np.int64), np.array(places, np.int64), strings)

    return fetched.repartition("anchor").sortWithinPartitions("anchor").mapInArrow(run, _FOUND)


def bucket_count(df: DataFrame, per_bucket: int = 32 << 20) -> int:
    """Buckets for the runs of a table: one per ``per_bucket`` of its size by the
    planner's estimate, and never fewer than the shuffle partitions."""
    spark = df.sparkSession
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return least if size >= 1 << 60 else max(least, -(-size // per_bucket))


def remove_repeats(df: DataFrame, keep: list[str], id_col: str = "doc_id", text_col: str = "text", as_text: bool = False) -> DataFrame:
    """``keep`` columns of every row with ``kept`` (binary, what is left of the
    text; ``as_text``: a string without characters that lost a byte), ``n_bytes``, ``n_removed`` and ``n_spans`` (maximal removed runs).

    Texts count as UTF-8 bytes, NULL as empty; matches never cross documents;
    strings are judged on the input. Rows of one id are separate documents in
    the order of their texts, a NULL id comes first. Texts under 100 bytes stay
    whole. Columns named like the ones added must not be in ``keep``.
    """
    prepare(df.sparkSession)
    names = [f"_k{i}" for i in range(len(keep))]
    docs = df.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).cast("string").alias("_text"), *(F.col(c).alias(n) for c, n in zip(keep, names)))
    docs = row_key(docs, "_id", "_text").drop("_id").select("_rid", "_text", *names)
    buckets = bucket_count(df)
    texts = docs.select("_rid", "_text")
    found = save(_first_of_each(texts, _chunks_of_runs, buckets), "repeat-runs")
    firsts = found.where("n > 0").select("doc", "start", "stop", "anchor")
    contents = firsts.groupBy("anchor").agg(F.count("*").alias("contents")).where("contents > 1")
    wanted = firsts.join(contents, "anchor").withColumn("frequent", F.col("contents") > FREQUENT * SAMPLE_ONE_IN)
    wanted = save(wanted.drop("contents"), "repeat-wanted")

    def ask(chosen):
        runs = chosen.groupBy("doc").agg(F.collect_list(F.struct("start", "stop", "anchor")).alias("runs"))
        return texts.join(runs, texts["_rid"] == runs["doc"]).select("_rid", "_text", "runs")

    def fetch(batches):
        for b in batches:
            raw, at, doc, start, stop, anchor = _asked_runs(b)
            for i in range(0, len(at), 20_000):
                s = slice(i, i + 20_000)
                own = [raw[x:y].tobytes() for x, y in zip(at[s].tolist(), (at + stop - start)[s].tolist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(anchor[s]), pa.array(doc[s]), pa.array(start[s]), pa.array(own, pa.binary())], names=["anchor", "doc", "pos", "text"]
                )

    fetched = ask(wanted.where("not frequent")).mapInArrow(fetch, "anchor long, doc long, pos long, text binary")
    spans = found.where("n = 0").unionByName(_shared(fetched))
    if wanted.where("frequent").limit(1).count():
        spans = spans.unionByName(_first_of_each(ask(wanted.where("frequent")), _split_runs, buckets).where("n = 0"))
    spans = spans.groupBy("doc").agg(F.collect_list(F.struct("start", "stop")).alias("spans"))
    joined = docs.join(spans, docs["_rid"] == spans["doc"], "left").select("_rid", "_text", *names, "spans")
    kept_type = docs.select(*names).schema

    def cut(batches):
        for b in batches:
            raw, off = byte_column(b.column(1))
            spans = b.column(b.num_columns - 1)
            flat = spans.flatten()
            start, stop = flat.field("start").to_numpy(), flat.field("stop").to_numpy()
            per = np.array([0 if s is None else s for s in pc.list_value_length(spans).to_pylist()], np.int64)
            row = np.repeat(np.arange(len(spans)), per)
            row, start, stop = _spans(row, start, stop)
            change = np.zeros(len(raw) + 1, np.int8)
            change[off[row] + start] += 1
            change[off[row] + stop] -= 1
            gone = np.cumsum(change[:-1], dtype=np.int8).astype(bool)
            left = np.concatenate(([0], np.cumsum(~gone)))[off]
            kept = pa.Array.from_buffers(pa.large_binary(), len(b), [None, pa.py_buffer(left.astype(np.int64)), pa.py_buffer(raw[~gone])]).cast(pa.binary())
            if as_text:
                kept = pa.array([x.decode("utf-8", "ignore") for x in kept.to_pylist()], pa.string())
            n = np.diff(off)
            yield pa.RecordBatch.from_arrays(
                [b.column(2 + i) for i in range(len(names))]
                + [kept, pa.array(n), pa.array(n - np.diff(left)), pa.array(np.bincount(row, minlength=len(b)).astype(np.int64))],
                names=[*names, "kept", "n_bytes", "n_removed", "n_spans"],
            )

    schema = kept_type.add("kept", "string" if as_text else "binary").add("n_bytes", "long").add("n_removed", "long").add("n_spans", "long")
    out = joined.mapInArrow(cut, schema)
    return out.select(*(F.col(n).alias(c) for c, n in zip(keep, names)), "kept", "n_bytes", "n_removed", "n_spans")
