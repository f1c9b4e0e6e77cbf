"""Nearest neighbours by cross-polytope hashing.

A table turns a unit vector by three rounds of random signs and a Hadamard
transform and assigns it to the nearest signed axis. A query looks into the
cells of its largest signed coordinates in every table; what it finds there is
ranked by the exact inner product. Every row is indexed in every table. A query
that meets too few rows is ranked against all rows.

Inner product search is made a search of nearest directions: rows are scaled
by the largest norm and get one more coordinate that fills them up to length
one, queries get a zero there. For that coordinate not to drown the direction
of short rows, rows are split into norm bands with a scale, index and probes
of their own, however few rows they hold.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from citymarts.llm.common import prepare, save
from citymarts.llm.vectors import by_length, keyed, lists, matrix

TABLES = 8
PROBES = 40
#: Rows of a cell that one task ranks at once; larger cells are cut into parts.
PART = 4096
#: Norms of one band differ by this factor at most; they are counted on a grid of so many steps per doubling.
BAND_RATIO = 2 ** 0.25
GRID = 16
#: Scores within this of the k-th may be its equals: they are compared exactly.
MARGIN = 1e-9


def hadamard(x: np.ndarray) -> np.ndarray:
    """Orthonormal Walsh-Hadamard transform of every row (a power of two long)."""
    n, step = x.shape[1], 1
    while step < n:
        x = x.reshape(-1, n // (2 * step), 2, step)
        x = np.concatenate((x[:, :, :1] + x[:, :, 1:], x[:, :, :1] - x[:, :, 1:]), axis=2).reshape(-1, n)
        step *= 2
    return x / np.sqrt(n)


class CrossPolytope:
    """Cells 2a and 2a+1 of a table are the positive and negative axis a."""

    def __init__(self, dim: int, tables: int = TABLES, seed: int = 17):
        self.width = 1 << dim.bit_length()
        self.signs = np.random.default_rng(seed).choice(np.array([-1.0, 1.0]), (tables, 3, self.width))

    def turned(self, x: np.ndarray, table: int) -> np.ndarray:
        y = np.zeros((len(x), self.width))
        y[:, : x.shape[1]] = x
        for s in self.signs[table]:
            y = hadamard(y * s)
        return y

    def signed(self, x: np.ndarray, table: int) -> np.ndarray:
        y = self.turned(x, table)
        return np.stack((y, -y), axis=2).reshape(len(x), -1)

    def cells(self, x: np.ndarray) -> np.ndarray:
        return np.stack([self.signed(x, t).argmax(axis=1) for t in range(len(self.signs))], axis=1)

    def probes(self, x: np.ndarray, count: int) -> np.ndarray:
        """``rows x tables x count`` cells of the largest signed coordinates."""
        out = []
        for t in range(len(self.signs)):
            s = self.signed(x, t)
            out.append(np.argpartition(-s, count - 1, axis=1)[:, :count] if count < s.shape[1] else np.tile(np.arange(s.shape[1]), (len(s), 1)))
        return np.stack(out, axis=1)


def inner(rows: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Inner products in double precision, summed in component order, so that equal vectors score alike."""
    total = np.zeros(len(rows))
    for d in range(rows.shape[1]):
        total += rows[:, d] * q[:, d]
    return total


def _rank(row_ids, rows, query_ids, queries, k):
    """Best ``k`` rows (and all that may equal the last) of every query."""
    out = []
    for i in range(0, len(queries), 256):
        q, own = queries[i : i + 256], query_ids[i : i + 256]
        score = q @ rows.T
        score[own[:, None] == row_ids[None, :]] = -np.inf
        if score.shape[1] > k:
            bound = np.partition(score, -k, axis=1)[:, -k]
        else:
            bound = np.full(len(q), -np.inf)
        scale = MARGIN * (1 + np.abs(np.where(np.isfinite(bound), bound, 0)))
        a, b = np.nonzero((score >= (bound - scale)[:, None]) & (score > -np.inf))
        out.append((own[a], row_ids[b], inner(rows[b], q[a])))
    return [np.concatenate(x) for x in zip(*out)]


def log_norms(x: np.ndarray) -> np.ndarray:
    """Binary logarithm of every row's norm, without overflow."""
    top = np.abs(x).max(axis=1)
    return np.log2(top) + 0.5 * np.log2(((x / top[:, None]) ** 2).sum(axis=1))


def norm_bands(steps) -> np.ndarray:
    """Upper ends (binary logarithms, falling) of the norm bands of the occupied grid ``steps``."""
    wide, tops = round(GRID * np.log2(BAND_RATIO)), []
    for step in sorted(steps, reverse=True):
        if not tops or tops[-1] - step >= wide:
            tops.append(step)
    return (np.array(tops) + 1) / GRID


def nearest_vectors(
    df: DataFrame, queries: Callable[[Column], Column], k: int, id_col: str = "vec_id", vector_col: str = "embedding", tables: int = TABLES, probes: int = PROBES
) -> DataFrame:
    """``query_id, rank, vec_id, score`` of the ``k`` rows of largest inner
    product found for each row whose id ``queries`` (a condition on the id) selects, ties to
    the smaller id; all candidates if fewer. Queries whose probes meet fewer than
    ``k`` rows (and fewer than there are) are ranked against all rows of their length.

    NULL, empty and zero vectors and such with NULL or non-finite components
    take no part; only vectors of one length are compared. Rows of one id are
    separate candidates, in the order of their vectors. Other columns are not read.
    """
    prepare(df.sparkSession)
    rows = keyed(df, id_col, vector_col).where("_v is not null")
    top = F.array_max(F.transform("_v", F.abs))
    norm = F.log2(top) + 0.5 * F.log2(F.aggregate(F.transform("_v", lambda x: x / top), F.lit(0.0), lambda s, x: s + x * x))
    flagged = rows.withColumn("_q", F.coalesce(queries(F.col("_id")), F.lit(False)))
    # counts of the occupied steps of a norm grid reach the driver, for each vector length
    grid: dict[int, dict[int, int]] = {}
    for r in rows.groupBy(F.size("_v").alias("d"), F.floor(norm * GRID).alias("step")).agg(F.count("*").alias("n")).collect():
        grid.setdefault(r.d, {})[r.step] = r.n
    total = {d: sum(steps.values()) for d, steps in grid.items()}
    bands = {d: norm_bands(steps) for d, steps in grid.items()}

    def hashes(d):
        return CrossPolytope(d + 1, tables, seed=17 + d)

    def index(batches):
        made = {d: hashes(d) for d in bands}
        for b in batches:
            for at, x in by_length(b.column(1)):
                d = x.shape[1]
                ends = bands[d]
                long = log_norms(x)
                band = (np.searchsorted(-ends, -long, side="right") - 1).clip(0)
                for own in np.unique(band):
                    some = np.flatnonzero(band == own)
                    for i in range(0, len(some), 2000):
                        row = some[i : i + 2000]
                        part, take = x[row], pa.array(at[row])
                        top = np.abs(part).max(axis=1)
                        unit = part / top[:, None] * np.exp2(np.log2(top) - ends[own])[:, None]
                        fill = np.sqrt(np.maximum(0, 1 - (unit * unit).sum(axis=1)))
                        cells = made[d].cells(np.hstack([unit, fill[:, None]]))
                        of = [pa.array(np.full(len(part), z, np.int32)) for z in (d, own)]
                        yield pa.RecordBatch.from_arrays([b.column(0).take(take), lists(part), *of, lists(cells)], names=["rid", "v", "d", "band", "cells"])

    indexed = save(rows.select("_rid", "_v").mapInArrow(index, "rid long, v array<double>, d int, band int, cells array<long>"), "ann-index")
    # the tables of all bands are numbered through
    spots = indexed.select("rid", "v", "d", "band", F.posexplode("cells").alias("t", "cell")).withColumn("t", F.col("band") * tables + F.col("t"))
    # at most bands x tables x cells counts reach the driver
    parts = {(r.d, r.t, r.cell): -(-r.n // PART) for r in spots.groupBy("d", "t", "cell").agg(F.count("*").alias("n")).collect()}

    def place(batches):
        for b in batches:
            d, t, cell, rid = (b.column(i).to_numpy() for i in range(4))
            part = np.array([int(r) % parts[key] for key, r in zip(zip(d.tolist(), t.tolist(), cell.tolist()), rid.tolist())], np.int32)
            kind = pa.array(np.zeros(len(b), np.int32))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), pa.array(part), kind, b.column(3), b.column(4)], names=names)

    def probe(batches):
        made = {d: hashes(d) for d in bands}
        for b in batches:
            for at, x in by_length(b.column(1)):
                d = x.shape[1]
                firsts = [band * tables for band in range(len(bands[d]))]
                for i in range(0, len(x), 64):
                    q, own = x[i : i + 64], b.column(0).take(pa.array(at[i : i + 64])).to_numpy()
                    unit = q / np.abs(q).max(axis=1, keepdims=True)
                    unit = np.hstack([unit / np.linalg.norm(unit, axis=1, keepdims=True), np.zeros((len(q), 1))])
                    look = [
                        (r, first + t, c, p)
                        for r, per in enumerate(made[d].probes(unit, probes).tolist())
                        for t, cells in enumerate(per)
                        for c in cells
                        for first in firsts
                        for p in range(parts.get((d, first + t, c), 0))
                    ]
                    if look:
                        r, t, c, p = (np.array(z) for z in zip(*look))
                        cols = [np.full(len(r), d, np.int32), t.astype(np.int32), c, p.astype(np.int32), np.ones(len(r), np.int32), own[r]]
                        yield pa.RecordBatch.from_arrays([*(pa.array(z) for z in cols), lists(q[r])], names=names)

    names = ["d", "t", "cell", "part", "kind", "rid", "v"]
    layout = "d int, t int, cell long, part int, kind int, rid long, v array<double>"
    asked = flagged.where("_q").select("_rid", "_v")
    group = ["d", "t", "cell", "part"]

    def rank(batches):
        key, held, rows_now = None, [], None

        def ready():
            ids = np.concatenate([x for x, _ in held])
            return ids, np.concatenate([x for _, x in held])

        for b in batches:
            if not len(b):
                continue
            at = np.stack([b.column(i).to_numpy() for i in range(5)])
            cuts = np.flatnonzero(np.append(True, (at[:, 1:] != at[:, :-1]).any(axis=0)))
            for s, e in zip(cuts, [*cuts[1:], len(b)]):
                now, kind = tuple(at[:4, s]), at[4, s]
                if now != key:
                    key, held, rows_now = now, [], None
                part = b.slice(s, e - s)
                ids, x = part.column(5).to_numpy(), matrix(part.column(6))
                if kind == 0:
                    held.append((ids, x))
                    continue
                if not held:
                    continue
                if rows_now is None:
                    rows_now = ready()
                q, r, score = _rank(*rows_now, ids, x, k)
                yield pa.RecordBatch.from_arrays([pa.array(q), pa.array(r), pa.array(score)], names=["query", "rid", "score"])

    def top(placed, probing):
        meet = placed.unionByName(probing).repartition(*group).sortWithinPartitions(*group, "kind")
        found = meet.mapInArrow(rank, "query long, rid long, score double")
        once = found.groupBy("query", "rid").agg(F.max("score").alias("score"))
        best = Window.partitionBy("query").orderBy(F.desc("score"), "rid")
        return once.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)

    def everything(batches):
        """Queries to all parts of all rows of their length."""
        for b in batches:
            for at, x in by_length(b.column(1)):
                d = x.shape[1]
                count = -(-total[d] // PART)
                for i in range(0, len(x), 64):
                    q, own = x[i : i + 64], b.column(0).take(pa.array(at[i : i + 64])).to_numpy()
                    for p in range(count):
                        cols = [np.full(len(q), z, y) for z, y in ((d, np.int32), (0, np.int32), (0, np.int64), (p, np.int32), (1, np.int32))]
                        yield pa.RecordBatch.from_arrays([*(pa.array(z) for z in cols), pa.array(own), lists(q)], names=names)

    met = save(top(spots.select("d", "t", "cell", "rid", "v").mapInArrow(place, layout), asked.mapInArrow(probe, layout)), "ann-met")
    sizes = F.create_map(*(F.lit(z) for d, n in total.items() for z in (d, n))) if total else F.lit(None).cast("map<int,int>")
    wants = asked.withColumn("_need", F.least(F.lit(k), sizes[F.size("_v")] - 1))
    counted = met.groupBy("query").agg(F.count("*").alias("_n"))
    short = wants.join(counted, F.col("_rid") == F.col("query"), "left").where(F.coalesce("_n", F.lit(0)) < F.col("_need"))
    short = save(short.select("_rid", "_v"), "ann-short")
    if short.limit(1).count():
        parted = F.pmod(F.xxhash64("rid"), F.element_at(F.create_map(*(F.lit(z) for d, n in total.items() for z in (d, -(-n // PART)))), F.col("d"))).cast("int")
        zero = F.lit(0)
        rest = indexed.select("d", zero.alias("t"), zero.cast("long").alias("cell"), parted.alias("part"), zero.alias("kind"), "rid", "v")
        again = top(rest, short.mapInArrow(everything, layout))
        met = met.join(short, met["query"] == short["_rid"], "left_anti").unionByName(again)
    ids = rows.select(F.col("_rid").alias("rid"), F.col("_id").alias(id_col))
    asked_ids = flagged.where("_q").select(F.col("_rid").alias("query"), F.col("_id").alias("query_id"))
    return met.join(ids, "rid").join(asked_ids, "query").select("query_id", "rank", id_col, "score")
