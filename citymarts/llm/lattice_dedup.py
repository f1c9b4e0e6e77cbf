"""Near-duplicate vectors by E8 lattice hashing.

In each of several tables a unit vector is projected at random to two blocks of
eight numbers, and each block is decoded to its nearest point of the E8
lattice; the two points name the vector's home cell. Neighbouring lattice
points in both blocks, nearest first, name the cells it probes. Two vectors
meet where one's home is the other's home or probe, and the cosine in double
precision decides.

Only cells in which several vectors meet are looked at, and no pair is ever
sent: a pair may meet in many cells, so each has one owner (the first table in
which it meets) that adds it to the link counts of both, and a cell sends a
count and one link per vector. Exact copies are collapsed to one weighted
vector before.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citymarts.llm.common import connected_components, prepare, save
from citymarts.llm.vectors import by_length, keyed, lists, matrix

MIN_COSINE = 0.95
TABLES = 8
PROBES = 7
#: Width of a lattice cell in units of the projected distance of unit vectors.
WIDTH = 1.5
#: Rows of a cell that one task compares with each other; larger cells are cut into parts.
PART = 2048
_BLOCKS = 2
_NEAR = 4

_ROOTS = np.array(
    [v for v in itertools.product((-1.0, 0.0, 1.0), repeat=8) if sum(map(abs, v)) == 2]
    + [v for v in itertools.product((-0.5, 0.5), repeat=8) if sum(x < 0 for x in v) % 2 == 0]
)


def nearest_e8(y: np.ndarray) -> np.ndarray:
    """Nearest E8 point of every row: the better of D8 and D8 shifted by a half."""

    def d8(x):
        r = np.rint(x)
        off = x - r
        worst = np.argmax(np.abs(off), axis=1)
        rows = np.flatnonzero(r.sum(axis=1) % 2)
        r[rows, worst[rows]] += np.where(off[rows, worst[rows]] >= 0, 1.0, -1.0)
        return r

    a, b = d8(y), d8(y - 0.5) + 0.5
    closer = ((y - b) ** 2).sum(axis=1) < ((y - a) ** 2).sum(axis=1)
    return np.where(closer[:, None], b, a)


class Lattice:
    """Cells of unit vectors of one dimension; equal seeds give equal cells."""

    def __init__(self, dim: int, tables: int = TABLES, probes: int = PROBES, width: float = WIDTH, seed: int = 5):
        rng = np.random.default_rng(seed)
        self.tables, self.probes = tables, probes
        self.turn = rng.normal(0, 1 / width, (tables, dim, 8 * _BLOCKS))
        self.mul = rng.integers(1, 1 << 62, (tables, 8 * _BLOCKS), dtype=np.int64) | 1

    def cells(self, unit: np.ndarray) -> np.ndarray:
        """``rows x tables x (1 + probes)`` cell numbers: the home cell, then the probes."""
        out = np.empty((len(unit), self.tables, 1 + self.probes), np.int64)
        for t in range(self.tables):
            y = unit @ self.turn[t]
            points, steps, costs = [], [], []
            for b in range(_BLOCKS):
                part = y[:, 8 * b : 8 * b + 8]
                p = nearest_e8(part)
                gain = (part - p) @ _ROOTS.T
                best = np.argpartition(-gain, _NEAR - 1, axis=1)[:, : _NEAR - 1]
                points.append(p)
                steps.append(np.concatenate([np.zeros((len(p), 1, 8)), _ROOTS[best]], axis=1))
                costs.append(np.concatenate([np.zeros((len(p), 1)), 2 - 2 * np.take_along_axis(gain, best, axis=1)], axis=1))
            cost = (costs[0][:, :, None] + costs[1][:, None, :]).reshape(len(unit), -1)
            cost[:, 0] = -1  # home first
            order = np.argsort(cost, axis=1, kind="stable")[:, : 1 + self.probes]
            i, j = order // _NEAR, order % _NEAR
            rows = np.arange(len(unit))[:, None]
            first = ((points[0][:, None] + steps[0][rows, i]) * 2).astype(np.int64)
            second = ((points[1][:, None] + steps[1][rows, j]) * 2).astype(np.int64)
            code = (first * self.mul[t, :8]).sum(axis=2) + (second * self.mul[t, 8:]).sum(axis=2)
            code = (code ^ (code >> 29)) * np.int64(0x1F0D3804F5A1C6B7)
            out[:, t] = (code ^ (code >> 31)) + t
        return out


def _owned(cells: np.ndarray, a: np.ndarray, b: np.ndarray, t: int, cell: int) -> np.ndarray:
    """Which pairs (a, b), smaller id first, belong to cell ``cell`` of table ``t``:
    the first table in which one's home is the other's home or probe, at a's home if that is the place."""
    out = np.zeros(len(a), bool)
    for i in range(0, len(a), 20_000):
        x, y = cells[a[i : i + 20_000]], cells[b[i : i + 20_000]]
        at_a = (x[:, :, :1] == y).any(axis=2)
        meet = at_a | (y[:, :, :1] == x).any(axis=2)
        first = meet.argmax(axis=1)
        rows = np.arange(len(x))
        place = np.where(at_a[rows, first], x[rows, first, 0], y[rows, first, 0])
        out[i : i + 20_000] = meet[rows, first] & (first == t) & (place == cell)
    return out


def _local_roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest index of each component of the pairs over ``n`` rows."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def _link(ids, weights, unit, cells, part, t, cell, i, j, least):
    """Link counts and one link per vector for one cell (or two parts of one)."""
    order = np.argsort(ids, kind="stable")
    ids, weights, unit, cells, part = ids[order], weights[order], unit[order], cells[order], part[order]
    home = cells[:, t, 0] == cell
    left, right = np.flatnonzero(part == i), np.flatnonzero(part == j)
    pairs_a, pairs_b = [], []
    for s in range(0, len(left), 512):
        rows = left[s : s + 512]
        near = unit[rows] @ unit[right].T >= least
        near &= home[rows][:, None] | home[right][None, :]
        x, y = np.nonzero(near)
        x, y = rows[x], right[y]
        ok = x < y if i == j else x != y
        x, y = x[ok], y[ok]
        x, y = np.minimum(x, y), np.maximum(x, y)
        own = _owned(cells, x, y, t, cell)
        pairs_a.append(x[own])
        pairs_b.append(y[own])
    a, b = np.concatenate(pairs_a), np.concatenate(pairs_b)
    if not len(a):
        return None
    degree = np.bincount(a, weights=weights[b], minlength=len(ids)) + np.bincount(b, weights=weights[a], minlength=len(ids))
    root = _local_roots(len(ids), a, b)
    some = np.flatnonzero(degree)
    return pa.RecordBatch.from_arrays(
        [pa.array(ids[some]), pa.array(degree[some].astype(np.int64)), pa.array(ids[root[some]])], names=["id", "degree", "link"]
    )


def near_vectors(
    df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", min_cosine: float = MIN_COSINE,
    tables: int = TABLES, probes: int = PROBES, width: float = WIDTH,
) -> DataFrame:
    """One row per row: ``id_col``, ``n_links`` (other rows linked directly),
    ``component_id`` (smallest id reachable) and ``kept``.

    Vectors that are NULL, empty, zero or hold NULL or non-finite components
    link with nothing, nor do vectors of different lengths; equal vectors
    always link. Repeated ids are rows of their own; a NULL id counts as the
    smallest. Other columns are not read.
    """
    prepare(df.sparkSession)
    rows = keyed(df, id_col, vector_col)
    copy = (F.xxhash64("_v"), F.xxhash64(F.lit("again"), F.size("_v"), F.col("_v")))
    rows = rows.withColumn("_h", F.when(F.col("_v").isNotNull(), F.struct(copy[0].alias("a"), copy[1].alias("b"))))
    names = save(rows.select("_rid", "_id", "_h"), "vector-names")
    reps = names.where("_h is not null").groupBy("_h").agg(F.min("_rid").alias("rep"), F.count("*").alias("copies"))
    reps = save(reps, "vector-copies")
    vectors = rows.join(reps.select("rep", "copies"), rows["_rid"] == F.col("rep")).select("rep", "copies", "_v")

    def index(batches):
        made = {}
        for b in batches:
            for at, x in by_length(b.column(2)):
                made.setdefault(x.shape[1], Lattice(x.shape[1], tables, probes, width, seed=5 + x.shape[1]))
                big = np.abs(x).max(axis=1, keepdims=True)
                unit = x / big
                unit /= np.linalg.norm(unit, axis=1, keepdims=True)
                for i in range(0, len(unit), 2000):
                    take = pa.array(at[i : i + 2000])
                    cells = made[x.shape[1]].cells(unit[i : i + 2000]).reshape(len(take), -1)
                    yield pa.RecordBatch.from_arrays(
                        [b.column(0).take(take), b.column(1).take(take), lists(unit[i : i + 2000]), lists(cells)], names=["rep", "copies", "unit", "cells"]
                    )

    indexed = save(vectors.mapInArrow(index, "rep long, copies long, unit array<double>, cells array<long>"), "vector-index")
    spots = indexed.select("rep", F.posexplode("cells").alias("spot", "cell")).select(
        "rep", F.expr(f"spot div {1 + probes}").cast("int").alias("t"), "cell", (F.col("spot") % (1 + probes) == 0).cast("int").alias("home")
    )
    met = spots.groupBy("t", "cell").agg(F.count("*").alias("n"), F.sum("home").alias("homes")).where("n > 1 and homes > 0")
    met = save(met.select("t", "cell", F.ceil(F.col("n") / PART).cast("int").alias("parts")), "vector-cells")
    members = spots.join(met, ["t", "cell"]).withColumn("part", F.pmod(F.xxhash64("rep"), F.col("parts")).cast("int"))
    members = members.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    members = members.select("t", "cell", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"), "part", "rep")
    full = members.join(indexed, "rep")

    def compare(batches):
        key, held = None, []

        def solve():
            if sum(map(len, held)) < 2:
                return None
            b = pa.Table.from_batches(held).combine_chunks()
            cells = matrix(b["cells"]).reshape(b.num_rows, tables, 1 + probes)
            cols = [b[c].to_numpy() for c in ("rep", "copies", "part")]
            return _link(cols[0], cols[1].astype(float), matrix(b["unit"]), cells, cols[2], *key, min_cosine)

        for b in batches:
            at = np.stack([b.column(i).to_numpy() for i in range(4)]) if len(b) else np.zeros((4, 0), np.int64)
            cuts = np.flatnonzero(np.append(True, (at[:, 1:] != at[:, :-1]).any(axis=0))) if len(b) else []
            for s, e in zip(cuts, [*cuts[1:], len(b)]):
                now = tuple(int(v) for v in at[:, s])
                if now != key and held:
                    out = solve()
                    if out is not None:
                        yield out
                    held = []
                key = now
                held.append(b.slice(s, e - s))
        if held:
            out = solve()
            if out is not None:
                yield out

    order = ["t", "cell", "i", "j"]
    grouped = full.select(*order, "part", "rep", "copies", "unit", "cells").repartition(*order).sortWithinPartitions(*order)
    links = save(grouped.mapInArrow(compare, "id long, degree long, link long"), "vector-links")
    degrees = links.groupBy("id").agg(F.sum("degree").alias("degree"))
    roots = connected_components(links.select(F.col("id").alias("a"), F.col("link").alias("b")), "vector-cc")
    per_rep = reps.join(degrees, reps["rep"] == degrees["id"], "left").join(roots, reps["rep"] == roots["node"], "left")
    per_rep = per_rep.select("_h", (F.col("copies") - 1 + F.coalesce("degree", F.lit(0))).alias("n_links"), F.coalesce("root", "rep").alias("root"))
    joined = names.join(per_rep, "_h", "left").select("_rid", "_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("root", "_rid").alias("root"))
    ids = names.select(F.col("_rid").alias("root"), F.col("_id").alias("component_id"))
    return joined.join(ids, "root").select(
        F.col("_id").alias(id_col), "n_links", "component_id", F.col("_id").eqNullSafe(F.col("component_id")).alias("kept")
    )
