"""Document quality: random-indexing word vectors and a small network.

Every word has a fixed sparse index vector (a few +1 and -1 places drawn from
its hash); a word's vector adds up the index vectors of its neighbours over the
whole corpus by grouped aggregation, those to its right turned by half the
places, so that word order counts. Sums are damped by a logarithm, for frequent
neighbours not to drown the others, and scaled to length one.

A document is pooled into two means: of its words' vectors, and of the products
(place by place) of the vectors of words that stand next to each other. The
second tells text whose neighbours fit from shuffled or repeated words. The
score has no other inputs. A two-layer network in numpy is trained on a bounded
sample of labelled rows and its logits are calibrated by one temperature on
rows that training did not see.

Words are runs of letters (bytes beyond ASCII are letters), runs of digits (as
zeros) and single other characters: punctuation has vectors like any word. They
are hashed to a fixed number of rows, so the model has the same size for any
corpus.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from citymarts.llm.common import byte_column, prepare, runs_of_rows

ROWS = 1 << 13
DIM = 48
NONZERO = 2
#: Vectors are whole multiples of this, kept as 32-bit integers: sums are exact in any order.
GRAIN = 2.0**-8
#: Labelled rows that the network is fitted on, drawn by hash of the id.
SAMPLE = 12_000
HIDDEN = 24
EPOCHS = 60
CHUNK = 1 << 20
#: Words pooled at once; so many products of two components stay below 2^31.
POOL_WORDS = 1 << 12

_rng = np.random.default_rng(7)
_BYTE = _rng.integers(1, 1 << 62, 256, dtype=np.uint64) | np.uint64(1)
_PLACE = _rng.integers(1, 1 << 62, 256, dtype=np.uint64) | np.uint64(1)
_INDEX_AT = _rng.integers(0, DIM, (ROWS, NONZERO))
_INDEX_SIGN = _rng.choice(np.array([-1, 1]), (ROWS, NONZERO))
_BLANK, _LETTER, _DIGIT, _SINGLE = range(4)
_KIND = np.full(256, _SINGLE, np.uint8)
_KIND[65:91] = _KIND[97:123] = _KIND[128:] = _LETTER
_KIND[48:58] = _DIGIT
_KIND[[32, 9, 10, 11, 12, 13]] = _BLANK
_SPELT = np.arange(256, dtype=np.uint8)
_SPELT[48:58] = 48


def _mix(h):
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return h ^ (h >> np.uint64(29))


def words(raw: np.ndarray, off: np.ndarray):
    """Words of joined texts: ``(document, word hash)``."""
    kind = _KIND[raw]
    solid = kind != _BLANK
    first = solid.copy()
    first[1:] &= (kind[1:] != kind[:-1]) | (kind[1:] == _SINGLE)
    cuts = off[:-1][off[:-1] < len(raw)]
    first[cuts] = solid[cuts]
    starts = np.flatnonzero(first)
    if not len(starts):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    doc = np.searchsorted(off, starts, side="right") - 1
    number = np.cumsum(first) - 1
    place = (np.arange(len(raw)) - starts[np.maximum(number, 0)]) & 255
    term = np.where(solid, _BYTE[_SPELT[raw]] * _PLACE[place], np.uint64(0))
    return doc, _mix(np.add.reduceat(term, starts))


def chunks(col: pa.Array, size: int = CHUNK):
    """``(first row, last row, words)`` of a text column, about ``size`` bytes at a time."""
    raw, off = byte_column(col)
    for i, j in runs_of_rows(off, size):
        part = off[i : j + 1] - off[i]
        yield i, j, words(raw[off[i] : off[j]], part)


def _row(hashes):
    return (hashes % np.uint64(ROWS)).astype(np.int64)


def context_vectors(df: DataFrame, text_col: str = "text") -> np.ndarray:
    """``ROWS x DIM`` word vectors from the neighbours (two to each side, same
    document) of every word of the corpus, damped and scaled to unit length.

    Tasks add up their own counts; the sums over tasks are a grouped
    aggregation of at most ``ROWS`` rows, which is all that reaches the driver.
    """

    def run(batches):
        total = np.zeros(ROWS * DIM, np.int64)
        for b in batches:
            for _, _, (doc, word) in chunks(b.column(0)):
                row = _row(word)
                for gap in (1, 2):
                    near = doc[gap:] == doc[:-gap]
                    a, c = row[:-gap][near], row[gap:][near]
                    for me, other, turn in ((a, c, DIM // 2), (c, a, 0)):
                        for k in range(NONZERO):
                            at = me * DIM + (_INDEX_AT[other, k] + turn) % DIM
                            total += np.bincount(at, weights=_INDEX_SIGN[other, k], minlength=ROWS * DIM).astype(np.int64)
        grid = total.reshape(ROWS, DIM)
        used = np.flatnonzero(grid.any(axis=1))
        cols = [pa.array(used.astype(np.int32))] + [pa.array(grid[used, d]) for d in range(DIM)]
        yield pa.RecordBatch.from_arrays(cols, names=["row", *(f"v{d}" for d in range(DIM))])

    prepare(df.sparkSession)
    schema = "row int, " + ", ".join(f"v{d} long" for d in range(DIM))
    sums = df.select(F.col(text_col).cast("string").alias("text")).mapInArrow(run, schema)
    out = np.zeros((ROWS, DIM))
    for r in sums.groupBy("row").agg(*(F.sum(f"v{d}").alias(f"v{d}") for d in range(DIM))).collect():
        out[r[0]] = r[1:]
    out = np.sign(out) * np.log1p(np.abs(out))
    norm = np.linalg.norm(out, axis=1, keepdims=True)
    return np.round(out / np.where(norm > 0, norm, 1) / GRAIN).astype(np.int32)


def pooled(found, rows: int, vectors: np.ndarray) -> np.ndarray:
    """Features of ``rows`` documents: mean word vector and mean product of the
    vectors of neighbouring words. No words: zeros."""
    doc, word = found
    dim = vectors.shape[1]
    total = np.zeros((rows, 2 * dim), np.int64)
    row = np.append(_row(word), 0)
    apart = np.flatnonzero(np.append(doc[1:] != doc[:-1], True))
    for i in range(0, len(doc), POOL_WORDS):
        own = doc[i : i + POOL_WORDS]
        x = vectors.take(row[i : i + len(own) + 1], axis=0)
        pairs = x[:-1] * x[1:]
        lo, hi = np.searchsorted(apart, (i, i + len(own)))
        ends = apart[lo:hi] - i
        pairs[ends] = 0
        edges = np.concatenate(([0], ends + 1))
        edges = edges[edges < len(own)]
        total[own[edges], :dim] += np.add.reduceat(x[:-1], edges, axis=0, dtype=np.int32)
        total[own[edges], dim:] += np.add.reduceat(pairs, edges, axis=0, dtype=np.int32)
    mean = total / np.maximum(np.bincount(doc, minlength=rows), 1)[:, None]
    return mean * np.repeat((GRAIN, GRAIN**2), dim)


def features(df: DataFrame, vectors: np.ndarray, keep: list[str], text_col: str = "text") -> DataFrame:
    """``keep`` columns and ``features`` (array<double>) per row."""
    kept = df.select(*keep).schema

    def run(batches):
        for b in batches:
            col = b.column(len(keep))
            for i, j, found in chunks(col):
                x = pooled(found, j - i, vectors)
                flat = pa.array(x.reshape(-1))
                ends = pa.array(np.arange(j - i + 1, dtype=np.int32) * x.shape[1])
                yield pa.RecordBatch.from_arrays(
                    [b.column(k).slice(i, j - i) for k in range(len(keep))] + [pa.ListArray.from_arrays(ends, flat)], names=[*keep, "features"]
                )

    schema = kept.add("features", T.ArrayType(T.DoubleType()))
    return df.select(*keep, F.col(text_col).cast("string").alias("_text")).mapInArrow(run, schema)


class Network:
    """Two layers (tanh, logistic) trained with Adam on full epochs of small
    batches, then one temperature fitted on held-back rows."""

    def __init__(self, x: np.ndarray, y: np.ndarray, seed: int = 11):
        rng = np.random.default_rng(seed)
        self.mean, self.scale = x.mean(axis=0), x.std(axis=0) + 1e-3
        x = (x - self.mean) / self.scale
        turn = rng.permutation(len(x))
        back, fit = turn[: len(x) // 5], turn[len(x) // 5 :]
        w = [rng.normal(0, x.shape[1] ** -0.5, (x.shape[1], HIDDEN)), np.zeros(HIDDEN), rng.normal(0, HIDDEN**-0.5, HIDDEN), np.zeros(1)]
        m, v, t = [np.zeros_like(p) for p in w], [np.zeros_like(p) for p in w], 0
        for _ in range(EPOCHS):
            rng.shuffle(fit)
            for i in range(0, len(fit), 256):
                at = fit[i : i + 256]
                h = np.tanh(x[at] @ w[0] + w[1])
                err = (1 / (1 + np.exp(-np.clip(h @ w[2] + w[3], -40, 40))) - y[at]) / len(at)
                dh = np.outer(err, w[2]) * (1 - h * h)
                grad = [x[at].T @ dh + 1e-4 * w[0], dh.sum(axis=0), h.T @ err + 1e-4 * w[2], np.array([err.sum()])]
                t += 1
                for k in range(4):
                    m[k] = 0.9 * m[k] + 0.1 * grad[k]
                    v[k] = 0.999 * v[k] + 0.001 * grad[k] ** 2
                    w[k] = w[k] - 0.003 * (m[k] / (1 - 0.9**t)) / (np.sqrt(v[k] / (1 - 0.999**t)) + 1e-8)
        self.w, self.temperature = w, 1.0
        if len(back):
            z = self._logits(x[back])
            grid = np.exp(np.linspace(-2, 3, 51))
            loss = [np.logaddexp(0, -z / g * (2 * y[back] - 1)).mean() for g in grid]
            self.temperature = float(grid[int(np.argmin(loss))])

    def _logits(self, x):
        return np.tanh(x @ self.w[0] + self.w[1]) @ self.w[2] + self.w[3][0]

    def score(self, x: np.ndarray) -> np.ndarray:
        z = self._logits((x - self.mean) / self.scale) / self.temperature
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def held_out(id_col: str = "doc_id"):
    """Rows whose labels are never learned: crc32(id as text) mod 3 is 1."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE):
    """``(vectors, network)``. Word vectors use all of ``docs``; the network at
    most ``sample`` labelled rows (quality 0 or 1, not held out, the first by
    hash of the id, one label per id; of a repeated id every row). Without both labels every score is 0.5.
    """
    vectors = context_vectors(docs, text_col)
    usable = labels.where(F.col("quality").isin(0, 1) & F.col(id_col).isNotNull() & ~held_out(id_col))
    one = usable.groupBy(F.col(id_col).cast("long").alias("_id")).agg(F.min("quality").alias("_quality"))
    drawn = F.broadcast(one.orderBy(F.xxhash64("_id"), "_id").limit(sample))
    plain = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).cast("string").alias("_text"))
    rows = plain.join(drawn, "_id").select("_id", "_quality", "_text")
    got = features(rows, vectors, ["_id", "_quality"], "_text").toArrow().sort_by("_id")
    y = got["_quality"].to_numpy().astype(float)
    if len(y) < 2 or y.min() == y.max():
        return vectors, None
    x = got["features"].combine_chunks().values.to_numpy().reshape(len(y), -1)
    return vectors, Network(x.astype(np.float64), y)


def score(docs: DataFrame, vectors: np.ndarray, network: Network | None, keep: list[str], text_col: str = "text") -> DataFrame:
    """``keep`` columns (none of them called ``score``) and ``score`` (0 to 1; empty and NULL texts too) per row, from the text alone."""

    at = keep.index(text_col) if text_col in keep else len(keep)

    def run(batches):
        for b in batches:
            for i, j, found in chunks(b.column(at)):
                s = network.score(pooled(found, j - i, vectors)) if network else np.full(j - i, 0.5)
                yield pa.RecordBatch.from_arrays([b.column(k).slice(i, j - i) for k in range(len(keep))] + [pa.array(s)], names=[*keep, "score"])

    prepare(docs.sparkSession)
    schema = docs.select(*keep).schema.add("score", "double")
    text = [] if text_col in keep else [F.col(text_col).cast("string").alias("_scored")]
    return docs.select(*keep, *text).mapInArrow(run, schema)
