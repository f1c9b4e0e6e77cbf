"""Packing of token ids into sequences by Karmarkar-Karp multiway differencing.

Every task packs its own documents as they stream by: full sequences are cut
off long documents, what is left waits in a pool, and a pool of ``windows``
sequences is dealt by differencing. Only the pool is held in memory, and no
shuffle is needed.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citymarts.llm.common import texts
from citymarts.llm.tokens import tokenizer

CAPACITY = 4096
END_ID = 2
#: Sequences that one pool fills.
WINDOWS = 128
#: Ids of each sequence that differencing may leave free.
SLACK = 8
#: Lengths of the small pieces, one of each per sequence, that a pool's last
#: documents are cut into; the next set is tried where the sequences would not fit.
FILLERS = ((128, 32, 16), (512, 256, 128, 64, 32, 16), (1024, 512, 512, 256, 128, 64, 32, 16))


def differencing(sizes: list[int], m: int) -> list[list[int]]:
    """Deal indices of ``sizes`` to ``m`` groups of near-equal sums.

    Each size starts as a partial partition (itself and m-1 empty groups); the
    two partitions of the largest imbalance are merged, the fullest group of one
    with the emptiest of the other, until one partition is left.
    """
    if m == 1 or not sizes:
        return [list(range(len(sizes)))] + [[] for _ in range(m - 1)]
    heap = []
    for i, s in enumerate(sizes):
        sums = np.zeros(m, np.int64)
        sums[0] = s
        heap.append((-s, i, sums, [i] + [None] * (m - 1)))
    heapq.heapify(heap)
    tie = len(sizes)
    while len(heap) > 1:
        _, _, a, ga = heapq.heappop(heap)
        _, _, b, gb = heapq.heappop(heap)
        sums = a + b[::-1]
        order = np.argsort(-sums, kind="stable")
        gb = gb[::-1]
        groups = []
        for i in order.tolist():
            x, y = ga[i], gb[i]
            groups.append(y if x is None else x if y is None else (x, y))
        sums = sums[order]
        heapq.heappush(heap, (-int(sums[0] - sums[-1]), tie, sums, groups))
        tie += 1
    out = []
    for g in heap[0][3]:
        flat, todo = [], [] if g is None else [g]
        while todo:
            x = todo.pop()
            if isinstance(x, tuple):
                todo += x
            else:
                flat.append(x)
        out.append(sorted(flat))
    return out


def pack_windows(sizes: list[int], capacity: int, most: int | None = None) -> list[list[int]] | None:
    """Groups of at most ``capacity``; their number starts at the least
    possible and rises by one whenever differencing exceeds the capacity
    (None if it would rise above ``most``)."""
    if max(sizes, default=0) > capacity:
        raise ValueError("a piece is longer than a sequence")
    m = max(1, -(-sum(sizes) // capacity))
    while True:
        groups = differencing(sizes, m)
        if max(sum(sizes[i] for i in g) for g in groups) <= capacity:
            return [g for g in groups if g]
        m += 1
        if most is not None and m > most:
            return None


class Packer:
    """Streams documents in, yields sequences: lists of (document, start, ids, document's length)."""

    def __init__(self, capacity: int = CAPACITY, windows: int = WINDOWS, slack: int = SLACK, fillers=FILLERS):
        self.capacity, self.windows, self.slack, self.fillers = capacity, windows, slack, fillers
        self.pool: list[tuple] = []
        self.total = 0

    def add(self, doc, ids: np.ndarray):
        n, at = len(ids), 0
        while n - at >= self.capacity:
            yield [(doc, at, ids[at : at + self.capacity], n)]
            at += self.capacity
        if at < n:
            self.pool.append((doc, at, ids[at:].copy(), n))
            self.total += n - at
        goal = self.windows * (self.capacity - self.slack)
        while self.total >= goal:
            later = self._cut(self.total - goal)
            yield from self._deal()
            self.pool, self.total = later, sum(len(p[2]) for p in later)

    def _cut(self, n: int) -> list[tuple]:
        """Cut the last ``n`` ids off the pool."""
        out = []
        self.total -= n
        while n:
            doc, start, ids, length = self.pool.pop()
            keep = max(0, len(ids) - n)
            if keep:
                self.pool.append((doc, start, ids[:keep], length))
            out.append((doc, start + keep, ids[keep:], length))
            n -= len(ids) - keep
        return out[::-1]

    def _deal(self):
        """Sequences of the whole pool."""
        count = max(1, -(-self.total // self.capacity))
        whole, total = self.pool, self.total
        for sizes in self.fillers:
            self.pool, self.total = list(whole), total
            small = []
            for size in sizes:
                for doc, start, ids, length in self._cut(min(self.total, size * count)):
                    small += [(doc, start + i, ids[i : i + size], length) for i in range(0, len(ids), size)]
            pieces = self.pool + small
            groups = pack_windows([len(p[2]) for p in pieces], self.capacity, count if sizes is not self.fillers[-1] else None)
            if groups:
                break
        for group in groups:
            yield [pieces[i] for i in group]
        self.pool, self.total = [], 0

    def close(self):
        """The rest: as many near-full sequences as it holds, then sequences whose lengths are powers of two."""
        over = self.total % (self.capacity - self.slack) if self.total else 0
        rest = self._cut(over)
        if self.total:
            yield from self._deal()
        self.pool, self.total = rest, over
        for bit in range(over.bit_length()):
            if over >> bit & 1:
                yield self._cut(1 << bit)


def pack_documents(
    df: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per piece: ``id_col, start, ids (binary, little-endian u32),
    length, doc_tokens, sequence_id, offset``.

    A NULL or empty text is its end id alone; documents of any length are cut
    whole into pieces; repeated rows are packed each; other columns are not
    read. ``sequence_id`` joins the task's number with a running number, so a
    repeated task gives the same ids.
    """

    def run(batches):
        tok, packer = tokenizer(path, True), Packer(capacity)
        number = TaskContext.get().partitionId() << 40
        names = [id_col, "start", "ids", "length", "doc_tokens", "sequence_id", "offset"]
        end = np.array([end_id], "<u4").tobytes()
        rows: list[tuple] = []

        def flush():
            cols = list(zip(*rows)) if rows else [[] for _ in names]
            kinds = [pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
            rows.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=names)

        def put(sequences):
            nonlocal number
            for seq in sequences:
                at = 0
                for doc, start, ids, length in seq:
                    rows.append((doc, start, ids.tobytes(), len(ids), length, number, at))
                    at += len(ids)
                number += 1

        for b in batches:
            for at, part in texts(b.column(1)):
                keys = b.column(0).slice(at, len(part)).to_pylist()
                for key, ids in zip(keys, tok.encode(part)):
                    put(packer.add(key, np.frombuffer(ids + end, "<u4")))
                if rows:
                    yield flush()
        put(packer.close())
        yield flush()

    return df.select(F.col(id_col).cast("long").alias(id_col), F.col(text_col).cast("string").alias(text_col)).mapInArrow(
        run, f"`{id_col}` long, start long, ids binary, length long, doc_tokens long, sequence_id long, offset long"
    )
