"""Byte-level BPE by rank file, with a segment tree of pair ranks.

The tree's leaves are the byte positions of one piece; a leaf holds the rank of
the pair that starts there, joined with its position so that the root is the
leftmost pair of least rank. A merge changes three leaves (the pair, its right
part, its left neighbour), each in logarithmic time, so a piece of n bytes
costs O(n log n) however long it is.
"""

from __future__ import annotations

import base64
from array import array

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citymarts.llm.common import byte_column, texts
from citymarts.llm.tokens import CACHE_CHUNKS, Recent, space_chunks

#: Above every rank: no such pair.
_NONE = 1 << 32
#: Pieces kept per worker and generation.
CACHE_PIECES = 2 * CACHE_CHUNKS


def pair_ranks(ranks: dict[bytes, int]) -> list[int]:
    """The rank of every pair of single bytes, at ``first << 8 | second``."""
    return [ranks.get(i.to_bytes(2, "big"), _NONE) for i in range(1 << 16)]


def merge_piece(piece: bytes, ranks: dict[bytes, int], pairs: list[int] | None = None) -> list[int]:
    """Ids of one piece: the leftmost pair of least rank merges until none is
    left. ``pairs``: ``pair_ranks(ranks)``, made once for many pieces."""
    if pairs is None:
        pairs = pair_ranks(ranks)
    rank = ranks.get
    whole = rank(piece)
    if whole is not None:
        return [whole]
    n = len(piece)
    shift = (n - 1).bit_length()
    size, mask, none = 1 << shift, (1 << shift) - 1, _NONE << shift
    # heap-ordered segment tree: leaf size + i holds (rank of the pair at i, i)
    leaves = [pairs[a << 8 | b] << shift | i for i, (a, b) in enumerate(zip(piece, piece[1:]))]
    tree = [none] * size + leaves + [none] * (size - n + 1)
    for i in range(size - 1, 0, -1):
        a, b = tree[2 * i], tree[2 * i + 1]
        tree[i] = a if a < b else b
    following = list(range(1, n + 1))
    before = list(range(-1, n - 1))
    while tree[1] < none:
        i = tree[1] & mask
        j = following[i]
        k = following[j]
        p = before[i]
        following[i] = k
        # three live leaves change: i has a new right part, j is gone, the left neighbour sees a longer i
        r = None
        if k < n:
            before[k] = i
            r = rank(piece[i : following[k]])
        tree[size + i] = none if r is None else r << shift | i
        tree[size + j] = none
        y, z = (size + i) >> 1, (size + j) >> 1
        x = y
        if p >= 0:
            r = rank(piece[p:k])
            tree[size + p] = none if r is None else r << shift | p
            x = (size + p) >> 1
        while x:
            a, b = tree[2 * x], tree[2 * x + 1]
            tree[x] = a if a < b else b
            if y != x:
                a, b = tree[2 * y], tree[2 * y + 1]
                tree[y] = a if a < b else b
            if z != y:
                a, b = tree[2 * z], tree[2 * z + 1]
                tree[z] = a if a < b else b
            x, y, z = x >> 1, y >> 1, z >> 1
    out, i = [], 0
    while i < n:
        k = following[i]
        out.append(ranks[piece[i:k]])
        i = k
    return out


class Filled(Recent):
    """A bounded memo that makes what it lacks."""

    def __init__(self, limit: int, make):
        super().__init__(limit)
        self.make = make

    def __missing__(self, key):
        got = self.old.get(key)
        if got is None:
            got = self.make(key)
        if len(self) >= self.limit:
            self.old = dict(self)
            self.clear()
        self[key] = got
        return got


class ByteBpe:
    """Encoder and decoder of one rank file and split pattern."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.vocab = [b""] * (max(self.ranks.values()) + 1)
        for token, i in self.ranks.items():
            self.vocab[i] = token
        self.split = regex.compile(pattern).findall
        self.pairs = pair_ranks(self.ranks)
        self.chunks, self.pieces = Recent(), Filled(CACHE_PIECES, self._piece)

    def _piece(self, piece: str) -> bytes:
        return array("i", merge_piece(piece.encode(), self.ranks, self.pairs)).tobytes()

    def _chunk(self, chunk: str) -> bytes:
        return b"".join(map(self.pieces.__getitem__, self.split(chunk)))

    def encode(self, text: str) -> bytes:
        """Ids of a whole text as little-endian 32-bit integers."""
        first, rest = space_chunks(text)
        known = self.chunks
        for c in known.ask(set(rest)):
            known[c] = self._chunk(" " + c)
        return self._chunk(first) + b"".join(map(known.__getitem__, rest))

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.vocab.__getitem__, ids.tolist()))


_codecs: dict[tuple[str, str], ByteBpe] = {}


def codec(path: str, pattern: str) -> ByteBpe:
    """The worker's own codec for ``path``."""
    if (path, pattern) not in _codecs:
        _codecs[path, pattern] = ByteBpe(path, pattern)
    return _codecs[path, pattern]


def encode_texts(df: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id_col, ids array<int>)`` per row. NULL and empty texts have no ids;
    a text of any length is encoded whole; repeated rows stay; other columns
    are not read."""

    def run(batches):
        bpe = codec(path, pattern)
        for b in batches:
            for at, part in texts(b.column(1)):
                ids = [bpe.encode(t) for t in part]
                ends = np.cumsum([0, *(len(x) // 4 for x in ids)]).astype(np.int32)
                flat = pa.array(np.frombuffer(b"".join(ids), "<i4"))
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(at, len(part)), pa.ListArray.from_arrays(pa.array(ends), flat)], names=[id_col, "ids"]
                )

    return df.select(F.col(id_col).cast("long").alias(id_col), F.col(text_col).cast("string").alias(text_col)).mapInArrow(
        run, f"`{id_col}` long, ids array<int>"
    )


def decode_ids(df: DataFrame, path: str, pattern: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """Adds ``decoded`` (binary): the bytes of ``ids_col``; NULL or empty ids give no bytes.
    An id outside the vocabulary fails."""

    def run(batches):
        bpe = codec(path, pattern)
        for b in batches:
            ids = b.column(1)
            flat = ids.values.to_numpy(zero_copy_only=False) if len(ids) else np.zeros(0, np.int32)
            off = ids.offsets.to_numpy()
            for i in range(0, len(ids), 512):
                j = min(len(ids), i + 512)
                got = [bpe.decode(flat[off[k] : off[k + 1]]) for k in range(i, j)]
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(i, j - i), ids.slice(i, j - i), pa.array(got, pa.binary())], names=[id_col, ids_col, "decoded"]
                )

    return df.select(id_col, ids_col).mapInArrow(run, f"`{id_col}` long, `{ids_col}` array<int>, decoded binary")
