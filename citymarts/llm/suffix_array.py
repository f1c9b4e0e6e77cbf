"""Two-stage suffix sorting of many byte strings at once (numpy).

Symbols are bytes plus one; every string ends with a 0. A suffix that is
smaller than its successor is sorted directly; every other suffix is larger
than its successor and is induced by scanning the buckets of first symbols in
ascending order: what precedes a sorted suffix goes to the next free place of
its own bucket.
"""

from __future__ import annotations

import numpy as np

#: Symbols of 9 bits in one 64-bit key.
KEY = 7


def join_strings(strings: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """``(symbols, start of each string)``."""
    lengths = np.fromiter(map(len, strings), np.int64, len(strings))
    starts = np.cumsum(lengths + 1) - lengths - 1
    sym = np.zeros(int((lengths + 1).sum()), np.uint16)
    body = np.ones(len(sym), bool)
    body[starts + lengths] = False
    sym[body] = np.frombuffer(b"".join(strings), np.uint8).astype(np.uint16) + 1
    return sym, starts


def _keys(sym: np.ndarray) -> np.ndarray:
    """The next ``KEY`` symbols of every position in one number; zeros from the string's end on."""
    n = len(sym)
    out = np.zeros(n, np.uint64)
    alive = np.ones(n, bool)
    for j in range(KEY):
        here = np.zeros(n, np.uint64)
        here[: n - j] = sym[j:]
        alive &= here > 0
        out |= np.where(alive, here, np.uint64(0)) << np.uint64(9 * (KEY - 1 - j))
    return out


def _ends(sym: np.ndarray) -> np.ndarray:
    stops = np.flatnonzero(sym == 0)
    return stops[np.searchsorted(stops, np.arange(len(sym)))]


def smaller_than_successor(sym: np.ndarray) -> np.ndarray:
    """True where a suffix is smaller than the suffix one further (string ends are)."""
    n = len(sym)
    change = np.append(np.flatnonzero(sym[:-1] != sym[1:]), n - 1)
    at = change[np.searchsorted(change, np.arange(n))]
    after = np.append(sym, 0)[at + 1]
    return (sym[at] < after) | (sym == 0)


def suffix_array(sym: np.ndarray, depth: int) -> np.ndarray:
    """Positions of all suffixes (string ends left out), sorted by their first
    ``depth`` symbols at least; equal ones stand together in any order."""
    keys, ends, small = _keys(sym), _ends(sym), smaller_than_successor(sym)
    direct = np.flatnonzero(small & (sym > 0))
    direct = direct[np.argsort(keys[direct], kind="stable")]
    if len(direct):
        group = np.cumsum(np.append(False, keys[direct[1:]] != keys[direct[:-1]]))
        for shift in range(KEY, depth, KEY):
            size = np.bincount(group)
            tied = np.flatnonzero(size[group] > 1)
            if not len(tied):
                break
            at = direct[tied]
            key = keys[np.minimum(at + shift, ends[at])]
            order = np.lexsort((key, group[tied]))
            direct[tied], key, own = at[order], key[order], group[tied]
            new = np.zeros(len(group), bool)
            new[tied[1:]] = (key[1:] != key[:-1]) & (own[1:] == own[:-1])
            group = group + np.cumsum(new)
    first = np.searchsorted(sym[direct], np.arange(258))
    pending: list[list[np.ndarray]] = [[] for _ in range(258)]
    out = []

    def before(at):
        """Larger-than-successor suffixes one before ``at``, in its order."""
        p = at[at > 0] - 1
        return p[~small[p]]

    def induce(at, symbol):
        p = before(at)
        s = sym[p]
        p, s = p[s > symbol], s[s > symbol]
        order = np.argsort(s, kind="stable")
        p, s = p[order], s[order]
        cuts = np.flatnonzero(np.append(True, s[1:] != s[:-1])) if len(s) else []
        for a, part in zip(cuts, np.split(p, cuts[1:]) if len(s) else []):
            pending[int(s[a])].append(part)

    induce(np.flatnonzero(sym == 0), 0)
    for c in range(1, 258):
        waves = [np.concatenate(pending[c])] if pending[c] else []
        while waves and len(waves[-1]):
            p = before(waves[-1])
            waves.append(p[sym[p] == c])
        bucket = np.concatenate([*waves, direct[first[c] : first[c + 1] if c < 257 else len(direct)]])
        if len(bucket):
            out.append(bucket)
            induce(bucket, c)
    return np.concatenate(out) if out else np.zeros(0, np.int64)


def repeated_prefixes(sym: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """``(positions, group)`` of the suffixes at least ``depth`` long in suffix
    order; neighbours whose common prefix reaches ``depth`` share a group."""
    ends = _ends(sym)
    order = suffix_array(sym, depth)
    order = order[ends[order] - order >= depth]
    if not len(order):
        return order, order
    keys = _keys(sym)
    a, b = order[:-1], order[1:]
    same = np.arange(len(a))
    whole = depth // KEY * KEY
    for shift in range(0, whole, KEY):
        same = same[keys[a[same] + shift] == keys[b[same] + shift]]
    for shift in range(whole, depth):
        same = same[sym[a[same] + shift] == sym[b[same] + shift]]
    fresh = np.ones(len(order), bool)
    fresh[same + 1] = False
    return order, np.cumsum(fresh) - 1
