"""Token ids in compressed, checksummed blocks: an adaptive context-mixing coder.

A block holds whole documents and is coded on its own. Its ids are laid out in
lanes, contiguous parts of the block that are coded side by side so that every
step is a handful of numpy operations over all lanes; the model is shared by
the lanes and starts anew with each block.

For each id, order-2 and order-1 tables name the id that last followed the same
context, with a confidence; their joint state has adaptive shares for "order-2
guess", "order-1 guess" and "neither", and "neither" is split by adaptive
order-0 frequencies. The mixed interval drives one step of a range asymmetric
numeral system (rANS) per lane: the intervals are found forwards and coded
backwards, so that the decoder reads one stream of words in the order in which
the lanes ask for them. It repeats the same updates from the decoded ids.

Block: ``IDB3``, u32 length of the zlib-packed header, header, lane states
(u64), words (u32), u32 crc32 of all before it. Little-endian throughout.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

MAGIC = b"IDB3"
LANES = 8192
#: Ids in a lane at least, where the block has enough.
LANE_IDS = 128
MAX_ID = (1 << 32) - 1

#: Bits of an interval at most, of its shares of the guesses and of its order-0 frequencies
#: (fewer of the first and more of the second, if a block has very many different ids).
_BITS, _MIX_BITS, _FREQ_BITS = 31, 12, 17
#: Between two ids a lane's state lies in [2^31, 2^63).
_LEAST = np.uint64(1 << 31)
_U32, _LOW32 = np.uint64(32), np.uint64((1 << 32) - 1)
_ORDER2_BITS = 18
#: A table entry is a symbol above its confidence, 0 to _SURE. A joint state is the confidences of
#: order 2 and order 1 and whether they agree; an outcome is a state and which of the guesses were right.
_SURE_BITS, _SURE = 3, 7
_STATES = (_SURE + 1) ** 2 * 2
_OUTCOMES = _STATES * 4


def _learning(order: int) -> tuple[np.ndarray, np.ndarray]:
    """By outcome: what an entry of this order's table gains, and whether it keeps its symbol."""
    outcome = np.arange(_OUTCOMES)
    sure = outcome >> (6 if order == 2 else 3) & _SURE
    hit = (outcome >> (0 if order == 2 else 1) & 1).astype(bool)
    gain = np.where(hit, np.minimum(sure + 1, _SURE), sure >> 1) - sure
    return gain.astype(np.int64).astype(np.uint32), hit | (sure >= 2)


_GAIN1, _KEEP1 = _learning(1)
_GAIN2, _KEEP2 = _learning(2)


class Model:
    """Order-0 to order-2 predictions over dense symbols below ``size``, one set for all lanes.

    An interval is one number: its start above its 32-bit size.
    """

    def __init__(self, size: int, lanes: int, decoding: bool):
        self.size, self.decoding = size, decoding
        # every symbol needs a share of the order-0 frequencies (a document has fewer than 2^29 ids)
        self.freq_bits = min(_BITS - 2, max(_FREQ_BITS, size.bit_length() + 1))
        self.mix = 1 << min(_MIX_BITS, _BITS - self.freq_bits)
        self.bits = np.uint64(self.freq_bits)
        self.total_bits = np.uint64(self.freq_bits + self.mix.bit_length() - 1)
        self.t1 = np.zeros(size + 1, np.uint32)
        self.t2 = np.zeros(1 << _ORDER2_BITS, np.uint32)
        self.p1 = np.full(lanes, size, np.uint32)
        self.p2 = np.full(lanes, size, np.uint32)
        self.seen = np.zeros(_OUTCOMES, np.int64)
        self.count = np.zeros(size, np.int64)
        self.recent: list[np.ndarray] = []
        self.outcomes: list[np.ndarray] = []
        self.step = 0
        self._order0()
        self._shares()

    def _order0(self) -> None:
        if self.recent:
            self.count += np.bincount(np.concatenate(self.recent), minlength=self.size)
            self.recent = []
        whole, total = 1 << self.freq_bits, max(1, int(self.count.sum()))
        freq = 1 + self.count * (whole - self.size) // total
        freq[int(np.argmax(freq))] += whole - int(freq.sum())
        self.order0 = ((np.cumsum(freq) - freq) << 32 | freq).astype(np.uint64)
        if self.decoding:
            self.find = np.repeat(np.arange(self.size, dtype=np.uint32), freq)

    def _shares(self) -> None:
        if self.outcomes:
            self.seen += np.bincount(np.concatenate(self.outcomes), minlength=_OUTCOMES)
            self.outcomes = []
        by = self.seen.reshape(_STATES, 4)
        n = 1 + np.stack([by[:, 1] + by[:, 3], by[:, 2], by[:, 0]], axis=1)
        n[1::2, 1] = 0  # both guesses agree: the order-1 share is empty
        total = n.sum(axis=1)
        share2 = 1 + n[:, 0] * (self.mix - 3) // total
        share1 = np.where(n[:, 1] > 0, 1 + n[:, 1] * (self.mix - 3) // total, 0)
        share12, none = share2 + share1, np.zeros(_STATES, np.int64)
        # the shares lie in this order in the whole interval: order 2, order 1, neither
        self.end2, self.end1 = (share2 << self.freq_bits).astype(np.uint32), (share12 << self.freq_bits).astype(np.uint32)
        # by outcome: neither guess right (order 0 divides the share), order 2 right, order 1 alone right, both right
        start = np.stack([share12, none, share2, none], axis=1) << self.freq_bits
        width = np.stack([self.mix - share12, share2 << self.freq_bits, share1 << self.freq_bits, share2 << self.freq_bits], axis=1)
        self.part = (start << 32 | width).reshape(-1).astype(np.uint64)

    def guess(self):
        """Guesses of order 1 and 2, whether they agree, and the outcome if neither is right."""
        mixed = self.p2 * np.uint32(2246822507) ^ self.p1 * np.uint32(2654435761)
        self.at1, self.at2 = self.p1.astype(np.intp), (mixed >> np.uint32(32 - _ORDER2_BITS)).astype(np.intp)
        self.e1, self.e2 = self.t1.take(self.at1), self.t2.take(self.at2)
        c1, c2 = self.e1 >> np.uint32(_SURE_BITS), self.e2 >> np.uint32(_SURE_BITS)
        low, same = np.uint32(_SURE), c1 == c2
        return c1, c2, same, ((self.e2 & low) << np.uint32(3) | self.e1 & low) << np.uint32(3) | same.view(np.uint8) << np.uint8(2)

    def update(self, x, outcome) -> None:
        new = x << np.uint32(_SURE_BITS)
        self.t1[self.at1] = np.where(_KEEP1.take(outcome), self.e1 + _GAIN1.take(outcome), new)
        self.t2[self.at2] = np.where(_KEEP2.take(outcome), self.e2 + _GAIN2.take(outcome), new)
        self.p2, self.p1 = self.p1, x
        self.recent.append(x)
        self.outcomes.append(outcome)
        self.step += 1
        if self.step % 32 == 0 or self.step & (self.step - 1) == 0:
            self._order0()
            self._shares()

    def intervals(self, x, out) -> None:
        """Intervals of the symbols ``x`` in the mixed prediction, into ``out``."""
        c1, c2, _, outcome = self.guess()
        right = (c1 == x).view(np.uint8) << np.uint8(1) | (c2 == x).view(np.uint8)
        outcome = (outcome | right).astype(np.intp)
        self.part.take(outcome, out=out, mode="clip")
        escape = np.flatnonzero(right == 0)
        share = out.take(escape)
        rest = share & _LOW32
        out[escape] = share - rest + self.order0.take(x.take(escape)) * rest
        self.update(x, outcome)

    def symbols(self, value):
        """The symbols in whose intervals ``value`` lies, and their intervals."""
        c1, c2, same, outcome = self.guess()
        state, small = (outcome >> np.uint32(2)).astype(np.intp), value.astype(np.uint32)
        second, known = small < self.end2.take(state), small < self.end1.take(state)
        right = (known & (~second | same)).view(np.uint8) << np.uint8(1) | second.view(np.uint8)
        outcome = (outcome | right).astype(np.intp)
        x, out = np.where(second, c2, c1), self.part.take(outcome)
        escape = np.flatnonzero(~known)
        share = out.take(escape)
        rest = share & _LOW32
        x[escape] = found = self.find.take(((value.take(escape) - (share >> _U32)) // rest).astype(np.intp))
        out[escape] = share - rest + self.order0.take(found) * rest
        self.update(x, outcome)
        return x, out


def encode_block(ids: np.ndarray, lengths: np.ndarray, keys: np.ndarray) -> bytes:
    """One block of the documents ``keys`` whose ``lengths`` ids are joined in ``ids``."""
    n = len(ids)
    if n and (ids.max() > MAX_ID or ids.min() < 0):
        raise ValueError(f"ids must lie in 0..{MAX_ID}")
    if n and ids.max() < 1 << 20:
        used = np.bincount(ids) > 0
        alphabet, place = np.flatnonzero(used), (np.cumsum(used) - 1).astype(np.uint32)
        dense = place[ids]
    else:
        alphabet, dense = np.unique(ids, return_inverse=True)
    lanes = max(1, min(LANES, n // LANE_IDS))
    steps = -(-n // lanes)
    grid = np.zeros(lanes * steps, np.uint32)
    grid[:n] = dense
    columns = np.ascontiguousarray(grid.reshape(lanes, steps).T)
    del grid, dense
    state, words = np.full(lanes, _LEAST), []
    if n:
        model = Model(len(alphabet), lanes, False)
        coded = np.empty((steps, lanes), np.uint64)
        for x, out in zip(columns, coded):
            model.intervals(x, out)
        room, whole = np.uint64(63) - model.total_bits, np.uint64(1) << model.total_bits
        for out in coded[::-1]:
            size = out & _LOW32
            at = np.flatnonzero(state >= size << room)
            part = state.take(at)
            words.append(part.astype("<u4"))
            state[at] = part >> _U32
            state += state // size * (whole - size) + (out >> _U32)
        del coded
    words = b"".join(w.tobytes() for w in reversed(words))
    gaps = np.diff(alphabet.astype(np.int64), prepend=0).astype("<u4")
    head = struct.pack("<IQII", len(keys), n, lanes, len(alphabet))
    head += keys.astype("<i8").tobytes() + lengths.astype("<i8").tobytes() + gaps.tobytes()
    head = zlib.compress(head, 6)
    body = MAGIC + struct.pack("<I", len(head)) + head + state.astype("<u8").tobytes() + words
    return body + struct.pack("<I", zlib.crc32(body))


def decode_block(block: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(ids, lengths, keys)`` of a block; a wrong magic or checksum fails."""
    if block[:4] != MAGIC or zlib.crc32(block[:-4]) != struct.unpack("<I", block[-4:])[0]:
        raise ValueError("damaged block")
    size = struct.unpack_from("<I", block, 4)[0]
    head = zlib.decompress(block[8 : 8 + size])
    docs, n, lanes, letters = struct.unpack_from("<IQII", head)
    at = struct.calcsize("<IQII")
    keys = np.frombuffer(head, "<i8", docs, at)
    lengths = np.frombuffer(head, "<i8", docs, at + 8 * docs)
    alphabet = np.cumsum(np.frombuffer(head, "<u4", letters, at + 16 * docs)).astype(np.uint32)
    if not n:
        return np.zeros(0, np.uint32), lengths, keys
    state = np.frombuffer(block, "<u8", lanes, 8 + size).astype(np.uint64)
    words = np.frombuffer(block, "<u4", (len(block) - 12 - size - 8 * lanes) // 4, 8 + size + 8 * lanes)
    steps, place = -(-n // lanes), 0
    model = Model(letters, lanes, True)
    out = np.empty((steps, lanes), np.uint32)
    low = (np.uint64(1) << model.total_bits) - np.uint64(1)
    for step in range(steps):
        value = state & low
        out[step], interval = model.symbols(value)
        state >>= model.total_bits
        state *= interval & _LOW32
        state += value - (interval >> _U32)
        at = np.flatnonzero(state < _LEAST)
        state[at] = state.take(at) << _U32 | words[place : place + len(at)]
        place += len(at)
    flat = np.ascontiguousarray(out.T).reshape(-1)[:n]
    return alphabet[flat], lengths, keys
