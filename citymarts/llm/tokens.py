"""Whole-text tokenization by the distinct chunks of a batch.

A text is cut only where every tokenizer here cuts anyway, each distinct chunk
of a batch is encoded once by the tokenizer itself, and a document's ids are
the joined ids of its chunks.
"""

from __future__ import annotations

import json
import os
import re
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from citymarts.llm.common import byte_column

#: Characters that no version of Unicode takes for white space.
_SOLID = "!-~¡-ᙿぁ-ヿ一-鿿가-힣"
_UNSAFE = re.compile(f"[^{_SOLID}] ")
_CUT = re.compile(f"(?<=[{_SOLID}])(?= )")
#: Letters and marks whose runs are matches of their own (the apostrophe starts endings like 's).
_LETTERS = "A-Za-zÀ-ÖØ-öø-įı-ɏ"
_MARKS = r"!-&(-/:-@\[-`{-~"
#: Words merged in one call.
MERGE_WORDS = 8192
#: Matches kept per worker, and their bytes at most.
MEMO_MATCHES, MEMO_BYTES = 600_000, 32_000_000
#: Chunks kept per worker and generation.
CACHE_CHUNKS = 150_000


def _visible() -> dict[int, str]:
    """The byte-level alphabet: printable Latin-1 stands for itself, other bytes for code points from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


_VISIBLE = _visible()


class Recent(dict):
    """A bounded memo of two generations: when the young one is full it turns
    old, and what is used from the old one becomes young again."""

    def __init__(self, limit: int = CACHE_CHUNKS):
        super().__init__()
        self.limit, self.old = limit, {}

    def ask(self, keys: set) -> set:
        """The keys without a value; all others of ``keys`` can be read until the next call."""
        new = [k for k in keys if k not in self]
        if len(self) + len(new) > self.limit:
            self.old = dict(self)
            self.clear()
            new = keys
        old = self.old
        self.update((k, old[k]) for k in new if k in old)
        return {k for k in new if k not in old}


def space_chunks(text: str) -> tuple[str, list[str]]:
    """``(first, rest)`` with ``text == first + "".join(" " + c for c in rest)``.

    Every cut lies between a solid character and a space, where patterns of
    the byte-level kind (optional space before a run, white space runs) always
    end one match and begin the next.
    """
    if text[:1] == " " or _UNSAFE.search(text):
        parts = _CUT.split(text)
        return parts[0], [p[1:] for p in parts[1:]]
    parts = text.split(" ")
    return parts[0], parts[1:]


def _binary(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """``data`` cut at ``offsets`` (one more than there are values)."""
    buffers = [None, pa.py_buffer(np.ascontiguousarray(offsets, np.int64)), pa.py_buffer(np.ascontiguousarray(data))]
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(offsets) - 1, buffers)


class MatchMemo:
    """Ids of distinct matches: what recent batches held is not merged again."""

    def __init__(self, limit: int = MEMO_MATCHES):
        self.limit = limit
        self.forget()

    def forget(self) -> None:
        self.known, self.known_ids = pa.array([], pa.large_string()), pa.array([], pa.large_binary())

    def ids(self, matches: pa.Array, merge) -> pa.Array:
        at = pc.index_in(matches, value_set=self.known).fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
        new = np.flatnonzero(at < 0)
        fresh = matches.take(pa.array(new))
        ascii_ = pc.string_is_ascii(fresh).to_numpy(zero_copy_only=False)
        sides = [np.flatnonzero(ascii_), np.flatnonzero(~ascii_)]
        at[new[np.concatenate(sides)]] = len(self.known) + np.arange(len(new))
        got = pa.concat_arrays([self.known_ids, *(merge(fresh.take(pa.array(s))) for s in sides)]).take(pa.array(at))
        idle = np.ones(len(self.known), bool)
        idle[at[at < len(idle)]] = False
        old = pa.array(np.flatnonzero(idle)[: max(0, self.limit - len(matches))])
        self.known = pa.concat_arrays([matches, self.known.take(old)])
        self.known_ids = pa.concat_arrays([got, self.known_ids.take(old)])
        if len(self.known) > self.limit or self.known.nbytes > MEMO_BYTES:
            self.forget()
        return got


class ChunkTokenizer:
    """Ids of whole texts as little-endian unsigned 32-bit bytes.

    ``word_ends``: the tokenizer drops white space (chunks are words);
    otherwise chunks keep their leading space. Special-token strings in a text
    are ordinary text and no special tokens are added.

    Chunks of letters and marks alone have known matches, which the
    tokenizer's model merges by itself; other chunks take the whole tokenizer.
    """

    def __init__(self, path: str, word_ends: bool):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.tok.encode_special_tokens = True
        self.words, self.lead = word_ends, "" if word_ends else " "
        lines = "" if word_ends else f"(?:\n[{_LETTERS}{_MARKS}]+)*"
        inner = f"[{_LETTERS}]*[{_MARKS}]*" if word_ends else f"[{_LETTERS}{_MARKS}]*"
        self.plain = f"^[{_LETTERS}]{inner}{lines}$"
        self.merger, self.width = self._merger(path)
        self.cache = MatchMemo()
        # the matches of a word stand between tabs, all else is spelt in the byte-level alphabet
        self.spell = _VISIBLE | {9: "\t"}

    @staticmethod
    def _merger(path: str):
        """The file's model over matches that are separated by tabs and spelt in
        the byte-level alphabet, and the number of bytes that each id stands for."""
        from tokenizers import Tokenizer, models, pre_tokenizers

        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        kinds = {k: model[k] for k in ("unk_token", "continuing_subword_prefix", "end_of_word_suffix") if model.get(k)}
        merger = Tokenizer(models.BPE(model["vocab"], pairs, cache_capacity=0, **kinds))
        merger.pre_tokenizer = pre_tokenizers.Split("\t", "removed")
        width = np.zeros(max(model["vocab"].values()) + 1, np.int64)
        for t, i in model["vocab"].items():
            width[i] = len(t.removesuffix(model.get("end_of_word_suffix") or ""))
        return merger, width

    def _each(self, chunks: list[str]) -> list[bytes]:
        return [array("I", e.ids).tobytes() for e in self.tok.encode_batch_fast(chunks, add_special_tokens=False)]

    def _merge(self, matches: pa.Array) -> pa.Array:
        """Ids of distinct matches (all of them ASCII, or none), merged many at a time and cut where a match's bytes end."""
        sizes = pc.binary_length(matches).to_numpy(zero_copy_only=False)
        got, ends, total = [np.zeros(0, "<u4")], [np.zeros(1, np.int64)], 0
        for i in range(0, len(matches), MERGE_WORDS):
            part = matches.slice(i, MERGE_WORDS)
            joined = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(part)], pa.int32()), part), pa.scalar("\t", pa.large_string()))[0].as_py()
            if joined.isascii():
                joined = joined.replace(" ", self.spell[32]).replace("\n", self.spell[10])
            else:
                joined = joined.encode().decode("latin-1").translate(self.spell)
            ids = np.array(self.merger.encode_batch_fast([joined], add_special_tokens=False)[0].ids, "<u4")
            done = np.cumsum(self.width[ids])
            ends.append(np.searchsorted(done, np.cumsum(sizes[i : i + len(part)], dtype=np.int64), side="right") + total)
            total += len(ids)
            got.append(ids)
        return _binary(np.concatenate(got), np.concatenate(ends) * 4)

    def _plain(self, chunks: pa.Array) -> pa.Array:
        """Ids of plain chunks, from the ids of their matches."""
        if self.words:
            chunks = pc.utf8_lower(chunks)
        marked = pc.replace_substring_regex(chunks, f"([{_MARKS}]+|\n)", "\t\\1\t")
        if self.lead:
            marked = pc.binary_join_element_wise(pa.scalar(self.lead, pa.large_string()), marked, pa.scalar("", pa.large_string()))
        lists = pc.split_pattern(marked, "\t")
        coded = lists.flatten().dictionary_encode()
        raw, off = byte_column(self.cache.ids(coded.dictionary, self._merge).take(coded.indices))
        bounds = np.concatenate(([0], np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))))
        return _binary(raw, off[bounds.astype(np.int64)])

    def _learn(self, chunks: pa.Array) -> pa.Array:
        """Ids of every chunk."""
        plain = pc.match_substring_regex(chunks, self.plain).to_numpy(zero_copy_only=False)
        at = [np.flatnonzero(plain), np.flatnonzero(~plain)]
        known, rest = (chunks.take(pa.array(i)) for i in at)
        other = pa.array(self._each([self.lead + c for c in rest.to_pylist()]), pa.large_binary())
        place = np.empty(len(chunks), np.int64)
        place[np.concatenate(at)] = np.arange(len(chunks))
        return pa.concat_arrays([self._plain(known), other]).take(pa.array(place))

    def _chunks(self, batch: list[str]) -> tuple[pa.Array, np.ndarray, list[int]]:
        """Chunks of all texts in one array, the offsets of each text's chunks, and
        the texts in the order in which they come there."""
        col, odd, even = pa.array(batch, pa.large_string()), [], list(range(len(batch)))
        if self.words:  # white space is dropped
            col = pc.replace_substring(col, "\n", " ")
        else:
            strange = pc.or_(pc.starts_with(col, " "), pc.match_substring_regex(col, _UNSAFE.pattern)).to_numpy(zero_copy_only=False)
            odd, even = np.flatnonzero(strange).tolist(), np.flatnonzero(~strange).tolist()
            col = col.take(pa.array(even, pa.int64()))
        lists = pc.split_pattern(col, " ")
        cut = [space_chunks(batch[i]) for i in odd]
        flat = pa.concat_arrays([lists.flatten(), pa.array([c for first, more in cut for c in (first, *more)], pa.large_string())])
        counts = np.concatenate((lists.value_lengths().to_numpy(zero_copy_only=False), [1 + len(more) for _, more in cut]))
        return flat, np.concatenate(([0], np.cumsum(counts))).astype(np.int64), even + odd

    def encode(self, batch: list[str]) -> list[bytes]:
        flat, bounds, order = self._chunks(batch)
        coded = flat.dictionary_encode()
        raw, off = byte_column(self._learn(coded.dictionary).take(coded.indices))
        out = [b""] * len(batch)
        if self.words:
            firsts, heads = bounds[:-1], out
        else:  # a text's first chunk has no space before it
            firsts = bounds[:-1] + 1
            heads = self._each(flat.take(pa.array(bounds[:-1])).to_pylist())
        for i, head, s, e in zip(order, heads, off[firsts].tolist(), off[bounds[1:]].tolist()):
            out[i] = head + raw[s:e].tobytes()
        return out


_tokenizers: dict[tuple[str, bool], ChunkTokenizer] = {}


def tokenizer(path: str, word_ends: bool) -> ChunkTokenizer:
    """The worker's own tokenizer for ``path``."""
    if (path, word_ends) not in _tokenizers:
        _tokenizers[path, word_ends] = ChunkTokenizer(path, word_ends)
    return _tokenizers[path, word_ends]
