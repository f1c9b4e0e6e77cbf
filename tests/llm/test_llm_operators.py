"""Operators for training data against brute force, round trips and held-out accuracy."""

import hashlib
import math
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from citymarts.llm import (
    byte_bpe, common, cross_polytope, id_codec, id_files, language_id, lattice_dedup, packing, quality, sharding, simhash_dedup, suffix_array, suffix_dedup,
)
from citymarts.llm.common import prepare, scratch
from citymarts.llm.tokens import ChunkTokenizer

WORDS = "the rain in spain stays mainly on a plain über straße niño d'été 42 x9 ... !!".split()
ODD = [
    "", " ", "  a  b", "a\n b \n c", " lead", "x\x1c y 　 z", "<|endoftext|> hi <|startoftext|>", "don't  we'll 12 345 $$$ á é́ É Σ ΑΣ.",
    "\ttab\r\nab", "日本 語 한국 어", "Wörter, Straße. ÉÀ Ǆ ſ İx, ı. Ω ab.c a, b", "ABC. İ", " a \x0b b",
]


def prose(n, seed=0):
    rng = np.random.default_rng(seed)
    return " ".join(rng.choice(WORDS, n))


@pytest.fixture(scope="module")
def corpus(spark):
    """Copies, near copies, shared passages, odd rows: NULLs, empty and long
    texts, repeated rows and ids, an extra column with a clashing name."""
    prepare(spark)
    shared, long = prose(60, 1), prose(9000, 2)
    rows = [(i, prose(80, i + 10)) for i in range(12)]
    rows += [(20, rows[0][1]), (21, rows[0][1]), (22, rows[1][1][:-5] + " new end"), (23, "pre " + shared + " post"), (24, "other " + shared)]
    rows += [(30, None), (31, ""), (32, "   \n"), (33, "one"), (34, "two words"), (35, long), (36, "start " + long[200:9000]), (37, "a" * 700)]
    rows += [(40, rows[3][1]), (40, rows[3][1]), (41, "same id"), (41, "same id, other text"), (None, rows[4][1]), (None, None)]
    rows += [(50 + i, t) for i, t in enumerate(ODD)]
    full = [(i, t, ("en", "de", None)[k % 3], f"s{k % 2}", None, 0, "clash", k) for k, (i, t) in enumerate(rows)]
    return spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long, _rid long, fp string, start long")


@pytest.fixture(scope="module")
def rows(corpus):
    return [(r.doc_id, r.text) for r in corpus.select("doc_id", "text").collect()]


def key(row):
    return (row[0] is not None, row[0] or 0, row[1] is not None, row[1] or "")


def test_rendezvous_sharding(spark, corpus, rows):
    got = sharding.assign_shards(corpus, "doc_id", [1.0, 2.0, 0.0, 1.0], "text", 1.0, slot_parts=3).collect()
    assert sorted((r.size, r.text_crc32) for r in got) == sorted((len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for _, t in rows)
    for s in {r["shard"] for r in got}:
        assert sorted(r.slot for r in got if r["shard"] == s) == list(range(sum(r["shard"] == s for r in got)))
    assert all(r.grown_shard in (r["shard"], 4) for r in got) and all(r["shard"] != 2 for r in got)
    ids = spark.range(6000).withColumn("text", F.lit("x"))
    share = {r["shard"]: r["count"] for r in sharding.assign_shards(ids, "id", [1.0, 2.0, 3.0]).groupBy("shard").count().collect()}
    assert abs(share[0] - 1000) < 150 and abs(share[2] - 3000) < 200
    again = sharding.assign_shards(ids.repartition(7), "id", [1.0, 2.0, 3.0]).select("id", "shard", "slot")
    assert not again.exceptAll(sharding.assign_shards(ids, "id", [1.0, 2.0, 3.0]).select("id", "shard", "slot")).count()
    assert not sharding.assign_shards(corpus.limit(0), "doc_id", [1.0], "text").count()
    with pytest.raises(ValueError):
        sharding.rendezvous_shard(F.col("x"), [0.0])


def brute_fingerprint(text):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    grams = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if hashes else 0


def brute_roots(n, linked):
    root = list(range(n))
    change = True
    while change:
        change = False
        for i in range(n):
            for j in range(i):
                if linked(i, j) and root[i] != root[j]:
                    root[i] = root[j] = min(root[i], root[j])
                    change = True
    return root


def test_simhash_groups(corpus, rows):
    rows = sorted(rows, key=key)
    prints = [brute_fingerprint(t) for _, t in rows]
    root = brute_roots(len(rows), lambda i, j: (prints[i] ^ prints[j]).bit_count() <= 2)
    want = []
    for i, (doc, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if root[j] == root[i] and rows[j][0] is not None]
        want.append((doc is not None, doc or 0, f"{prints[i]:016x}", min(ids, default=None)))
    got = [(r.doc_id is not None, r.doc_id or 0, r.fingerprint, r.component_id) for r in simhash_dedup.simhash_groups(corpus).collect()]
    assert sorted(got) == sorted(want)
    assert not simhash_dedup.simhash_groups(corpus.limit(0)).count()


@pytest.mark.parametrize("bits", [0, 2, 4])
def test_ball_links_find_every_pair(spark, bits):
    rng = np.random.default_rng(bits)
    base = rng.integers(0, 1 << 62, 12)
    prints = {int(b) for b in base}
    for b in base:
        for _ in range(6):
            x = int(b)
            for i in rng.choice(62, rng.integers(1, 6), replace=False):
                x ^= 1 << int(i)
            prints.add(x)
    prints = sorted(prints)
    from citymarts.llm.common import connected_components

    df = spark.createDataFrame([(p,) for p in prints], "fp long")
    found = {r.node: r.root for r in connected_components(simhash_dedup.link_fingerprints(df, bits)).collect()}
    root = brute_roots(len(prints), lambda i, j: (prints[i] ^ prints[j]).bit_count() <= bits)
    assert [found.get(p, p) for p in prints] == [prints[r] for r in root]


def test_suffix_array_sorts_all_suffixes():
    rng = np.random.default_rng(3)
    for n, letters in ((150, 2), (200, 3), (100, 256), (40, 1), (0, 1)):
        strings = [bytes(rng.integers(0, letters, rng.integers(0, 40)).astype(np.uint8)) for _ in range(n)]
        sym, starts = suffix_array.join_strings(strings)
        order = suffix_array.suffix_array(sym, 40) if n else []
        own = np.searchsorted(starts, order, side="right") - 1
        assert [strings[o][p - starts[o] :] for o, p in zip(own, order)] == sorted(s[i:] for s in strings for i in range(len(s)))


def brute_repeats(rows):
    seen, out = set(), []
    for doc, text in sorted(rows, key=key):
        b = (text or "").encode()
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - 99):
            if b[i : i + 100] in seen:
                gone[i : i + 100] = True
            seen.add(b[i : i + 100])
        kept = np.frombuffer(b, np.uint8)[~gone].tobytes()
        out.append((doc is not None, doc or 0, len(b), int(gone.sum()), int((np.diff(np.concatenate(([0], gone.astype(int)))) == 1).sum()), kept))
    return sorted(out)


@pytest.mark.parametrize("frequent", [suffix_dedup.FREQUENT, 2])
def test_repeats_are_removed(corpus, rows, monkeypatch, frequent):
    monkeypatch.setattr(suffix_dedup, "FREQUENT", frequent)
    monkeypatch.setattr(suffix_dedup, "SAMPLE_ONE_IN", 1)
    got = suffix_dedup.remove_repeats(corpus, ["doc_id"]).collect()
    assert sorted((r.doc_id is not None, r.doc_id or 0, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in got) == brute_repeats(rows)
    assert not suffix_dedup.remove_repeats(corpus.limit(0), ["doc_id"]).count()


def test_no_anchor_of_many_contents_reaches_one_sort(spark, monkeypatch):
    prepare(spark)
    monkeypatch.setattr(suffix_dedup, "FREQUENT", 1)
    rng = np.random.default_rng(12)
    line = "the very same line stands between changing neighbours, again and again."
    change = ["".join(rng.choice(list("abcdefghijklmnop "), 90)) for _ in range(600)]
    rows = [(3, line.join(change)), (4, "new " + line.join(change[200:240]) + " end"), (5, change[7] + line + change[9])]
    most, real = [], suffix_dedup._shared

    def shared(fetched):
        most.append(fetched.groupBy("anchor").count().agg(F.max("count")).first()[0] or 0)
        return real(fetched)

    monkeypatch.setattr(suffix_dedup, "_shared", shared)
    got = suffix_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"), ["doc_id"]).collect()
    assert sorted((True, r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in got) == brute_repeats(rows)
    assert most[0] <= suffix_dedup.FREQUENT * suffix_dedup.SAMPLE_ONE_IN


def test_byte_bpe_equals_tiktoken(corpus, rows):
    path, pattern = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    ranks = byte_bpe.ByteBpe(path, pattern).ranks
    ref = tiktoken.Encoding("ref", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    ids = byte_bpe.encode_texts(corpus, path, pattern)
    got = byte_bpe.decode_ids(ids, path, pattern).collect()
    want = sorted((ref.encode_ordinary(t or ""), (t or "").encode()) for _, t in rows)
    assert sorted((r.ids, bytes(r.decoded)) for r in got) == want
    piece = ("ab" * 3000 + "é" * 500).encode()
    assert byte_bpe.merge_piece(piece, ranks) == ref.encode_ordinary(piece.decode())


@pytest.mark.parametrize("name,word_ends", [("word_bpe_49k.json", True), ("byte_bpe_50k.json", False)])
def test_chunked_tokenizer_equals_the_library(rows, name, word_ends):
    ref = Tokenizer.from_file(public_tokenizers.path(name))
    ref.encode_special_tokens = True
    texts = [t or "" for _, t in rows] + ODD
    want = [np.array(e.ids, "<u4").tobytes() for e in ref.encode_batch(texts, add_special_tokens=False)]
    tok = ChunkTokenizer(public_tokenizers.path(name), word_ends)
    assert tok.encode(texts) == want
    tok.cache.limit = 5  # generations turn over all the time
    assert [tok.encode([t])[0] for t in texts] == want


def test_packing_keeps_every_id(corpus, rows):
    path = public_tokenizers.path("word_bpe_49k.json")
    got = packing.pack_documents(corpus, path, capacity=256).collect()
    by_doc, by_seq = {}, {}
    for r in got:
        by_doc.setdefault((r.doc_id is not None, r.doc_id or 0, r.doc_tokens), []).append((r.start, bytes(r.ids)))
        by_seq.setdefault(r.sequence_id, []).append((r.offset, r.length))
    tok = ChunkTokenizer(path, True)
    want = sorted((d is not None, d or 0, tok.encode([t or ""])[0] + b"\2\0\0\0") for d, t in rows)
    assert sum(len(x) for v in by_doc.values() for _, x in v) == sum(len(w[2]) for w in want)
    alone = [w for w in want if sum(x[:2] == w[:2] for x in want) == 1]
    for known, doc, ids in alone:
        assert b"".join(x for _, x in sorted(by_doc[known, doc, len(ids) // 4])) == ids
    for parts in by_seq.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 256
    assert not packing.pack_documents(corpus.limit(0), path).count()


def test_differencing_balances_and_never_exceeds():
    rng = np.random.default_rng(1)
    sizes = [int(x) for x in rng.integers(1, 4096, 400)]
    groups = packing.pack_windows(sizes, 4096)
    sums = [sum(sizes[i] for i in g) for g in groups]
    assert sorted(i for g in groups for i in g) == list(range(400)) and max(sums) <= 4096
    assert len(groups) <= math.ceil(sum(sizes) / 4096) * 1.1
    assert packing.differencing([8, 7, 6, 5, 4], 2) and packing.pack_windows([], 10) == []
    with pytest.raises(ValueError):
        packing.pack_windows([11], 10)


def test_packing_has_little_padding():
    rng = np.random.default_rng(2)
    packer, lengths = packing.Packer(), []
    for d in range(3000):
        lengths += [sum(len(p[2]) for p in s) for s in packer.add(d, np.zeros(int(rng.integers(1, 3000)), np.uint32))]
    lengths += [sum(len(p[2]) for p in s) for s in packer.close()]
    assert sum(4096 - n for n in lengths if n & (n - 1)) / sum(lengths) < 0.01


@pytest.mark.parametrize("ids", [[], [0] * 5000, list(range(3000)), [65535], list(np.random.default_rng(1).zipf(1.3, 30000) % 50000)])
def test_codec_round_trip(ids):
    ids = np.array(ids, np.uint32)
    block = id_codec.encode_block(ids, np.array([len(ids)]), np.array([7]))
    back, lengths, keys = id_codec.decode_block(block)
    assert (back == ids).all() and lengths.tolist() == [len(ids)] and keys.tolist() == [7]
    if len(ids) == 30000:
        assert len(block) < 2 * len(ids)
    broken = bytearray(block)
    broken[len(block) // 2] ^= 1
    with pytest.raises(ValueError):
        id_codec.decode_block(bytes(broken))


def test_id_files_give_every_document_its_place(spark, corpus, rows):
    path, folder = public_tokenizers.path("byte_bpe_50k.json"), scratch(spark, "ids-test")
    id_files.write_ids(corpus, folder, path, block_ids=500)
    got = sorted((r.start, r.doc_id, bytes(r.ids)) for r in id_files.read_ids(spark, folder).collect())
    tok, at, want = ChunkTokenizer(path, False), 0, []
    for doc, text in sorted(rows, key=key):
        ids = tok.encode([text or ""])[0] + b"\0\0\0\0"
        want.append((at, doc, ids))
        at += len(ids) // 4
    assert got == want
    empty = scratch(spark, "ids-none")
    id_files.write_ids(corpus.limit(0), empty, path)
    assert not id_files.read_ids(spark, empty).count()


def test_id_blocks_end_with_the_document_that_fills_them(spark):
    texts = [(i, f"word{i} and some more of it. " * 20) for i in range(200)]
    path, folder = public_tokenizers.path("byte_bpe_50k.json"), scratch(spark, "ids-blocks")
    id_files.write_ids(spark.createDataFrame(texts, "doc_id long, text string").coalesce(1), folder, path, block_ids=500)
    longest = max(len(r.ids) // 4 for r in id_files.read_ids(spark, folder).collect())
    blocks = spark.read.parquet(folder).collect()
    assert sum(r.n_docs for r in blocks) == 200 and max(r.n_ids for r in blocks) < 500 + longest


def test_an_arrow_batch_is_tokenized_in_one_piece():
    batch = pa.array(["x" * 1024] * (8 << 10))
    assert len(list(common.texts(batch, id_files.TEXT_BYTES))) == 1


def test_lanes_read_one_stream_of_words():
    ids = np.random.default_rng(5).integers(0, 1 << 16, 40_000).astype(np.uint32)
    block = id_codec.encode_block(ids, np.array([len(ids)]), np.array([1]))
    head = 8 + int.from_bytes(block[4:8], "little")
    lanes = len(ids) // id_codec.LANE_IDS
    states = np.frombuffer(block, "<u8", lanes, head)
    assert (states >= 1 << 31).all() and (states < 1 << 63).all() and (len(block) - head - 8 * lanes - 4) % 4 == 0
    assert (id_codec.decode_block(block)[0] == ids).all()


@pytest.mark.parametrize("bits", [19, 24, 31])
def test_codec_with_few_bits_for_the_guesses(monkeypatch, bits):
    monkeypatch.setattr(id_codec, "_BITS", bits)
    rng = np.random.default_rng(bits)
    for ids in (rng.zipf(1.3, 30_000) % 50_000, rng.permutation(300_000)[: 300_000 if bits == 31 else 30_000], np.arange(9000) // 3000):
        got = id_codec.decode_block(id_codec.encode_block(ids.astype(np.uint32), np.array([len(ids)]), np.array([4])))[0]
        assert (got == ids).all()


def brute_links(x, least):
    n = len(x)
    ok = [v is not None and len(v) > 0 and all(c is not None and math.isfinite(c) for c in v) and any(v) for v in x]
    unit = [np.array(v, float) / np.linalg.norm(v) if o else None for v, o in zip(x, ok)]
    near = np.zeros((n, n), bool)
    for i in range(n):
        for j in range(n):
            near[i, j] = i != j and ok[i] and ok[j] and len(x[i]) == len(x[j]) and unit[i] @ unit[j] >= least
    return near, brute_roots(n, lambda i, j: near[i, j])


@pytest.fixture(scope="module")
def vectors(spark):
    prepare(spark)
    rng = np.random.default_rng(4)
    base = rng.normal(size=(20, 64))
    x = [list(map(float, b)) for b in base]
    x += [list(map(float, base[i % 4] + 0.15 * rng.normal(size=64))) for i in range(40)]
    x += [x[0], x[0], [2 * c for c in x[1]], None, [], [0.0] * 64, [math.nan] * 64, [None] * 64, [math.inf] + [0.0] * 63, [1.0, 0.0], [1.0, 0.01]]
    rows = [(i, v, 1, "clash") for i, v in enumerate(x)] + [(5, x[5], 1, "again"), (6, x[7], 1, "same id")]
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, rep string")


def test_lattice_links_equal_brute_force(vectors, monkeypatch):
    monkeypatch.setattr(lattice_dedup, "PART", 8)
    rows = sorted(((r.vec_id, r.embedding) for r in vectors.collect()), key=lambda r: (r[0], r[1] or []))
    near, root = brute_links([v for _, v in rows], 0.95)
    want = sorted((d, int(near[i].sum()), rows[root[i]][0]) for i, (d, _) in enumerate(rows))
    got = lattice_dedup.near_vectors(vectors).collect()
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in got) == want
    assert all(r.kept == (r.vec_id == r.component_id) for r in got)
    assert not lattice_dedup.near_vectors(vectors.limit(0)).count()


def test_e8_decoder_finds_the_nearest_point():
    y = np.random.default_rng(0).normal(0, 2, (500, 8))
    p = lattice_dedup.nearest_e8(y)
    d = ((y - p) ** 2).sum(axis=1)
    assert d.max() <= 1 + 1e-9 and all((d <= ((y - p - v) ** 2).sum(axis=1) + 1e-12).all() for v in lattice_dedup._ROOTS)


def test_lattice_recall_at_the_threshold():
    rng = np.random.default_rng(8)
    x = rng.normal(size=(600, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    n = rng.normal(size=x.shape)
    n -= (n * x).sum(axis=1, keepdims=True) * x
    n /= np.linalg.norm(n, axis=1, keepdims=True)
    grid = lattice_dedup.Lattice(64)
    a, b = grid.cells(x), grid.cells(0.95 * x + math.sqrt(1 - 0.95**2) * n)
    assert ((a[:, :, :1] == b).any(axis=2) | (b[:, :, :1] == a).any(axis=2)).any(axis=1).mean() >= 0.97


def test_codec_takes_any_32_bit_id():
    rng = np.random.default_rng(12)
    for ids in (rng.integers(0, 1 << 32, 70_000, dtype=np.uint32), rng.integers(100_000, 300_000, 5000).astype(np.uint32), np.full(3, (1 << 32) - 1, np.uint32)):
        got, lengths, keys = id_codec.decode_block(id_codec.encode_block(ids, np.array([len(ids)]), np.array([4])))
        assert (got == ids).all() and lengths.tolist() == [len(ids)] and keys.tolist() == [4]


def test_cross_polytope_recall_and_scores(spark, vectors):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(1500, 64)) * rng.uniform(0.5, 1, (1500, 1))
    df = spark.createDataFrame([(i, list(map(float, v))) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = cross_polytope.nearest_vectors(df, lambda i: i % 20 == 0, 20).collect()
    score = x @ x.T
    hits = 0
    for q in range(0, 1500, 20):
        own = sorted((r.rank, r.vec_id, r.score) for r in got if r.query_id == q)
        assert [r for r, _, _ in own] == list(range(1, 21)) and [s for _, _, s in own] == sorted((s for _, _, s in own), reverse=True)
        assert all(abs(s - score[q, v]) < 1e-9 and v != q for _, v, s in own)
        hits += len({v for _, v, _ in own} & set(sorted((i for i in range(1500) if i != q), key=lambda i: (-score[q, i], i))[:20]))
    assert hits / (75 * 20) >= 0.9
    few = cross_polytope.nearest_vectors(vectors, lambda i: i == 0, 5).orderBy("rank").collect()
    assert [r.vec_id for r in few][:2] == [60, 61] or few[0].score >= few[1].score
    assert not cross_polytope.nearest_vectors(vectors.limit(0), lambda i: i == 0, 5).count()


@pytest.mark.parametrize("norms", ["outlier", "lognormal"])
def test_cross_polytope_recall_under_skewed_norms(spark, norms):
    prepare(spark)
    rng = np.random.default_rng(8)
    x = rng.normal(size=(3000, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    if norms == "outlier":
        x[7] *= 100
    else:
        x *= rng.lognormal(0, 1, (3000, 1))
    df = spark.createDataFrame([(i, list(map(float, v))) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = {}
    for r in cross_polytope.nearest_vectors(df, lambda i: i % 30 == 0, 20).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    score = x @ x.T
    np.fill_diagonal(score, -np.inf)
    hits = [len(got.get(q, set()) & set(np.argsort(-score[q])[:20].tolist())) for q in range(0, 3000, 30)]
    assert sum(hits) / (100 * 20) >= 0.9


@pytest.mark.parametrize("sf", ["0.001", "0.01", "0.1"])
def test_ann_query_recall_on_whole_tables(spark, sf):
    """The registered query against all inner products; small tables take the index as well."""
    from citymarts.llm.queries import op4_cross_polytope_ann

    got = {}
    for r in op4_cross_polytope_ann(spark, f"/root/testdata/sf{sf}").collect():
        got.setdefault(r.query_id, {})[r.vec_id] = r.score
    rows = spark.read.parquet(f"/root/testdata/sf{sf}/embeddings.parquet").select("vec_id", "embedding").collect()
    rows = [(r.vec_id, r.embedding) for r in rows if r.embedding and all(c is not None and math.isfinite(c) for c in r.embedding) and any(r.embedding)]
    ids, x = np.array([i for i, _ in rows]), np.array([v for _, v in rows], float)
    queries = np.flatnonzero(ids % 20 == 0)
    assert set(got) == set(ids[queries].tolist())
    hits = 0
    for q in queries:
        score = x @ x[q]
        score[q] = -np.inf
        best = set(ids[np.lexsort((ids, -score))[:20]].tolist())
        own = got[int(ids[q])]
        assert len(own) == min(20, len(ids) - 1) and all(abs(s - x[np.flatnonzero(ids == v)[0]] @ x[q]) < 1e-9 for v, s in own.items())
        hits += len(best & set(own))
    assert hits >= 0.9 * 20 * len(queries)


def test_cross_polytope_always_returns_all_candidates_there_are(spark, monkeypatch):
    prepare(spark)
    monkeypatch.setattr(cross_polytope, "PART", 8)
    x = np.random.default_rng(9).normal(size=(35, 64))
    x = [v / np.linalg.norm(v) for v in x[:21]] + [v[:5] for v in x[21:]]
    df = spark.createDataFrame([(i, list(map(float, v))) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = {}
    for r in cross_polytope.nearest_vectors(df, lambda i: i >= 0, 20).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append(r.vec_id)
    for q, v in enumerate(x):
        others = [i for i in range(len(x)) if i != q and len(x[i]) == len(v)]
        assert got[q] == sorted(others, key=lambda i: -float(v @ x[i]))


def test_quality_learns_and_ignores_held_out(spark):
    prepare(spark)
    docs = [(i, prose(60, i).upper().replace(" ", "!! ") if i % 2 else prose(60, i)) for i in range(300)] + [(900, None), (901, "")]
    docs = spark.createDataFrame(docs, "doc_id long, text string")
    labels = docs.where("doc_id < 300").select("doc_id", (1 - F.col("doc_id") % 2).cast("int").alias("quality"), F.lit(0).alias("toxic"))
    held = {r.doc_id for r in docs.where(quality.held_out()).collect()}
    assert held == {r.doc_id for r in docs.collect() if zlib.crc32(str(r.doc_id).encode()) % 3 == 1}
    vectors, net = quality.fit(docs, labels)
    got = {r.doc_id: r.score for r in quality.score(docs, vectors, net, ["doc_id"]).collect()}
    assert len(got) == 302 and all(0 <= s <= 1 for s in got.values())
    assert all((got[i] >= 0.5) == (i % 2 == 0) for i in held if i < 300)
    flipped = labels.withColumn("quality", F.when(quality.held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
    _, other = quality.fit(docs, flipped)
    assert {r.doc_id: r.score for r in quality.score(docs, vectors, other, ["doc_id"]).collect()} == got
    _, none = quality.fit(docs, labels.limit(0))
    assert {r.score for r in quality.score(docs, vectors, none, ["doc_id"]).collect()} == {0.5}


def test_language_fuses_evidence(spark, corpus):
    prepare(spark)
    en, de = "the house and the river with a long road that ", "das haus und der fluss mit einer langen straße die "
    docs = [(i, (en if i % 2 else de) * 4, "en-US" if i % 2 else "DE", f"h{i % 4}") for i in range(40)]
    docs += [(100, en * 4, None, "new host"), (101, de * 4, "en", "h1"), (102, None, "en", "h1"), (103, "12 34 !!", "de", "h2"), (104, en, "??", None)]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string")
    got = {r.doc_id: r for r in language_id.identify(df, ["doc_id"], F.col("text"), F.col("lang"), F.col("source")).collect()}
    assert all(got[i].language == ("en" if i % 2 else "de") and got[i].kept for i in range(40))
    assert got[100].language == "en" and got[101].language == "de" and got[104].language == "en"
    assert not got[102].kept and not got[103].kept and got[102].language is None
    assert language_id.identify(corpus, ["doc_id"], F.col("text"), F.col("lang"), F.col("source")).count() == corpus.count()
    assert not language_id.identify(df.limit(0), ["doc_id"], F.col("text"), F.col("lang")).count()
    page = spark.createDataFrame([(1, "http://a.b.de:80/x?y", '<!DOCTYPE html><html class="x" LANG="de-AT"><p>Haus<script>bad</script></p>')], "id int, url string, html string")
    text, declared, host, suffix = language_id.page_columns()
    row = page.select(F.trim(text), declared, host, suffix).first()
    assert tuple(row) == ("Haus", "de-AT", "a.b.de", "de")


def test_every_declared_language_is_told_apart(spark):
    prepare(spark)
    codes = "aa ab af am ar az be bg bn br bs ca cs cy da de el en eo es et eu fa fi fr ga gl gu ha he hi hr hu hy id is it ja ka kk km kn ko ky la lb lo lt lv".split()
    codes += "mg mk ml mn mr ms mt my ne nl no pl pt ro ru sk sl sq sr sv sw ta te th tr uk ur ceb fil".split()
    letters = "abcdefghijklmnopqrstuvwxyz"

    def words(i):
        own = np.random.default_rng(i)
        return " ".join("".join(own.choice(list(letters), 7)) for _ in range(12))

    docs = [(i * 10 + k, words(i) * 2, c) for i, c in enumerate(codes) for k in range(3 if i < 64 else 2)]
    docs += [(9000, words(500), "xx"), (9001, words(500), "und"), (9002, words(77), None)]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string")
    got = {r.doc_id: r for r in language_id.identify(df, ["doc_id"], F.col("text"), F.col("lang")).collect()}
    assert len(codes) > 64 and all(got[i].language == c and got[i].kept for i, _, c in docs if i < 9000)
    assert got[9000].language in codes and got[9001].language in codes and got[9002].language == codes[77]


def test_codes_of_no_language_make_no_class(spark):
    prepare(spark)
    letters = "abcdefghijklmnopqrstuvwxyz"
    junk = [a + b + c for a in "xqj" for b in letters for c in letters]
    junk = [c for c in junk if c not in language_id.LANGUAGES and c not in language_id.SAME]
    docs = [(i, "the house and the river with a long road ", "eng" if i % 2 else "en-GB") for i in range(20)]
    docs += [(20 + i, "das haus und der fluss mit einer straße ", "ger" if i % 2 else "de") for i in range(20)]
    docs += [(100 + i, "the house and a long river road ", c) for i, c in enumerate(junk)]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string")
    rows = language_id.evidence_rows(df, F.col("text"), F.col("lang"), None, None, ["doc_id"])
    known, _ = language_id.gather(rows)
    assert sorted(known.languages) == ["de", "en"]
    got = {r.doc_id: r for r in language_id.identify(df, ["doc_id"], F.col("text"), F.col("lang")).collect()}
    assert all(got[i].language == ("de" if 20 <= i < 40 else "en") and got[i].kept for i, _, _ in docs)


def test_short_texts_are_judged_by_their_other_evidence(spark):
    prepare(spark)
    docs = [(i, "the house and the river " if i % 2 else "das haus und der fluss ", "en" if i % 2 else "de", f"h{i % 2}") for i in range(40)]
    docs += [(100, "A.", "en", "h1"), (101, "b", "de", "h0"), (102, "7.", "en", "h1"), (103, "é", "en", "h1"), (104, "", "de", "h0")]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string")
    got = {r.doc_id: (r.language, r.kept) for r in language_id.identify(df, ["doc_id"], F.col("text"), F.col("lang"), F.col("source")).collect()}
    assert [got[i] for i in range(100, 105)] == [("en", True), ("de", True), (None, False), ("en", True), (None, False)]
