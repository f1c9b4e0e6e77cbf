"""Quality classifier: words, pooling and the query against brute force and held-out labels."""

import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from citymarts.llm import quality, queries
from citymarts.llm.common import table

SF = "/root/testdata/sf0.01"
TEXTS = ["One two, two 1200 3!", "", None, "  \n", "naïve Größe 9.", "x", "a b " * 9000, "A" * 700 + " ,,"]


def split(text):
    """Words by a regular expression over UTF-8 bytes, digits as zeros."""
    found = re.findall(rb"[A-Za-z\x80-\xff]+|[0-9]+|[^A-Za-z0-9\x80-\xff\x20\x09-\x0d]", (text or "").encode())
    return [re.sub(rb"[0-9]", b"0", w) for w in found]


def test_words_are_letter_runs_digit_runs_and_single_characters():
    of = {}
    (_, last, (doc, word)), = quality.chunks(pa.array(TEXTS))
    assert last == len(TEXTS)
    for i, text in enumerate(TEXTS):
        own = word[doc == i].tolist()
        assert len(own) == len(split(text))
        for w, h in zip(split(text), own):
            assert of.setdefault(w, h) == h
    assert len(set(of.values())) == len(of)


@pytest.mark.parametrize("size", [1, 7, 4096])
def test_pooling_equals_brute_force_for_any_slice(monkeypatch, size):
    monkeypatch.setattr(quality, "POOL_WORDS", size)
    vectors = np.random.default_rng(3).integers(-256, 257, (quality.ROWS, quality.DIM)).astype(np.int32)
    texts = [t[:300] if t else t for t in TEXTS]
    (_, _, found), = quality.chunks(pa.array(texts))
    got = quality.pooled(found, len(texts), vectors)
    for i in range(len(texts)):
        v = vectors[quality._row(found[1][found[0] == i])] * quality.GRAIN
        n = max(1, len(v))
        assert np.allclose(got[i], np.concatenate([v.sum(axis=0) / n, (v[:-1] * v[1:]).sum(axis=0) / n]), atol=1e-12)


def test_context_vectors_equal_brute_force(spark):
    texts = ["the cat sat, the cat", "cat the", None, "", "12 34 the"]
    got = quality.context_vectors(spark.createDataFrame([(t,) for t in texts * 3], "text string").repartition(4))
    total = np.zeros((quality.ROWS, quality.DIM))
    for t in texts * 3:
        (_, _, (_, word)), = quality.chunks(pa.array([t])) if split(t) else [(0, 1, (None, np.zeros(0, np.uint64)))]
        row = quality._row(word)
        for i, me in enumerate(row):
            for j in (i - 2, i - 1, i + 1, i + 2):
                if 0 <= j < len(row):
                    for at, sign in zip(quality._INDEX_AT[row[j]], quality._INDEX_SIGN[row[j]]):
                        total[me, (at + (quality.DIM // 2 if j > i else 0)) % quality.DIM] += sign
    total = np.sign(total) * np.log1p(np.abs(total))
    norm = np.linalg.norm(total, axis=1, keepdims=True)
    assert (got == np.round(total / np.where(norm > 0, norm, 1) / quality.GRAIN)).all()


def test_query_tells_held_out_labels(spark):
    got = queries.op6_quality_classifier(spark, SF).toPandas().set_index("doc_id")
    assert len(got) == table(spark, SF, "documents").count() and got.score.between(0, 1).all()
    assert (got.held_out == [zlib.crc32(str(i).encode()) % 3 == 1 for i in got.index]).all()
    assert (got.predicted == (got.score >= 0.5)).all()
    labels = table(spark, SF, "labels").toPandas().drop_duplicates("doc_id").set_index("doc_id").quality
    both = got[got.held_out].join(labels, how="inner")
    assert len(both) >= 100 and (both.predicted == both.quality).mean() >= 0.97


def test_equal_texts_score_alike_wherever_they_stand(spark):
    docs = table(spark, SF, "documents").select("doc_id", "text").limit(200)
    twice = docs.unionByName(docs.selectExpr("-1 - doc_id", "text").toDF("doc_id", "text")).repartition(7)
    vectors, net = quality.fit(docs, table(spark, SF, "labels"))
    got = quality.score(twice, vectors, net, ["doc_id"]).toPandas().set_index("doc_id").score
    assert np.allclose(got[got.index >= 0].sort_index(), got[got.index < 0].sort_index(ascending=False), atol=1e-12)
