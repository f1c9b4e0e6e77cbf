"""The corpus pipeline on a small table, stage by stage."""

import numpy as np
import pytest

import corpus_pipeline
from citymarts.llm import stages
from citymarts.llm.common import table

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def kept(spark):
    docs = table(spark, SF, "documents")
    out = [docs.toPandas()]
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
        frame = docs.toPandas()
        out.append(frame)
        if name != "packing":
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    return out


def test_stages_in_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality classifier", "language ID", "SimHash near-dedup", "suffix-array dedup", "packing"]
    assert corpus_pipeline.ORACLE_SQL is None


def test_clean_documents_stay_and_junk_goes(spark, kept):
    labels = table(spark, SF, "labels").toPandas().set_index("doc_id").quality
    stayed = set(kept[1].doc_id)
    good, bad = set(labels[labels == 1].index), set(labels[labels == 0].index)
    assert len(good - stayed) <= 0.02 * len(good) and len(bad & stayed) <= 0.3 * len(bad)
    assert len(kept[2]) >= 0.98 * len(kept[1])


def test_one_of_each_group_stays(spark, kept):
    from citymarts.llm.simhash_dedup import simhash_groups

    before = spark.createDataFrame(kept[2])
    groups = simhash_groups(before).toPandas()
    assert set(kept[3].doc_id) == set(groups.component_id) and kept[3].doc_id.is_unique


def test_no_long_string_repeats_after_dedup(kept):
    assert len(kept[4]) == len(kept[3])
    assert (kept[4].n_chars == kept[4].text.str.len()).all()
    assert kept[4].text.str.len().sum() <= kept[3].text.str.len().sum()


def test_every_kept_document_is_packed(kept):
    pieces = kept[5]
    assert set(pieces.doc_id) == set(kept[4].doc_id)
    assert (pieces.groupby("doc_id").length.sum() == pieces.groupby("doc_id").doc_tokens.first()).all()
    assert pieces.groupby("sequence_id").length.sum().max() <= 4096


def test_repeated_rows_and_nulls_pass_every_stage(spark):
    row = ("word " * 30, "en", "s", 1)
    rows = [(1, *row), (1, *row), (None, *row), (2, None, None, None, None), (3, "", "en", "s", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    one = stages.one_of_near_copies(spark, docs, SF).collect()
    assert len(one) == 2 and len({r.text or "" for r in one}) == 2
    assert stages.known_language(spark, docs, SF).count() == 3
    assert stages.without_repeats(spark, docs, SF).count() == 5
    assert np.isclose(stages.packed(spark, docs, SF).toPandas().length.sum(), stages.packed(spark, docs, SF).toPandas().length.sum())
    for _, stage in stages.STAGES:
        assert stage(spark, docs.limit(0), SF).count() == 0
