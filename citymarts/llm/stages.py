"""Stages of the corpus pipeline; each calls one operator of this folder.

Every stage takes ``(spark, docs, sf_dir)``; all but the last return the
columns of ``documents`` (extra columns pass through).
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citymarts.llm import language_id, packing, quality, simhash_dedup, suffix_dedup
from citymarts.llm.common import prepare, row_key, table


def renamed(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with names of this module's own, and the new name of each column:
    no operator's column can clash with one of ``docs``."""
    names = {c: f"c{i}" for i, c in enumerate(docs.columns)}
    return docs.select(*(F.col(f"`{c}`").alias(n) for c, n in names.items())), names


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier scores 0.5 or more."""
    plain, name = renamed(docs)
    vectors, network = quality.fit(docs, table(spark, sf_dir, "labels"))
    scored = quality.score(plain, vectors, network, plain.columns, name["text"])
    return scored.where("score >= 0.5").select(*plain.columns).toDF(*docs.columns)


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told with confidence; the declared language
    and the source are the evidence beside the text. What a row is judged by
    makes its key, so equal rows fare alike."""
    plain, name = renamed(docs)
    key = F.xxhash64(*(name[c] for c in ("doc_id", "text", "lang", "source")))
    named = plain.select("*", key.alias("row_key"))
    evidence = (F.col(name[c]) for c in ("text", "lang", "source"))
    found = language_id.identify(named, [name["doc_id"], "row_key"], *evidence)
    gone = found.where("not kept").select(F.col(name["doc_id"]).alias("gone_id"), F.col("row_key").alias("gone_key")).distinct()
    same = (named["row_key"] == gone["gone_key"]) & named[name["doc_id"]].eqNullSafe(gone["gone_id"])
    return named.join(gone, same, "left_anti").select(*plain.columns).toDF(*docs.columns)


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of every SimHash group."""
    prepare(spark)
    plain, name = renamed(docs)
    rows = row_key(plain, name["doc_id"], name["text"])
    groups = simhash_dedup.simhash_groups(rows, "_rid", name["text"])
    gone = groups.where("component_id <> _rid").select("_rid")
    return rows.join(gone, "_rid", "left_anti").select(*plain.columns).toDF(*docs.columns)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without repeated byte strings; a character that lost a byte goes, ``n_chars`` is counted anew."""
    plain, name = renamed(docs)
    rest = [n for c, n in name.items() if c not in ("text", "n_chars")]
    texts = suffix_dedup.remove_repeats(plain, rest, name["doc_id"], name["text"], as_text=True)
    back = {"text": F.col("kept"), "n_chars": F.length("kept").cast(docs.schema["n_chars"].dataType) if "n_chars" in name else None}
    return texts.select(*(back.get(c, F.col(n)).alias(c) for c, n in name.items()))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of packed sequences with their ids' checksum."""
    prepare(spark)
    return piece_digest(packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json")))


def piece_digest(pieces: DataFrame) -> DataFrame:
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


STAGES = [
    ("quality classifier", good_documents),
    ("language ID", known_language),
    ("SimHash near-dedup", one_of_near_copies),
    ("suffix-array dedup", without_repeats),
    ("packing", packed),
]
