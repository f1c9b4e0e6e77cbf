"""Registered queries of this folder: ``(spark, sf_dir) -> DataFrame``.

Each applies its operator, with production parameters, to the whole of its
table and derives the digest columns from the operator's output.
``ORACLE_SQL`` (see ``oracle_sql``) holds DuckDB SQL where SQL can express the result.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citymarts.llm import (
    byte_bpe, cross_polytope, fill_middle, id_files, language_id, lattice_dedup, lexical_search, packing, quality, sharding, simhash_dedup,
    suffix_dedup, url_rules,
)
from citymarts.llm.common import scratch, table
from citymarts.llm.oracle_sql import ORACLE_SQL  # noqa: F401
from citymarts.llm.stages import piece_digest

SHARDS = 24
QUERY_EVERY = 20
NEIGHBOURS = 20
RANKED = 10
URL_RULES = [
    (url_rules.ALLOW, "org/"),
    (url_rules.BLOCK, "example.org/es/"),
    (url_rules.BLOCK, "example.org/en/1"),
    (url_rules.ALLOW, "com/fr/"),
    (url_rules.BLOCK, "com/de/"),
]


def op1_lattice_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links of cosine 0.95 or more between all vectors, by E8 lattice hashing."""
    return lattice_dedup.near_vectors(table(spark, sf_dir, "embeddings"))


def op2_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the 100-byte strings that start earlier in the corpus."""
    left = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"), ["doc_id"])
    return left.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op3_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash fingerprints and their groups at two differing bits."""
    return simhash_dedup.simhash_groups(table(spark, sf_dir, "documents"))


def op4_cross_polytope_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest vectors of every twentieth vector."""
    return cross_polytope.nearest_vectors(table(spark, sf_dir, "embeddings"), lambda i: i % QUERY_EVERY == 0, NEIGHBOURS)


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Byte-level BPE ids of every document, and what they decode to."""
    path, pattern = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    ids = byte_bpe.encode_texts(table(spark, sf_dir, "documents"), path, pattern)
    both = byte_bpe.decode_ids(ids, path, pattern)
    return both.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document, learned from rows that are not held out."""
    docs = table(spark, sf_dir, "documents")
    vectors, network = quality.fit(docs, table(spark, sf_dir, "labels"))
    scored = quality.score(docs, vectors, network, ["doc_id"])
    return scored.select("doc_id", quality.held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 4096 ids."""
    docs = table(spark, sf_dir, "documents")
    return piece_digest(packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json")))


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents written as files of context-mixed id blocks and read back."""
    folder = scratch(spark, "ids")
    id_files.write_ids(table(spark, sf_dir, "documents"), folder, public_tokenizers.path("byte_bpe_50k.json"))
    back = id_files.read_ids(spark, folder)
    return back.select(
        F.col("doc_id"), "start", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.crc32("ids").alias("ids_crc32")
    )


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document; its declared language and source are the evidence beside the text."""
    docs = table(spark, sf_dir, "documents")
    return language_id.identify(docs, ["doc_id"], F.col("text"), F.col("lang"), F.col("source"))


def page_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every raw page, with its markup's language and its address as evidence."""
    return language_id.identify(table(spark, sf_dir, "pages"), ["page_id"], *language_id.page_columns())


def op10_rendezvous_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents on 24 equal shards by key, and where a 25th shard would move them."""
    docs = table(spark, sf_dir, "documents")
    placed = sharding.assign_shards(docs, "doc_id", [1.0] * SHARDS, "text", 1.0)
    return placed.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents of every benchmark item, by weighted terms."""
    return lexical_search.rank_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), RANKED)


def op12_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict of every page's URL: the given rules', else that of the rules mined from the URLs those judge."""
    return url_rules.filter_urls(table(spark, sf_dir, "pages"), rules=URL_RULES)


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as fill-in-the-middle text, and the text rebuilt from it."""
    made = fill_middle.fill_in_middle(table(spark, sf_dir, "documents"))
    return made.select(
        "doc_id",
        "n",
        "form",
        F.char_length("prefix").cast("long").alias("prefix_chars"),
        F.char_length("middle").cast("long").alias("middle_chars"),
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(fill_middle.restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )


QUERIES = {
    "op1_lattice_near_dedup": op1_lattice_near_dedup,
    "op2_suffix_array_dedup": op2_suffix_array_dedup,
    "op3_simhash_near_dedup": op3_simhash_near_dedup,
    "op4_cross_polytope_ann": op4_cross_polytope_ann,
    "op5_byte_bpe": op5_byte_bpe,
    "op6_quality_classifier": op6_quality_classifier,
    "op7_packing": op7_packing,
    "op8_token_files": op8_token_files,
    "op9_language_id": op9_language_id,
    "op10_rendezvous_sharding": op10_rendezvous_sharding,
    "op11_lexical_search": op11_lexical_search,
    "op12_url_rules": op12_url_rules,
    "op13_fill_in_middle": op13_fill_in_middle,
    "page_languages": page_languages,
}
