"""Corpus pipeline: documents -> quality -> language -> near copies -> repeats -> packed sequences.

``STAGES`` lists (name, function); each function takes ``(spark, docs,
sf_dir)`` and returns a DataFrame, written as Parquet and reread as the next
one's ``docs``. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from citymarts.llm.common import save, table
from citymarts.llm.stages import STAGES

#: A tokenizer, a trained network and suffix sorting are beyond SQL; the operators
#: behind the stages are tested by brute force, round trips and held-out accuracy.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply ``STAGES`` in order to the documents table."""
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = save(docs, f"stage-{name.replace(' ', '-')}")
    return docs
