"""Token-id files: documents in key order, in blocks of the context-mixing codec.

Writing sorts the documents by range of key, tokenizes them and codes whole
documents into blocks; Spark commits the blocks as rows of a Parquet table in
the given folder (so a lost task is simply redone). Reading decodes the blocks
again and gives every document its position in the whole stream.
"""

from __future__ import annotations

from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from citymarts.llm.common import roomy_heap, row_key, texts
from citymarts.llm.id_codec import decode_block, encode_block
from citymarts.llm.tokens import tokenizer

#: Ids of a block, reached with whole documents (a longer document is a block of its own).
BLOCK_IDS = 3 << 20
#: Bytes of text tokenized at a time: a whole Arrow batch (BATCH_BYTES), as each call has its fixed cost.
TEXT_BYTES = 10_000_000
#: A task's arrays are about the size of a block or of its text: so much heap stays with it while it runs.
HEAP_KEPT, HEAP_ARRAYS = 48 << 20, 24 << 20
END_ID = 0
#: Stands for a NULL key in a block.
NO_KEY = -(1 << 63)
FORMAT = "part int, block int, n_docs long, n_ids long, data binary"


def write_ids(
    df: DataFrame, folder: str, path: str, end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text", block_ids: int = BLOCK_IDS
) -> None:
    """Write the ids of every whole text, each with ``end_id`` after it, to ``folder``.

    Documents come in ascending key order; rows of one key in the order of
    their texts, a NULL key first. NULL and empty texts are their end id alone.
    Other columns are not read.
    """

    def run(batches):
        tok, part, block = tokenizer(path, False), TaskContext.get().partitionId(), 0
        end = np.array([end_id], "<u4").tobytes()
        keys: list[int] = []
        ids: list[bytes] = []
        held = 0

        def flush():
            lengths = np.array([len(x) // 4 for x in ids], np.int64)
            joined, docs = b"".join(ids), np.array(keys, np.int64)
            keys.clear()
            ids.clear()
            data = encode_block(np.frombuffer(joined, "<u4"), lengths, docs)
            row = [[part], [block], [len(docs)], [int(lengths.sum())], [data]]
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(row, kinds)], names=["part", "block", "n_docs", "n_ids", "data"])

        for b in batches:
            for at, some in texts(b.column(1), TEXT_BYTES):
                own = b.column(0).slice(at, len(some)).fill_null(NO_KEY).to_pylist()
                for key, got in zip(own, tok.encode(some)):
                    keys.append(key)
                    ids.append(got + end)
                    held += len(got) // 4 + 1
                    if held >= block_ids:
                        yield flush()
                        block, held = block + 1, 0
        if keys:
            yield flush()

    docs = df.select(F.col(id_col).cast("long").alias("_key"), F.col(text_col).cast("string").alias("_text"))
    docs = row_key(docs, "_key", "_text").repartitionByRange("_rid").sortWithinPartitions("_rid")
    docs.select("_key", "_text").mapInArrow(roomy_heap(run, HEAP_KEPT, HEAP_ARRAYS), FORMAT).write.parquet(folder)


def read_ids(spark: SparkSession, folder: str, id_col: str = "doc_id") -> DataFrame:
    """``(id_col, start, ids)`` per document from the files: ``start`` is the
    number of ids of all documents before it, ``ids`` its ids (with the end
    id) as little-endian unsigned 32-bit bytes. Damaged blocks fail."""
    blocks = spark.read.schema(FORMAT).parquet(folder)
    index = blocks.select("part", "block", "n_ids")
    # one number per written part reaches the driver
    sums = sorted((r.part, r.n) for r in index.groupBy("part").agg(F.sum("n_ids").alias("n")).collect())
    base = dict(zip((p for p, _ in sums), accumulate([0, *(n for _, n in sums)])))
    inside = Window.partitionBy("part").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    shift = index.select("part", "block", F.coalesce(F.sum("n_ids").over(inside), F.lit(0)).alias("before"))

    def run(batches):
        for b in batches:
            part, before, data = (b.column(i).to_pylist() for i in range(3))
            for p, s, block in zip(part, before, data):
                ids, lengths, keys = decode_block(block)
                starts = np.cumsum(lengths) - lengths
                raw = ids.astype("<u4").tobytes()
                for i in range(0, len(keys), 256):
                    k = slice(i, min(len(keys), i + 256))
                    own = [raw[4 * x : 4 * (x + n)] for x, n in zip(starts[k].tolist(), lengths[k].tolist())]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(keys[k], mask=keys[k] == NO_KEY), pa.array(starts[k] + (base[p] + s)), pa.array(own, pa.binary())], names=[id_col, "start", "ids"]
                    )

    return blocks.join(shift, ["part", "block"]).select("part", "before", "data").mapInArrow(roomy_heap(run, HEAP_KEPT, HEAP_ARRAYS), f"`{id_col}` long, start long, ids binary")
