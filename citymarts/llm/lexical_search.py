"""Ranked lexical search of many items at once, with shared partial sums.

Items (queries) that hold the same terms share work. Terms held by exactly the
same items form a leaf; each item is the row of its leaves, the most shared
first, and pairs of neighbours that several items hold become inner nodes,
round after round, until no pair is shared: a DAG whose nodes are shared term
sets. A document's partial sums are made once per node, leaves from its
terms and inner nodes from their two children, and an item adds up the few
nodes left in its row. Sums are 64-bit integers, so sharing changes nothing.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from citymarts.llm.common import prepare, save

#: UTF-8 bytes of the terms [^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+ after A-Z is lower-cased.
TERM = re.compile(rb"[0-9a-z\x80-\xff]+")
NO_TERM = re.compile(rb"[^0-9a-z\x80-\xff]")
#: A text is counted in windows of about this many bytes, cut between terms.
WINDOW = 4 << 20
#: Items are searched in blocks of about this many bytes of text, one pass over the postings each.
BLOCK_BYTES = 2 << 20
#: Cells (documents x nodes) of the partial sums held at once.
CELLS = 2 << 20
#: A task's best rows meet in this many groups per item before the last ranking.
GROUPS = 512


def count_terms(text: str | None) -> Counter:
    """How often each term (as UTF-8 bytes) occurs in the whole text; NULL has none."""
    data = (text or "").encode("utf-8", "surrogatepass").lower()  # bytes: A-Z alone
    if len(data) <= WINDOW:
        return Counter(TERM.findall(data))
    counts, at = Counter(), 0
    while at < len(data):
        gap = NO_TERM.search(data, at + WINDOW)
        end = gap.start() if gap else len(data)
        counts.update(TERM.findall(data, at, end))
        at = end
    return counts


@dataclass
class Plan:
    """Query-sharing DAG of a block of items.

    Nodes 0 .. ``leaves`` - 1 are leaves, ``leaf_of[t]`` the leaf of term t;
    node ``leaves + k`` is the sum of the two nodes ``pairs[k]`` (both before
    it); ``rows[i]`` are the nodes whose sum is item i.
    """

    leaves: int
    leaf_of: np.ndarray
    pairs: list[tuple[int, int]]
    rows: list[list[int]]


def share_terms(items: list[set]) -> tuple[list, Plan]:
    """Terms of ``items`` (in their order of numbers) and the DAG that shares their sets.

    Time grows with the total number of terms in each of the (logarithmically
    many, at most the longest row's length) rounds: only neighbours in the
    order of the most shared leaves are counted, never all pairs.
    """
    holders: dict = {}
    for i, terms in enumerate(items):
        for t in terms:
            holders.setdefault(t, []).append(i)
    terms = sorted(holders)
    by_items: dict = {}
    for t in terms:
        by_items.setdefault(tuple(holders[t]), []).append(t)
    sets = sorted(by_items, key=lambda s: (-len(s), s))
    leaf = {t: k for k, s in enumerate(sets) for t in by_items[s]}
    rows: list[list[int]] = [[] for _ in items]
    for k, s in enumerate(sets):
        for i in s:
            rows[i].append(k)
    pairs: list[tuple[int, int]] = []
    while True:
        seen = Counter(p for row in rows for p in zip(row, row[1:]))
        shared = {p for p, n in seen.items() if n > 1}
        if not shared:
            break
        order = {p: r for r, p in enumerate(sorted(shared, key=lambda p: (-seen[p], p)))}
        # A pair is replaced where it stands before both pairs that overlap it.
        node: dict[tuple[int, int], int] = {}
        for i, row in enumerate(rows):
            rank = [order.get(p, math.inf) for p in zip(row, row[1:])]
            out, j = [], 0
            while j < len(row):
                if j < len(rank) and rank[j] < math.inf and (j + 1 >= len(rank) or rank[j] <= rank[j + 1]):
                    p = (row[j], row[j + 1])
                    if p not in node:
                        node[p] = len(sets) + len(pairs)
                        pairs.append(p)
                    out.append(node[p])
                    j += 2
                else:
                    out.append(row[j])
                    j += 1
            rows[i] = out
    return terms, Plan(len(sets), np.array([leaf[t] for t in terms], np.int64), pairs, rows)


def term_postings(docs: DataFrame, doc_id: str, text: str, terms: list[bytes]) -> DataFrame:
    """``(doc, n, ids, tfs)`` for every row of ``docs``: its number of terms with
    repeats, and which of ``terms`` it holds how often. Reads whole texts; nothing is shuffled."""
    number = {t: k for k, t in enumerate(terms)}

    def run(batches):
        for b in batches:
            n, ids, tfs = [], [], []
            for t in b.column(1):
                counts = count_terms(t.as_py())
                n.append(sum(counts.values()))
                held = sorted((number[t], counts[t]) for t in number.keys() & counts.keys())
                ids.append([k for k, _ in held])
                tfs.append([f for _, f in held])
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n, pa.int64()), pa.array(ids, pa.list_(pa.int32())), pa.array(tfs, pa.list_(pa.int64()))],
                names=["doc", "n", "ids", "tfs"],
            )

    rows = docs.select(F.col(doc_id).cast("long").alias("doc"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc long, n long, ids array<int>, tfs array<long>")


def term_weights(df: np.ndarray, n_docs: int) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(d) + 1))) for d in df], np.int64)


def partial_sums(plan: Plan, doc: np.ndarray, term: np.ndarray, parts: np.ndarray, n_docs: int) -> np.ndarray:
    """(items, documents) scores: ``parts`` are the terms' shares of the score, made to sums node by node."""
    nodes = np.zeros((plan.leaves + len(plan.pairs), n_docs), np.int64)
    np.add.at(nodes, (plan.leaf_of[term], doc), parts)
    for k, (a, b) in enumerate(plan.pairs):
        np.add(nodes[a], nodes[b], out=nodes[plan.leaves + k])
    scores = np.zeros((len(plan.rows), n_docs), np.int64)
    for i, row in enumerate(plan.rows):
        for k in row:
            scores[i] += nodes[k]
    return scores


def _best(item, score, doc, null, top: int):
    """The first ``top`` of each item: larger score, then smaller document, NULL last."""
    order = np.lexsort((doc, null, -score, item))
    item, score, doc, null = item[order], score[order], doc[order], null[order]
    first = np.searchsorted(item, item, side="left")
    keep = np.arange(len(item)) - first < top
    return item[keep], score[keep], doc[keep], null[keep]


def _rank_block(postings: DataFrame, plan: Plan, weights: np.ndarray, n_docs: int, n_terms: int, top: int) -> DataFrame:
    """``(item, score, doc)``: the best of every task."""

    def run(batches):
        best = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool))
        least = np.ones(len(plan.rows), np.int64)  # a score above 0, later the last of the best
        step = max(1, CELLS // (plan.leaves + len(plan.pairs) + len(plan.rows)))
        for b in batches:
            for at in range(0, b.num_rows, step):
                part = b.slice(at, step)
                ids, tfs = part.column(2).flatten().to_numpy(), part.column(3).flatten().to_numpy()
                sizes = np.array(part.column(2).value_lengths())
                n = part.column(1).to_numpy()
                m = 10 + 90 * n * n_docs // n_terms
                own = np.repeat(np.arange(part.num_rows), sizes)
                parts = weights[ids] * (1_000_000_000 * tfs // (1000 * tfs + 8 * m[own]))
                scores = partial_sums(plan, own, ids, parts, part.num_rows)
                item, row = np.nonzero(scores >= least[:, None])
                if not len(item):
                    continue
                docs = part.column(0)
                null = docs.is_null().to_numpy(zero_copy_only=False)
                docs = docs.fill_null(0).to_numpy()
                new = (item, scores[item, row], docs[row], null[row])
                best = _best(*(np.concatenate(x) for x in zip(best, new)), top)
                counts = np.bincount(best[0], minlength=len(least))
                full = np.flatnonzero(counts >= top)
                least[full] = best[1][np.searchsorted(best[0], full, side="right") - 1]
        item, score, doc, null = best
        yield pa.RecordBatch.from_arrays(
            [pa.array(item, pa.int32()), pa.array(score, pa.int64()), pa.array(doc, pa.int64(), mask=null)], names=["item", "score", "doc"]
        )

    return postings.mapInArrow(run, "item int, score long, doc long")


def rank_items(
    docs: DataFrame,
    items: DataFrame,
    top: int = 10,
    doc_id: str = "doc_id",
    item_id: str = "item_id",
    text: str = "text",
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``item_id``, ``rank``, ``doc_id``, ``score``: the ``top`` documents of every item with a score above 0.

    Scores as in the module's contract: over an item's distinct terms the sum
    of ``w * (10**9 tf div (1000 tf + 8 m))`` with
    ``w = floor(1000 ln((2N+2)/(2df+1)))`` and ``m = 10 + (90 n N) div L``; N
    counts documents with a term, L their terms. Highest first, equal scores
    by ascending document id, NULL ids last.

    Every row of ``docs`` is a document (repeated rows and ids count and rank
    each for themselves); NULL and empty texts have no terms. Every distinct
    (id, text) of ``items`` is an item; one without terms gets no rows. Other
    columns are not read, so names cannot clash. Empty tables give no rows.

    Items are taken in blocks of about ``block_bytes`` of text (one item at
    least), told apart by a hash; what a block sends to the tasks (its terms and DAG) is bounded by
    that, not by the tables. Per block: one pass over the texts writes the
    documents' postings of the block's terms to the shared folder, document
    frequencies are counted map-side, and one pass over the postings makes the
    partial sums and keeps each task's ``top`` rows an item. No row of a
    document is shuffled, whatever its size; only best rows are.
    """
    spark = docs.sparkSession
    prepare(spark)
    body = F.col(text).cast("string")
    asked = items.where(body != "").select(F.col(item_id).alias("_item"), body.alias("_text")).distinct()
    asked = save(asked, "search-items")
    size, count = asked.agg(F.coalesce(F.sum(F.octet_length("_text")), F.lit(0)), F.count("*")).first()
    blocks = min(count, 1 + size // block_bytes)
    block = F.pmod(F.xxhash64("_item", "_text"), F.lit(blocks))
    found = []
    for k in range(blocks):
        part = sorted(asked.where(block == k).collect(), key=lambda r: (r["_item"] is None, r["_item"] or 0, r["_text"]))
        terms, plan = share_terms([set(count_terms(r["_text"])) for r in part])
        postings = save(term_postings(docs, doc_id, text, terms), "search-postings") if terms else None
        n_docs, n_terms = postings.agg(F.count_if(F.col("n") > 0), F.sum("n")).first() if terms else (0, 0)
        if not n_docs:
            continue
        df = np.zeros(len(terms), np.int64)
        for t, c in postings.select(F.explode("ids").alias("t")).groupBy("t").count().collect():  # at most one row a term
            df[t] = c
        best = _rank_block(postings, plan, term_weights(df, n_docs), n_docs, n_terms, top)
        best = _first(best.withColumn("_group", F.pmod(F.spark_partition_id(), F.lit(GROUPS))), ["item", "_group"], top)
        named = spark.createDataFrame([(i, r["_item"]) for i, r in enumerate(part)], asked.select(F.lit(0).alias("item"), "_item").schema)
        ranked = _first(best.drop("rank"), ["item"], top).join(F.broadcast(named), "item")
        found.append(ranked.select(F.col("_item").alias(item_id), "rank", F.col("doc").alias(doc_id), "score"))
    if not found:
        none = {item_id: items.schema[item_id].dataType, "rank": "int", doc_id: "long", "score": "long"}
        return spark.range(0).select(*(F.lit(None).cast(t).alias(c) for c, t in none.items()))
    return reduce(DataFrame.unionByName, found)


def _first(rows: DataFrame, by: list[str], top: int) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.desc("score"), F.asc_nulls_last("doc"))
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
