"""Ranked lexical search of many items at once over all documents.

Items share terms, so their scores share sums. Over the items of a block, term sets that occur in several items are mined:
again and again the pair of nodes (terms or earlier sets) that most items hold together becomes a node of its own, and
those items hold it instead of the two. The result is a DAG: leaves are terms, inner nodes are shared sets, roots are items.
For a batch of documents the accumulator of each node is made once, as the sum of its parts, and serves all nodes and items
above it. Scores are integers, so the order of additions doesn't matter.

A document's terms are its runs of ASCII letters, digits and characters beyond ASCII, with only A to Z lower-cased.
Documents are read once per block of items: the tasks count each document's terms and the items' terms in it and write these
postings; document frequencies and lengths are sums over them. Each scoring task keeps its best documents of every item;
these are merged in groups of tasks, then once more. Blocks hold BLOCK_TERMS terms and the last item's, which bounds what is
sent to the tasks; the driver reads the items one by one.

Null and empty texts have no terms and are in no ranking, and such items have no rows. Equal scores rank by ascending
doc_id, a null doc_id first; repeated rows are documents each, and repeated items are ranked each (an item_id occurs then as
often). Extra columns are passed over; empty tables give empty results.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from roundhouse.llm.common import slices, small_batches, stored
from roundhouse.llm.terms import LETTERS_AND_DIGITS, terms_of

TOP = 20
#: Terms of the items of a block, with repeats; an item with more is a block of its own. With their DAG some 20 MB.
BLOCK_TERMS = 1 << 17
#: Nodes of an item that a node may be paired with: those next in order of frequency.
NEAR = 48
#: Bytes of accumulators that a task holds at a time.
HELD = 32 << 20
#: Groups of tasks whose best documents are merged first.
GROUPS = 64
_POSTING = "doc_id long, n long, terms array<int>, tfs array<int>"
_BEST = "item int, doc_id long, score long"


@dataclass
class SharedPlan:
    """leaves: (term, times); nodes: (left, right), numbered after the leaves in an order in which parts come first; roots: the nodes of each item."""

    leaves: list[tuple[int, int]]
    nodes: list[tuple[int, int]]
    roots: list[list[int]]


def mine(items: list[dict[int, int]]) -> SharedPlan:
    """Shared term sets of items (term -> times). A set is made only where two items or more hold it, so a document never costs more additions than without."""
    leaves = sorted({x for item in items for x in item.items()})
    number = {x: k for k, x in enumerate(leaves)}
    held = [{number[x] for x in item.items()} for item in items]
    owners: dict[int, set[int]] = defaultdict(set)
    for k, own in enumerate(held):
        for node in own:
            owners[node].add(k)
    nodes: list[tuple[int, int]] = []
    while True:
        together: Counter = Counter()
        for own in held:
            order = sorted((x for x in own if len(owners[x]) > 1), key=lambda x: (-len(owners[x]), x))
            for k, a in enumerate(order):
                together.update((a, b) if a < b else (b, a) for b in order[k + 1 : k + 1 + NEAR])
        shared = sorted((x for x in together.items() if x[1] > 1), key=lambda x: (-x[1], x[0]))
        if not shared:
            return SharedPlan(leaves, nodes, [sorted(x) for x in held])
        for (a, b), _ in shared:
            both = owners[a] & owners[b]
            if len(both) < 2:
                continue
            node = len(leaves) + len(nodes)
            nodes.append((a, b))
            owners[node] = both
            for k in both:
                held[k] -= {a, b}
                held[k].add(node)
            owners[a] = owners[a] - both
            owners[b] = owners[b] - both


def additions(plan: SharedPlan) -> int:
    """Additions of accumulators for a document: one per inner node, and per item one less than its roots."""
    return len(plan.nodes) + sum(max(len(x) - 1, 0) for x in plan.roots)


def postings(docs: DataFrame, vocabulary: list[bytes]) -> DataFrame:
    """doc_id, n (all terms), and the vocabulary's terms and their occurrences, of each document that has terms; stored."""
    known = docs.sparkSession.sparkContext.broadcast({t: k for k, t in enumerate(vocabulary)})  # BLOCK_TERMS and one item's terms at most

    def count(batches):
        find = known.value.get
        for batch in slices(batches, 1):
            out = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist(), strict=True):
                n, tf = 0, Counter()
                for words in terms_of(text, LETTERS_AND_DIGITS):
                    n += len(words)
                    tf.update(map(find, words))
                tf.pop(None, None)
                if n:
                    out.append((doc_id, n, list(tf), list(tf.values())))
            kinds = [pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int32())]
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], kind) for k, kind in enumerate(kinds)], names=["doc_id", "n", "terms", "tfs"])

    rows = small_batches(docs).select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(count, _POSTING)
    return stored(rows, "search-postings")


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def impacts(n: np.ndarray, terms: np.ndarray, tfs: np.ndarray, weights: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """The score of one occurrence of each term in an item, for postings (n is the length of each one's document)."""
    m = 75 + 25 * n * n_docs // n_terms
    return weights[terms] * (1_000_000_000 * tfs // (1000 * tfs + 12 * m))


class Best:
    """The `top` best documents of each item so far. least: the score that a further document needs at least."""

    def __init__(self, n_items: int, top: int):
        self.top, self.least = top, np.ones(n_items, np.int64)
        self.item, self.doc, self.known, self.score = (np.zeros(0, kind) for kind in (np.int64, np.int64, bool, np.int64))

    def add(self, item: np.ndarray, doc: np.ndarray, known: np.ndarray, score: np.ndarray) -> None:
        parts = ((self.item, item), (self.doc, doc), (self.known, known), (self.score, score))
        item, doc, known, score = (np.concatenate(x) for x in parts)
        order = np.lexsort((doc, known, -score, item))
        item, doc, known, score = item[order], doc[order], known[order], score[order]
        first = np.searchsorted(item, item)
        rank = np.arange(len(item)) - first
        last = rank == self.top - 1
        self.least[item[last]] = score[last]
        keep = rank < self.top
        self.item, self.doc, self.known, self.score = item[keep], doc[keep], known[keep], score[keep]

    def batch(self) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(self.item, pa.int32()), pa.array(self.doc, pa.int64(), mask=~self.known), pa.array(self.score, pa.int64())], names=["item", "doc_id", "score"])


def accumulate(plan: SharedPlan, batch: pa.RecordBatch, weights: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """The score of each item (rows) for each posting of the batch (columns)."""
    n = batch.column(1).to_numpy()
    held = np.diff(batch.column(2).offsets.to_numpy())
    terms, tfs = (batch.column(k).flatten().to_numpy().astype(np.int64) for k in (2, 3))
    doc = np.repeat(np.arange(len(n)), held)
    single = np.zeros((len(weights), len(n)), np.int64)
    single[terms, doc] = impacts(n[doc], terms, tfs, weights, n_docs, n_terms)
    at = len(plan.leaves)
    sums = np.empty((at + len(plan.nodes), len(n)), np.int64)
    for k, (term, times) in enumerate(plan.leaves):
        np.multiply(single[term], times, out=sums[k])
    for k, (a, b) in enumerate(plan.nodes, at):
        np.add(sums[a], sums[b], out=sums[k])
    out = np.zeros((len(plan.roots), len(n)), np.int64)
    for k, roots in enumerate(plan.roots):
        for node in roots:
            out[k] += sums[node]
    return out


def best_of(scores: DataFrame, top: int, keys: list[str]) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), F.asc_nulls_first("doc_id"))
    return scores.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


def search_block(docs: DataFrame, items: list[tuple[int | None, dict[bytes, int]]], top: int) -> DataFrame:
    """item_id, rank, doc_id, score for the items (item_id, its terms and their repeats) of one block."""
    spark = docs.sparkSession
    vocabulary = sorted({t for _, terms in items for t in terms})
    number = {t: k for k, t in enumerate(vocabulary)}
    found = postings(docs, vocabulary)
    totals = found.agg(F.count("*").alias("docs"), F.coalesce(F.sum("n"), F.lit(0)).alias("terms")).first()
    df = dict.fromkeys(range(len(vocabulary)), 0) | {r[0]: r[1] for r in found.select(F.explode("terms").alias("t")).groupBy("t").count().collect()}
    weights = np.array([weight(totals["docs"], df[k]) for k in range(len(vocabulary))], np.int64)
    plan = mine([{number[t]: times for t, times in terms.items()} for _, terms in items])
    shared = spark.sparkContext.broadcast((plan, weights))
    n_docs, n_terms = totals["docs"], totals["terms"]
    rows = max(1, HELD // (8 * (len(vocabulary) + len(plan.leaves) + len(plan.nodes) + len(items))))

    def score(batches):
        plan, weights = shared.value
        best = Best(len(plan.roots), top)
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                part = pa.RecordBatch.from_arrays([pa.concat_arrays([c.slice(at, rows)]) for c in batch.columns], names=batch.schema.names)
                scores = accumulate(plan, part, weights, n_docs, n_terms)
                item, doc = np.nonzero(scores >= best.least[:, None])
                ids = part.column(0)
                known = ids.is_valid().to_numpy(zero_copy_only=False)
                best.add(item, ids.fill_null(0).to_numpy()[doc], known[doc], scores[item, doc])
        yield best.batch()

    scores = found.mapInArrow(score, _BEST).withColumn("part", F.spark_partition_id() % GROUPS)
    merged = best_of(best_of(scores, top, ["item", "part"]).drop("rank"), top, ["item"])
    ids = F.broadcast(spark.createDataFrame([(k, item_id) for k, (item_id, _) in enumerate(items)], "item int, item_id long"))  # the items of one block
    return merged.join(ids, "item").select("item_id", "rank", "doc_id", "score")


def blocks(items: Iterable[tuple[int | None, str | None]], limit: int) -> Iterator[list[tuple[int | None, dict[bytes, int]]]]:
    """Items with terms, in lists that end as soon as they hold `limit` terms."""
    block, size = [], 0
    for item_id, text in items:
        terms: Counter = Counter()
        for words in terms_of((text or "").encode(), LETTERS_AND_DIGITS):
            terms.update(words)
        if terms:
            block.append((item_id, terms))
            size += terms.total()
        if size >= limit:
            yield block
            block, size = [], 0
    if block:
        yield block


def search(docs: DataFrame, items: DataFrame, top: int = TOP, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """item_id, rank, doc_id, score: the `top` documents (doc_id, text) of each item (item_id, text) whose score is above 0."""
    rows = ((r[0], r[1]) for r in items.select(F.col("item_id").cast("long"), F.col("text").cast("string")).toLocalIterator())
    found = [search_block(docs, block, top) for block in blocks(rows, block_terms)]
    if not found:
        return docs.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    return reduce(DataFrame.unionByName, found)
