"""Exact deduplication by a log-structured merge of digest runs.

Every task keeps a memtable, digest -> (best doc_id, rows, rows with that doc_id). A full memtable is flushed as a run
sorted by digest. Compaction deals the runs by ranges of digests and merges them in order: entries of one digest follow
each other, and one identifier (the smallest or the largest) is kept with the counts. A filter of fixed size holds the
digests with more than one row. A row that the filter doesn't know is alone and needs no lookup; a hit is looked up in
the index, and its text is compared byte by byte: a digest that stands for different texts is split by text.

Null texts count as empty. A null doc_id stays only where its whole group has none. Repeated rows (same doc_id and
text) are copies as well: one of them stays. Extra columns are passed on, whatever their names are. An empty table
gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roundhouse.llm.common import few, small_batches, stored

#: Entries of a memtable, about 25 MB.
MEMTABLE_ROWS = 100_000
#: Bits of the filter: 8 MB whatever the corpus is. Beyond some ten million digests with copies it lets more single rows through, which are then looked up.
FILTER_BITS, PROBES, FILTER_BLOCK = 1 << 26, 4, 1 << 16
_RUN = "digest string, keep_id long, n_rows long, n_keep long"


def merged(old: list | None, new: list, largest: bool) -> list:
    """Two entries [keep_id, n_rows, n_keep] of one digest."""
    if old is None:
        return new
    a, b = old[0], new[0]
    if a == b:
        return [a, old[1] + new[1], old[2] + new[2]]
    first = b is None or (a is not None and (a > b) == largest)
    best = old if first else new
    return [best[0], old[1] + new[1], best[2]]


def _batch(digests: list[str], entries: list[list]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(digests, pa.string()), *[pa.array([x[k] for x in entries], pa.int64()) for k in range(3)]], names=["digest", "keep_id", "n_rows", "n_keep"])


def flush_runs(batches, largest: bool, memtable_rows: int = MEMTABLE_ROWS):
    """Sorted runs of the (doc_id, digest) rows of one task."""
    memtable: dict[str, list] = {}

    def flush():
        order = sorted(memtable)
        return _batch(order, [memtable[x] for x in order])

    for batch in batches:
        for doc_id, digest in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            memtable[digest] = merged(memtable.get(digest), [doc_id, 1, 1], largest)
            if len(memtable) >= memtable_rows:
                yield flush()
                memtable = {}
    if memtable:
        yield flush()


def compact(batches, largest: bool):
    """Entries in order of digest -> one entry per digest. Only the last digest is carried from batch to batch."""
    digest, entry = None, None
    for batch in batches:
        digests, entries = [], []
        for key, *new in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
            if key != digest and entry is not None:
                digests.append(digest)
                entries.append(entry)
                entry = None
            digest, entry = key, merged(entry, new, largest)
        yield _batch(digests, entries)
    if entry is not None:
        yield _batch([digest], [entry])


def build_index(rows: DataFrame, largest: bool = True, memtable_rows: int = MEMTABLE_ROWS) -> DataFrame:
    """Compacted index of (doc_id, digest) rows: one row per digest with keep_id, n_rows and n_keep, stored.

    The memtables have merged the copies within a task, so a hot digest sends a row per run at most.
    """
    runs = stored(small_batches(rows).select("doc_id", "digest").mapInArrow(lambda it: flush_runs(it, largest, memtable_rows), _RUN), "exact-runs")
    return stored(runs.repartitionByRange("digest").sortWithinPartitions("digest").mapInArrow(lambda it: compact(it, largest), _RUN), "exact-index")


def _places(hashes: np.ndarray) -> np.ndarray:
    """PROBES bits of the filter for each 64-bit hash, a row per probe."""
    a, b = hashes.view(np.uint64), (hashes.view(np.uint64) >> np.uint64(29)) | np.uint64(1)
    with np.errstate(over="ignore"):
        return np.stack([((a + np.uint64(k) * b) >> np.uint64(7)) & np.uint64(FILTER_BITS - 1) for k in range(PROBES)]).astype(np.int64)


def copies_filter(index: DataFrame) -> np.ndarray:
    """A Bloom filter, as bytes, of the digests with more than one row. Tasks send the blocks in which they set bits; FILTER_BITS reach the driver at most."""

    def either(sums: dict[int, np.ndarray]):
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([x.tobytes() for x in sums.values()], pa.binary())], names=["block", "bits"])

    def fill(batches):
        bits = np.zeros(FILTER_BITS, bool)
        for batch in batches:
            bits[_places(batch.column(0).to_numpy()).reshape(-1)] = True
        blocks = np.packbits(bits).reshape(-1, FILTER_BLOCK // 8)
        yield from either({int(k): blocks[k] for k in np.flatnonzero(blocks.any(1))})

    def join(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, own in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                sums[block] = sums.get(block, 0) | np.frombuffer(own, np.uint8)
        yield from either(sums)

    kind = "block int, bits binary"
    found = index.where("n_rows > 1").select(F.xxhash64("digest")).mapInArrow(fill, kind).repartition("block").mapInArrow(join, kind)
    out = np.zeros(FILTER_BITS // 8, np.uint8).reshape(-1, FILTER_BLOCK // 8)
    for r in found.collect():
        out[r["block"]] = np.frombuffer(r["bits"], np.uint8)
    return out.reshape(-1)


def probed(rows: DataFrame, index: DataFrame, digest: str = "__digest") -> DataFrame:
    """rows with __hit: whether the filter knows the digest, so that the row may have copies."""
    bits = rows.sparkSession.sparkContext.broadcast(copies_filter(index))  # 8 MB
    out = small_batches(rows).withColumn("__hit", F.xxhash64(digest))
    schema = rows.withColumn("__hit", F.lit(True)).schema
    at = len(schema.names) - 1

    def probe(batches):
        for batch in batches:
            place = _places(batch.column(at).to_numpy())
            known = ((bits.value[place >> 3] >> (7 - (place & 7)).astype(np.uint8)) & 1).all(0)
            yield pa.RecordBatch.from_arrays([*batch.columns[:at], pa.array(known)], names=schema.names)

    return out.mapInArrow(probe, schema)


def sha256(text: Column) -> Column:
    return F.sha2(text, 256)


def collisions(docs: DataFrame, index: DataFrame, small: int = 200_000) -> DataFrame:
    """Byte verification: the digests among the hits that stand for different texts.

    Copies meet as one smallest and one largest text per task, so no group is gathered.
    """
    hits = few(index.where("n_rows > 1").select(F.col("digest").alias("__digest")), small)
    return docs.select("__digest", "__body").join(hits, "__digest", "left_semi").groupBy("__digest").agg(F.min("__body").alias("a"), F.max("__body").alias("b")).where("a <> b").select("__digest")


def indexed(df: DataFrame, doc_id: str = "doc_id", text: str = "text", largest: bool = True, digest: Callable[[Column], Column] = sha256, memtable_rows: int = MEMTABLE_ROWS) -> tuple[DataFrame, DataFrame]:
    """(df with __doc_id, __body and __digest, verified index). Where a digest stands for several texts, it becomes digest:text."""
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    docs = df.withColumns({"__doc_id": F.col(f"`{doc_id}`").cast("long"), "__body": body, "__digest": digest(body)})
    index_of = lambda rows: build_index(rows.select(F.col("__doc_id").alias("doc_id"), F.col("__digest").alias("digest")), largest, memtable_rows)
    index = index_of(docs)
    bad = stored(collisions(docs, index), "exact-collisions")
    if bad.isEmpty():
        return docs, index
    docs = docs.join(bad.withColumn("__bad", F.lit(True)), "__digest", "left")
    docs = docs.withColumn("__digest", F.when(F.col("__bad"), F.concat_ws(":", "__digest", "__body")).otherwise(F.col("__digest"))).drop("__bad")
    return docs, index_of(docs)


def looked_up(rows: DataFrame, index: DataFrame, small: int) -> DataFrame:
    """rows (with __digest) with the index entry of those that have copies: __keep, __rows and __same, the number of rows with the kept doc_id; null for the others.

    Up to `small` entries go along to the rows. More are joined by a shuffle, which only the rows that the filter knows take part in.
    """
    copies = index.where("n_rows > 1").withColumnsRenamed({"digest": "__digest", "keep_id": "__keep", "n_rows": "__rows", "n_keep": "__same"})
    rows = probed(rows, index)
    if copies.count() <= small:
        return rows.join(F.broadcast(copies.withColumn("__hit", F.lit(True))), ["__digest", "__hit"], "left")
    alone = rows.where("not __hit").withColumns({c: F.lit(None).cast("long") for c in ("__keep", "__rows", "__same")})
    return rows.where("__hit").join(copies, "__digest", "left").unionByName(alone)


def assign(df: DataFrame, small: int = 200_000, **how) -> DataFrame:
    """One row per document, dropped ones too: doc_id, keep_id, group_size, kept, text_sha256.

    Of repeated rows with the kept doc_id, one is kept and the others are not.
    """
    docs, index = indexed(df, **how)
    rows = docs.select("__doc_id", "__digest", F.sha2("__body", 256).alias("text_sha256"))
    rows = looked_up(rows, index, small)  # hits without copies (the filter's mistakes) find no entry and are alone too
    alone = F.col("__rows").isNull()
    rows = rows.select(F.col("__doc_id").alias("doc_id"), F.when(alone, F.col("__doc_id")).otherwise(F.col("__keep")).alias("keep_id"), F.coalesce("__rows", F.lit(1)).alias("group_size"), "text_sha256", "__digest", "__same")
    stays = F.col("doc_id").eqNullSafe(F.col("keep_id"))
    out = ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    rows = rows.withColumn("kept", stays)
    if index.where("n_keep > 1").isEmpty():
        return rows.select(*out)
    again = stays & (F.coalesce("__same", F.lit(1)) > 1)
    repeated = rows.where(again).groupBy("__digest", "doc_id", "keep_id", "group_size", "text_sha256").agg(F.count("*").alias("n"))
    repeated = repeated.withColumn("i", F.explode(F.sequence(F.lit(1), F.col("n")))).withColumn("kept", F.col("i") == 1)
    return rows.where(~again).select(*out).unionByName(repeated.select(*out))


def keep_one(df: DataFrame, small: int = 200_000, doc_id: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """The rows that stay, one per text, with df's columns, whatever their names are."""
    own = [f"c{k}" for k in range(len(df.columns))]
    docs, index = indexed(df.toDF(*own), doc_id=own[df.columns.index(doc_id)], text=own[df.columns.index(text)], **how)
    rows = looked_up(docs.drop("__body"), index, small)
    stays = F.col("__doc_id").eqNullSafe(F.col("__keep"))
    kept = rows.where(F.col("__rows").isNull() | ((F.col("__same") == 1) & stays)).select(*own)
    if not index.where("n_keep > 1").isEmpty():
        kept = kept.unionByName(rows.where((F.col("__same") > 1) & stays).dropDuplicates(["__digest"]).select(*own))
    return kept.toDF(*df.columns)
