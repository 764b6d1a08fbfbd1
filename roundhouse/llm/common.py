"""Helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
from collections.abc import Iterable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roundhouse.storage import forget, stored

__all__ = ["few", "fold", "forget", "labelled", "slices", "small_batches", "spans", "stored", "sum_blocks", "table", "texts_of", "unused", "with_input"]

#: Code points that one vectorised step of a task looks at; a longer text is a step of its own.
CHUNK_CHARS = 1 << 19
#: Bytes of text that a task turns into Python strings at a time; a longer text is a slice of its own.
SLICE_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def few(df: DataFrame, small: int) -> DataFrame:
    """df, broadcast if it has `small` rows at most; a larger one is joined by a shuffle."""
    return F.broadcast(df) if df.count() <= small else df


def unused(name: str, columns: list[str]) -> str:
    """name, with underscores before it until no column has it."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def small_batches(df: DataFrame) -> DataFrame:
    """df. Its session sends SLICE_BYTES of rows to Python at a time, unless a limit of its own was set: texts vary too much for a limit in rows."""
    conf, key = df.sparkSession.conf, "spark.sql.execution.arrow.maxBytesPerBatch"
    if conf.get(key, None) in (None, "67108864b", "64m", "64MB"):  # Spark's default
        conf.set(key, f"{SLICE_BYTES}b")
    return df


def with_input(df: DataFrame, keep: list[str], column: str) -> tuple[DataFrame, int]:
    """df's columns `keep`, and the place of `column` among them; a column that isn't kept is put after them."""
    df = small_batches(df)
    if column in keep:
        return df.select(*[F.col(f"`{c}`") for c in keep]), keep.index(column)
    return df.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{column}`").alias(unused("__input", keep))), len(keep)


@cache
def _trim():
    try:
        return ctypes.CDLL(None).malloc_trim
    except (AttributeError, OSError):  # another allocator
        return lambda _: 0


def slices(batches: Iterable[pa.RecordBatch], text: int, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches in slices whose texts (or other bytes) in column `text` hold about `limit` bytes.

    What a worker held for earlier slices goes back to the system, so that it doesn't keep the most it ever needed.
    """
    for batch in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
        start = 0
        while start < batch.num_rows:
            held = ends[start - 1] if start else 0
            end = max(start + 1, int(np.searchsorted(ends, held + limit, side="right")))
            yield batch.slice(start, end - start)
            start = end
            pa.default_memory_pool().release_unused()
            _trim()(0)


def texts_of(column) -> list[str]:
    """The strings of an Arrow column, nulls as empty texts."""
    return [x or "" for x in column.to_pylist()]


def spans(texts: Iterable[str], limit: int = CHUNK_CHARS) -> Iterator[tuple[int, int]]:
    """Index ranges of neighbouring texts that hold about `limit` code points together."""
    start = size = 0
    end = -1
    for end, text in enumerate(texts):
        if size and size + len(text) > limit:
            yield start, end
            start, size = end, 0
        size += len(text) + 1
    if end >= start:
        yield start, end + 1


def labelled(spark: SparkSession, sf_dir: str, label: str) -> DataFrame:
    """(doc_id, label) of the rows to learn from: crc32(doc_id as text) mod 5 is not 0. Of repeated rows the larger label counts."""
    rows = table(spark, sf_dir, "labels").where(F.col(label).isNotNull() & F.col("doc_id").isNotNull())
    return rows.where(fold("doc_id") != 0).groupBy("doc_id").agg(F.max(label).cast("int").alias("label"))


def fold(doc_id: str) -> Column:
    """crc32 of the doc_id as text, mod 5."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 5


def sum_blocks(blocks: DataFrame) -> dict[int, np.ndarray]:
    """Sums of float64 vectors (block int, vector binary) by block, added up as they stream through the tasks that own a block."""

    def add(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, vector in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                sums[block] = sums.get(block, 0) + np.frombuffer(vector)
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([x.tobytes() for x in sums.values()], pa.binary())], names=["block", "vector"])

    kind = "block int, vector binary"
    return {r["block"]: np.frombuffer(r["vector"]) for r in blocks.repartition("block").mapInArrow(add, kind).collect()}
