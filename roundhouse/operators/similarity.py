"""Nearest vectors by hashed projections, for galleries that are too large to be compared in full.

A table of hashes has some random planes; the signs of a vector's projections on them are its code. Vectors at a small
angle differ in few signs, so a query meets the gallery rows with its own code and, if that sends fewer vectors, with each
code that differs in one sign (its probes). Codes are join keys. The code's length follows the gallery's size, so a bucket
holds about BUCKET_ROWS whatever that is (without probes up to some times as many: a query meets fewer buckets then), and
the number of tables follows from the chance that a neighbour at the least similarity is missed.
What meets is compared exactly. Buckets that hold more than BLOCK_ROWS gallery rows or queries (many equal vectors) are
dealt into blocks and parts that all meet, so no group is large; nothing is left out.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roundhouse.operators.joins import best_matches, unit_rows

BUCKET_ROWS, BLOCK_ROWS = 256, 20_000
#: Vectors that are copied to their probes' codes at a time.
STEP = 1024
#: Tables are a copy of the gallery each; a lower least similarity or a smaller chance of a miss would need more than this.
MOST_TABLES = 64


def plan_hashes(rows: int, least: float, miss: float, bucket_rows: int = BUCKET_ROWS) -> tuple[int, int]:
    """(tables, bits) for a gallery of `rows` vectors: at similarity `least` a pair meets in no table with a chance of `miss` at most."""
    bits = max(1, math.ceil(math.log2(max(rows, 1) / bucket_rows)) if rows > bucket_rows else 1)
    same = 1 - math.acos(min(least, 1.0)) / math.pi  # the chance that a plane doesn't part the two
    met = same**bits + bits * (1 - same) * same ** (bits - 1)
    tables = 1 if met >= 1 else max(1, math.ceil(math.log(miss) / math.log(1 - met)))
    if tables > MOST_TABLES:
        raise ValueError(f"{tables} tables for similarity {least} in {rows} rows: compare in full (top1_similarity), or ask for a higher similarity or more misses")
    return tables, bits


def plan_search(rows: int, asked: int, least: float, miss: float, bucket_rows: int = BUCKET_ROWS) -> tuple[int, int, bool]:
    """(tables, bits, probe) that send the fewest vectors: a gallery row goes to each table, a query to each table and, with probe, to the codes that differ in one sign too.

    plan_hashes gives the longest code. Shorter ones and searches without probes are taken only if the buckets that a query meets hold no more rows in all than with that plan;
    the chance of a miss is the same.
    """
    tables, bits = plan_hashes(rows, least, miss, bucket_rows)
    same = 1 - math.acos(min(least, 1.0)) / math.pi
    plans = [(tables, bits, True)]
    for b in range(1, bits + 1):
        for probe in (True, False):
            met = same**b + (b * (1 - same) * same ** (b - 1) if probe else 0)
            plans.append((1 if met >= 1 else max(1, math.ceil(math.log(miss) / math.log(1 - met))), b, probe))
    reach = lambda p: p[0] * (1 + p[1] * p[2]) / 2 ** p[1]
    sent = lambda p: p[0] * (rows + asked * (1 + p[1] * p[2]))
    return min((p for p in plans if p[0] <= MOST_TABLES and reach(p) <= reach(plans[0])), key=lambda p: (sent(p), reach(p)))


def codes(vectors: np.ndarray, tables: int, bits: int, seed: int) -> np.ndarray:
    """The code of each row in each table."""
    planes = np.random.default_rng(seed).standard_normal((tables * bits, vectors.shape[1]))
    signs = (vectors @ planes.T >= 0).reshape(len(vectors), tables, bits)
    return signs @ (1 << np.arange(bits, dtype=np.int64))


def keyed(df: DataFrame, tables: int, bits: int, seed: int, probe: bool, whole: bool = True) -> DataFrame:
    """(slot, code, id) of df's (id, vec) in each table, with vec if `whole`; with `probe` also under the codes that differ in one sign."""
    flips = np.array([0, *(1 << np.arange(bits, dtype=np.int64))] if probe else [0], np.int64)
    kind = f"slot int, code long, id long{', vec ' + df.schema['vec'].dataType.simpleString() if whole else ''}"

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            own = codes(unit_rows(batch.column(1)), tables, bits, seed)
            for table in range(tables):
                for at in range(0, batch.num_rows, STEP):
                    code = (own[at : at + STEP, table, None] ^ flips).reshape(-1)
                    row = pa.array(np.repeat(np.arange(at, min(at + STEP, batch.num_rows)), len(flips)))
                    columns = [pa.array(np.full(len(row), table, np.int32)), pa.array(code), batch.column(0).take(row)]
                    yield pa.RecordBatch.from_arrays(columns + [batch.column(1).take(row)] * whole, names=["slot", "code", "id", "vec"][: 3 + whole])

    return df.mapInArrow(run, kind)


def buckets(gallery: DataFrame, queries: DataFrame, block_rows: int) -> DataFrame:
    """slot, code, blocks and parts of the buckets that hold both; the counts are made without the vectors."""
    n = lambda df, name: df.groupBy("slot", "code").agg(F.count("*").alias(name))
    many = lambda c: F.ceil(F.col(c) / block_rows).cast("int")
    both = n(gallery, "own").join(n(queries, "asked"), ["slot", "code"])
    return both.select("slot", "code", many("own").alias("blocks"), many("asked").alias("parts"), "own", "asked")


def top1_similarity_hashed(queries: DataFrame, gallery: DataFrame, least: float = 0.8, miss: float = 0.001, seed: int = 42, bucket_rows: int = BUCKET_ROWS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(q_id, best, g_id) of queries whose largest dot product of unit vectors is `least` or more; ties (to four decimals) go to the smaller id.

    A query's best match is missed with a chance of `miss` at most, and less the nearer it is. Null vectors match nothing; an empty side gives no rows.
    """
    rows = gallery.where("g_vec is not null").count()
    tables, bits, near = plan_search(rows, queries.where("q_vec is not null").count(), least, miss, bucket_rows)
    g = gallery.where("g_vec is not null").select(F.col("g_id").cast("long").alias("id"), F.col("g_vec").alias("vec"))
    q = queries.where("q_vec is not null").select(F.col("q_id").cast("long").alias("id"), F.col("q_vec").alias("vec"))
    hashed = lambda df, probe, whole: keyed(df, tables, bits, seed, probe, whole)
    met = buckets(hashed(g, False, False), hashed(q, near, False), block_rows).select("slot", "code", "blocks", "parts")
    every = lambda c: F.explode(F.sequence(F.lit(0), F.col(c) - 1))
    place = lambda c: F.pmod(F.xxhash64("id"), F.col(c)).cast("int")
    columns = ["slot", "code", "part", "block", "query", "id", "vec"]
    own = hashed(g, False, True).join(met, ["slot", "code"]).withColumns({"query": F.lit(False), "block": place("blocks")}).withColumn("part", every("parts")).select(*columns)
    ask = hashed(q, near, True).join(met, ["slot", "code"]).withColumns({"query": F.lit(True), "part": place("parts")}).withColumn("block", every("blocks")).select(*columns)

    def meet(table: pa.Table) -> pa.Table:
        theirs, asked = table.filter(pc.invert(table["query"])).sort_by("id"), table.filter(table["query"])
        if not theirs.num_rows or not asked.num_rows:
            return pa.table({"q_id": pa.array([], pa.int64()), "best": pa.array([], pa.float64()), "g_id": pa.array([], pa.int64())})
        score, best = best_matches(unit_rows(asked["vec"]), theirs["id"].to_numpy(), unit_rows(theirs["vec"]))
        enough = pa.array(score >= least)
        return pa.table({"q_id": asked["id"].filter(enough), "best": pa.array(score).filter(enough), "g_id": pa.array(best).filter(enough)})

    won = own.unionByName(ask.withColumn("vec", F.col("vec").cast(own.schema["vec"].dataType))).groupBy("slot", "code", "part", "block").applyInArrow(meet, "q_id long, best double, g_id long")
    top = F.max(F.struct("best", (-F.col("g_id")).alias("g")))
    return won.groupBy("q_id").agg(top.alias("t")).select("q_id", F.col("t.best").alias("best"), (-F.col("t.g")).alias("g_id"))
