"""Top-k, sampling and set operators. Random choices follow md5 hashes of (seed, ids), so a rerun repeats them on any engine."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def topk_per_group(df: DataFrame, keys: list[str], order: list[Column], k: int, name: str = "place") -> DataFrame:
    """The first k rows of each group, numbered from 1."""
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col(name) <= k)


def rep_frames(frames: DataFrame, k: int) -> DataFrame:
    """Per round the k frames with most detections; ties go to the earlier one."""
    counts = frames.groupBy("round_id", "frame_id").agg(F.count("*").alias("n_dets"))
    return topk_per_group(counts, ["round_id"], [F.desc("n_dets"), F.asc("frame_id")], k)


def best_rep_frame(candidates: DataFrame, seats: DataFrame) -> DataFrame:
    """Per round the candidate frame with most seats; ties go to the better placed candidate."""
    rows = candidates.join(seats.select("round_id", "frame_id", "n_seats"), ["round_id", "frame_id"], "left").withColumn("n_seats", F.coalesce("n_seats", F.lit(0)))
    best = rows.groupBy("round_id").agg(F.min(F.struct((-F.col("n_seats")).alias("s"), "place", "frame_id", "n_seats")).alias("b"))
    return best.select("round_id", "b.frame_id", "b.n_seats", "b.place")


def first_per_cluster(pairs: DataFrame, keys: list[str], px: int) -> DataFrame:
    """The first pair per rank and px-wide stretch of x, numbered per group in order of frame, overlap, distance and ids."""
    order = [F.asc("frame_id"), F.desc("overlap"), F.asc("distance"), F.asc("a_det_id"), F.asc("b_det_id")]
    rows = pairs.withColumn("cluster_x", (F.floor(F.least("a_cx", "b_cx") / px) * px).cast("int"))
    rows = topk_per_group(rows, [*keys, "rank_norm", "cluster_x"], order, 1, "__first").drop("__first")
    return rows.withColumn("pair_no", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))


#: Rows of a part of the hash, at most for a table of 10**12 rows.
PART_ROWS = 100_000


def random_key(ids: list[str], seed: int) -> Column:
    """A hash of the seed and the ids as hexadecimal text."""
    return F.md5(F.concat_ws("|", F.lit(seed).cast("string"), *[F.col(c).cast("string") for c in ids]))


def with_place(df: DataFrame, keys: list[str], ids: list[str], seed: int) -> DataFrame:
    """df with __place, each row's place (from 1) in random order within its group (keys; [] for all rows), and __size, the group's rows.

    A place is the count of the rows with smaller leading digits of the hash, from a table of those counts, and the place among the rows with
    the same digits. So the rows of a group are ordered in 4096 parts, or 16 or 256 times as many where df has very many rows, not in one task.
    """
    digits = min(6, max(3, math.ceil(math.log(max(df.count(), 1) / PART_ROWS, 16))))
    rows = df.withColumn("__h", random_key(ids, seed)).withColumn("__bin", F.substring("__h", 1, digits))
    sizes = rows.groupBy(*[F.col(c).alias(f"__k{i}") for i, c in enumerate(keys)], F.col("__bin").alias("__b")).agg(F.count("*").alias("__n"))
    group = Window.partitionBy(*[f"__k{i}" for i in range(len(keys))]) if keys else Window.partitionBy(F.lit(0))  # a row per part
    before = F.coalesce(F.sum("__n").over(group.orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sizes = sizes.withColumns({"__before": before, "__size": F.sum("__n").over(group)}).drop("__n")
    same = F.col("__bin") == F.col("__b")
    for i, c in enumerate(keys):
        same &= F.col(c).eqNullSafe(F.col(f"__k{i}"))
    rows = rows.join(sizes, same).drop("__b", *[f"__k{i}" for i in range(len(keys))])
    order = Window.partitionBy(*keys, "__bin").orderBy("__h", *ids)
    return rows.withColumn("__place", F.col("__before") + F.row_number().over(order)).drop("__h", "__bin", "__before")


def sample_per_class(df: DataFrame, label: str, ids: list[str], n: int, seed: int = 42, skip: str = "background") -> DataFrame:
    """n random rows of each class but `skip`. A top n per class: each task passes on n rows of a class at most."""
    rows = df.where(F.col(label) != skip).withColumn("__h", random_key(ids, seed))
    return topk_per_group(rows, [label], [F.asc("__h"), *[F.asc(c) for c in ids]], n, "__r").drop("__r", "__h")


def evenly_spaced(names: DataFrame, order: str, n: int) -> DataFrame:
    """n evenly spaced rows of a table of names, places round(i * (len - 1) / (n - 1)) with halves to even; all rows if there are no more."""
    rows = names.withColumns({"pos": F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(order)) - 1})
    size = names.agg(F.count("*").alias("len"))
    at = size.select(F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("i"), "len").select(F.bround(F.col("i") * (F.col("len") - 1) / max(n - 1, 1)).cast("int").alias("pos")).where("pos is not null").distinct()
    return rows.join(F.broadcast(at), "pos")


def balanced_union(a: DataFrame, b: DataFrame, ids: list[str], seed: int = 42) -> DataFrame:
    """As many random rows of each as the smaller one has, with their source."""
    n = min(a.count(), b.count())
    take = lambda df, name: with_place(df, [], ids, seed).where(F.col("__place") <= n).drop("__place", "__size").withColumn("source", F.lit(name))
    return take(a, "human").unionByName(take(b, "auto"))


def latest_frame(names: DataFrame) -> DataFrame:
    """Per round the frame file of the largest frame."""
    best = names.groupBy("round_name").agg(F.max(F.struct("frame_id", "file_name")).alias("b"))
    return best.select("round_name", "b.frame_id", "b.file_name")


def first_n_groups(df: DataFrame, key: str, seq: str, n: int) -> DataFrame:
    """The rows of the n groups that come first by their least seq."""
    first = df.groupBy(key).agg(F.min(seq).alias("__s")).orderBy("__s", key).limit(n).select(key)
    return df.join(F.broadcast(first), key, "left_semi")


def balanced_batches(items: DataFrame, ids: list[str], focus: Column, batch: int, fraction: float, seed: int = 42, least: int = 4) -> DataFrame:
    """The batches of an epoch: items with batch, slot and is_focus. Each batch has fraction * batch focus items and others up to its size.

    There are as many batches as show the focus items twice, `least` at the fewest. Both kinds are dealt in random order, again and again: a batch
    repeats an item only where there are fewer than it needs.
    """
    n_focus = max(1, int(batch * fraction))
    rows = with_place(items.withColumn("is_focus", focus), ["is_focus"], ids, seed)
    batches = items.agg(F.greatest(F.lit(least), F.floor(2 * F.count_if(focus) / n_focus)).cast("long").alias("__batches"))  # one row
    per = F.when(F.col("is_focus"), n_focus).otherwise(batch - n_focus)
    rows = rows.join(F.broadcast(batches)).withColumn("__slots", F.col("__batches") * per).where("__place <= __slots")
    rows = rows.withColumn("__s", F.explode(F.sequence(F.col("__place") - 1, F.col("__slots") - 1, F.col("__size"))))
    return rows.withColumns({"batch": F.floor(F.col("__s") / per), "slot": (F.col("__s") % per).cast("int")}).drop("__s", "__slots", "__batches", "__place", "__size")


def union_sources(frames: dict[str, DataFrame]) -> DataFrame:
    out = None
    for name, df in frames.items():
        df = df.withColumn("source", F.lit(name))
        out = df if out is None else out.unionByName(df)
    return out


def label_vocabulary(df: DataFrame, last: str = "background") -> DataFrame:
    """Distinct labels in order with their ids; `last` comes last."""
    labels = df.select("label").distinct().where("label is not null")
    return labels.withColumn("label_id", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(F.col("label") == last, "label")) - 1)


def names_in_both(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.intersect(b)


def names_only_in(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.distinct().exceptAll(b.distinct())
