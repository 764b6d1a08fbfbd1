"""Aggregations: coverage, votes, distributions, summaries."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roundhouse.functions import geometry as g
from roundhouse.operators.joins import CHUNK_FRAMES, assign_seats_obb, assign_seats_template, chunk_slices

META_LABELS = ("initial hands 1st", "initial hands 2nd", "discard")


def coverage(rounds: DataFrame, chunks: DataFrame) -> DataFrame:
    """Per round: expected and merged frames, and status full, partial or no_match.

    Full: the first chunk starts at or before the round, the last ends at or after it, and no gap lies between neighbours.
    """
    order = Window.partitionBy("round_id").orderBy("chunk_start")
    s = chunk_slices(rounds, chunks).withColumn("gap", F.lead("chunk_start").over(order) - F.col("chunk_start") > CHUNK_FRAMES)
    agg = s.groupBy("round_id").agg(F.min("chunk_start").alias("first"), (F.max("chunk_start") + CHUNK_FRAMES - 1).alias("last"), F.bool_or(F.coalesce("gap", F.lit(False))).alias("gap"), F.sum(F.col("slice_to") - F.col("slice_from")).alias("merged"))
    out = rounds.withColumn("expected", F.col("end_1idx") - F.col("start_1idx") + 1).join(agg, "round_id", "left")
    full = (F.col("first") <= F.col("start_1idx") - 1) & (F.col("last") >= F.col("end_1idx") - 1) & ~F.col("gap")
    status = F.when(F.col("merged").isNull(), "no_match").when(full & (F.col("merged") >= F.col("expected")), "full").otherwise("partial")
    return out.select("round_id", "expected", F.coalesce("merged", F.lit(0)).alias("merged"), status.alias("status"))


def active_seats(dets: DataFrame, keys: list[str]) -> DataFrame:
    """Per group the player seats (1 to 7) with a detection, as a string in order; '' if there are none."""
    seat = F.when(F.col("seat") > 0, F.col("seat"))
    return assign_seats_template(dets).groupBy(*keys).agg(F.array_join(F.transform(F.array_sort(F.collect_set(seat)), lambda x: x.cast("string")), "").alias("active_seats"))


def meta_text(segs: DataFrame, dets: DataFrame, frame: Column | None = None) -> DataFrame:
    """Segments with meta_text: the active seats at the last frame of the round's first 'initial hands 1st' segment, on three kinds of labels.

    frame: the frame to look up from a segment's end_frame, itself by default.
    """
    first = segs.where(F.col("label") == META_LABELS[0]).groupBy("round_id").agg(F.min(F.struct("start_frame", "seg_id", "end_frame"))["end_frame"].alias("end_frame"))
    at = first.select("round_id", (F.col("end_frame") if frame is None else frame).cast("int").alias("frame_id"))
    seats = active_seats(dets.join(at, ["round_id", "frame_id"], "left_semi"), ["round_id"])
    text = at.select("round_id").join(seats, "round_id", "left").select("round_id", F.coalesce("active_seats", F.lit("")).alias("__text"))
    return segs.join(text, "round_id", "left").withColumn("meta_text", F.when(F.col("label").isin(*META_LABELS), F.col("__text"))).drop("__text")


def label_distribution(df: DataFrame) -> DataFrame:
    """Counts and percent of the total per (source, label), per source and overall."""
    out = df.rollup("source", "label").agg(F.count("*").alias("n"), F.grouping_id().alias("level"))
    total = df.agg(F.count("*").alias("__total"))  # one row
    out = out.join(F.broadcast(total)).withColumn("percent", g.r4(F.col("n") * 100.0 / F.col("__total"))).drop("__total")
    return out.withColumn("level", F.col("level").cast("int"))


def funnel(verdicts: DataFrame) -> DataFrame:
    """Rows per label and stage of failure; stage null: passed."""
    return verdicts.groupBy("label", "stage").agg(F.count("*").alias("n"))


def frame_label_stats(frames: DataFrame) -> DataFrame:
    n = F.count("*").alias("n")
    share = g.r4(F.col("n") * 100.0 / F.sum("n").over(Window.partitionBy("round_id")))
    return frames.groupBy("round_id", "label").agg(n).withColumn("percent", share)


def majority(df: DataFrame, keys: list[str], values: list[str], seq: list[str]) -> DataFrame:
    """The most frequent values per group; ties go to the values seen first."""
    counts = df.groupBy(*keys, *values).agg(F.count("*").alias("votes"), F.min(F.struct(*seq)).alias("__first"))
    best = F.min(F.struct((-F.col("votes")).alias("__neg"), "__first", *values, "votes")).alias("b")
    return counts.groupBy(*keys).agg(best).select(*keys, *[F.col(f"b.{v}").alias(v) for v in values], F.col("b.votes").alias("votes"))


def seat_vote(obs: DataFrame, obbs: DataFrame, entry: bool = False) -> DataFrame:
    """Per track the seat with most observations (none counts too; ties: seen first), its share, and whether most of its votes lie inside.

    entry: with entry_frame, the first frame inside the seat's box, else the track's first frame.
    """
    rows = assign_seats_obb(obs.select("round_id", "track_id", "frame_id", "det_id", "cx", "cy"), obbs)
    # a vote for the seat that an observation got, and a mark for each seat that holds it
    vote = F.array(F.struct("seat_id", F.lit(1).alias("vote"), F.lit(0).alias("held")))
    held = F.transform("holding", lambda x: F.struct(x.alias("seat_id"), F.lit(0).alias("vote"), F.lit(1).alias("held")))
    rows = rows.select("round_id", "track_id", "frame_id", "det_id", F.explode(F.concat(vote, held)).alias("v")).select("round_id", "track_id", "frame_id", "det_id", "v.*")
    seats = rows.groupBy("round_id", "track_id", "seat_id").agg(F.sum("vote").alias("votes"), F.sum("held").alias("n_in"), F.min(F.when(F.col("vote") == 1, F.struct("frame_id", "det_id"))).alias("first"), F.min(F.when(F.col("held") == 1, F.col("frame_id"))).alias("first_in"), F.min("frame_id").alias("first_frame"))
    best = F.min(F.when(F.col("votes") > 0, F.struct((-F.col("votes")).alias("neg"), "first", "seat_id", "votes", "n_in", "first_in"))).alias("b")
    out = seats.groupBy("round_id", "track_id").agg(best, F.sum("votes").alias("n_obs"), F.min("first_frame").alias("first_frame"))
    via = F.when(F.col("b.seat_id").isNotNull(), F.when(F.col("b.n_in") > F.col("b.votes") / 2, "inside").otherwise("nearest"))
    entered = [F.coalesce("b.first_in", "first_frame").alias("entry_frame")] if entry else []
    return out.select("round_id", "track_id", F.col("b.seat_id").alias("seat_id"), via.alias("seat_via"), g.r4(F.col("b.votes") / F.col("n_obs")).alias("vote_share"), "n_obs", *entered)


def vote_select(samples: DataFrame) -> DataFrame:
    """Per segment the card most often nearest to a tip (C1), or the card closest overall (C2) if it is closer than C1 ever was and over 20 px away.

    samples: round_id, seg_id, frame_id, tip, tx, ty, det_id, cx, cy, one row per sample, tip and eligible card.
    """
    d = g.distance(F.col("cx"), F.col("cy"), F.col("tx"), F.col("ty"))
    rows = samples.withColumns({"d": d, "gx": g.grid_key(F.col("cx")), "gy": g.grid_key(F.col("cy"))})
    near = F.min(F.struct("d", "det_id", "cx", "cy", "gx", "gy")).alias("b")
    votes = rows.groupBy("round_id", "seg_id", "frame_id", "tip").agg(near).select("round_id", "seg_id", "frame_id", "tip", "b.*")
    keyed = votes.groupBy("round_id", "seg_id", "gx", "gy").agg(F.count("*").alias("votes"), F.min(F.struct("frame_id", "tip", "det_id", "cx", "cy")).alias("first"), F.max("frame_id").alias("last_frame"), F.min("d").alias("dmin"))
    c1 = keyed.groupBy("round_id", "seg_id").agg(F.min(F.struct((-F.col("votes")).alias("v"), "first", "votes", "last_frame", "dmin")).alias("c1"), F.sum("votes").alias("total_votes"))
    c2 = rows.groupBy("round_id", "seg_id").agg(F.min(F.struct("d", "frame_id", "tip", "det_id", "cx", "cy")).alias("c2"))
    apart = g.distance(F.col("c1.first.cx"), F.col("c1.first.cy"), F.col("c2.cx"), F.col("c2.cy"))
    use2 = (F.col("c2.d") < F.col("c1.dmin")) & (apart > 20)
    out = c1.join(c2, ["round_id", "seg_id"]).withColumn("use2", use2)
    return out.select(
        "round_id", "seg_id", F.when(F.col("use2"), F.col("c2.det_id")).otherwise(F.col("c1.first.det_id")).alias("det_id"), F.when(F.col("use2"), F.col("c2.frame_id")).otherwise(F.col("c1.last_frame")).alias("last_frame"),
        F.when(F.col("use2"), F.col("c2.frame_id")).otherwise(F.col("c1.first.frame_id")).alias("det_frame"), F.col("c1.votes").alias("votes"), "total_votes", F.when(F.col("use2"), "global_closest").otherwise("vote_winner").alias("method"),
    )


def seat_boxes(dets: DataFrame, images: DataFrame, pad: int = 10, w: int = 1920, h: int = 1080) -> DataFrame:
    """Per image (round_id, frame_id) and seat the padded union of its boxes inside the image; images without one have a status."""
    rows = assign_seats_template(dets.join(images, ["round_id", "frame_id"], "left_semi")).where("seat is not null")
    box = rows.groupBy("round_id", "frame_id", "seat").agg(
        F.greatest(F.lit(0), F.min("x1") - pad).alias("x1"), F.greatest(F.lit(0), F.min("y1") - pad).alias("y1"), F.least(F.lit(w), F.max("x2") + pad).alias("x2"), F.least(F.lit(h), F.max("y2") + pad).alias("y2")
    )
    box = box.where("x2 > x1 and y2 > y1")
    seen = dets.select("round_id", "frame_id").distinct().withColumn("__seen", F.lit(True))
    out = images.join(seen, ["round_id", "frame_id"], "left").join(box, ["round_id", "frame_id"], "left")
    status = F.when(F.col("__seen").isNull(), "no_detections").when(F.col("seat").isNull(), "no_seats").otherwise("ok")
    return out.withColumn("status", status).drop("__seen")


def sparse_rounds(dets: DataFrame, most: int) -> DataFrame:
    """Rounds whose frames never show more than `most` player seats (and at least one), with the first frame of most detections."""
    rows = assign_seats_template(dets)
    frame = rows.groupBy("round_id", "frame_id").agg(F.count_distinct(F.when(F.col("seat") > 0, F.col("seat"))).alias("seats"), F.count("*").alias("n"))
    out = frame.groupBy("round_id").agg(F.max("seats").alias("max_seats"), F.max(F.struct("n", (-F.col("frame_id")).alias("f"))).alias("b"))
    return out.where(F.col("max_seats").between(1, most)).select("round_id", "max_seats", (-F.col("b.f")).alias("frame_id"), F.col("b.n").alias("n_dets"))


def crowded_frames(dets: DataFrame, least: int = 23) -> DataFrame:
    return dets.groupBy("round_id", "frame_id").agg(F.count("*").alias("n_dets")).where(F.col("n_dets") >= least)


#: Bins of a histogram that finds the values at a rank.
BINS = 1024


def matched(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """left joined with right on keys, where null equals null."""
    other = right.withColumnsRenamed({k: f"__r_{k}" for k in keys})
    same = [left[k].eqNullSafe(F.col(f"__r_{k}")) for k in keys]
    out = left.join(other, reduce(lambda a, b: a & b, same)) if keys else left.join(F.broadcast(other))  # without keys it is one row
    return out.drop(*[f"__r_{k}" for k in keys])


def exact_percentile(df: DataFrame, keys: list[str], value: str, share: float, name: str, bins: int = BINS) -> DataFrame:
    """keys and the exact percentile of `value` (finite; nulls don't count) per group, between two values in proportion.

    A first pass counts a histogram of `bins` bins between a group's least and largest value. A second one orders the different values of the bins alone that hold the two
    ranks, so no task keeps all values of a group. Equal values are added up before they are shuffled.
    """
    rows = df.where(F.col(value).isNotNull()).groupBy(*keys, F.col(value).cast("double").alias("__v")).agg(F.count("*").alias("__n"))
    ends = rows.groupBy(*keys).agg(F.min("__v").alias("__lo"), F.max("__v").alias("__hi"), F.sum("__n").alias("__all"))
    at = F.floor((F.col("__v") - F.col("__lo")) / (F.col("__hi") - F.col("__lo")) * (bins - 1))
    rows = matched(rows, ends, keys).withColumn("__bin", F.when(F.col("__hi") > F.col("__lo"), at).otherwise(0))
    rank = (F.col("__all") - 1) * share
    rows = rows.withColumns({"__first": F.floor(rank), "__second": F.ceil(rank), "__part": rank - F.floor(rank)})
    group = Window.partitionBy(*(keys or [F.lit(0)])).orderBy("__bin").rowsBetween(Window.unboundedPreceding, -1)  # `bins` rows at most
    hist = rows.groupBy(*keys, "__bin", "__first", "__second").agg(F.sum("__n").alias("__in"))
    hist = hist.withColumn("__before", F.coalesce(F.sum("__in").over(group), F.lit(0)))
    holds = lambda r: (F.col(r) >= F.col("__before")) & (F.col(r) < F.col("__before") + F.col("__in"))
    found = matched(rows, hist.where(holds("__first") | holds("__second")).select(*keys, "__bin", "__before"), [*keys, "__bin"])
    inside = Window.partitionBy(*keys, "__bin").orderBy("__v").rowsBetween(Window.unboundedPreceding, -1)
    found = found.withColumn("__before", F.col("__before") + F.coalesce(F.sum("__n").over(inside), F.lit(0))).withColumn("__in", F.col("__n"))
    pick = lambda r: F.max(F.when(holds(r), F.col("__v")))
    two = found.groupBy(*keys).agg(pick("__first").alias("__a"), pick("__second").alias("__b"), F.first("__part").alias("__part"))
    return two.select(*keys, F.when(F.col("__a") == F.col("__b"), F.col("__a")).otherwise((1 - F.col("__part")) * F.col("__a") + F.col("__part") * F.col("__b")).alias(name))


def summary(df: DataFrame, columns: list[str]) -> DataFrame:
    """Mean, median, least and most of each column, one row per column."""
    rows = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("v")) for c in columns])).alias("r")).select("r.*")
    middle = exact_percentile(rows, ["metric"], "v", 0.5, "median")
    out = rows.groupBy("metric").agg(g.r4(F.avg("v")).alias("mean"), F.min("v").alias("least"), F.max("v").alias("most"), F.count_if(F.col("v") > 0).alias("n_any"))
    return out.join(middle, "metric", "left").select("metric", "mean", g.r4(F.col("median")).alias("median"), "least", "most", "n_any")


def track_export(obs: DataFrame) -> DataFrame:
    """Per track first and last centre, observations, mean confidence and majority identity."""
    order = F.struct("frame_id", "det_id", "cx", "cy")
    out = obs.groupBy("round_id", "track_id").agg(F.min(order).alias("a"), F.max(order).alias("z"), F.count("*").alias("n_obs"), g.r4(F.floor(F.sum("conf") * 1e6 + 0.5) / 1e6 / F.count("conf")).alias("mean_conf"))  # summed to six decimals: the same in any order
    names = majority(obs, ["round_id", "track_id"], ["rank", "suit"], ["frame_id", "det_id"]).drop("votes")
    out = out.join(names, ["round_id", "track_id"])
    return out.select("round_id", "track_id", "rank", "suit", F.col("a.frame_id").alias("first_frame"), F.col("z.frame_id").alias("last_frame"), g.r4(F.col("a.cx")).alias("first_x"), g.r4(F.col("a.cy")).alias("first_y"), g.r4(F.col("z.cx")).alias("last_x"), g.r4(F.col("z.cy")).alias("last_y"), "n_obs", "mean_conf")


def auto_window(segs: DataFrame) -> DataFrame:
    """Per label a window (75th percentile of the lengths, truncated, up to a multiple of 5, 10 at least) and its stride."""
    p = exact_percentile(segs.withColumn("__length", F.col("end_frame") - F.col("start_frame") + 1), ["label"], "__length", 0.75, "p75")
    window = F.greatest(F.lit(10), (F.ceil(F.floor("p75") / 5) * 5).cast("int"))
    return p.withColumn("window", window).withColumn("stride", F.greatest(F.lit(2), F.floor(F.col("window") / 4).cast("int"))).select("label", "window", "stride")


def pr_at(df: DataFrame, thresholds: list[float]) -> DataFrame:
    """Accuracy, precision, recall and F1 of score >= threshold against `positive`; 0 where undefined. Rows without a score or a truth don't count.

    Rows are counted once, by the number of thresholds that they reach; what reaches a threshold is the sum over the counts from there on.
    """
    known = sorted({float(x) for x in thresholds})
    reached = reduce(lambda a, b: a + b, [F.when(F.col("score") >= x, 1).otherwise(0) for x in known])
    rows = df.where("score is not null and positive is not null").groupBy(reached.alias("k")).agg(F.count_if("positive").alias("pos"), F.count_if(~F.col("positive")).alias("neg"))
    total = rows.agg(F.sum("pos").alias("all_pos"), F.sum("neg").alias("all_neg"), F.map_from_entries(F.collect_list(F.struct("k", F.struct("pos", "neg")))).alias("at")).where("all_pos is not null")  # a row, of one entry per threshold
    at = F.explode(F.arrays_zip(F.array(*map(F.lit, known)).alias("threshold"), F.sequence(F.lit(1), F.lit(len(known))).alias("k"))).alias("t")
    c = total.select("all_pos", "all_neg", "at", at).select(F.col("t.threshold").alias("threshold"), "all_pos", "all_neg", F.filter(F.map_entries("at"), lambda e: e["key"] >= F.col("t.k")).alias("own"))
    add = lambda part: F.aggregate("own", F.lit(0).cast("long"), lambda n, e: n + e["value"][part])
    c = c.withColumns({"tp": add("pos"), "fp": add("neg")}).withColumns({"fn": F.col("all_pos") - F.col("tp"), "tn": F.col("all_neg") - F.col("fp")})
    ratio = lambda a, b: F.when(b > 0, a / b).otherwise(F.lit(0.0))
    c = c.withColumns({"accuracy": ratio(F.col("tp") + F.col("tn"), F.col("tp") + F.col("tn") + F.col("fp") + F.col("fn")), "precision": ratio(F.col("tp"), F.col("tp") + F.col("fp")), "recall": ratio(F.col("tp"), F.col("tp") + F.col("fn"))})
    f1 = F.when(F.col("precision") + F.col("recall") > 0, 2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall"))).otherwise(F.lit(0.0))
    return c.withColumn("f1", f1).select("threshold", *[g.r4(F.col(x)).alias(x) for x in ("accuracy", "precision", "recall", "f1")])


def cv_summary(df: DataFrame) -> DataFrame:
    return df.groupBy("metric").agg(g.r4(F.avg("value")).alias("mean"), g.r4(F.stddev_pop("value")).alias("std"))


def best_per_class(df: DataFrame, keys: list[str], cls: str, required: int) -> DataFrame:
    """Per group and class the detection of highest confidence (ties: smaller det_id), only for groups with all required classes."""
    best = df.groupBy(*keys, cls).agg(F.max(F.struct("conf", (-F.col("det_id")).alias("d"))).alias("b"))
    out = best.select(*keys, cls, F.col("b.conf").alias("conf"), (-F.col("b.d")).alias("det_id"))
    full = out.groupBy(*keys).agg(F.count("*").alias("n")).where(F.col("n") == required).select(*keys)
    return out.join(full, keys, "left_semi")


def keypoint_box(kps: DataFrame, pad: float = 0.01) -> DataFrame:
    """Per (task, class) the box around two key points or more, padded and clamped to the unit square, as centre and size."""
    lo = lambda c: F.greatest(F.lit(0.0), F.min(F.col(c) / 100) - pad)
    hi = lambda c: F.least(F.lit(1.0), F.max(F.col(c) / 100) + pad)
    b = kps.groupBy("task_id", "class_id").agg(F.count("*").alias("n"), lo("x_pct").alias("a"), hi("x_pct").alias("b"), lo("y_pct").alias("c"), hi("y_pct").alias("d"))
    b = b.where("n >= 2 and b > a and d > c")
    return b.select("task_id", "class_id", "n", *[g.r4(v).alias(k) for k, v in (("bx", (F.col("a") + F.col("b")) / 2), ("by_", (F.col("c") + F.col("d")) / 2), ("bw", F.col("b") - F.col("a")), ("bh", F.col("d") - F.col("c")))])


def keypoint_pivot(kps: DataFrame, slot: Column, slots: int = 7) -> DataFrame:
    """Per (task, class) x, y and v of fixed slots; of several points in a slot the last counts, an empty slot is 0, 0, 0."""
    rows = kps.withColumn("slot", slot).where("slot >= 0")
    last = rows.groupBy("task_id", "class_id").agg(*[F.max(F.when(F.col("slot") == k, F.struct("seq", "x_pct", "y_pct"))).alias(f"s{k}") for k in range(slots)])
    return last.select("task_id", "class_id", *[c for k in range(slots) for c in (F.coalesce(g.r4(F.col(f"s{k}.x_pct") / 100), F.lit(0.0)).alias(f"x{k}"), F.coalesce(g.r4(F.col(f"s{k}.y_pct") / 100), F.lit(0.0)).alias(f"y{k}"), F.when(F.col(f"s{k}").isNotNull(), 2).otherwise(0).alias(f"v{k}"))])


def class_counts(kps: DataFrame, slot: Column, split: Column) -> DataFrame:
    """Instances and visible key points per class and split."""
    rows = kps.withColumns({"slot": slot, "split": split})
    return rows.groupBy("split", "class_id").agg(F.count_distinct("task_id").alias("instances"), F.count_if(F.col("slot") >= 0).alias("keypoints"))


def latest_annotation(tasks: DataFrame) -> DataFrame:
    """Per task the annotation with results that isn't cancelled and was updated last; ties go to the later one.

    Where updated_at is null or empty, created_at counts (if tasks have it), else ''. The result's updated_at is what counted.
    """
    rows = tasks.where(~F.coalesce("was_cancelled", F.lit(False)) & (F.col("n_results") > 0))
    at = F.coalesce(*[F.nullif(F.col(c), F.lit("")) for c in ("updated_at", "created_at") if c in tasks.columns], F.lit(""))
    best = rows.groupBy("task_id").agg(F.max(F.struct(at.alias("u"), "ann_seq", "n_results")).alias("b"))
    return best.select("task_id", "b.ann_seq", "b.n_results", F.col("b.u").alias("updated_at"))
