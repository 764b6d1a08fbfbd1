"""Composed verification pipelines. Each gives one verdict per input segment: passed, or the first stage that failed and why."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roundhouse.functions import geometry as g
from roundhouse.operators import aggregates as agg
from roundhouse.operators import joins, sequences
from roundhouse.operators.datasets import score_windows
from roundhouse.operators.picks import first_per_cluster
from roundhouse.operators.scalar import in_zone, stage_duration
from roundhouse.storage import forget, stored

KEYS = ["round_id", "seg_id"]


def verdict(rows: DataFrame, stages: list[tuple[str, Column, Column]], keep: list[str]) -> DataFrame:
    """rows with passed, stage and reason: stages are (name, failed, reason) in order, the first that failed wins."""
    stage, reason = F.lit(None).cast("string"), F.lit(None).cast("string")
    for name, failed, why in reversed(stages):
        bad = F.coalesce(failed, F.lit(False))
        stage, reason = F.when(bad, F.lit(name)).otherwise(stage), F.when(bad, why).otherwise(reason)
    return rows.withColumns({"stage": stage, "reason": reason}).withColumn("passed", F.col("stage").isNull()).select(*keep, "passed", "stage", "reason")


def spans(segs: DataFrame, dets: DataFrame) -> DataFrame:
    """segs with the first and last frame inside them that has detections (null: none)."""
    within = lambda c: F.when(F.col(c).between(F.col("start_frame"), F.col("end_frame")), F.col(c))
    out = joins.neighbours(segs, dets, F.col("start_frame")).withColumn("first_frame", within("__next")).drop("__prev", "__next")
    return joins.neighbours(out, dets, F.col("end_frame")).withColumn("last_frame", within("__prev")).drop("__prev", "__next")


def verify_hit(segs: DataFrame, dets: DataFrame, cards: DataFrame, least: int = 30) -> DataFrame:
    """Hits and dealer hits: long enough, with cards, a card at the end that wasn't there at the start, in the label's zone.

    cards: the round_ids that have card tables at all. dets: 720p. The chosen card is the rightmost (dealer) or lowest (hit) new one.
    """
    rows = stage_duration(segs, ["hit", "dealer hits"], least).drop("passed", "stage", "reason")
    rows = spans(joins.require_asset(rows, cards, ["round_id"], "none"), dets)
    # only segments that no earlier stage stops are matched
    ready = (F.col("duration") >= least) & (F.col("status") == "ok") & (F.col("first_frame") < F.col("last_frame"))
    found = joins.new_items(rows.where(ready).select(*KEYS, "first_frame", "last_frame"), dets)
    rows = rows.join(found.drop("first_frame", "last_frame"), KEYS, "left")
    zone = F.when(F.col("label") == "hit", F.lit(True)).otherwise(F.lit(False))
    rank = lambda x: F.when(zone, x["y"]).otherwise(x["x"])
    (x1, y1), (x2, y2) = (535, 411), (800, 489)
    ok = F.filter("new", lambda x: F.when(zone, x["y"] >= 450).otherwise(x["x"].between(x1, x2) & x["y"].between(y1, y2)))
    chosen = F.get(F.array_sort(F.transform(ok, lambda x: F.struct((-rank(x)).alias("v"), x["i"].alias("i")))), F.lit(0))["i"]
    rows = rows.withColumns({"n_new": F.size("new"), "n_ok": F.size(ok), "det_id": chosen})
    stages = [
        ("stage1_duration", F.col("duration") < least, F.concat(F.lit("duration="), F.col("duration"), F.lit(f" < {least}"))),
        ("stage2_no_card_jsonl", F.col("status") != "ok", F.lit("no card table")),
        ("stage2_no_detections", F.col("first_frame").isNull(), F.lit("no detections within the segment")),
        ("stage2_bad_frame_order", F.col("first_frame") >= F.col("last_frame"), F.concat(F.lit("start frame "), F.col("first_frame"), F.lit(" >= end frame "), F.col("last_frame"))),
        ("stage2_no_new_card", F.col("n_new") == 0, F.lit("no new card at the end")),
        ("stage3_spatial", F.col("n_ok") == 0, F.concat(F.lit("none of "), F.col("n_new"), F.lit(" new cards in the zone"))),
    ]
    out = verdict(rows, stages, [*KEYS, "label", "det_id"])
    return out.withColumn("det_id", F.when(F.col("passed"), F.col("det_id")))


def verify_call(segs: DataFrame, dets: DataFrame, hands: DataFrame, cards: DataFrame, least: int = 45, stride: int = 5) -> DataFrame:
    """Calls for action: long enough, with hands and cards in a sampled frame (cards up to two frames away), then the two-criterion vote."""
    rows = stage_duration(segs, ["call for action"], least).drop("passed", "stage", "reason")
    rows = joins.require_asset(joins.require_asset(rows, hands.select("round_id").distinct(), ["round_id"], "none").withColumnRenamed("status", "has_pose"), cards, ["round_id"], "none")
    frames = sequences.sample_frames(rows.select(*KEYS, "start_frame", "end_frame"), stride).drop("start_frame", "end_frame")
    seen = hands.where("x8 > 0.01 or y8 > 0.01").groupBy("round_id", "frame_id").agg(F.count_distinct("hand").alias("n")).where("n = 2").select("round_id", "frame_id")
    posed = frames.join(seen, ["round_id", "frame_id"]).select(*KEYS, F.col("frame_id").alias("at"))
    near = joins.asof_offset(posed, dets, "at", 2)
    count = near.groupBy(*KEYS).agg(F.count("*").alias("n_samples"), F.count("asof_frame").alias("n_valid"))
    tips = hands.select("round_id", F.col("frame_id").alias("at"), F.col("hand").alias("tip"), F.floor(F.col("x8") * 1280).cast("double").alias("tx"), F.floor(F.col("y8") * 720).cast("double").alias("ty"))
    eligible = dets.where(in_zone("call")).select("round_id", F.col("frame_id").alias("asof_frame"), "det_id", "cx", "cy")
    samples = near.where("asof_frame is not null").join(tips, ["round_id", "at"]).join(eligible, ["round_id", "asof_frame"]).withColumnRenamed("at", "frame_id")
    rows = rows.join(count, KEYS, "left").join(agg.vote_select(samples), KEYS, "left")
    stages = [
        ("stage1_duration", F.col("duration") < least, F.concat(F.lit("duration="), F.col("duration"), F.lit(f" < {least}"))),
        ("stage2_no_pkl", F.col("has_pose") != "ok", F.lit("no pose table")),
        ("stage2_no_card_jsonl", F.col("status") != "ok", F.lit("no card table")),
        ("stage2_no_valid_samples", F.coalesce("n_valid", F.lit(0)) == 0, F.concat(F.coalesce("n_samples", F.lit(0)), F.lit(" pose samples, none with cards"))),
        ("stage3_no_votes", F.col("votes").isNull(), F.lit("no card votes could be cast")),
    ]
    out = verdict(rows, stages, [*KEYS, "det_id", "method", "votes"])
    return out.withColumns({c: F.when(F.col("passed"), F.col(c)) for c in ("det_id", "method", "votes")})


def verify_tap(segs: DataFrame, dets: DataFrame, kps: DataFrame, dip: float = 0.02, zone: str = "tap") -> DataFrame:
    """Taps: a fingertip moves down and up over the table, near a card of the player zone, and no new card appears."""
    rows = joins.require_asset(segs.where("label = 'tap'"), kps.select("round_id").distinct(), ["round_id"], "none")
    rows = rows.join(sequences.tap_motion(rows, kps, dip=dip), KEYS, "left")
    tapped = rows.where("tap_frame is not null").select(*KEYS, "tap_frame", F.col("tap_x").alias("px"), F.col("tap_y").alias("py"))
    at = joins.asof_offset(tapped, dets, "tap_frame", 9).withColumnRenamed("asof_frame", "frame_id")
    near = joins.nearest_detection(at.where("frame_id is not null"), dets, 150.0, in_zone(zone)).select(*KEYS, "det_id", "distance", F.col("frame_id").alias("card_frame"))
    rejected = sequences.count_increased(segs.where("label = 'tap'"), dets, in_zone(zone)).select(*KEYS, "rejected")
    rows = rows.join(near, KEYS, "left").join(rejected, KEYS, "left")
    stages = [
        ("stage1_no_pose", F.col("status") != "ok", F.lit("no pose table")),
        ("stage1_no_tap_motion", F.col("tap_frame").isNull(), F.lit("no tap motion")),
        ("stage1_above_table", F.col("tap_y") < 480, F.lit("tap above the table")),
        ("stage2_no_card", F.col("det_id").isNull(), F.lit("no card within reach")),
        ("stage3_new_card", F.col("rejected"), F.lit("a new card appears")),
    ]
    out = verdict(rows, stages, [*KEYS, "tap_frame", "hand", "kp", "det_id"])
    return out.withColumn("det_id", F.when(F.col("passed"), F.col("det_id")))


def split_candidates(segs: DataFrame, dets: DataFrame, top: int = 10) -> DataFrame:
    """The first `top` pairs of one rank per segment (KEYS, start_frame, end_frame), one per rank and 50 px of x, as track_pair takes them."""
    pairs = joins.point_in_interval_join(joins.pair_self_join(dets), segs.select(*KEYS, "start_frame", "end_frame"), ["round_id"], "frame_id")
    found = first_per_cluster(pairs, KEYS, 50).where(F.col("pair_no") <= top)
    places = [F.col(f"{p}_{n}").alias(f"s_{p}{m}") for p in "ab" for n, m in (("cx", "x"), ("cy", "y"), ("suit", "suit"))]
    return found.select(*KEYS, "pair_no", F.col("rank_norm").alias("pair_rank"), F.col("frame_id").alias("start_frame"), F.col("end_frame").alias("last_frame"), F.col("a_det_id").alias("start_a"), F.col("b_det_id").alias("start_b"), *places)


def widest_pair(moved: DataFrame, also: Sequence[str] = ()) -> DataFrame:
    """Per segment the tracked pair of largest spread (ties: smaller pair_no) and how many there are; also: more columns of the pair."""
    best = F.min(F.struct((-F.col("spread")).alias("s"), "pair_no", "end_frame", "end_a", "end_b", *also)).alias("b")
    out = moved.groupBy(*KEYS).agg(F.count("*").alias("n_pairs"), best)
    return out.select(*KEYS, "n_pairs", (-F.col("b.s")).alias("spread"), "b.pair_no", F.col("b.end_frame").alias("pair_end_frame"), "b.end_a", "b.end_b", *[f"b.{c}" for c in also])


def verify_split(segs: DataFrame, dets: DataFrame, cards: DataFrame, hands: DataFrame | None = None, least: int = 25, spread: int = 5, top: int = 10) -> DataFrame:
    """Splits: long enough, a same-rank pair that overlaps, and one of the first pairs moves apart by `spread` px at least.

    hands: round_id, frame_id, h0x, h0y, h1x, h1y, as hands_wide gives them. A passing pair has start_a and start_b with the end card of each, end_of_a and end_of_b,
    resolved by suits, hands or (via: fallback) the order of the match.
    """
    rows = joins.require_asset(stage_duration(segs, ["split"], least).drop("passed", "stage", "reason"), cards, ["round_id"], "none")
    zone = stored(sequences.paired_cards(dets.where(in_zone("split"))), "split-cards")  # pairs are found and followed in it
    good = stored(spans(rows, dets), "split-spans")
    live = good.where((F.col("duration") >= least) & (F.col("status") == "ok"))
    candidates = stored(split_candidates(live, zone, top), "split-candidates")
    ends = [x.split()[0] for x in sequences.END_CARDS.split(", ")]
    best = stored(widest_pair(sequences.track_pair(candidates.drop("start_a", "start_b"), zone, ends=True), ends), "split-pairs")
    forget(zone)
    rows = good.join(best, KEYS, "left")
    stages = [
        ("stage1_duration", F.col("duration") < least, F.concat(F.lit("duration="), F.col("duration"), F.lit(f" < {least}"))),
        ("stage2_no_card_jsonl", F.col("status") != "ok", F.lit("no card table")),
        ("stage2_no_detections", F.col("first_frame").isNull(), F.lit("no detections within the segment")),
        ("stage2_no_same_rank_pair", F.col("n_pairs").isNull(), F.lit("no same-rank pair found")),
        ("stage3_no_spread", F.col("spread") < spread, F.when(F.col("spread") < 0, "no match").otherwise(F.concat(F.lit("best_move="), F.col("spread"), F.lit("px")))),
    ]
    out = verdict(rows, stages, [*KEYS, "pair_no", "spread", "pair_end_frame", "end_a", "end_b", *ends])
    return out.drop("end_a", "end_b", *ends).join(split_cards(out.where("passed"), candidates, hands), KEYS, "left")


def split_cards(passed: DataFrame, candidates: DataFrame, hands: DataFrame | None) -> DataFrame:
    """The cards of passing pairs: KEYS, start_a, start_b, end_of_a, end_of_b and via."""
    rows = passed.drop("spread", "passed", "stage", "reason").join(candidates.withColumnRenamed("start_frame", "pair_start_frame"), [*KEYS, "pair_no"])
    rows = rows.withColumnsRenamed({f"s_{p}{m}": f"s{k}{n}" for k, p in enumerate("ab") for m, n in (("x", "x"), ("y", "y"), ("suit", "_suit"))})
    for side, frame in (("s", "pair_start_frame"), ("e", "pair_end_frame")):
        names = [f"h{k}{c}" for k in (0, 1) for c in "xy"]
        if hands is None:
            rows = rows.withColumns({side + n: F.lit(None).cast("double") for n in names})
        else:
            rows = rows.join(hands.select("round_id", F.col("frame_id").alias(frame), *[F.col(n).alias(side + n) for n in names]), ["round_id", frame], "left")
    rows = joins.resolve_pair(rows.withColumn("swapped", F.lit(False)))
    own, other = (F.when(F.col("first_end") == x, F.col("end_a")).otherwise(F.col("end_b")) for x in "ab")
    return rows.select(*KEYS, "start_a", "start_b", own.alias("end_of_a"), other.alias("end_of_b"), "via")


def verify_clean(segs: DataFrame, frames: DataFrame) -> DataFrame:
    """Clean hands: no frame says that the game is paused."""
    rows = joins.reject_by_text(segs.where("label = 'clean hand'").select(*KEYS, "start_frame", "end_frame"), frames)
    stage = F.when(F.col("reason") == "no frames", "stage1_no_frames").when(F.col("reason").isNotNull(), "stage1_paused")
    return rows.select(*KEYS, "passed", stage.alias("stage"), "reason")


def label_round(dets: DataFrame, obbs: DataFrame, rep: DataFrame | None = None, **tracker) -> DataFrame:
    """Tracks of every round with identity, seat, ordinal, split pile and double flag, first and last centre and mean confidence.

    dets: 720p. rep: (round_id, rep_frame), the frame whose layout decides; without it the last places and the zigzag rule count.
    Splits come before doubles, since split seats have none.
    """
    tk = ["round_id", "track_id"]
    obs = stored(sequences.track_items(sequences.dedup_spatial(dets), **tracker), "round-tracks")  # read many times below
    who = agg.majority(obs, tk, ["rank", "suit"], ["frame_id", "det_id"]).drop("votes").where("not (rank = 'CB' and suit = 'CB')")
    obs = obs.join(who.select(*tk), tk, "left_semi")
    seats = stored(agg.seat_vote(obs, obbs), "round-seats")
    ords = sequences.seat_ordinal(obs, seats, obbs)
    life = obs.groupBy(*tk).agg(F.min("frame_id").alias("first_frame"), F.max("frame_id").alias("last_frame"))
    at = obs.join(rep, "round_id", "left") if rep is not None else obs.withColumn("rep_frame", F.lit(None).cast("int"))
    near = F.when(F.col("rep_frame").isNull(), -F.col("frame_id")).otherwise(F.abs(F.col("frame_id") - F.col("rep_frame")))
    place = at.groupBy(*tk).agg(F.min(F.struct(near.alias("d"), "frame_id", "cx", "cy")).alias("p"), F.max("rep_frame").alias("rep_frame"))
    cards = ords.join(place, tk).join(life, tk).join(who, tk)
    alive = F.col("rep_frame").isNull() | F.col("rep_frame").between(F.col("first_frame"), F.col("last_frame"))
    cards = stored(cards.select(*tk, "seat_id", "ordinal", "rank", F.col("p.cx").alias("cx"), F.col("p.cy").alias("cy"), alive.alias("alive"), F.col("rep_frame").isNotNull().alias("by_frame")), "round-cards")
    seat = ["round_id", "seat_id"]
    split = sequences.split_seats(cards, obbs).select(*seat).distinct()
    piles = sequences.two_means(cards.join(split, seat, "left_semi")).select(*seat, "ordinal", "pile")
    rest = cards.join(split, seat, "left_anti")
    seen = rest.where("by_frame and alive").join(obbs, seat).where(g.point_in_obb(F.col("cx"), F.col("cy"), g.corners())).select(*rest.columns)
    double = sequences.fan_double(seen).select(*seat, "double_ordinal").unionByName(sequences.zigzag(rest.where("not by_frame"), obbs))
    ends = agg.track_export(obs).select(*tk, "first_x", "first_y", "last_x", "last_y", "mean_conf")
    out = seats.join(who, tk).join(life, tk).join(ends, tk).join(ords.select(*tk, "ordinal"), tk, "left").join(piles, [*seat, "ordinal"], "left").join(double, seat, "left")
    return out.select(*tk, "rank", "suit", "seat_id", "seat_via", "vote_share", "ordinal", F.coalesce("pile", F.lit(0)).alias("split_pile"), F.coalesce(F.col("ordinal") == F.col("double_ordinal"), F.lit(False)).alias("double"), "first_frame", "last_frame", "first_x", "first_y", "last_x", "last_y", "n_obs", "mean_conf")


def detect_actions(features: DataFrame, gallery: DataFrame | None, exclude: DataFrame, ids: DataFrame, width: int = 10, stride: int = 5, bins: int = 2, threshold: float = 0.5, topn: int = 3, model=None, focus: int | None = None) -> DataFrame:
    """Windows of videos that aren't excluded, scored, suppressed, with task ids, at `threshold` or more.

    The score is the similarity of the nearest gallery vector or, with a model of fit_window_classifier, its probability of label `focus` (g_id is null then).
    features: video_id, frame_idx, embedding. gallery: g_id, g_vec. ids: video_id, task_id.
    """
    own = joins.exclude(features, exclude, ["video_id"])
    lengths = own.groupBy("video_id").agg((F.max("frame_idx") + 1).alias("n"))
    w = sequences.sliding_windows(lengths, width, stride).drop("n")
    vec = stored(sequences.temporal_bins(w, own, bins).where(F.size("vec") > 0).withColumn("seg_id", F.monotonically_increasing_id()), "action-windows")  # numbered as they are written
    if model is None:
        score = joins.top1_similarity(vec.select(F.col("seg_id").alias("q_id"), F.col("vec").alias("q_vec")), gallery)
        rows = vec.join(score.withColumnRenamed("q_id", "seg_id"), "seg_id").withColumn("score", F.col("best"))
    else:
        rows = score_windows(model, vec, focus).withColumn("g_id", F.lit(None).cast("long"))
    rows = stored(rows.select("video_id", "seg_id", "start_frame", "end_frame", "score", "g_id"), "action-scores")  # read twice below
    kept = sequences.nms_1d(rows, ["video_id"], topn=topn).where(F.col("score") >= threshold)
    out = joins.lookup_ids(kept, ids, "video_id").join(rows.select("seg_id", "g_id"), "seg_id")
    return out.select("video_id", "task_id", (F.col("place") + 1).alias("rank"), "start_frame", "end_frame", "score", "g_id")
