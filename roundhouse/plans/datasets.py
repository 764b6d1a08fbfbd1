"""Queries of dataset building."""

from __future__ import annotations

from pyspark.sql import functions as F

from roundhouse.operators import datasets as d
from roundhouse.operators import training
from roundhouse.operators.sequences import segment_mean
from roundhouse.plans.aggregates import LATEST
from roundhouse.plans.joins import DOT
from roundhouse.plans.picks import random_order
from roundhouse.plans.registry import query
from roundhouse.plans.scalars import r4


@query("split_sorted_ratio", "SELECT c_name, CASE WHEN row_number() OVER (ORDER BY c_name) <= FLOOR(count(*) OVER () * 0.8) THEN 'train' ELSE 'test' END AS split FROM customer")
def _(t):
    return d.split_sorted(t.customer, "c_name")


@query("split_hash_ratio", f"""WITH g AS (SELECT DISTINCT round_id FROM {{segments}}), p AS (SELECT round_id, row_number() OVER (ORDER BY {random_order('round_id')}) AS place, count(*) OVER () AS n FROM g)
    SELECT s.round_id, s.seg_id, CASE WHEN place <= least(FLOOR(n * CAST(0.8 AS DOUBLE)), n - 1) THEN 'train' ELSE 'test' END AS split FROM {{segments}} s JOIN p ON s.round_id = p.round_id""")
def _(t):
    return d.split_hashed(t.segments.select("round_id", "seg_id"), "round_id")


STRATA = f"SELECT seg_id, label = 'split' AS positive, row_number() OVER (PARTITION BY label = 'split' ORDER BY {random_order('seg_id')}) AS place, count(*) OVER (PARTITION BY label = 'split') AS n FROM {{segments}}"


@query("stratified_split", f"SELECT seg_id, positive, CASE WHEN place <= greatest(1, round_even(n * CAST(0.2 AS DOUBLE), 0)) THEN 'val' ELSE 'train' END AS split FROM ({STRATA})")
def _(t):
    return d.split_stratified(t.segments.select("seg_id", (F.col("label") == "split").alias("positive")), "positive", ["seg_id"])


@query("stratified_kfold", f"SELECT seg_id, positive, CAST((place - 1) % 5 AS INTEGER) AS fold FROM ({STRATA})")
def _(t):
    return d.kfold_stratified(t.segments.select("seg_id", (F.col("label") == "split").alias("positive")), "positive", ["seg_id"])


@query("oversample_train", "SELECT seg_id, copy, CASE WHEN copy > 0 THEN concat('s', seg_id, '_r', copy) ELSE concat('s', seg_id) END AS name FROM (SELECT seg_id, CAST(unnest(range(CASE WHEN label = 'split' AND seg_id % 5 <> 0 THEN 5 ELSE 1 END)) AS INTEGER) AS copy FROM {segments})")
def _(t):
    rows = t.segments.withColumn("name", F.concat(F.lit("s"), F.col("seg_id")))
    return d.oversample(rows, (F.col("label") == "split") & (F.col("seg_id") % 5 != 0)).select("seg_id", "copy", "name")


ANNOTATED = """SELECT s.round_id, s.seg_id, s.label, CASE WHEN s.seg_id % 3 = 0 THEN '12' END AS meta_text, CAST(coalesce(b.n, 0) AS INT) AS n_boxes, b.k AS n_keyframes
    FROM {segments} s LEFT JOIN (SELECT s.seg_id, count(*) AS n, min(b.n_keyframes) AS k FROM {segments} s JOIN {boxes} b ON s.round_id = b.round_id AND b.anchor_frame BETWEEN s.start_frame AND s.end_frame GROUP BY s.seg_id) b ON s.seg_id = b.seg_id"""


@query("validate_annotations", f"""WITH a AS ({ANNOTATED}), m AS (SELECT round_id, seg_id, label, 'meta_missing' AS rule FROM a WHERE label IN ('initial hands 1st', 'initial hands 2nd', 'discard') AND coalesce(meta_text, '') = ''
      UNION ALL SELECT round_id, seg_id, label, 'needs_one_box_two_keyframes' FROM a WHERE label IN ('split', 'hit') AND NOT (n_boxes = 1 AND coalesce(n_keyframes, 0) = 2) UNION ALL SELECT round_id, seg_id, label, 'needs_one_box' FROM a WHERE label IN ('tap', 'call for action') AND n_boxes <> 1)
    SELECT * FROM m UNION ALL SELECT DISTINCT round_id, CAST(NULL AS BIGINT), CAST(NULL AS VARCHAR), 'OK' FROM a WHERE round_id NOT IN (SELECT round_id FROM m)""")
def _(t):
    return d.validate_annotations(t.sql(ANNOTATED))


@query("extract_export_segments", """WITH n AS (SELECT s.seg_id, count(*) AS n, string_agg(CAST(b.box_id AS VARCHAR), ',' ORDER BY b.box_id) AS boxes FROM {segments} s JOIN {boxes} b ON s.round_id = b.round_id AND b.anchor_frame BETWEEN s.start_frame AND s.end_frame GROUP BY s.seg_id)
    SELECT s.round_id, s.seg_id, s.label, CAST(row_number() OVER (PARTITION BY s.round_id ORDER BY start_frame, s.seg_id) AS INTEGER) AS place, CAST(coalesce(n.n, 0) AS INTEGER) AS n_boxes, coalesce(n.boxes, '') AS boxes, end_frame - start_frame AS span_exclusive FROM {segments} s LEFT JOIN n ON s.seg_id = n.seg_id""")
def _(t):
    """Segments and boxes written as one mixed list of items per round, then read."""
    null = lambda *names: [F.lit(None).cast("int").alias(n) for n in names]
    ranges = t.segments.select("round_id", F.struct(F.lit("range").alias("type"), F.col("seg_id").alias("id"), F.col("start_frame").alias("start"), F.col("end_frame").alias("end"), "label", *null("frame", "x1", "y1", "x2", "y2")).alias("r"))
    boxes = t.boxes.select("round_id", F.struct(F.lit("rectangle").alias("type"), F.col("box_id").alias("id"), *null("start", "end"), F.lit(None).cast("string").alias("label"), F.col("anchor_frame").alias("frame"), "x1", "y1", "x2", "y2").alias("r"))
    tasks = ranges.unionByName(boxes).groupBy("round_id").agg(F.collect_list("r").cast(d.EXPORT).alias("result"))
    return d.extract_export(tasks).select("round_id", "seg_id", "label", "place", "n_boxes", F.coalesce(F.array_join(F.transform("boxes", lambda x: x.cast("string")), ","), F.lit("")).alias("boxes"), "span_exclusive")


HUMAN = "SELECT task_id, ann_seq, CAST(task_id % 3 AS INT) AS box_no, CAST(10 + task_id % 50 AS DOUBLE) AS x, CAST(20 + ann_seq AS DOUBLE) AS y, CAST(30 AS DOUBLE) AS w, CAST(12 AS DOUBLE) AS h, CAST(task_id % 90 AS DOUBLE) AS degrees FROM {tasks} WHERE task_id % 4 <> 0"


@query("human_boxes_to_entries", f"""WITH l AS ({LATEST}), b AS (SELECT b.* FROM ({HUMAN}) b JOIN l ON b.task_id = l.task_id AND b.ann_seq = l.ann_seq)
    SELECT a.task_id, b.box_no, FLOOR((x + w * cos(radians(degrees))) * 1000 + 0.5) / 1000 AS c1x, FLOOR((y + w * sin(radians(degrees))) * 1000 + 0.5) / 1000 AS c1y, CASE WHEN l.task_id IS NULL THEN 'no_annotation' WHEN b.task_id IS NULL THEN 'no_boxes' ELSE 'ok' END AS status
    FROM (SELECT DISTINCT task_id FROM {{tasks}}) a LEFT JOIN l ON a.task_id = l.task_id LEFT JOIN b ON a.task_id = b.task_id""")
def _(t):
    return d.human_boxes(t.tasks, t.sql(HUMAN)).select("task_id", "box_no", "c1x", "c1y", "status")


_CORNERS = [f"c{k}{a}" for k in range(4) for a in "xy"]


@query("obb_label_lines", "SELECT round_id, seat_id, printf('" + " ".join(["%.1f"] * 8) + " class_%d 0', " + ", ".join(_CORNERS) + ", seat_id) AS dota_line, printf('%d " + " ".join(["%.6g"] * 8) + "', seat_id, " + ", ".join(f"{c} / CAST({1279 if c.endswith('x') else 719} AS DOUBLE)" for c in _CORNERS) + ") AS obb_line FROM {seat_obbs}")
def _(t):
    return d.obb_label_lines(t.seat_obbs.withColumn("class_id", F.col("seat_id")), 1279.0, 719.0).select("round_id", "seat_id", "dota_line", "obb_line")


@query("split_field_override", "SELECT seg_id, CASE WHEN bool_or(seg_id % 10 = 0) OVER () THEN CASE WHEN seg_id % 10 = 0 THEN 'val' ELSE 'train' END ELSE CASE WHEN seg_id % 5 = 0 THEN 'val' ELSE 'train' END END AS split FROM {segments}")
def _(t):
    rows = t.segments.select("seg_id", F.when(F.col("seg_id") % 10 == 0, "val").alias("split"))
    return d.apply_split_field(rows, F.when(F.col("seg_id") % 5 == 0, "val").otherwise("train"))


HARD = f"""WITH i AS (SELECT video_id * 50 + frame_idx AS id, label_id, embedding FROM {{features}}), n AS (SELECT q.id AS q_id, max({r4(DOT)}) AS neg, arg_min(g.id, struct_pack(a := -({r4(DOT)}), b := g.id)) AS neg_id FROM i q JOIN i g ON q.label_id = 1 AND g.label_id <> 1 GROUP BY 1),
    o AS (SELECT id, embedding, row_number() OVER (ORDER BY {random_order('id')}) AS place, count(*) OVER () AS size FROM i WHERE label_id = 1), p AS (SELECT q.id AS q_id, g.id AS pos_id, {r4(DOT)} AS pos FROM o q JOIN o g ON g.place = q.place % q.size + 1 AND g.id <> q.id)
    SELECT n.q_id, neg, neg_id, pos_id, pos, CASE WHEN pos IS NOT NULL THEN {r4('greatest(CAST(0 AS DOUBLE), CAST(0.2 AS DOUBLE) - pos + neg)')} END AS loss FROM n LEFT JOIN p ON n.q_id = p.q_id"""


def _items(t):
    return t.features.select((F.col("video_id").cast("long") * 50 + F.col("frame_idx")).alias("id"), "label_id", F.col("embedding").alias("vec"))


@query("hard_negative_mining", HARD)
def _(t):
    return d.mine_hard_negatives(_items(t), 1)


@query("negative_pools", f"""WITH i AS (SELECT video_id * 50 + frame_idx AS id, label_id FROM {{features}}), c AS (SELECT count(CASE WHEN label_id IN (2) THEN 1 END) AS n_hard, count(CASE WHEN label_id NOT IN (1, 2) THEN 1 END) AS n_soft FROM i),
    a AS (SELECT id AS q_id, row_number() OVER (ORDER BY {random_order('id')}) AS place, n_hard, n_soft, least(n_soft, greatest(1, 60 - n_hard)) AS k FROM i, c WHERE label_id = 1), s AS (SELECT id, row_number() OVER (ORDER BY {random_order('id')}) AS place FROM i WHERE label_id NOT IN (1, 2)),
    w AS (SELECT q_id, n_hard, ((place - 1) * k + j) % n_soft + 1 AS place FROM (SELECT *, unnest(range(k)) AS j FROM a))
    SELECT q_id, n_hard, list(s.id ORDER BY s.id) AS soft FROM w JOIN s ON w.place = s.place GROUP BY q_id, n_hard""")
def _(t):
    """Pools of 60: every item of label 2 and soft ones."""
    return d.negative_pools(_items(t).select("id", "label_id"), 1, [2], 60)


@query("filter_videos_with_label", "SELECT DISTINCT round_id FROM {segments} WHERE label = 'split'")
def _(t):
    return d.with_label(t.segments.select("round_id").distinct(), t.segments, "split")


@query("window_classifier")
def _(t):
    """No SQL twin: an iterative fit. One row per segment with the probability of class 1; held-out accuracy is tested."""
    w = segment_mean(t.feature_segments, t.features)
    model = d.fit_window_classifier(w.where("video_id % 5 <> 0"))
    return d.score_windows(model, w, 1).select("video_id", "start_frame", "end_frame", "label_id", F.round("score", 4).alias("score"))


@query("window_classifier_balanced")
def _(t):
    """No SQL twin: an iterative fit on balanced draws (a quarter of each batch is class 1), tested against a plain loop. One row per segment with the probability of class 1."""
    w = segment_mean(t.feature_segments, t.features)
    classes = w.agg(F.max("label_id")).first()[0]
    model = training.fit_balanced(w.where("video_id % 5 <> 0"), ["video_id", "start_frame"], 1, 1 + (classes or 0), batch=64, epochs=3)
    return training.with_probability(model, w, 1).select("video_id", "start_frame", "end_frame", "label_id", F.round("score", 4).alias("score"))
