"""Queries of aggregations."""

from __future__ import annotations

from pyspark.sql import functions as F

from roundhouse.functions import geometry as g
from roundhouse.operators import aggregates as a
from roundhouse.operators import scalar as s
from roundhouse.plans.joins import SEAT_OF_POINT, SLICES
from roundhouse.plans.registry import query
from roundhouse.plans.scalars import SEATED, hyp, r4

SLOT = "CASE WHEN CAST(substr(kp_label, 2) AS INTEGER) BETWEEN 1 AND 7 THEN CAST(substr(kp_label, 2) AS INTEGER) - 1 ELSE -1 END"


@query("coverage_report", f"""WITH s AS (SELECT *, lead(chunk_start) OVER (PARTITION BY round_id ORDER BY chunk_start) - chunk_start > 300 AS gap FROM ({SLICES})),
    x AS (SELECT round_id, min(chunk_start) AS a, max(chunk_start) + 299 AS z, bool_or(coalesce(gap, false)) AS gap, CAST(sum(slice_to - slice_from) AS BIGINT) AS merged FROM s GROUP BY round_id)
    SELECT r.round_id, end_1idx - start_1idx + 1 AS expected, coalesce(merged, 0) AS merged, CASE WHEN merged IS NULL THEN 'no_match' WHEN a <= start_1idx - 1 AND z >= end_1idx - 1 AND NOT gap AND merged >= end_1idx - start_1idx + 1 THEN 'full' ELSE 'partial' END AS status
    FROM {{rounds}} r LEFT JOIN x ON r.round_id = x.round_id""")
def _(t):
    return a.coverage(t.rounds, t.chunks)


@query("active_seats_string", f"SELECT round_id, frame_id, coalesce(string_agg(DISTINCT CASE WHEN seat > 0 THEN CAST(seat AS VARCHAR) END, '' ORDER BY CASE WHEN seat > 0 THEN CAST(seat AS VARCHAR) END), '') AS active_seats FROM ({SEATED}) GROUP BY round_id, frame_id")
def _(t):
    return a.active_seats(t.detections, ["round_id", "frame_id"])


@query("meta_text_by_round", f"""WITH f AS (SELECT round_id, CAST(10 * FLOOR(end_frame / 10) AS INT) AS frame_id FROM (SELECT *, row_number() OVER (PARTITION BY round_id ORDER BY start_frame, seg_id) AS rn FROM {{segments}} WHERE label = 'initial hands 1st') WHERE rn = 1),
    x AS (SELECT f.round_id, coalesce(string_agg(DISTINCT CASE WHEN seat > 0 THEN CAST(seat AS VARCHAR) END, '' ORDER BY CASE WHEN seat > 0 THEN CAST(seat AS VARCHAR) END), '') AS txt FROM f LEFT JOIN ({SEATED}) d ON d.round_id = f.round_id AND d.frame_id = f.frame_id GROUP BY f.round_id)
    SELECT s.round_id, s.seg_id, s.label, CASE WHEN s.label IN ('initial hands 1st', 'initial hands 2nd', 'discard') THEN txt END AS meta_text FROM {{segments}} s LEFT JOIN x ON s.round_id = x.round_id""")
def _(t):
    """The flagship: seats that hold cards at the end of a round's first deal, written to three kinds of labels."""
    frame = 10 * F.floor(F.col("end_frame") / 10)
    return a.meta_text(t.segments, t.detections, frame).select("round_id", "seg_id", "label", "meta_text")


@query("label_distribution_rollup", f"""SELECT source, label, count(*) AS n, CAST(grouping(source, label) AS INTEGER) AS level, {r4('count(*) * CAST(100 AS DOUBLE) / max(count(*)) OVER ()')} AS percent FROM (SELECT *, CASE WHEN seg_id % 2 = 0 THEN 'human' ELSE 'auto' END AS source FROM {{segments}}) GROUP BY ROLLUP (source, label)""")
def _(t):
    return a.label_distribution(t.segments.withColumn("source", F.when(F.col("seg_id") % 2 == 0, "human").otherwise("auto")))


@query("stage_funnel_stats", "SELECT label, CASE WHEN end_frame - start_frame + 1 < 30 THEN 'stage1_duration' END AS stage, count(*) AS n FROM {segments} WHERE label IN ('hit', 'split', 'call for action') GROUP BY ALL")
def _(t):
    return a.funnel(s.stage_duration(t.segments, ["hit", "split", "call for action"], 30))


@query("frame_label_distribution", f"""WITH f AS (SELECT round_id, label FROM (SELECT round_id, label, unnest(range(start_frame, end_frame + 1)) AS frame_id FROM {{segments}})) SELECT round_id, label, count(*) AS n, {r4('count(*) * CAST(100 AS DOUBLE) / sum(count(*)) OVER (PARTITION BY round_id)')} AS percent FROM f GROUP BY round_id, label""")
def _(t):
    return a.frame_label_stats(t.segments.select("round_id", "label", F.explode(F.sequence("start_frame", "end_frame")).alias("frame_id")))


MAJORITY = "SELECT round_id, track_id, rank, suit, votes FROM (SELECT round_id, track_id, rank, suit, count(*) AS votes, row_number() OVER (PARTITION BY round_id, track_id ORDER BY count(*) DESC, min(CAST(frame_id AS BIGINT) * 10000000 + det_id)) AS rn FROM {tracks} GROUP BY round_id, track_id, rank, suit) WHERE rn = 1"


@query("majority_vote_identity", MAJORITY)
def _(t):
    return a.majority(t.tracks, ["round_id", "track_id"], ["rank", "suit"], ["frame_id", "det_id"])


SEAT_VOTE = f"""WITH v AS (SELECT k.round_id, k.track_id, k.frame_id, k.det_id, k.cx, k.cy, b.seat_id FROM {{tracks}} k LEFT JOIN ({SEAT_OF_POINT}) b ON k.round_id = b.round_id AND k.det_id = b.det_id),
    w AS (SELECT round_id, track_id, seat_id, count(*) AS votes, row_number() OVER (PARTITION BY round_id, track_id ORDER BY count(*) DESC, min(CAST(frame_id AS BIGINT) * 10000000 + det_id)) AS rn FROM v GROUP BY round_id, track_id, seat_id)
    SELECT w.round_id, w.track_id, w.seat_id, CASE WHEN w.seat_id IS NOT NULL THEN CASE WHEN count(CASE WHEN INSIDE_TEST THEN 1 END) > w.votes / 2 THEN 'inside' ELSE 'nearest' END END AS seat_via, {r4('CAST(w.votes AS DOUBLE) / count(*)')} AS vote_share, count(*) AS n_obs
    FROM w JOIN v ON w.round_id = v.round_id AND w.track_id = v.track_id AND w.rn = 1 LEFT JOIN {{seat_obbs}} o ON o.round_id = w.round_id AND o.seat_id = w.seat_id GROUP BY w.round_id, w.track_id, w.seat_id, w.votes"""


def _seat_vote_sql() -> str:
    from roundhouse.plans.scalars import INSIDE

    return SEAT_VOTE.replace("INSIDE_TEST", INSIDE)


@query("seat_majority_vote", _seat_vote_sql())
def _(t):
    return a.seat_vote(t.tracks, t.seat_obbs)


SAMPLES = """SELECT s.round_id, s.seg_id, h.frame_id, h.hand AS tip, FLOOR(h.x8 * 1280) AS tx, FLOOR(h.y8 * 720) AS ty, d.det_id, d.cx, d.cy
    FROM {segments} s JOIN {hands} h ON s.round_id = h.round_id AND h.frame_id BETWEEN s.start_frame AND s.end_frame AND h.frame_id % 5 = s.start_frame % 5
    JOIN {dets720} d ON d.round_id = s.round_id AND d.frame_id = CAST(10 * FLOOR(h.frame_id / 10) AS INT) AND h.frame_id % 10 <= 2 AND d.cy > 450
    WHERE s.label = 'call for action' AND h.x8 > 0"""
VOTES = f"""WITH p AS ({SAMPLES}), r AS (SELECT *, {hyp('cx', 'cy', 'tx', 'ty')} AS d, CAST(round_even(cx / 10, 0) * 10 AS INTEGER) AS gx, CAST(round_even(cy / 10, 0) * 10 AS INTEGER) AS gy FROM p),
    v AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY round_id, seg_id, frame_id, tip ORDER BY d, det_id) AS rn FROM r) WHERE rn = 1),
    k AS (SELECT round_id, seg_id, gx, gy, count(*) AS votes, max(frame_id) AS last_frame, min(d) AS dmin, min(struct_pack(f := frame_id, t := tip, i := det_id, x := cx, y := cy)) AS first FROM v GROUP BY ALL),
    c1 AS (SELECT *, sum(votes) OVER (PARTITION BY round_id, seg_id) AS total_votes, row_number() OVER (PARTITION BY round_id, seg_id ORDER BY votes DESC, first) AS rn FROM k),
    c2 AS (SELECT round_id, seg_id, min(struct_pack(d := d, f := frame_id, t := tip, i := det_id, x := cx, y := cy)) AS b FROM r GROUP BY ALL),
    j AS (SELECT c1.*, c2.b, c2.b.d < dmin AND sqrt((first.x - c2.b.x) * (first.x - c2.b.x) + (first.y - c2.b.y) * (first.y - c2.b.y)) > 20 AS use2 FROM c1 JOIN c2 ON c1.round_id = c2.round_id AND c1.seg_id = c2.seg_id AND rn = 1)
    SELECT round_id, seg_id, CASE WHEN use2 THEN b.i ELSE first.i END AS det_id, CASE WHEN use2 THEN b.f ELSE last_frame END AS last_frame, CASE WHEN use2 THEN b.f ELSE first.f END AS det_frame, votes, CAST(total_votes AS BIGINT) AS total_votes, CASE WHEN use2 THEN 'global_closest' ELSE 'vote_winner' END AS method FROM j"""


@query("card_vote_two_criterion", VOTES)
def _(t):
    return a.vote_select(t.sql(SAMPLES))


IMAGES = "SELECT DISTINCT round_id, end_frame AS frame_id FROM {segments} WHERE label = 'tap' UNION SELECT DISTINCT round_id, CAST(10 * FLOOR(end_frame / 10) AS INT) FROM {segments} WHERE label = 'hit'"


@query("union_box_per_seat", f"""WITH i AS ({IMAGES}), b AS (SELECT round_id, frame_id, seat, greatest(0, min(x1) - 10) AS x1, greatest(0, min(y1) - 10) AS y1, least(1920, max(x2) + 10) AS x2, least(1080, max(y2) + 10) AS y2 FROM ({SEATED}) WHERE seat IS NOT NULL GROUP BY ALL)
    SELECT i.round_id, i.frame_id, b.seat, b.x1, b.y1, b.x2, b.y2, CASE WHEN f.round_id IS NULL THEN 'no_detections' WHEN b.seat IS NULL THEN 'no_seats' ELSE 'ok' END AS status
    FROM i LEFT JOIN (SELECT DISTINCT round_id, frame_id FROM {{detections}}) f ON i.round_id = f.round_id AND i.frame_id = f.frame_id LEFT JOIN b ON i.round_id = b.round_id AND i.frame_id = b.frame_id AND b.x2 > b.x1 AND b.y2 > b.y1""")
def _(t):
    return a.seat_boxes(t.detections, t.sql(IMAGES))


@query("sparse_rounds", f"""WITH f AS (SELECT round_id, frame_id, count(DISTINCT CASE WHEN seat > 0 THEN seat END) AS seats, count(*) AS n FROM ({SEATED}) GROUP BY ALL)
    SELECT round_id, max(seats) AS max_seats, arg_max(frame_id, n * 100000 - frame_id) AS frame_id, max(n) AS n_dets FROM f GROUP BY round_id HAVING max(seats) BETWEEN 1 AND 5""")
def _(t):
    return a.sparse_rounds(t.detections, 5)


@query("crowded_frames", "SELECT round_id, frame_id, count(*) AS n_dets FROM {detections} GROUP BY ALL HAVING count(*) >= 15")
def _(t):
    return a.crowded_frames(t.detections, 15)


@query("batch_summary_stats", f"""WITH r AS (SELECT round_id, count(DISTINCT seat) AS seats, count(DISTINCT frame_id) AS frames, count(CASE WHEN seat IS NULL THEN 1 END) AS unassigned FROM ({SEATED}) GROUP BY round_id),
    u AS (SELECT 'seats' AS metric, CAST(seats AS DOUBLE) AS v FROM r UNION ALL SELECT 'frames', frames FROM r UNION ALL SELECT 'unassigned', unassigned FROM r)
    SELECT metric, {r4('avg(v)')} AS mean, {r4('quantile_cont(v, 0.5)')} AS median, min(v) AS least, max(v) AS most, count(CASE WHEN v > 0 THEN 1 END) AS n_any FROM u GROUP BY metric""")
def _(t):
    from roundhouse.operators.joins import assign_seats_template

    rows = assign_seats_template(t.detections).groupBy("round_id").agg(F.count_distinct("seat").alias("seats"), F.count_distinct("frame_id").alias("frames"), F.count_if(F.col("seat").isNull()).alias("unassigned"))
    return a.summary(rows, ["seats", "frames", "unassigned"])


@query("per_track_export", f"""WITH o AS (SELECT *, row_number() OVER w AS a, row_number() OVER (PARTITION BY round_id, track_id ORDER BY frame_id DESC, det_id DESC) AS z FROM {{tracks}} WINDOW w AS (PARTITION BY round_id, track_id ORDER BY frame_id, det_id))
    SELECT o.round_id, o.track_id, m.rank, m.suit, min(frame_id) AS first_frame, max(frame_id) AS last_frame, max(CASE WHEN a = 1 THEN {r4('cx')} END) AS first_x, max(CASE WHEN a = 1 THEN {r4('cy')} END) AS first_y, max(CASE WHEN z = 1 THEN {r4('cx')} END) AS last_x, max(CASE WHEN z = 1 THEN {r4('cy')} END) AS last_y,
      count(*) AS n_obs, {r4('FLOOR(sum(conf) * 1000000 + 0.5) / 1000000 / count(conf)')} AS mean_conf FROM o JOIN ({MAJORITY}) m ON o.round_id = m.round_id AND o.track_id = m.track_id GROUP BY o.round_id, o.track_id, m.rank, m.suit""")
def _(t):
    return a.track_export(t.tracks)


WINDOWS = "SELECT label, CAST(greatest(10, ceil(FLOOR(p) / 5) * 5) AS INTEGER) AS win, CAST(greatest(2, FLOOR(greatest(10, ceil(FLOOR(p) / 5) * 5) / 4)) AS INTEGER) AS stride FROM (SELECT label, quantile_cont(end_frame - start_frame + 1, 0.75) AS p FROM {segments} GROUP BY label)"


@query("auto_window_stride", f"SELECT label, win AS \"window\", stride FROM ({WINDOWS})")
def _(t):
    return a.auto_window(t.segments)


THRESHOLDS = [0.1, 0.25, 0.5, 0.7, 0.9]


@query("precision_recall_at_thresholds", f"""WITH c AS (SELECT x AS threshold, CAST(count(CASE WHEN score >= x AND p THEN 1 END) AS DOUBLE) AS tp, CAST(count(CASE WHEN score >= x AND NOT p THEN 1 END) AS DOUBLE) AS fp, CAST(count(CASE WHEN score < x AND p THEN 1 END) AS DOUBLE) AS fn, CAST(count(CASE WHEN score < x AND NOT p THEN 1 END) AS DOUBLE) AS tn
      FROM (SELECT score, label IN ('hit', 'tap') AS p FROM {{segments}}) s, (SELECT unnest([{', '.join(f'CAST({x} AS DOUBLE)' for x in THRESHOLDS)}]) AS x) h GROUP BY x),
    q AS (SELECT threshold, (tp + tn) / (tp + tn + fp + fn) AS accuracy, CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0 END AS precision, CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0 END AS recall FROM c)
    SELECT threshold, {r4('accuracy')} AS accuracy, {r4('precision')} AS precision, {r4('recall')} AS recall, {r4('CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0 END')} AS f1 FROM q""")
def _(t):
    return a.pr_at(t.segments.select("score", F.col("label").isin("hit", "tap").alias("positive")), THRESHOLDS)


@query("cv_mean_std", f"SELECT label AS metric, {r4('avg(v)')} AS mean, {r4('stddev_pop(v)')} AS std FROM (SELECT label, seg_id % 5 AS fold, avg(score) AS v FROM {{segments}} GROUP BY ALL) GROUP BY label")
def _(t):
    return a.cv_summary(t.segments.groupBy(F.col("label").alias("metric"), (F.col("seg_id") % 5).alias("fold")).agg(F.avg("score").alias("value")))


@query("best_instance_per_class", """WITH b AS (SELECT round_id, frame_id, suit, max(conf) AS conf, arg_min(det_id, struct_pack(a := -conf, b := det_id)) AS det_id FROM {detections} GROUP BY ALL)
    SELECT * FROM b WHERE (round_id, frame_id) IN (SELECT (round_id, frame_id) FROM b GROUP BY round_id, frame_id HAVING count(*) = 4)""")
def _(t):
    return a.best_per_class(t.detections, ["round_id", "frame_id"], "suit", 4)


@query("keypoints_to_box", f"""WITH b AS (SELECT task_id, class_id, count(*) AS n, greatest(CAST(0 AS DOUBLE), min(x_pct / 100) - CAST(0.01 AS DOUBLE)) AS a, least(CAST(1 AS DOUBLE), max(x_pct / 100) + CAST(0.01 AS DOUBLE)) AS b, greatest(CAST(0 AS DOUBLE), min(y_pct / 100) - CAST(0.01 AS DOUBLE)) AS c, least(CAST(1 AS DOUBLE), max(y_pct / 100) + CAST(0.01 AS DOUBLE)) AS d FROM {{keypoints}} GROUP BY ALL)
    SELECT task_id, class_id, n, {r4('(a + b) / 2')} AS bx, {r4('(c + d) / 2')} AS by_, {r4('b - a')} AS bw, {r4('d - c')} AS bh FROM b WHERE n >= 2 AND b > a AND d > c""")
def _(t):
    return a.keypoint_box(t.keypoints)


@query("keypoint_slots_pivot", "SELECT task_id, class_id, " + ", ".join(f"coalesce({r4(f'max_by(x_pct, seq) FILTER (slot = {k}) / 100')}, 0) AS x{k}, coalesce({r4(f'max_by(y_pct, seq) FILTER (slot = {k}) / 100')}, 0) AS y{k}, CASE WHEN count(*) FILTER (slot = {k}) > 0 THEN 2 ELSE 0 END AS v{k}" for k in range(7)) + f" FROM (SELECT *, {SLOT} AS slot FROM {{keypoints}}) WHERE slot >= 0 GROUP BY task_id, class_id")
def _(t):
    return a.keypoint_pivot(t.keypoints, s.parse_slot(F.col("kp_label")))


@query("instances_per_class", f"SELECT CASE WHEN task_id % 5 = 0 THEN 'val' ELSE 'train' END AS split, class_id, count(DISTINCT task_id) AS instances, count(CASE WHEN {SLOT} >= 0 THEN 1 END) AS keypoints FROM {{keypoints}} GROUP BY ALL")
def _(t):
    return a.class_counts(t.keypoints, s.parse_slot(F.col("kp_label")), F.when(F.col("task_id") % 5 == 0, "val").otherwise("train"))


LATEST = "SELECT task_id, ann_seq, n_results, coalesce(nullif(updated_at, ''), nullif(created_at, ''), '') AS updated_at FROM (SELECT *, row_number() OVER (PARTITION BY task_id ORDER BY coalesce(nullif(updated_at, ''), nullif(created_at, ''), '') DESC, ann_seq DESC) AS rn FROM {tasks} WHERE NOT was_cancelled AND n_results > 0) WHERE rn = 1"


@query("latest_valid_annotation", LATEST)
def _(t):
    return a.latest_annotation(t.tasks)
