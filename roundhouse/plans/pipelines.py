"""Queries of composed pipelines."""

from __future__ import annotations

from pyspark.sql import functions as F

from roundhouse.operators import pipelines as p
from roundhouse.operators import sequences as q
from roundhouse.operators.datasets import fit_window_classifier
from roundhouse.operators.joins import hands_wide
from roundhouse.operators.picks import rep_frames
from roundhouse.operators.scalar import hand_position
from roundhouse.plans.joins import FRAMES, GALLERY
from roundhouse.plans.registry import query
from roundhouse.plans.scalars import CLEAN, hyp
from roundhouse.plans.sequences import COUNTED, TAP

#: The rounds that have a card table.
CARDS = "SELECT s_suppkey AS round_id FROM {supplier} WHERE s_acctbal > 1000"

HIT = f"""WITH RECURSIVE fr AS ({FRAMES}), sg AS (SELECT s.round_id, s.seg_id, s.label, s.end_frame - s.start_frame + 1 AS du, min(f.frame_id) AS f0, max(f.frame_id) AS f1 FROM {{segments}} s LEFT JOIN fr f ON s.round_id = f.round_id AND f.frame_id BETWEEN s.start_frame AND s.end_frame WHERE s.label IN ('hit', 'dealer hits') GROUP BY ALL),
    pr AS (SELECT sg.seg_id, e.det_id AS e, b.det_id AS b, row_number() OVER (PARTITION BY sg.seg_id ORDER BY {hyp('e.cx', 'e.cy', 'b.cx', 'b.cy')}, e.det_id, b.det_id) AS rn FROM sg JOIN {{dets720}} e ON sg.round_id = e.round_id AND e.frame_id = sg.f1 JOIN {{dets720}} b ON sg.round_id = b.round_id AND b.frame_id = sg.f0 WHERE sg.f0 < sg.f1 AND {hyp('e.cx', 'e.cy', 'b.cx', 'b.cy')} <= 120),
    fold AS (SELECT seg_id, CAST(0 AS BIGINT) AS rn, CAST([] AS BIGINT[]) AS es, CAST([] AS BIGINT[]) AS bs FROM sg UNION ALL SELECT f.seg_id, p.rn, CASE WHEN list_contains(f.es, p.e) OR list_contains(f.bs, p.b) THEN f.es ELSE list_append(f.es, p.e) END, CASE WHEN list_contains(f.es, p.e) OR list_contains(f.bs, p.b) THEN f.bs ELSE list_append(f.bs, p.b) END FROM fold f JOIN pr p ON p.seg_id = f.seg_id AND p.rn = f.rn + 1),
    dn AS (SELECT seg_id, arg_max(es, rn) AS es FROM fold GROUP BY seg_id),
    nw AS (SELECT sg.seg_id, sg.label, e.det_id, e.cx, e.cy, CASE WHEN sg.label = 'hit' THEN e.cy >= 450 ELSE e.cx BETWEEN 535 AND 800 AND e.cy BETWEEN 411 AND 489 END AS ok FROM sg JOIN dn ON sg.seg_id = dn.seg_id JOIN {{dets720}} e ON sg.round_id = e.round_id AND e.frame_id = sg.f1 AND NOT list_contains(dn.es, e.det_id) WHERE sg.f0 < sg.f1),
    ag AS (SELECT seg_id, count(*) AS n_new, count(CASE WHEN ok THEN 1 END) AS n_ok, arg_min(CASE WHEN ok THEN det_id END, CASE WHEN ok THEN struct_pack(a := -(CASE WHEN label = 'hit' THEN cy ELSE cx END), b := det_id) END) AS det_id FROM nw GROUP BY seg_id),
    v AS (SELECT sg.*, coalesce(n_new, 0) AS n_new, coalesce(n_ok, 0) AS n_ok, det_id, c.round_id IS NULL AS no_cards FROM sg LEFT JOIN ag ON sg.seg_id = ag.seg_id LEFT JOIN ({CARDS}) c ON c.round_id = sg.round_id),
    st AS (SELECT *, CASE WHEN du < 30 THEN 'stage1_duration' WHEN no_cards THEN 'stage2_no_card_jsonl' WHEN f0 IS NULL THEN 'stage2_no_detections' WHEN f0 >= f1 THEN 'stage2_bad_frame_order' WHEN n_new = 0 THEN 'stage2_no_new_card' WHEN n_ok = 0 THEN 'stage3_spatial' END AS stage FROM v)
    SELECT round_id, seg_id, label, CASE WHEN stage IS NULL THEN det_id END AS det_id, stage IS NULL AS passed, stage FROM st"""


@query("verify_hit", HIT)
def _(t):
    return p.verify_hit(t.segments, t.dets720, t.sql(CARDS)).drop("reason")


def _poses(t):
    """Hands next to frames with cards: every tenth frame's hands, moved up to two frames."""
    return t.sql(POSES)


POSES = "SELECT DISTINCT CAST(round_id AS BIGINT) AS round_id, CAST(10 * (frame_id % 60) + frame_id % 3 AS INT) AS frame_id, hand, max(x8) AS x8, max(y8) AS y8 FROM {hands} GROUP BY 1, 2, 3"
CALL = f"""WITH ps AS ({POSES}), sg AS (SELECT *, end_frame - start_frame + 1 AS du FROM {{segments}} WHERE label = 'call for action'),
    sp AS (SELECT round_id, seg_id, unnest(range(start_frame, end_frame + 1, 5)) AS at FROM sg), bo AS (SELECT round_id, frame_id FROM ps WHERE x8 > 0.01 OR y8 > 0.01 GROUP BY ALL HAVING count(DISTINCT hand) = 2),
    po AS (SELECT sp.* FROM sp JOIN bo ON sp.round_id = bo.round_id AND sp.at = bo.frame_id), ne AS (SELECT po.round_id, po.seg_id, po.at, arg_min(f.frame_id, abs(f.frame_id - po.at) * 2 + CASE WHEN f.frame_id < po.at THEN 1 ELSE 0 END) AS fr FROM po LEFT JOIN ({FRAMES}) f ON f.round_id = po.round_id AND abs(f.frame_id - po.at) <= 2 GROUP BY ALL),
    ct AS (SELECT round_id, seg_id, count(fr) AS n_valid FROM ne GROUP BY ALL),
    r AS (SELECT ne.round_id, ne.seg_id, ne.at AS frame_id, ps.hand AS tip, d.det_id, d.cx, d.cy, sqrt((d.cx - FLOOR(ps.x8 * 1280)) * (d.cx - FLOOR(ps.x8 * 1280)) + (d.cy - FLOOR(ps.y8 * 720)) * (d.cy - FLOOR(ps.y8 * 720))) AS d, CAST(round_even(d.cx / 10, 0) * 10 AS INTEGER) AS gx, CAST(round_even(d.cy / 10, 0) * 10 AS INTEGER) AS gy
          FROM ne JOIN ps ON ps.round_id = ne.round_id AND ps.frame_id = ne.at JOIN {{dets720}} d ON d.round_id = ne.round_id AND d.frame_id = ne.fr AND d.cy > 450),
    v AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY round_id, seg_id, frame_id, tip ORDER BY d, det_id) AS rn FROM r) WHERE rn = 1),
    k AS (SELECT round_id, seg_id, gx, gy, count(*) AS votes, min(d) AS dmin, min(struct_pack(f := frame_id, t := tip, i := det_id, x := cx, y := cy)) AS first FROM v GROUP BY ALL), c1 AS (SELECT *, row_number() OVER (PARTITION BY round_id, seg_id ORDER BY votes DESC, first) AS rn FROM k),
    c2 AS (SELECT round_id, seg_id, min(struct_pack(d := d, f := frame_id, t := tip, i := det_id, x := cx, y := cy)) AS b FROM r GROUP BY ALL),
    jn AS (SELECT c1.*, c2.b, c2.b.d < dmin AND sqrt((first.x - c2.b.x) * (first.x - c2.b.x) + (first.y - c2.b.y) * (first.y - c2.b.y)) > 20 AS use2 FROM c1 JOIN c2 ON c1.round_id = c2.round_id AND c1.seg_id = c2.seg_id AND rn = 1),
    x AS (SELECT sg.round_id, sg.seg_id, CASE WHEN du < 45 THEN 'stage1_duration' WHEN hp.round_id IS NULL THEN 'stage2_no_pkl' WHEN c.round_id IS NULL THEN 'stage2_no_card_jsonl' WHEN coalesce(n_valid, 0) = 0 THEN 'stage2_no_valid_samples' WHEN jn.votes IS NULL THEN 'stage3_no_votes' END AS stage, CASE WHEN use2 THEN b.i ELSE first.i END AS det_id, CASE WHEN use2 THEN 'global_closest' ELSE 'vote_winner' END AS method, votes
          FROM sg LEFT JOIN (SELECT DISTINCT round_id FROM ps) hp ON hp.round_id = sg.round_id LEFT JOIN ({CARDS}) c ON c.round_id = sg.round_id LEFT JOIN ct ON ct.round_id = sg.round_id AND ct.seg_id = sg.seg_id LEFT JOIN jn ON jn.round_id = sg.round_id AND jn.seg_id = sg.seg_id)
    SELECT round_id, seg_id, CASE WHEN stage IS NULL THEN det_id END AS det_id, CASE WHEN stage IS NULL THEN method END AS method, CASE WHEN stage IS NULL THEN votes END AS votes, stage IS NULL AS passed, stage FROM x"""


@query("verify_call", CALL)
def _(t):
    return p.verify_call(t.segments, t.dets720, _poses(t), t.sql(CARDS)).drop("reason")


_TAP = TAP.replace("DIP", "0.004").replace("FLOOR((x * 1280) * 10000 + 0.5) / 10000 AS tap_x, FLOOR((y * 720) * 10000 + 0.5) / 10000 AS tap_y", "x * 1280 AS tap_x, y * 720 AS tap_y")
VTAP = f"""WITH tm AS ({_TAP}), atf AS (SELECT tm.round_id, tm.seg_id, tm.tap_x, tm.tap_y, arg_min(f.frame_id, abs(f.frame_id - tm.tap_frame) * 2 + CASE WHEN f.frame_id < tm.tap_frame THEN 1 ELSE 0 END) AS fr FROM tm LEFT JOIN ({FRAMES}) f ON f.round_id = tm.round_id AND abs(f.frame_id - tm.tap_frame) <= 9 GROUP BY ALL),
    nd AS (SELECT a.round_id, a.seg_id, min(struct_pack(d := {hyp('d.cx', 'd.cy', 'a.tap_x', 'a.tap_y')}, i := d.det_id)) AS b FROM atf a JOIN {{dets720}} d ON d.round_id = a.round_id AND d.frame_id = a.fr AND d.cy >= 480 GROUP BY ALL), cn AS ({COUNTED}),
    x AS (SELECT s.round_id, s.seg_id, tm.tap_frame, tm.hand, tm.kp, CASE WHEN nd.b.d <= 150 THEN nd.b.i END AS det_id, CASE WHEN h.round_id IS NULL THEN 'stage1_no_pose' WHEN tm.tap_frame IS NULL THEN 'stage1_no_tap_motion' WHEN tm.tap_y < 480 THEN 'stage1_above_table' WHEN nd.b IS NULL OR nd.b.d > 150 THEN 'stage2_no_card' WHEN cn.rejected THEN 'stage3_new_card' END AS stage
          FROM {{segments}} s LEFT JOIN (SELECT DISTINCT round_id FROM {{hands}}) h ON h.round_id = s.round_id LEFT JOIN tm ON tm.round_id = s.round_id AND tm.seg_id = s.seg_id LEFT JOIN nd ON nd.round_id = s.round_id AND nd.seg_id = s.seg_id LEFT JOIN cn ON cn.round_id = s.round_id AND cn.seg_id = s.seg_id WHERE s.label = 'tap')
    SELECT round_id, seg_id, tap_frame, hand, kp, CASE WHEN stage IS NULL THEN det_id END AS det_id, stage IS NULL AS passed, stage FROM x"""


@query("verify_tap", VTAP)
def _(t):
    return p.verify_tap(t.segments, t.dets720, t.keypoints21, dip=0.004).drop("reason")


@query("verify_split")
def _(t):
    """On the table in which pairs part. No SQL twin: pairs are followed from match to match."""
    hands = hands_wide(hand_position(t.keypoints21, ["round_id", "frame_id", "hand"]))
    return p.verify_split(t.segments, t.parting, t.sql(CARDS), hands)


@query("verify_clean", f"SELECT round_id, seg_id, passed, CASE WHEN n_frames = 0 THEN 'stage1_no_frames' WHEN n_paused > 0 THEN 'stage1_paused' END AS stage, reason FROM ({CLEAN})")
def _(t):
    return p.verify_clean(t.segments, t.frame_text)


@query("label_round")
def _(t):
    """No SQL twin: tracks carry state. One row per track."""
    rep = rep_frames(t.detections, 1).select("round_id", F.col("frame_id").alias("rep_frame"))
    return p.label_round(t.dets720, t.seat_obbs, rep, least_obs=5)


def _detected(t, **how):
    gallery = q.temporal_bins(t.feature_segments.where(GALLERY).withColumn("end_frame", F.col("end_frame") + 1), t.features, 2).select((F.col("video_id").cast("long") * 100_000 + F.col("start_frame")).alias("g_id"), F.col("vec").alias("g_vec"))
    ids = t.customer.where("c_acctbal > 1000").select(F.col("c_custkey").cast("int").alias("video_id"), F.col("c_custkey").alias("task_id"))
    return p.detect_actions(t.features, gallery, t.features.where(GALLERY).select("video_id").distinct(), ids, threshold=0.1, **how)


@query("detect_actions")
def _(t):
    """No SQL twin over nearest gallery vectors of binned windows; its parts have twins."""
    return _detected(t)


@query("detect_actions_classifier")
def _(t):
    """The same windows, scored by a classifier of the gallery's segments. No SQL twin: an iterative fit."""
    units = t.feature_segments.where(GALLERY).withColumn("end_frame", F.col("end_frame") + 1)
    vec = q.temporal_bins(units, t.features, 2).join(units, ["video_id", "start_frame", "end_frame"])
    focus = vec.agg(F.min("label_id")).first()[0]
    return _detected(t, model=fit_window_classifier(vec), focus=focus).withColumn("score", F.round("score", 4))
