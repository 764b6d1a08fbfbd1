"""Queries of projections, filters, predicates and geometry."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from roundhouse.functions import geometry as g
from roundhouse.operators import joins as j
from roundhouse.operators import scalar as s
from roundhouse.plans.registry import query

R4 = "FLOOR(({}) * 10000 + 0.5) / 10000"


def r4(x: str) -> str:
    return R4.format(x)


def hyp(ax: str, ay: str, bx: str, by: str) -> str:
    return f"sqrt(({ax} - ({bx})) * ({ax} - ({bx})) + ({ay} - ({by})) * ({ay} - ({by})))"


@query("scale_detections", "SELECT round_id, det_id, " + r4("cx") + " AS cx, " + r4("cy") + " AS cy, x1, y1, x2, y2 FROM {dets720}")
def _(t):
    return s.scale_dets(t.detections).select("round_id", "det_id", g.r4(F.col("cx")).alias("cx"), g.r4(F.col("cy")).alias("cy"), "x1", "y1", "x2", "y2")


@query("box_to_percent", "SELECT round_id, det_id, " + ", ".join(f"{r4(e)} AS {n}" for n, e in (("x_pct", "x1 / CAST(1280 AS DOUBLE) * 100"), ("y_pct", "y1 / CAST(720 AS DOUBLE) * 100"), ("w_pct", "(x2 - x1) / CAST(1280 AS DOUBLE) * 100"), ("h_pct", "(y2 - y1) / CAST(720 AS DOUBLE) * 100"))) + " FROM {dets720}")
def _(t):
    parts = g.to_percent(*[F.col(x) for x in ("x1", "y1", "x2", "y2")], 1280.0, 720.0)
    return t.dets720.select("round_id", "det_id", *[g.r4(v).alias(k) for k, v in parts.items()])


@query("duration_filter", """SELECT round_id, seg_id, label, end_frame - start_frame + 1 AS duration, end_frame - start_frame + 1 >= 30 AS passed, CASE WHEN end_frame - start_frame + 1 < 30 THEN 'stage1_duration' END AS stage,
    CASE WHEN end_frame - start_frame + 1 < 30 THEN concat('duration=', end_frame - start_frame + 1, ' < 30') END AS reason FROM {segments} WHERE label IN ('hit', 'dealer hits')""")
def _(t):
    return s.stage_duration(t.segments, ["hit", "dealer hits"], 30).select("round_id", "seg_id", "label", "duration", "passed", "stage", "reason")


@query("zone_filter", """SELECT 'hit' AS zone, count(*) AS n FROM {dets720} WHERE cy >= 450 UNION ALL SELECT 'call', count(*) FROM {dets720} WHERE cy > 450
    UNION ALL SELECT 'tap', count(*) FROM {dets720} WHERE cy >= 480 UNION ALL SELECT 'dealer', count(*) FROM {dets720} WHERE cx BETWEEN 535 AND 800 AND cy BETWEEN 411 AND 489""")
def _(t):
    zones = F.array(*[F.when(s.in_zone(z), F.lit(z)) for z in ("hit", "call", "tap", "dealer")])
    return t.dets720.select(F.explode(zones).alias("zone")).where("zone is not null").groupBy("zone").agg(F.count("*").alias("n"))


def seat_sql(k: int, cx: str = "cx", cy: str = "cy") -> str:
    (dx, dy), (sx, sy) = [(x / 1920, y / 1080) for x, y in (g.SEATS_PX[0], g.SEATS_PX[k])]
    e = lambda v: f"CAST('{v!r}' AS DOUBLE)"
    px, py = f"{cx} / CAST(1920 AS DOUBLE)", f"{cy} / CAST(1080 AS DOUBLE)"
    straight = hyp(f"({px})", f"({py})", e(sx), e(sy))
    if k == 0:
        return straight
    turn = f"abs(atan2({py} - {e(dy)}, {px} - {e(dx)}) - {e(math.atan2(sy - dy, sx - dx))})"
    return f"{e(1 - 0.3)} * {straight} + {e(0.3)} * least({turn}, {e(2 * math.pi)} - {turn}) * {e(math.hypot(sx - dx, sy - dy))}"


SEAT_CASE = "(WITH_D) "
SEATED = "SELECT *, CASE WHEN least(d0, d1, d2, d3, d4, d5, d6, d7) <= CAST('" + repr(200 / 1920) + "' AS DOUBLE) THEN CASE least(d0, d1, d2, d3, d4, d5, d6, d7) " + " ".join(f"WHEN d{k} THEN {k}" for k in range(8)) + " END END AS seat FROM (SELECT *, " + ", ".join(f"{seat_sql(k)} AS d{k}" for k in range(8)) + " FROM {detections})"


@query("polar_seat_distance", "SELECT round_id, det_id, " + ", ".join(f"{r4(seat_sql(k))} AS d{k}" for k in range(8)) + " FROM {detections}")
def _(t):
    return t.detections.select("round_id", "det_id", *[g.r4(g.seat_distance(F.col("cx"), F.col("cy"), k)).alias(f"d{k}") for k in range(8)])


PAIRED = "SELECT d.round_id, d.frame_id, d.det_id, o.seat_id, d.cx, d.cy, c0x, c0y, c1x, c1y, c2x, c2y, c3x, c3y FROM {dets720} d JOIN {seat_obbs} o ON d.round_id = o.round_id"
ALONG = "((cx - c0x) * (c1x - c0x) + (cy - c0y) * (c1y - c0y))"
ACROSS = "((cx - c0x) * (c3x - c0x) + (cy - c0y) * (c3y - c0y))"
LEN1, LEN3 = "((c1x - c0x) * (c1x - c0x) + (c1y - c0y) * (c1y - c0y))", "((c3x - c0x) * (c3x - c0x) + (c3y - c0y) * (c3y - c0y))"
INSIDE = f"({ALONG} >= 0 AND {ALONG} <= {LEN1} AND {ACROSS} >= 0 AND {ACROSS} <= {LEN3})"


def edge_sql(a: int, b: int) -> str:
    ex, ey = f"(c{b}x - c{a}x)", f"(c{b}y - c{a}y)"
    t = f"greatest(CAST(0 AS DOUBLE), least(CAST(1 AS DOUBLE), ((cx - c{a}x) * {ex} + (cy - c{a}y) * {ey}) / ({ex} * {ex} + {ey} * {ey})))"
    return hyp("cx", "cy", f"c{a}x + {t} * {ex}", f"c{a}y + {t} * {ey}")


OBB_DISTANCE = f"CASE WHEN {INSIDE} THEN CAST(0 AS DOUBLE) ELSE least({', '.join(edge_sql(k, (k + 1) % 4) for k in range(4))}) END"


def _paired(t):
    return s.obb_points(t.dets720, t.seat_obbs)


@query("point_in_obb", f"SELECT round_id, det_id, seat_id, {INSIDE} AS inside FROM ({PAIRED})")
def _(t):
    return _paired(t).select("round_id", "det_id", "seat_id", g.point_in_obb(F.col("cx"), F.col("cy"), g.corners()).alias("inside"))


@query("point_to_obb_distance", f"SELECT round_id, det_id, seat_id, {r4(OBB_DISTANCE)} AS distance FROM ({PAIRED})")
def _(t):
    return s.with_obb_distance(_paired(t)).select("round_id", "det_id", "seat_id", g.r4(F.col("distance")).alias("distance"))


@query("obb_axis_projection", f"""SELECT round_id, det_id, seat_id, {r4(f'CASE WHEN {LEN1} >= {LEN3} THEN {ALONG} / sqrt({LEN1}) ELSE {ACROSS} / sqrt({LEN3}) END')} AS long_axis,
    {r4(f'CASE WHEN {LEN1} >= {LEN3} THEN {ACROSS} / sqrt({LEN3}) ELSE {ALONG} / sqrt({LEN1}) END')} AS short_axis,
    {r4(f'CASE WHEN abs(c1y - c0y) >= abs(c3y - c0y) THEN {ACROSS} / sqrt({LEN3}) ELSE {ALONG} / sqrt({LEN1}) END')} AS local_x,
    {r4(f'CASE WHEN abs(c1y - c0y) >= abs(c3y - c0y) THEN {ALONG} / sqrt({LEN1}) ELSE {ACROSS} / sqrt({LEN3}) END')} AS local_y FROM ({PAIRED})""")
def _(t):
    p, box = (F.col("cx"), F.col("cy")), g.corners()
    lx, ly = g.upright_frame(*p, box)
    return _paired(t).select("round_id", "det_id", "seat_id", g.r4(g.project_obb(*p, box, "long")).alias("long_axis"), g.r4(g.project_obb(*p, box, "short")).alias("short_axis"), g.r4(lx).alias("local_x"), g.r4(ly).alias("local_y"))


_TURNED = "SELECT round_id, box_id, x1 / CAST(19.2 AS DOUBLE) AS x, y1 / CAST(10.8 AS DOUBLE) AS y, (x2 - x1) / CAST(19.2 AS DOUBLE) AS w, (y2 - y1) / CAST(10.8 AS DOUBLE) AS h, CAST(box_id % 90 AS DOUBLE) AS degrees FROM {boxes}"


@query("rotated_box_corners", "SELECT round_id, box_id, " + ", ".join(f"FLOOR(({x}) * 1000 + 0.5) / 1000 AS c{k}x, FLOOR(({y}) * 1000 + 0.5) / 1000 AS c{k}y" for k, (x, y) in enumerate((f"x + {dx} * cos(radians(degrees)) - {dy} * sin(radians(degrees))", f"y + {dx} * sin(radians(degrees)) + {dy} * cos(radians(degrees))") for dx, dy in (("CAST(0 AS DOUBLE)", "CAST(0 AS DOUBLE)"), ("w", "CAST(0 AS DOUBLE)"), ("w", "h"), ("CAST(0 AS DOUBLE)", "h")))) + f" FROM ({_TURNED})")
def _(t):
    return s.with_rotated(t.sql(_TURNED)).select("round_id", "box_id", *[f"c{k}{a}" for k in range(4) for a in "xy"])


BOX_PAIRS = "SELECT a.round_id, a.frame_id, a.det_id, b.det_id AS b_id, a.x1, a.y1, a.x2, a.y2, b.x1 AS b_x1, b.y1 AS b_y1, b.x2 AS b_x2, b.y2 AS b_y2 FROM {dets720} a JOIN {dets720} b ON a.round_id = b.round_id AND a.frame_id = b.frame_id AND a.det_id < b.det_id"

#: The same from lists of a frame's boxes, for the twins.
_FRAME_BOXES = "SELECT round_id, frame_id, list(struct_pack(det_id := det_id, x1 := x1, y1 := y1, x2 := x2, y2 := y2) ORDER BY det_id) AS c FROM {dets720} GROUP BY ALL"
BOX_PAIR_LISTS = f"SELECT round_id, a.det_id AS det_id, b.det_id AS b_id, a.x1 AS x1, a.y1 AS y1, a.x2 AS x2, a.y2 AS y2, b.x1 AS b_x1, b.y1 AS b_y1, b.x2 AS b_x2, b.y2 AS b_y2 FROM (SELECT round_id, c[i] AS a, unnest(c[i + 1:]) AS b FROM (SELECT *, CAST(unnest(range(1, len(c))) AS INTEGER) AS i FROM ({_FRAME_BOXES})))"


@query("box_iou_overlap", f"SELECT round_id, det_id, b_id, greatest(0, least(x2, b_x2) - greatest(x1, b_x1)) * greatest(0, least(y2, b_y2) - greatest(y1, b_y1)) AS overlap FROM ({BOX_PAIR_LISTS})")
def _(t):
    rows = t.sql(BOX_PAIRS)
    return rows.select("round_id", "det_id", "b_id", g.overlap_area(*s.boxes_of(rows)).alias("overlap"))


@query("encompassing_box", f"SELECT round_id, det_id, b_id, least(x1, b_x1) AS ux1, least(y1, b_y1) AS uy1, greatest(x2, b_x2) AS ux2, greatest(y2, b_y2) AS uy2 FROM ({BOX_PAIR_LISTS})")
def _(t):
    rows = t.sql(BOX_PAIRS)
    return rows.select("round_id", "det_id", "b_id", *[v.alias(n) for v, n in zip(g.union_box(*s.boxes_of(rows)), ("ux1", "uy1", "ux2", "uy2"), strict=True)])


SEG_PAIRS = "SELECT a.round_id, a.seg_id, b.seg_id AS other, a.start_frame AS s1, a.end_frame AS e1, b.start_frame AS s2, b.end_frame AS e2 FROM {segments} a JOIN {segments} b ON a.round_id = b.round_id AND a.label = b.label AND a.seg_id < b.seg_id"


@query("interval_iou", f"""SELECT round_id, seg_id, other, {r4('CASE WHEN (e1 - s1) + (e2 - s2) - greatest(0, least(e1, e2) - greatest(s1, s2)) > 0 THEN greatest(0, least(e1, e2) - greatest(s1, s2)) / CAST((e1 - s1) + (e2 - s2) - greatest(0, least(e1, e2) - greatest(s1, s2)) AS DOUBLE) ELSE 0 END')} AS iou FROM ({SEG_PAIRS})""")
def _(t):
    return t.sql(SEG_PAIRS).select("round_id", "seg_id", "other", g.r4(g.interval_iou(*[F.col(x) for x in ("s1", "e1", "s2", "e2")])).alias("iou"))


@query("grid_key", "SELECT round_id, det_id, CAST(round_even(cx / 10, 0) * 10 AS INTEGER) AS gx, CAST(round_even(cy / 10, 0) * 10 AS INTEGER) AS gy FROM {detections}")
def _(t):
    return t.detections.select("round_id", "det_id", g.grid_key(F.col("cx")).alias("gx"), g.grid_key(F.col("cy")).alias("gy"))


NORM_RANK = "CASE WHEN rank IN ('10', 'J', 'Q', 'K') THEN 'T' WHEN rank IN ('', 'U', '?') THEN NULL ELSE rank END"


@query("normalize_rank", f"SELECT round_id, det_id, {NORM_RANK} AS rank_norm FROM {{detections}}")
def _(t):
    return t.detections.select("round_id", "det_id", g.norm_rank(F.col("rank")).alias("rank_norm"))


@query("keep_or_background", "SELECT round_id, seg_id, CASE WHEN label IN ('hit', 'split', 'tap') THEN label ELSE 'background' END AS label FROM {segments}")
def _(t):
    return t.segments.select("round_id", "seg_id", s.normalize_label(F.col("label"), ["hit", "split", "tap"]).alias("label"))


@query("keypoint_slot_parse", "SELECT task_id, seq, CASE WHEN CAST(substr(kp_label, 2) AS INTEGER) BETWEEN 1 AND 7 THEN CAST(substr(kp_label, 2) AS INTEGER) - 1 ELSE -1 END AS slot FROM {keypoints}")
def _(t):
    return t.keypoints.select("task_id", "seq", s.parse_slot(F.col("kp_label")).alias("slot"))


HAND_POS = """SELECT round_id, frame_id, hand, CASE WHEN m >= 0.1 THEN CASE WHEN a8 > 0.01 AND b8 > 0.01 THEN a8 * CAST(1280 AS DOUBLE) WHEN a0 > 0.01 AND b0 > 0.01 THEN a0 * CAST(1280 AS DOUBLE) END END AS hx,
    CASE WHEN m >= 0.1 THEN CASE WHEN a8 > 0.01 AND b8 > 0.01 THEN b8 * CAST(720 AS DOUBLE) WHEN a0 > 0.01 AND b0 > 0.01 THEN b0 * CAST(720 AS DOUBLE) END END AS hy
    FROM (SELECT round_id, frame_id, hand, avg((x + y) / 2) AS m, max(CASE WHEN kp = 8 THEN x END) AS a8, max(CASE WHEN kp = 8 THEN y END) AS b8, max(CASE WHEN kp = 0 THEN x END) AS a0, max(CASE WHEN kp = 0 THEN y END) AS b0
          FROM {keypoints21} GROUP BY round_id, frame_id, hand)"""


@query("hand_position", f"SELECT round_id, frame_id, hand, {r4('hx')} AS hx, {r4('hy')} AS hy FROM ({HAND_POS})")
def _(t):
    rows = s.hand_position(t.keypoints21, ["round_id", "frame_id", "hand"])
    return rows.select("round_id", "frame_id", "hand", g.r4(F.col("hx")).alias("hx"), g.r4(F.col("hy")).alias("hy"))


CLEAN = """WITH x AS (SELECT s.round_id, s.seg_id, count(f.frame_id) AS n_frames, count(CASE WHEN regexp_matches(f.text, '\\bpaus\\w*d\\b|\\binact\\w{2,6}ity\\b', 'i') THEN 1 END) AS n_paused
      FROM {segments} s LEFT JOIN {frame_text} f ON s.round_id = f.round_id AND f.frame_id BETWEEN s.start_frame AND s.end_frame WHERE s.label = 'clean hand' GROUP BY ALL)
    SELECT round_id, seg_id, n_frames, n_paused, CASE WHEN n_frames = 0 THEN 'no frames' WHEN n_paused > 0 THEN 'paused' END AS reason, n_frames > 0 AND n_paused = 0 AS passed FROM x"""


def clean_verdicts(t):
    segs = t.segments.where("label = 'clean hand'").select("round_id", "seg_id", "start_frame", "end_frame")
    return j.reject_by_text(segs, t.frame_text).drop("start_frame", "end_frame")


@query("ocr_pause_filter", CLEAN)
def _(t):
    return clean_verdicts(t)


@query("l2_normalize", "SELECT vec_id, list_transform(embedding, lambda x: FLOOR(CAST(x AS DOUBLE) / n * 10000 + 0.5) / 10000) AS unit FROM (SELECT vec_id, embedding, CASE WHEN list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE) * x)) = 0 THEN 1e-8 ELSE sqrt(list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE) * CAST(x AS DOUBLE)))) END AS n FROM embeddings)")
def _(t):
    return t.embeddings.select("vec_id", F.transform(s.l2_normalize(F.col("embedding")), lambda x: g.r4(x)).alias("unit"))
