"""Queries of joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from roundhouse.functions import geometry as g
from roundhouse.operators import joins as j
from roundhouse.operators import scalar as s
from roundhouse.operators import similarity as sim
from roundhouse.operators.pipelines import spans
from roundhouse.plans.registry import query
from roundhouse.plans.scalars import HAND_POS, INSIDE, NORM_RANK, OBB_DISTANCE, SEATED, hyp, r4

SLICES = """SELECT r.round_id, r.video_id, c.chunk_start, r.start_1idx - 1 AS lo, r.end_1idx - 1 AS hi, greatest(r.start_1idx - 1, c.chunk_start) - c.chunk_start AS slice_from,
    least(r.end_1idx - 1, c.chunk_start + 299) - c.chunk_start + 1 AS slice_to FROM {rounds} r JOIN {chunks} c ON r.video_id = c.video_id AND c.chunk_start <= r.end_1idx - 1 AND c.chunk_start + 299 >= r.start_1idx - 1"""


@query("overlap_join_chunks_rounds", f"SELECT round_id, video_id, chunk_start, slice_from, slice_to FROM ({SLICES})")
def _(t):
    return j.chunk_slices(t.rounds, t.chunks).select("round_id", "video_id", "chunk_start", "slice_from", "slice_to")


@query("overlap_join_bucketed", """SELECT a.round_id, a.seg_id, b.seg_id AS other FROM {segments} a JOIN {segments} b ON a.round_id = b.round_id AND a.start_frame <= b.end_frame AND b.start_frame <= a.end_frame WHERE a.label = 'hit' AND b.label = 'tap'""")
def _(t):
    """The overlap join with bucketed frames, for keys with very many rows."""
    a = t.segments.where("label = 'hit'").select("round_id", "seg_id", F.col("start_frame").alias("s1"), F.col("end_frame").alias("e1"))
    b = t.segments.where("label = 'tap'").select("round_id", F.col("seg_id").alias("other"), F.col("start_frame").alias("s2"), F.col("end_frame").alias("e2"))
    return j.interval_overlap_join(a, b, ["round_id"], ("s1", "e1"), ("s2", "e2"), bucket=100).select("round_id", "seg_id", "other")


@query("frame_in_segment_join", "SELECT b.round_id, b.box_id, s.seg_id FROM {boxes} b LEFT JOIN {segments} s ON b.round_id = s.round_id AND b.anchor_frame BETWEEN s.start_frame AND s.end_frame")
def _(t):
    """Boxes with every covering segment; boxes without one have a null seg_id."""
    hit = j.point_in_interval_join(t.boxes, t.segments.select("round_id", "seg_id", "start_frame", "end_frame"), ["round_id"], "anchor_frame").select("round_id", "box_id", "seg_id")
    none = t.boxes.join(hit, ["round_id", "box_id"], "left_anti").select("round_id", "box_id", F.lit(None).cast("bigint").alias("seg_id"))
    return hit.unionByName(none)


FRAMES = "SELECT DISTINCT round_id, frame_id FROM {detections}"


def asof_sql(target: str, prefer: str) -> str:
    side = f"max(CASE WHEN f.frame_id <= s.{target} THEN f.frame_id END)" if prefer == "before" else f"min(CASE WHEN f.frame_id >= s.{target} THEN f.frame_id END)"
    return f"""SELECT s.round_id, s.seg_id, coalesce({side}, min_by(f.frame_id, abs(f.frame_id - s.{target}) * 100000 + f.frame_id)) AS asof_frame
        FROM {{segments}} s LEFT JOIN ({FRAMES}) f ON s.round_id = f.round_id AND f.frame_id BETWEEN s.start_frame AND s.end_frame GROUP BY s.round_id, s.seg_id"""


@query("asof_nearest_frame_directional", asof_sql("start_frame", "after"))
def _(t):
    return j.asof_frame(t.segments.select("round_id", "seg_id", "start_frame", "end_frame"), t.detections, "start_frame", "after").select("round_id", "seg_id", "asof_frame")


@query("asof_nearest_frame_tolerance", f"""SELECT s.round_id, s.seg_id, min_by(f.frame_id, abs(f.frame_id - s.start_frame) * 2 + CASE WHEN f.frame_id < s.start_frame THEN 1 ELSE 0 END) AS asof_frame
    FROM {{segments}} s LEFT JOIN ({FRAMES}) f ON s.round_id = f.round_id AND abs(f.frame_id - s.start_frame) <= 9 GROUP BY s.round_id, s.seg_id""")
def _(t):
    return j.asof_offset(t.segments.select("round_id", "seg_id", "start_frame"), t.detections, "start_frame", 9).select("round_id", "seg_id", "asof_frame")


@query("asof_nearest_frame_min_diff", f"""SELECT s.round_id, s.seg_id, min_by(f.frame_id, abs(f.frame_id - s.start_frame) * 100000 + f.frame_id) AS asof_frame
    FROM {{segments}} s LEFT JOIN ({FRAMES}) f ON s.round_id = f.round_id AND f.frame_id <= s.start_frame + 10 GROUP BY s.round_id, s.seg_id""")
def _(t):
    return j.nearest_frame(t.segments.select("round_id", "seg_id", "start_frame"), t.detections, "start_frame").select("round_id", "seg_id", "asof_frame")


@query("frame_lookup_with_fallback", f"""WITH f AS (SELECT *, row_number() OVER (PARTITION BY round_id ORDER BY frame_id) - 1 AS pos FROM ({FRAMES}))
    SELECT s.round_id, s.seg_id, coalesce(a.frame_id, b.frame_id) AS found_frame FROM {{segments}} s LEFT JOIN f a ON s.round_id = a.round_id AND a.frame_id = s.start_frame LEFT JOIN f b ON s.round_id = b.round_id AND b.pos = s.start_frame""")
def _(t):
    return j.lookup_frame(t.segments.select("round_id", "seg_id", "start_frame"), t.detections, "start_frame").select("round_id", "seg_id", "found_frame")


@query("nearest_seat_join", f"SELECT round_id, det_id, seat FROM ({SEATED})")
def _(t):
    return j.assign_seats_template(t.detections).select("round_id", "det_id", "seat")


SEAT_OF_POINT = f"""SELECT d.round_id, d.det_id, min_by(seat_id, CASE WHEN {INSIDE} THEN seat_id - 1000 ELSE {OBB_DISTANCE} END) AS seat_id, bool_or({INSIDE}) AS inside
    FROM {{dets720}} d JOIN {{seat_obbs}} o ON d.round_id = o.round_id WHERE {INSIDE} OR {OBB_DISTANCE} <= 30 GROUP BY d.round_id, d.det_id"""


@query("nearest_obb_join", f"SELECT d.round_id, d.det_id, b.seat_id, b.inside FROM {{dets720}} d LEFT JOIN ({SEAT_OF_POINT}) b ON d.round_id = b.round_id AND d.det_id = b.det_id")
def _(t):
    return j.assign_seats_obb(t.dets720, t.seat_obbs).select("round_id", "det_id", "seat_id", "inside")


TAPS = "SELECT round_id, CAST(10 * FLOOR(frame_id / 10) AS INT) AS frame_id, frame_id AS hand_frame, hand, x8 * CAST(1280 AS DOUBLE) AS px, y8 * CAST(720 AS DOUBLE) AS py FROM {hands} WHERE x8 > 0"


@query("nearest_detection_join", f"""WITH p AS ({TAPS}), d AS (SELECT p.round_id, p.hand_frame, p.hand, det_id, {hyp('d.cx', 'd.cy', 'p.px', 'p.py')} AS dist FROM p JOIN {{dets720}} d ON p.round_id = d.round_id AND p.frame_id = d.frame_id AND d.cy >= 450)
    SELECT p.round_id, p.hand_frame, p.hand, {r4('b.dist')} AS distance, CASE WHEN b.dist <= 150 THEN b.det_id END AS det_id
    FROM p LEFT JOIN (SELECT round_id, hand_frame, hand, min(dist) AS dist, min_by(det_id, struct_pack(a := dist, b := det_id)) AS det_id FROM d GROUP BY ALL) b ON p.round_id = b.round_id AND p.hand_frame = b.hand_frame AND p.hand = b.hand""")
def _(t):
    out = j.nearest_detection(t.sql(TAPS), t.dets720, 150.0, s.in_zone("hit"))
    return out.select("round_id", "hand_frame", "hand", g.r4(F.col("distance")).alias("distance"), "det_id")


NEW_ITEMS = f"""WITH RECURSIVE fr AS ({FRAMES}), sg AS (SELECT s.round_id, s.seg_id, min(f.frame_id) AS f0, max(f.frame_id) AS f1 FROM {{segments}} s JOIN fr f ON s.round_id = f.round_id AND f.frame_id BETWEEN s.start_frame AND s.end_frame WHERE s.label = 'hit' GROUP BY ALL),
    pr AS (SELECT sg.seg_id, e.det_id AS e, b.det_id AS b, row_number() OVER (PARTITION BY sg.seg_id ORDER BY {hyp('e.cx', 'e.cy', 'b.cx', 'b.cy')}, e.det_id, b.det_id) AS rn
           FROM sg JOIN {{dets720}} e ON sg.round_id = e.round_id AND e.frame_id = sg.f1 JOIN {{dets720}} b ON sg.round_id = b.round_id AND b.frame_id = sg.f0 WHERE {hyp('e.cx', 'e.cy', 'b.cx', 'b.cy')} <= 120),
    fold AS (SELECT seg_id, CAST(0 AS BIGINT) AS rn, CAST([] AS BIGINT[]) AS es, CAST([] AS BIGINT[]) AS bs FROM sg
             UNION ALL SELECT f.seg_id, p.rn, CASE WHEN list_contains(f.es, p.e) OR list_contains(f.bs, p.b) THEN f.es ELSE list_append(f.es, p.e) END, CASE WHEN list_contains(f.es, p.e) OR list_contains(f.bs, p.b) THEN f.bs ELSE list_append(f.bs, p.b) END
             FROM fold f JOIN pr p ON p.seg_id = f.seg_id AND p.rn = f.rn + 1),
    done AS (SELECT seg_id, max_by(es, rn) AS es FROM fold GROUP BY seg_id)
    SELECT sg.round_id, sg.seg_id, e.det_id FROM sg JOIN done ON sg.seg_id = done.seg_id JOIN {{dets720}} e ON sg.round_id = e.round_id AND e.frame_id = sg.f1 AND NOT list_contains(done.es, e.det_id)"""


def hit_spans(t, labels=("hit",)):
    """Segments with the first and last frame that have detections."""
    return spans(t.segments.where(F.col("label").isin(*labels)), t.detections).where("first_frame is not null")


@query("greedy_new_items", NEW_ITEMS)
def _(t):
    return j.new_items(hit_spans(t), t.dets720).select("round_id", "seg_id", F.explode("new.i").alias("det_id"))


#: The pairs of a frame's cards of one rank, from lists: no planner can join the table with itself in a bad way.
_CARDS_OF_RANK = f"SELECT round_id, frame_id, rank_norm, list(struct_pack(det_id := det_id, cx := cx, cy := cy, x1 := x1, y1 := y1, x2 := x2, y2 := y2, suit := suit) ORDER BY det_id) AS c FROM (SELECT *, {NORM_RANK} AS rank_norm FROM {{dets720}}) WHERE rank_norm IS NOT NULL GROUP BY ALL"
_RANK_PAIRS = f"SELECT round_id, frame_id, rank_norm, c[i] AS a, unnest(c[i + 1:]) AS b FROM (SELECT *, CAST(unnest(range(1, len(c))) AS INTEGER) AS i FROM ({_CARDS_OF_RANK}))"
PAIRS = f"""SELECT round_id, frame_id, a.det_id AS a_det_id, b.det_id AS b_det_id, rank_norm, {hyp('a.cx', 'a.cy', 'b.cx', 'b.cy')} AS distance,
    greatest(0, least(a.x2, b.x2) - greatest(a.x1, b.x1)) * greatest(0, least(a.y2, b.y2) - greatest(a.y1, b.y1)) AS overlap, a.cx AS a_cx, b.cx AS b_cx, a.cy AS a_cy, b.cy AS b_cy, a.suit AS a_suit, b.suit AS b_suit
    FROM ({_RANK_PAIRS}) WHERE {hyp('a.cx', 'a.cy', 'b.cx', 'b.cy')} <= 60 AND greatest(0, least(a.x2, b.x2) - greatest(a.x1, b.x1)) * greatest(0, least(a.y2, b.y2) - greatest(a.y1, b.y1)) >= 200"""


@query("same_rank_pairs", f"SELECT round_id, frame_id, a_det_id, b_det_id, rank_norm, {r4('distance')} AS distance, overlap FROM ({PAIRS})")
def _(t):
    return j.pair_self_join(t.dealt.dets720).select("round_id", "frame_id", "a_det_id", "b_det_id", "rank_norm", g.r4(F.col("distance")).alias("distance"), "overlap")


WIDE = "SELECT round_id, frame_id, max(CASE WHEN hand = 0 THEN hx END) AS h0x, max(CASE WHEN hand = 0 THEN hy END) AS h0y, max(CASE WHEN hand = 1 THEN hx END) AS h1x, max(CASE WHEN hand = 1 THEN hy END) AS h1y FROM (" + HAND_POS + ") GROUP BY round_id, frame_id"
HAND_PAIRS = f"""SELECT p.round_id, p.frame_id, p.a_det_id, p.b_det_id, a_cx AS ax, a_cy AS ay, b_cx AS bx, b_cy AS by_, h.h0x, h.h0y, h.h1x, h.h1y FROM ({PAIRS}) p JOIN ({WIDE}) h ON h.round_id = p.round_id AND h.frame_id = p.frame_id WHERE h0x IS NOT NULL AND h1x IS NOT NULL"""


@query("greedy_hand_card_assignment", f"""SELECT round_id, frame_id, a_det_id, b_det_id, CASE WHEN {hyp('h0x', 'h0y', 'ax', 'ay')} + {hyp('h1x', 'h1y', 'bx', 'by_')} <= {hyp('h0x', 'h0y', 'bx', 'by_')} + {hyp('h1x', 'h1y', 'ax', 'ay')} THEN 'direct' ELSE 'swapped' END AS assignment FROM ({HAND_PAIRS})""")
def _(t):
    hands = j.hands_wide(s.hand_position(t.keypoints21, ["round_id", "frame_id", "hand"])).where("h0x is not null and h1x is not null")
    rows = j.pair_self_join(t.dealt.dets720).join(hands, ["round_id", "frame_id"])
    d = lambda h, p: g.distance(F.col(f"h{h}x"), F.col(f"h{h}y"), F.col(f"{p}_cx"), F.col(f"{p}_cy"))
    return rows.select("round_id", "frame_id", "a_det_id", "b_det_id", j.assign_2x2(d(0, "a"), d(0, "b"), d(1, "a"), d(1, "b")).alias("assignment"))


IDENTITY = f"""WITH h AS ({WIDE}), q AS (SELECT *, a_cx AS ax, a_cy AS ay, a_suit AS asuit, b_cx AS bx, b_cy AS by_, b_suit AS bsuit FROM ({PAIRS})),
    x AS (SELECT s.round_id, s.rank_norm, s.frame_id, s.a_det_id, e.a_det_id AS e_det_id, s.ax AS s0x, s.ay AS s0y, s.bx AS s1x, s.by_ AS s1y, s.asuit AS s0_suit, s.bsuit AS s1_suit, e.ax AS eax, e.ay AS eay, e.bx AS ebx, e.by_ AS eby, e.asuit AS ea_suit,
                 hs.h0x AS sh0x, hs.h0y AS sh0y, hs.h1x AS sh1x, hs.h1y AS sh1y, he.h0x AS eh0x, he.h0y AS eh0y, he.h1x AS eh1x, he.h1y AS eh1y
          FROM q s JOIN q e ON s.round_id = e.round_id AND s.rank_norm = e.rank_norm AND e.frame_id = s.frame_id + 10 LEFT JOIN h hs ON hs.round_id = s.round_id AND hs.frame_id = s.frame_id LEFT JOIN h he ON he.round_id = e.round_id AND he.frame_id = e.frame_id),
    y AS (SELECT *, s0_suit <> s1_suit AS known, sh0x IS NOT NULL AND sh1x IS NOT NULL AND eh0x IS NOT NULL AND eh1x IS NOT NULL AS seen FROM x)
    SELECT round_id, frame_id, a_det_id, e_det_id, CASE WHEN known THEN 'suit' WHEN seen THEN 'hand' ELSE 'fallback' END AS via,
      CASE WHEN CASE WHEN known THEN ea_suit = s0_suit WHEN seen THEN CASE WHEN {hyp('sh0x', 'sh0y', 's0x', 's0y')} < {hyp('sh1x', 'sh1y', 's0x', 's0y')} THEN {hyp('eh0x', 'eh0y', 'eax', 'eay')} < {hyp('eh0x', 'eh0y', 'ebx', 'eby')} ELSE {hyp('eh1x', 'eh1y', 'eax', 'eay')} < {hyp('eh1x', 'eh1y', 'ebx', 'eby')} END
           ELSE NOT (a_det_id % 2 = 0) END THEN 'a' ELSE 'b' END AS first_end FROM y"""


@query("resolve_pair_identity", IDENTITY)
def _(t):
    """Pairs of one frame and of the next observed one: which end card is the first start card."""
    names = {"a_cx": "s0x", "a_cy": "s0y", "b_cx": "s1x", "b_cy": "s1y", "a_suit": "s0_suit", "b_suit": "s1_suit"}
    ends = {"a_det_id": "e_det_id", "a_cx": "eax", "a_cy": "eay", "b_cx": "ebx", "b_cy": "eby", "a_suit": "ea_suit"}
    pairs = j.with_next(j.pair_self_join(t.dealt.dets720), ["round_id", "rank_norm"], ends, 10).withColumnsRenamed(names)
    hands = j.hands_wide(s.hand_position(t.keypoints21, ["round_id", "frame_id", "hand"]))
    rows = pairs.select("round_id", "frame_id", "a_det_id", *names.values(), *ends.values()).join(j.hands_and_next(hands, 10), ["round_id", "frame_id"], "left")
    return j.resolve_pair(rows.withColumn("swapped", F.col("a_det_id") % 2 == 0)).select("round_id", "frame_id", "a_det_id", "e_det_id", "via", "first_end")


@query("semi_filter_with_asset", "SELECT s.round_id, s.seg_id, CASE WHEN c.video_id IS NULL THEN 'no_cards' ELSE 'ok' END AS status FROM {segments} s LEFT JOIN (SELECT DISTINCT video_id FROM {chunks}) c ON s.round_id = c.video_id")
def _(t):
    return j.require_asset(t.segments.select("round_id", "seg_id"), t.chunks.select(F.col("video_id").alias("round_id")), ["round_id"], "no_cards")


@query("exclude_training_videos", "SELECT video_id, frame_idx FROM {features} WHERE video_id NOT IN (SELECT DISTINCT video_id FROM {rounds} WHERE start_1idx > 6000)")
def _(t):
    return j.exclude(t.features.select("video_id", "frame_idx"), t.rounds.where("start_1idx > 6000"), ["video_id"])


#: One video in eight is the gallery, the rest ask.
GALLERY, ASKING = "video_id % 8 = 0", "video_id % 8 <> 0"
DOT = "list_inner_product(CAST(q.embedding AS DOUBLE[]), CAST(g.embedding AS DOUBLE[])) / (sqrt(list_inner_product(CAST(q.embedding AS DOUBLE[]), CAST(q.embedding AS DOUBLE[]))) * sqrt(list_inner_product(CAST(g.embedding AS DOUBLE[]), CAST(g.embedding AS DOUBLE[]))))"


def vectors(t, where: str, prefix: str):
    return t.features.where(where).select((F.col("video_id").cast("long") * 50 + F.col("frame_idx")).alias(f"{prefix}_id"), F.col("embedding").alias(f"{prefix}_vec"), F.col("label_id").alias(f"{prefix}_label"))


@query("top1_similarity_join", f"""SELECT q.video_id * 50 + q.frame_idx AS q_id, max({r4(DOT)}) AS best, min_by(g.video_id * 50 + g.frame_idx, struct_pack(a := -({r4(DOT)}), b := g.video_id * 50 + g.frame_idx)) AS g_id
    FROM {{features}} q JOIN {{features}} g ON q.video_id % 8 <> 0 AND g.video_id % 8 = 0 GROUP BY 1""")
def _(t):
    return j.top1_similarity(vectors(t, ASKING, "q"), vectors(t, GALLERY, "g"))


#: Frames blended with a third of the next frame of their video: each has a near match among the frames.
BLENDED = "list_transform(range(1, len(a.embedding) + 1), lambda i: 3 * CAST(a.embedding[i] AS DOUBLE) + CAST(b.embedding[i] AS DOUBLE))"


@query("top1_similarity_hashed", f"""WITH b AS (SELECT a.video_id, a.frame_idx, {BLENDED} AS embedding FROM {{features}} a JOIN {{features}} b ON a.video_id = b.video_id AND b.frame_idx = a.frame_idx + 1)
    SELECT q.video_id * 50 + q.frame_idx AS q_id, max({r4(DOT)}) AS best, min_by(g.video_id * 50 + g.frame_idx, struct_pack(a := -({r4(DOT)}), b := g.video_id * 50 + g.frame_idx)) AS g_id
    FROM b q JOIN {{features}} g ON true GROUP BY 1 HAVING max({r4(DOT)}) >= 0.9""")
def _(t):
    """Every blended frame against all frames, by hashed projections; the twin compares all pairs."""
    f = t.features.select("video_id", "frame_idx", F.col("embedding").cast("array<double>").alias("vec"))
    after = f.select("video_id", (F.col("frame_idx") - 1).alias("frame_idx"), F.col("vec").alias("after"))
    blended = f.join(after, ["video_id", "frame_idx"]).withColumn("q_vec", F.zip_with("vec", "after", lambda x, y: 3 * x + y))
    asked = blended.select((F.col("video_id").cast("long") * 50 + F.col("frame_idx")).alias("q_id"), "q_vec")
    return sim.top1_similarity_hashed(asked, vectors(t, "true", "g"), least=0.9, miss=1e-6)


@query("task_id_lookup", "SELECT s.seg_id, s.round_id, c.c_name FROM {segments} s LEFT JOIN (SELECT c_custkey, c_name FROM customer WHERE c_acctbal > 1000) c ON s.round_id = c.c_custkey")
def _(t):
    ids = t.customer.where("c_acctbal > 1000").select(F.col("c_custkey").alias("round_id"), "c_name")
    return j.lookup_ids(t.segments.select("seg_id", "round_id"), ids, "round_id")
