"""Queries of ordered and sequential operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from roundhouse.functions import geometry as g
from roundhouse.operators import joins as j
from roundhouse.operators import scalar as s
from roundhouse.operators import sequences as q
from roundhouse.operators.pipelines import split_candidates
from roundhouse.plans.aggregates import SEAT_VOTE
from roundhouse.plans.joins import PAIRS, SEAT_OF_POINT, SLICES
from roundhouse.plans.registry import query
from roundhouse.plans.scalars import ACROSS, ALONG, INSIDE, LEN1, LEN3, NORM_RANK, hyp, r4

SEAT_VOTES = SEAT_VOTE.replace("INSIDE_TEST", INSIDE)


@query("merge_frames_to_round", f"""WITH x AS (SELECT round_id, lo, chunk_start, unnest(range(slice_from, slice_to)) AS pos FROM ({SLICES})), y AS (SELECT *, row_number() OVER (PARTITION BY round_id ORDER BY chunk_start, pos) - 1 AS frame_id, chunk_start + pos - lo AS kept FROM x)
    SELECT round_id, chunk_start, count(*) AS n, CAST(min(frame_id) AS INTEGER) AS first_frame, CAST(max(frame_id) AS INTEGER) AS last_frame, min(kept) AS first_kept, max(kept) AS last_kept FROM y GROUP BY ALL""")
def _(t):
    """Merged and gap-preserving frame ids, summed up per chunk."""
    keys = ["round_id", "chunk_start"]
    a = q.merge_chunks(t.rounds, t.chunks).groupBy(*keys).agg(F.count("*").alias("n"), F.min("frame_id").alias("first_frame"), F.max("frame_id").alias("last_frame"))
    b = q.merge_chunks(t.rounds, t.chunks, gap_preserving=True).groupBy(*keys).agg(F.min("frame_id").alias("first_kept"), F.max("frame_id").alias("last_kept"))
    return a.join(b, keys)


TAP = f"""WITH k AS (SELECT s.round_id, s.seg_id, s.start_frame, s.end_frame, p.hand, p.kp, p.frame_id, p.x, p.y FROM {{segments}} s JOIN {{keypoints21}} p ON s.round_id = p.round_id AND p.frame_id BETWEEN s.start_frame AND s.end_frame WHERE s.label = 'tap' AND p.kp <> 0),
    f AS (SELECT *, count(*) OVER (PARTITION BY round_id, seg_id, hand, kp) AS n FROM k), t AS (SELECT * FROM f WHERE n = end_frame - start_frame + 1 AND n >= 3 AND y >= CAST(480 AS DOUBLE) / 720),
    w AS (SELECT *, lag(y) OVER o AS p, lead(y) OVER o AS nx, min(y) OVER (PARTITION BY round_id, seg_id, hand, kp ORDER BY frame_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS lb, min(y) OVER (PARTITION BY round_id, seg_id, hand, kp ORDER BY frame_id ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS la,
            max(y) OVER (PARTITION BY round_id, seg_id, hand, kp) - min(y) OVER (PARTITION BY round_id, seg_id, hand, kp) AS rg FROM t WINDOW o AS (PARTITION BY round_id, seg_id, hand, kp ORDER BY frame_id)),
    pk AS (SELECT *, row_number() OVER (PARTITION BY round_id, seg_id, hand, kp ORDER BY frame_id) AS rn, (y - lb) + (y - la) AS dip FROM w WHERE rg >= CAST(DIP AS DOUBLE) AND y >= p AND y >= nx AND y - lb >= CAST(DIP AS DOUBLE) AND y - la >= CAST(DIP AS DOUBLE)),
    b AS (SELECT *, row_number() OVER (PARTITION BY round_id, seg_id ORDER BY dip DESC, hand, kp) AS r2 FROM pk WHERE rn = 1)
    SELECT round_id, seg_id, frame_id AS tap_frame, hand, kp, {r4('x * 1280')} AS tap_x, {r4('y * 720')} AS tap_y, {r4('dip')} AS dip FROM b WHERE r2 = 1"""


@query("first_peak_tap", TAP.replace("DIP", "0.004"))
def _(t):
    out = q.tap_motion(t.segments.where("label = 'tap'"), t.keypoints21, dip=0.004)
    return out.select("round_id", "seg_id", "tap_frame", "hand", "kp", *[g.r4(F.col(x)).alias(x) for x in ("tap_x", "tap_y", "dip")])


@query("rolling_median_spread", f"""WITH w AS (SELECT round_id, rank_norm, list_sort(list(distance) OVER (PARTITION BY round_id, rank_norm ORDER BY frame_id, a_det_id, b_det_id ROWS BETWEEN CURRENT ROW AND 4 FOLLOWING)) AS d FROM ({PAIRS}))
    SELECT round_id, rank_norm, CAST(ceil(max(d[3]) - min(d[3])) AS INTEGER) AS spread, count(*) AS n_windows FROM w WHERE len(d) = 5 GROUP BY round_id, rank_norm""")
def _(t):
    return q.rolling_median_spread(j.pair_self_join(t.dealt.dets720), ["round_id", "rank_norm"], ["frame_id", "a_det_id", "b_det_id"], "distance")


def tracked_pairs(t, dets):
    """The candidate pairs of long enough splits, followed in the zone."""
    segs = t.segments.where("label = 'split' and end_frame - start_frame + 1 >= 25")
    zone = dets.where(s.in_zone("split"))
    return q.track_pair(split_candidates(segs, zone).drop("start_a", "start_b"), zone)


@query("track_pair")
def _(t):
    """No SQL twin: the state follows the matches. Compared with a plain loop in the tests."""
    return tracked_pairs(t, t.dets720)


@query("track_items")
def _(t):
    """No SQL twin. One row per track."""
    obs = q.track_items(q.dedup_spatial(t.dets720), least_obs=5)
    return obs.groupBy("round_id", "track_id").agg(F.count("*").alias("n_obs"), F.min("frame_id").alias("first_frame"), F.max("frame_id").alias("last_frame"))


SEATS_OF_TRACKS = "SELECT round_id, track_id, CAST(track_id % 8 AS INT) AS seat_id FROM (SELECT DISTINCT round_id, track_id FROM {tracks}) k"
ORDINALS = f"""SELECT round_id, track_id, seat_id, entry_frame, CAST(row_number() OVER (PARTITION BY round_id, seat_id ORDER BY entry_frame, track_id) AS INTEGER) AS ordinal
    FROM (SELECT k.round_id, k.track_id, v.seat_id, coalesce(min(CASE WHEN {INSIDE} THEN frame_id END), min(frame_id)) AS entry_frame FROM {{tracks}} k JOIN ({SEAT_VOTES}) v ON k.round_id = v.round_id AND k.track_id = v.track_id
          JOIN {{seat_obbs}} o ON o.round_id = k.round_id AND o.seat_id = v.seat_id GROUP BY ALL)"""


@query("seat_entry_ordinal", ORDINALS)
def _(t):
    from roundhouse.operators.aggregates import seat_vote

    seats = seat_vote(t.tracks, t.seat_obbs, entry=True).where("seat_id is not null")  # votes and entries come from one reading
    return q.in_order_of_entry(seats.select("round_id", "track_id", "seat_id", "entry_frame"))


#: The cards of a seat in one frame, in an order of dealing that follows det_id.
CARDS = """SELECT round_id * 1000 + frame_id AS round_id, seat_id, CAST(row_number() OVER (PARTITION BY round_id, frame_id, seat_id ORDER BY det_id) AS INT) AS ordinal, rank, cx, cy, det_id % 7 <> 0 AS alive
    FROM (SELECT round_id, frame_id, det_id, cx, cy, rank, CAST(det_id % 3 AS INT) AS seat_id FROM {dets720}) d"""
CARD_OBBS = "SELECT DISTINCT d.round_id * 1000 + d.frame_id AS round_id, o.seat_id - 3 AS seat_id, c0x - 200 AS c0x, c0y - 100 AS c0y, c1x + 300 AS c1x, c1y - 100 AS c1y, c2x + 300 AS c2x, c2y + 200 AS c2y, c3x - 200 AS c3x, c3y + 200 AS c3y FROM {dets720} d JOIN {seat_obbs} o ON d.round_id = o.round_id WHERE o.seat_id BETWEEN 3 AND 5"


@query("first_sign_reversal", f"""WITH c AS (SELECT c.*, CASE WHEN {LEN1} >= {LEN3} THEN {ALONG} / sqrt({LEN1}) ELSE {ACROSS} / sqrt({LEN3}) END AS l, CASE WHEN {LEN1} >= {LEN3} THEN {ACROSS} / sqrt({LEN3}) ELSE {ALONG} / sqrt({LEN1}) END AS s, count(*) OVER (PARTITION BY c.round_id, c.seat_id) AS n
      FROM ({CARDS}) c JOIN ({CARD_OBBS}) o ON c.round_id = o.round_id AND c.seat_id = o.seat_id WHERE c.seat_id > 0),
    u AS (SELECT round_id, seat_id, ordinal, 1 AS axis, l - lag(l) OVER w AS st FROM c WHERE n >= 3 WINDOW w AS (PARTITION BY round_id, seat_id ORDER BY ordinal) UNION ALL SELECT round_id, seat_id, ordinal, 2, s - lag(s) OVER w FROM c WHERE n >= 3 WINDOW w AS (PARTITION BY round_id, seat_id ORDER BY ordinal)),
    p AS (SELECT *, lag(sign(st)) OVER (PARTITION BY round_id, seat_id, axis ORDER BY ordinal) AS ps FROM u WHERE abs(st) >= 3)
    SELECT round_id, seat_id, min(ordinal) AS double_ordinal FROM p WHERE ps <> sign(st) GROUP BY ALL""")
def _(t):
    return q.zigzag(t.sql(CARDS), t.sql(CARD_OBBS))


@query("fan_turn_double", f"""WITH w AS (SELECT *, cx - lag(cx) OVER o AS vx, cy - lag(cy) OVER o AS vy, row_number() OVER o AS k FROM ({CARDS}) WHERE seat_id > 0 WINDOW o AS (PARTITION BY round_id, seat_id ORDER BY ordinal)),
    t AS (SELECT w.round_id, w.seat_id, w.k, sqrt(h.vx * h.vx + h.vy * h.vy) AS lf, sqrt(w.vx * w.vx + w.vy * w.vy) AS lv, h.vx * w.vy - h.vy * w.vx AS cr FROM w JOIN w h ON w.round_id = h.round_id AND w.seat_id = h.seat_id AND h.k = 2 WHERE w.k >= 3)
    SELECT t.round_id, t.seat_id, CAST(min(k) AS INTEGER) AS turn, m AS double_ordinal FROM t JOIN (SELECT round_id, seat_id, max(ordinal) AS m FROM ({CARDS}) GROUP BY ALL) x ON t.round_id = x.round_id AND t.seat_id = x.seat_id WHERE lf >= 4 AND (lv < 4 OR CASE WHEN lf * lv > 0 THEN cr / (lf * lv) END < -0.3) GROUP BY ALL""")
def _(t):
    return q.fan_double(t.sql(CARDS))


_UP = "abs(c1y - c0y) >= abs(c3y - c0y)"


def _local(p: str) -> tuple[str, str]:
    along = f"((({p}.cx - c0x) * (c1x - c0x) + ({p}.cy - c0y) * (c1y - c0y)) / sqrt({LEN1}))"
    across = f"((({p}.cx - c0x) * (c3x - c0x) + ({p}.cy - c0y) * (c3y - c0y)) / sqrt({LEN3}))"
    return f"CASE WHEN {_UP} THEN {across} ELSE {along} END", f"CASE WHEN {_UP} THEN {along} ELSE {across} END"


def _inside(p: str) -> str:
    return INSIDE.replace("(cx ", f"({p}.cx ").replace("(cy ", f"({p}.cy ")


@query("horizontal_pair_split", f"""WITH c AS (SELECT *, {NORM_RANK} AS rn FROM ({CARDS}) WHERE seat_id > 0), g AS (SELECT round_id, seat_id, list(struct_pack(ordinal := ordinal, rn := rn, cx := cx, cy := cy, alive := alive) ORDER BY ordinal) AS c FROM c GROUP BY ALL HAVING count(*) >= 3),
    h AS (SELECT round_id, seat_id, c[1] AS one, c[2] AS two, list_filter(c[3:], lambda x: x.alive AND x.rn = c[1].rn) AS sp FROM g WHERE c[1].rn = c[2].rn),
    k AS (SELECT round_id, seat_id, CASE WHEN one.alive THEN one ELSE coalesce(sp[1], one) END AS a, CASE WHEN two.alive THEN two ELSE coalesce(CASE WHEN one.alive THEN sp[1] ELSE sp[2] END, two) END AS b FROM h),
    x AS (SELECT k.round_id, k.seat_id, k.a, k.b, {_local('k.b')[0]} - ({_local('k.a')[0]}) AS dx, {_local('k.b')[1]} - ({_local('k.a')[1]}) AS dy FROM k JOIN ({CARD_OBBS}) o ON k.round_id = o.round_id AND k.seat_id = o.seat_id WHERE {_inside('k.a')} AND {_inside('k.b')})
    SELECT round_id, seat_id, a.ordinal AS first_ordinal, b.ordinal AS second_ordinal FROM x WHERE sqrt(dx * dx + dy * dy) >= 25 AND degrees(atan2(abs(dy), abs(dx))) < 40""")
def _(t):
    return q.split_seats(t.sql(CARDS), t.sql(CARD_OBBS))


@query("two_means_piles")
def _(t):
    """No SQL twin: an iteration. Compared with a plain loop in the tests."""
    return q.two_means(t.sql(CARDS))


SEQ_SEGS = "SELECT round_id, seg_id, start_frame, end_frame, CASE WHEN label IN ('hit', 'split', 'tap') THEN label ELSE 'background' END AS label, ROW_NUMBER() OVER (PARTITION BY round_id ORDER BY start_frame, seg_id) AS seq FROM {segments}"


@query("frame_labels_from_segments", f"""WITH f AS (SELECT round_id, unnest(range(1, 669)) AS frame_id FROM (SELECT DISTINCT round_id FROM {{segments}})), l AS (SELECT round_id, frame_id, arg_min(label, seq) AS label FROM (SELECT round_id, unnest(range(start_frame, end_frame + 1)) AS frame_id, label, seq FROM ({SEQ_SEGS}) WHERE label <> 'background') GROUP BY ALL),
    d AS (SELECT f.round_id, f.frame_id, coalesce(l.label, 'background') AS label FROM f LEFT JOIN l ON f.round_id = l.round_id AND f.frame_id = l.frame_id) SELECT round_id, label, count(*) AS n, CAST(sum(frame_id) AS BIGINT) AS frames FROM d GROUP BY ALL""")
def _(t):
    """Dense labels, summed up per round and label."""
    lengths = t.segments.select("round_id").distinct().withColumn("n", F.lit(668))
    return q.frame_labels(t.sql(SEQ_SEGS), lengths).groupBy("round_id", "label").agg(F.count("*").alias("n"), F.sum("frame_id").alias("frames"))


@query("frame_samples_stride", "SELECT round_id, seg_id, unnest(range(start_frame, least(end_frame, 599) + 1, 5)) AS frame_id FROM {segments} WHERE start_frame <= 599")
def _(t):
    return q.sample_frames(t.segments, 5, F.lit(599)).select("round_id", "seg_id", F.col("frame_id").cast("bigint"))


def _rounded(column: str):
    return F.transform(column, lambda x: g.r4(x))


MEANS = """SELECT video_id, start_frame, end_frame, place, avg(v) AS v FROM (SELECT s.video_id, s.start_frame, s.end_frame, unnest(CAST(embedding AS DOUBLE[])) AS v, unnest(range(len(embedding))) AS place FROM {feature_segments} s JOIN {features} f ON s.video_id = f.video_id AND f.frame_idx BETWEEN s.start_frame AND s.end_frame) GROUP BY ALL"""


@query("segment_mean_features", f"SELECT video_id, start_frame, end_frame, list({r4('v')} ORDER BY place) AS vec FROM ({MEANS}) GROUP BY video_id, start_frame, end_frame")
def _(t):
    return q.segment_mean(t.feature_segments.drop("label_id"), t.features).withColumn("vec", _rounded("vec"))


UNITS = "SELECT video_id, CAST(5 * k AS INT) AS start_frame, CAST(5 * k + 7 AS INT) AS end_frame FROM (SELECT DISTINCT video_id FROM {features}) v CROSS JOIN (SELECT 0 AS k UNION ALL SELECT 1 UNION ALL SELECT 4 UNION ALL SELECT 8) n"
BINS = f"""WITH u AS ({UNITS}), p AS (SELECT u.*, b, CAST(FLOOR(b * 7 / 9) AS INT) AS a, CASE WHEN b = 0 THEN greatest(1, CAST(FLOOR((b + 1) * 7 / 9) AS INT)) ELSE CAST(FLOOR((b + 1) * 7 / 9) AS INT) END AS z FROM u, (SELECT unnest(range(9)) AS b)),
    m AS (SELECT p.video_id, p.start_frame, p.end_frame, p.b, place, avg(v) AS v FROM p JOIN (SELECT video_id, frame_idx, unnest(CAST(embedding AS DOUBLE[])) AS v, unnest(range(len(embedding))) AS place FROM {{features}}) f ON p.video_id = f.video_id AND f.frame_idx >= p.start_frame + a AND f.frame_idx < p.start_frame + z GROUP BY ALL),
    l AS (SELECT video_id, start_frame, end_frame, b, list(v ORDER BY place) AS vec FROM m GROUP BY ALL), f AS (SELECT p.video_id, p.start_frame, p.end_frame, p.b, last_value(l.vec IGNORE NULLS) OVER (PARTITION BY p.video_id, p.start_frame, p.end_frame ORDER BY p.b) AS vec FROM p LEFT JOIN l ON p.video_id = l.video_id AND p.start_frame = l.start_frame AND p.b = l.b)
    SELECT video_id, start_frame, end_frame, list_transform(flatten(list(vec ORDER BY b)), lambda x: FLOOR(x * 10000 + 0.5) / 10000) AS vec FROM f GROUP BY video_id, start_frame, end_frame"""


@query("temporal_bin_features", BINS)
def _(t):
    """Nine bins over seven frames, so that some bins are empty."""
    return q.temporal_bins(t.sql(UNITS), t.features, 9).withColumn("vec", _rounded("vec"))


#: A round lasts to the end of its last segment.
LENGTHS = "SELECT round_id, CAST(max(end_frame) + 1 AS INT) AS n FROM {segments} GROUP BY round_id"
WINDOWS = f"SELECT round_id, s AS start_frame, s + 40 AS end_frame FROM (SELECT round_id, unnest(range(0, n - 39, 10)) AS s FROM ({LENGTHS}))"


@query("sliding_windows", f"SELECT round_id, CAST(start_frame AS INTEGER) AS start_frame, CAST(end_frame AS INTEGER) AS end_frame FROM ({WINDOWS})")
def _(t):
    return q.sliding_windows(t.sql(LENGTHS), 40, 10).drop("n")


@query("window_labels_by_overlap", f"""WITH w AS ({WINDOWS}), o AS (SELECT w.round_id, w.start_frame AS ws, w.end_frame AS we, s.label, sum(least(w.end_frame, s.end_frame) - greatest(w.start_frame, s.start_frame)) AS o, min(struct_pack(a := s.start_frame, b := s.seg_id)) AS f
      FROM w JOIN {{segments}} s ON w.round_id = s.round_id AND least(w.end_frame, s.end_frame) - greatest(w.start_frame, s.start_frame) > 0 GROUP BY ALL),
    b AS (SELECT round_id, ws, we, max(CASE WHEN label = 'hit' THEN o END) AS h, arg_min(struct_pack(l := label, o := o), struct_pack(a := -o, b := f)) AS b FROM o GROUP BY ALL)
    SELECT w.round_id, CAST(w.start_frame AS INTEGER) AS start_frame, CAST(w.end_frame AS INTEGER) AS end_frame, CASE WHEN h >= 12 THEN 'hit' WHEN b.b.o >= 12 THEN b.b.l ELSE 'discard' END AS label FROM w LEFT JOIN b ON w.round_id = b.round_id AND w.start_frame = b.ws AND w.end_frame = b.we""")
def _(t):
    return q.window_labels(q.sliding_windows(t.sql(LENGTHS), 40, 10), t.segments, "hit", 40, 0.3)


MOVE = "CAST({c} + FLOOR((CAST('0x' || substr(md5(concat_ws('|', 42, seg_id, copy)), {at}, 8) AS BIGINT) % 2000001 / CAST(1000000 AS DOUBLE) - 1) * CAST(0.15 AS DOUBLE) * (end_frame - start_frame + 1) + 0.5) AS INTEGER)"
JITTER = f"""SELECT round_id, seg_id, copy, s AS start_frame, e AS end_frame, label FROM (SELECT *, greatest(0, CASE WHEN copy = 0 THEN start_frame ELSE {MOVE.format(c='start_frame', at=1)} END) AS s, least(668, CASE WHEN copy = 0 THEN end_frame ELSE {MOVE.format(c='end_frame', at=9)} END) AS e
    FROM (SELECT *, CAST(unnest(range(4)) AS INTEGER) AS copy FROM {{segments}})) WHERE s <= e"""


@query("boundary_jitter_augment", JITTER)
def _(t):
    return q.jitter(t.segments, last=F.lit(668)).select("round_id", "seg_id", "copy", "start_frame", "end_frame", "label")


IOU = "(greatest(0, least({a}.e, {b}.e) - greatest({a}.s, {b}.s)) / CAST(greatest(1, ({a}.e - {a}.s) + ({b}.e - {b}.s) - greatest(0, least({a}.e, {b}.e) - greatest({a}.s, {b}.s))) AS DOUBLE))"
NMS = f"""WITH RECURSIVE o AS (SELECT round_id, label, seg_id, score, struct_pack(i := seg_id, s := start_frame, e := end_frame) AS v, row_number() OVER (PARTITION BY round_id, label ORDER BY score DESC, start_frame, seg_id) AS rn FROM {{segments}}),
    f AS (SELECT round_id, label, CAST(0 AS BIGINT) AS rn, list_filter([v], lambda x: false) AS kept FROM o WHERE rn = 1
          UNION ALL SELECT f.round_id, f.label, o.rn, CASE WHEN len(f.kept) >= 10 OR len(list_filter(f.kept, lambda k: {IOU.format(a='k', b='o.v')} > 0.3)) > 0 THEN f.kept ELSE list_append(f.kept, o.v) END FROM f JOIN o ON o.round_id = f.round_id AND o.label = f.label AND o.rn = f.rn + 1),
    d AS (SELECT round_id, label, arg_max(kept, rn) AS kept FROM f GROUP BY ALL), x AS (SELECT round_id, label, unnest(kept) AS v, unnest(range(len(kept))) AS place FROM d)
    SELECT x.round_id, x.label, CAST(place AS INTEGER) AS place, x.v.i AS seg_id, x.v.s AS start_frame, x.v.e AS end_frame, o.score FROM x JOIN o ON o.seg_id = x.v.i"""


@query("nms_1d", NMS)
def _(t):
    return q.nms_1d(t.segments, ["round_id", "label"])


@query("nms_1d_rounds", NMS)
def _(t):
    """The same by rounds of local maxima, whatever the stretches' lengths are."""
    return q.nms_1d(t.segments, ["round_id", "label"], most=0)


DEDUP = f"""WITH RECURSIVE o AS (SELECT round_id, frame_id, rank, suit, conf, struct_pack(i := det_id, x := cx, y := cy) AS v, row_number() OVER (PARTITION BY round_id, frame_id, rank, suit ORDER BY conf DESC, det_id) AS rn FROM {{dets720}}),
    f AS (SELECT round_id, frame_id, rank, suit, CAST(0 AS BIGINT) AS rn, list_filter([v], lambda x: false) AS kept FROM o WHERE rn = 1
          UNION ALL SELECT f.round_id, f.frame_id, f.rank, f.suit, o.rn, CASE WHEN len(list_filter(f.kept, lambda k: {hyp('k.x', 'k.y', 'o.v.x', 'o.v.y')} < 20)) > 0 THEN f.kept ELSE list_append(f.kept, o.v) END
          FROM f JOIN o ON o.round_id = f.round_id AND o.frame_id = f.frame_id AND o.rank = f.rank AND o.suit = f.suit AND o.rn = f.rn + 1),
    d AS (SELECT round_id, frame_id, rank, suit, arg_max(kept, rn) AS kept FROM f GROUP BY ALL) SELECT round_id, frame_id, unnest(list_transform(kept, lambda k: k.i)) AS det_id FROM d"""


@query("dedup_frame_detections", DEDUP)
def _(t):
    return q.dedup_spatial(t.dets720).select("round_id", "frame_id", "det_id")


def nearest_count(at: str) -> str:
    return f"""SELECT s.round_id, s.seg_id, coalesce(arg_min(c.n, abs(c.frame_id - s.{at}) * 2 + CASE WHEN c.frame_id < s.{at} THEN 1 ELSE 0 END), -1) AS n FROM {{segments}} s LEFT JOIN (SELECT round_id, frame_id, count(CASE WHEN cy >= 480 THEN 1 END) AS n FROM {{dets720}} GROUP BY ALL) c
        ON s.round_id = c.round_id AND abs(c.frame_id - s.{at}) <= 9 WHERE s.label = 'tap' GROUP BY ALL"""


COUNTED = f"SELECT a.round_id, a.seg_id, a.n AS start_count, z.n AS end_count, a.n >= 0 AND z.n >= 0 AND z.n > a.n AS rejected FROM ({nearest_count('start_frame')}) a JOIN ({nearest_count('end_frame')}) z ON a.round_id = z.round_id AND a.seg_id = z.seg_id"


@query("count_increase_reject", COUNTED)
def _(t):
    return q.count_increased(t.segments.where("label = 'tap'"), t.dets720, s.in_zone("tap")).select("round_id", "seg_id", "start_count", "end_count", "rejected")


@query("dealer_max_x_pick", "SELECT round_id, frame_id, count(*) AS n_candidates, arg_min(CASE WHEN cx BETWEEN 535 AND 800 AND cy BETWEEN 411 AND 489 THEN det_id END, CASE WHEN cx BETWEEN 535 AND 800 AND cy BETWEEN 411 AND 489 THEN struct_pack(a := -cx, b := det_id) END) AS det_id FROM {dets720} GROUP BY ALL")
def _(t):
    return q.pick_extreme(t.dets720, ["round_id", "frame_id"], s.in_zone("dealer"), F.col("cx")).select("round_id", "frame_id", "n_candidates", "det_id")


@query("hit_max_y_pick", "SELECT round_id, frame_id, count(*) AS n_candidates, arg_min(CASE WHEN cy >= 450 THEN det_id END, CASE WHEN cy >= 450 THEN struct_pack(a := -cy, b := det_id) END) AS det_id FROM {dets720} GROUP BY ALL")
def _(t):
    return q.pick_extreme(t.dets720, ["round_id", "frame_id"], s.in_zone("hit"), F.col("cy")).select("round_id", "frame_id", "n_candidates", "det_id")
