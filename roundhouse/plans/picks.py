"""Queries of top-k, sampling and set operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from roundhouse.operators import picks as p
from roundhouse.operators.joins import assign_seats_template, pair_self_join
from roundhouse.operators.pipelines import widest_pair
from roundhouse.plans.joins import PAIRS
from roundhouse.plans.registry import query
from roundhouse.plans.scalars import SEATED
from roundhouse.plans.sequences import tracked_pairs
from roundhouse.sources import names

TOPK = "SELECT round_id, frame_id, n_dets, place FROM (SELECT round_id, frame_id, count(*) AS n_dets, CAST(row_number() OVER (PARTITION BY round_id ORDER BY count(*) DESC, frame_id) AS INTEGER) AS place FROM {detections} GROUP BY round_id, frame_id) WHERE place <= 10"


@query("rep_frames_topk", TOPK)
def _(t):
    return p.rep_frames(t.detections, 10)


@query("best_rep_frame", f"""WITH s AS (SELECT round_id, frame_id, count(DISTINCT CASE WHEN seat > 0 THEN seat END) AS n_seats FROM ({SEATED}) GROUP BY ALL), c AS (SELECT k.*, coalesce(s.n_seats, 0) AS n_seats FROM ({TOPK}) k LEFT JOIN s ON k.round_id = s.round_id AND k.frame_id = s.frame_id)
    SELECT round_id, frame_id, n_seats, place FROM (SELECT *, row_number() OVER (PARTITION BY round_id ORDER BY n_seats DESC, place) AS rn FROM c) WHERE rn = 1""")
def _(t):
    seats = assign_seats_template(t.detections).groupBy("round_id", "frame_id").agg(F.count_distinct(F.when(F.col("seat") > 0, F.col("seat"))).alias("n_seats"))
    return p.best_rep_frame(p.rep_frames(t.detections, 10), seats)


CLUSTERS = f"""SELECT round_id, frame_id, a_det_id, b_det_id, rank_norm, cluster_x, CAST(row_number() OVER (PARTITION BY round_id ORDER BY frame_id, overlap DESC, distance, a_det_id, b_det_id) AS INTEGER) AS pair_no
    FROM (SELECT *, row_number() OVER (PARTITION BY round_id, rank_norm, cluster_x ORDER BY frame_id, overlap DESC, distance, a_det_id, b_det_id) AS rn FROM (SELECT *, CAST(FLOOR(least(a_cx, b_cx) / 50) * 50 AS INTEGER) AS cluster_x FROM ({PAIRS}))) WHERE rn = 1"""


@query("dedup_pairs_by_cluster", CLUSTERS)
def _(t):
    return p.first_per_cluster(pair_self_join(t.dealt.dets720), ["round_id"], 50).select("round_id", "frame_id", "a_det_id", "b_det_id", "rank_norm", "cluster_x", "pair_no")


@query("topk_pairs_per_segment")
def _(t):
    """Of the first ten tracked pairs of a segment the one of largest spread, if it is 5 at least, where pairs part. No SQL twin: track_pair has none."""
    return widest_pair(tracked_pairs(t, t.parting)).where("spread >= 5").drop("n_pairs")


def random_order(ids: str) -> str:
    """The order of random places in SQL: by md5 of the seed and the ids."""
    return f"md5(concat_ws('|', 42, {ids})), {ids}"


@query("sample_n_per_class", f"""SELECT seg_id, label FROM (SELECT *, row_number() OVER (PARTITION BY label ORDER BY {random_order('seg_id')}) AS r FROM (SELECT seg_id, CASE WHEN label IN ('hit', 'tap', 'split') THEN label ELSE 'background' END AS label FROM {{segments}}) WHERE label <> 'background') WHERE r <= 5""")
def _(t):
    rows = t.segments.select("seg_id", F.when(F.col("label").isin("hit", "tap", "split"), F.col("label")).otherwise("background").alias("label"))
    return p.sample_per_class(rows, "label", ["seg_id"], 5)


@query("evenly_spaced_pick", """WITH n AS (SELECT c_name, row_number() OVER (ORDER BY c_name) - 1 AS pos, count(*) OVER () AS len FROM customer), k AS (SELECT DISTINCT CAST(round_even(i * (l - 1) / CAST(19 AS DOUBLE), 0) AS BIGINT) AS pos FROM (SELECT unnest(range(20)) AS i) a, (SELECT count(*) AS l FROM customer) b)
    SELECT c_name, CAST(n.pos AS INTEGER) AS pos FROM n JOIN k ON n.pos = k.pos""")
def _(t):
    return p.evenly_spaced(t.customer.select("c_name"), "c_name", 20)


@query("balanced_sample_union", f"""WITH r AS (SELECT seg_id, label, row_number() OVER (PARTITION BY label ORDER BY {random_order('seg_id')}) AS place, count(*) OVER (PARTITION BY label) AS n FROM {{segments}} WHERE label IN ('hit', 'tap'))
    SELECT seg_id, label, CASE WHEN label = 'hit' THEN 'human' ELSE 'auto' END AS source FROM r WHERE place <= (SELECT min(n) FROM r)""")
def _(t):
    s = t.segments.select("seg_id", "label")
    return p.balanced_union(s.where("label = 'hit'"), s.where("label = 'tap'"), ["seg_id"])


@query("latest_annotated_frame", """SELECT round_name, frame_id, max(file_name) AS file_name FROM (SELECT *, regexp_extract(file_name, '^(.*)_f([0-9]+)\\.png$', 1) AS round_name, CAST(regexp_extract(file_name, '^(.*)_f([0-9]+)\\.png$', 2) AS INTEGER) AS frame_id FROM {frame_images} WHERE regexp_matches(file_name, '^(.*)_f([0-9]+)\\.png$'))
    QUALIFY frame_id = max(frame_id) OVER (PARTITION BY round_name) GROUP BY round_name, frame_id""".replace("QUALIFY frame_id = max(frame_id) OVER (PARTITION BY round_name) GROUP BY round_name, frame_id", "GROUP BY round_name, frame_id QUALIFY frame_id = max(frame_id) OVER (PARTITION BY round_name)"))
def _(t):
    return p.latest_frame(names.parse_frame_name(t.frame_images).where("status = 'ok'"))


@query("limit_first_n_videos", "SELECT * FROM {segments} WHERE round_id IN (SELECT round_id FROM (SELECT round_id, min(seg_id) AS s FROM {segments} GROUP BY round_id ORDER BY s, round_id LIMIT 5))")
def _(t):
    return p.first_n_groups(t.segments, "round_id", "seg_id", 5)


@query("balanced_batch_sampler", f"""WITH i AS (SELECT seg_id, label, label = 'hit' AS is_focus, row_number() OVER (PARTITION BY label = 'hit' ORDER BY {random_order('seg_id')}) - 1 AS p, count(*) OVER (PARTITION BY label = 'hit') AS n FROM {{segments}}),
    b AS (SELECT greatest(4, 2 * max(CASE WHEN is_focus THEN n END) // 8) AS nb FROM i), s AS (SELECT i.*, CASE WHEN is_focus THEN 8 ELSE 24 END AS per, unnest(range(p, nb * CASE WHEN is_focus THEN 8 ELSE 24 END, n)) AS s FROM i, b)
    SELECT seg_id, label, s // per AS batch, CAST(s % per AS INTEGER) AS slot, is_focus FROM s""")
def _(t):
    rows = p.balanced_batches(t.segments.select("seg_id", "label"), ["seg_id"], F.col("label") == "hit", 32, 0.25)
    return rows.select("seg_id", "label", "batch", "slot", "is_focus")


@query("union_sources", "SELECT seg_id, label, 'human' AS source FROM {segments} WHERE label = 'hit' UNION ALL SELECT seg_id, label, 'auto' FROM {segments} WHERE score > 0.05")
def _(t):
    s = t.segments
    return p.union_sources({"human": s.where("label = 'hit'").select("seg_id", "label"), "auto": s.where("score > 0.05").select("seg_id", "label")})


@query("label_vocabulary", "SELECT label, CAST(row_number() OVER (ORDER BY label = 'discard', label) - 1 AS INTEGER) AS label_id FROM (SELECT DISTINCT label FROM {segments})")
def _(t):
    return p.label_vocabulary(t.segments, "discard")


@query("names_present_in_both", "SELECT round_id FROM {segments} INTERSECT SELECT video_id FROM {chunks}")
def _(t):
    return p.names_in_both(t.segments.select("round_id"), t.chunks.select(F.col("video_id").alias("round_id")))


@query("names_only_in_first", "SELECT round_id FROM {segments} EXCEPT SELECT video_id FROM {chunks}")
def _(t):
    return p.names_only_in(t.segments.select("round_id"), t.chunks.select(F.col("video_id").alias("round_id")))
