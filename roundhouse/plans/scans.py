"""Queries of scans, sources and sinks."""

from __future__ import annotations

from pyspark.sql import functions as F

from roundhouse.operators.joins import pair_self_join, point_in_interval_join
from roundhouse.plans.joins import PAIRS
from roundhouse.plans.registry import query
from roundhouse.sources import annotations as a
from roundhouse.sources import names
from roundhouse.storage import scratch_folder

_PARSED = """SELECT asset_id, file_name, substr(file_name, 1, 19) AS base_name, CAST(substr(file_name, 21, 6) AS INTEGER) AS chunk_index,
    CAST(substr(file_name, 28, 6) AS INTEGER) AS chunk_start FROM {asset_names} WHERE file_name NOT LIKE 'bad%'"""


@query("parse_asset_names", _PARSED)
def _(t):
    return names.parse_asset_name(t.asset_names)


@query("parse_frame_image_names", """SELECT round_id, image_id, file_name, CASE WHEN file_name LIKE '%\\_f%' ESCAPE '\\' THEN regexp_extract(file_name, '^(.*)_f([0-9]+)\\.png$', 1) END AS round_name,
    TRY_CAST(regexp_extract(file_name, '^(.*)_f([0-9]+)\\.png$', 2) AS INTEGER) AS frame_id,
    CASE WHEN regexp_matches(file_name, '^(.*)_f([0-9]+)\\.png$') THEN 'ok' ELSE 'bad_filename' END AS status FROM {frame_images}""")
def _(t):
    return names.parse_frame_name(t.frame_images)


@query("chunk_index_by_video", f"""SELECT base_name, count(*) AS n_chunks, string_agg(file_name, ',' ORDER BY chunk_start, file_name) AS files FROM ({_PARSED}) GROUP BY base_name""")
def _(t):
    return names.index_chunks(names.parse_asset_name(t.asset_names)).select("base_name", "n_chunks", F.concat_ws(",", "files.file_name").alias("files"))


@query("normalize_detections", """SELECT round_id, det_id, cx, cy, x1, y1, x2, y2, conf, CASE WHEN det_id % 5 = 0 THEN 'U' ELSE rank END AS rank, CAST(0 AS DOUBLE) AS rank_conf, suit, CAST(0.5 AS DOUBLE) AS suit_conf,
    CASE WHEN det_id % 5 = 0 THEN 'unmatched' ELSE 'matched' END AS match_type FROM {detections}""")
def _(t):
    """Detections written as JSON in two spellings, then read."""
    box, centre = F.array("x1", "y1", "x2", "y2"), F.array("cx", "cy")
    old = F.to_json(F.struct(box.alias("bbox"), F.col("conf").alias("confidence"), F.array(centre).alias("polygon_center"), F.col("suit"), F.lit(0.5).alias("suit_conf"), F.when(F.col("det_id") % 5 != 0, F.col("rank")).alias("rank")))
    new = F.to_json(F.struct(box.alias("box"), F.col("conf"), centre.alias("polygon_center"), F.col("suit"), F.lit(0.5).alias("suit_conf"), F.when(F.col("det_id") % 5 != 0, F.col("rank")).alias("rank")))
    return a.normalize_detection(t.detections.select("round_id", "det_id", F.when(F.col("det_id") % 2 == 0, old).otherwise(new).alias("raw"))).drop("raw")


def _segment_map(t):
    item = F.struct("start_frame", "end_frame", "label", "seg_id")
    rows = t.segments.groupBy("round_id").agg(F.array_sort(F.collect_list(item)).alias("items"))
    return rows.select(F.to_json(F.map_from_arrays(F.array(F.concat(F.col("round_id").cast("string"), F.lit(".txt"))), F.array("items"))).alias("raw"))


@query("flatten_segment_map", """SELECT CAST(round_id AS STRING) AS video, CAST(row_number() OVER (PARTITION BY round_id ORDER BY start_frame, end_frame, label, seg_id) - 1 AS INTEGER) AS seq, start_frame, end_frame, label, seg_id FROM {segments}""")
def _(t):
    return a.flatten_segment_map(_segment_map(t))


@query("flatten_predictions_min_score", """SELECT CAST(round_id AS STRING) AS video, label, score, start_frame, end_frame, seg_id FROM {segments} WHERE label = 'tap' AND score >= 0.3""")
def _(t):
    item = F.struct("label", "score", "start_frame", "end_frame", "seg_id")
    rows = t.segments.groupBy("round_id").agg(F.collect_list(item).alias("detections"))
    raw = F.to_json(F.map_from_arrays(F.array(F.col("round_id").cast("string")), F.array(F.struct("detections"))))
    return a.flatten_predictions(rows.select(raw.alias("raw")), "tap", 0.3)


_NORMED = "SELECT round_id, box_id, CAST(box_id % 4 AS INTEGER) AS class_id, (x1 + x2) / CAST(3838 AS DOUBLE) AS bx, (y1 + y2) / CAST(2158 AS DOUBLE) AS by_, (x2 - x1) / CAST(1919 AS DOUBLE) AS bw, (y2 - y1) / CAST(1079 AS DOUBLE) AS bh FROM {boxes}"


def _lines(t):
    return a.format_labels(t.sql(_NORMED), ["bx", "by_", "bw", "bh"])


@query("write_label_text", f"""SELECT round_id, box_id, printf('%d %.6f %.6f %.6f %.6f', class_id, bx, by_, bw, bh) AS line FROM ({_NORMED})""")
def _(t):
    return _lines(t).select("round_id", "box_id", "line")


@query("read_label_text", f"""SELECT round_id, box_id, class_id, CAST(printf('%.6f', bx) AS DOUBLE) AS bx, CAST(printf('%.6f', by_) AS DOUBLE) AS by_, CAST(printf('%.6f', bw) AS DOUBLE) AS bw, CAST(printf('%.6f', bh) AS DOUBLE) AS bh FROM ({_NORMED})""")
def _(t):
    rows = a.parse_labels(_lines(t).select("round_id", "box_id", "line"), "box", "line")
    return rows.select("round_id", "box_id", "class_id", *[F.get("numbers", F.lit(k)).alias(n) for k, n in enumerate(("bx", "by_", "bw", "bh"))])


_BOXED = """SELECT s.round_id, s.seg_id, b.box_id, b.anchor_frame, b.x1, b.y1, b.x2, b.y2 FROM {segments} s JOIN {boxes} b ON s.round_id = b.round_id AND b.anchor_frame BETWEEN s.start_frame AND s.end_frame"""


def _records(t):
    return a.build_annotation_records(t.customer.select(F.col("c_custkey").alias("round_id")), t.segments, t.dealt.boxes)


@query("annotation_record_write", f"""WITH b AS ({_BOXED}), n AS (SELECT round_id, seg_id, count(*) AS n FROM b GROUP BY ALL)
    SELECT c_custkey AS round_id, count(s.seg_id) AS n_segments, CAST(coalesce(sum(end_frame - start_frame + 1), 0) AS BIGINT) AS frames, CAST(coalesce(sum(n.n), 0) AS BIGINT) AS n_boxes,
           min_by(s.seg_id, {{'a': s.start_frame, 'b': s.seg_id}}) AS first_id
    FROM {{customer}} LEFT JOIN {{segments}} s ON s.round_id = c_custkey LEFT JOIN n ON n.round_id = s.round_id AND n.seg_id = s.seg_id GROUP BY c_custkey""".replace("{{", "{").replace("}}", "}").replace("{'a': s.start_frame, 'b': s.seg_id}", "struct_pack(a := s.start_frame, b := s.seg_id)"))
def _(t):
    """Records counted back from their nested form."""
    s = F.coalesce("timeline_segments", F.array().cast("array<struct<start_frame:int,id:bigint,end_frame:int,labels:array<string>,duration_frames:int,bounding_boxes:array<struct<frame:int,id:bigint,x1:int,y1:int,x2:int,y2:int>>>>"))
    total = lambda f: F.aggregate(s, F.lit(0).cast("bigint"), lambda n, x: n + f(x))
    return _records(t).select("round_id", F.size(s).cast("bigint").alias("n_segments"), total(lambda x: x["duration_frames"]).alias("frames"), total(lambda x: F.when(x["bounding_boxes"].isNull(), 0).otherwise(F.size(x["bounding_boxes"]))).alias("n_boxes"), F.get(s, F.lit(0))["id"].alias("first_id"))


@query("annotation_record_read_back", f"""WITH b AS (SELECT *, count(*) OVER (PARTITION BY round_id, seg_id) AS n_boxes, row_number() OVER (PARTITION BY round_id, seg_id ORDER BY anchor_frame, box_id) AS rn FROM ({_BOXED}))
    SELECT s.round_id, s.seg_id, s.start_frame, s.end_frame, s.label, s.end_frame - s.start_frame + 1 AS duration_frames, CAST(n_boxes AS INTEGER) AS n_boxes, anchor_frame AS frame, box_id, x1, y1, x2, y2
    FROM {{segments}} s JOIN b ON s.round_id = b.round_id AND s.seg_id = b.seg_id AND rn = 1 WHERE s.round_id IN (SELECT c_custkey FROM {{customer}})""".replace("{{", "{").replace("}}", "}"))
def _(t):
    return a.flatten_annotation_records(_records(t))


@query("skip_already_done", """SELECT * FROM {segments} WHERE round_id NOT IN (SELECT video_id FROM {chunks})""")
def _(t):
    return a.skip_done(t.segments, t.chunks.select(F.col("video_id").alias("round_id")), ["round_id"])


@query("skip_already_done_count", "SELECT count(CASE WHEN c.video_id IS NOT NULL THEN 1 END) AS n_skipped, count(CASE WHEN c.video_id IS NULL THEN 1 END) AS n_left FROM {segments} s LEFT JOIN (SELECT DISTINCT video_id FROM {chunks}) c ON s.round_id = c.video_id")
def _(t):
    return a.count_done(t.segments, t.chunks.select(F.col("video_id").alias("round_id")), ["round_id"])


_SPLIT_PAIRS = f"SELECT s.round_id, s.seg_id, p.* EXCLUDE (round_id) FROM {{segments}} s JOIN ({PAIRS}) p ON s.round_id = p.round_id AND p.frame_id BETWEEN s.start_frame AND s.end_frame WHERE s.label = 'split'"


@query("annotation_pair_read_back", f"""WITH p AS ({_SPLIT_PAIRS}), k AS (SELECT round_id, seg_id, CAST(count(*) AS INTEGER) AS n_keyframes, min(struct_pack(f := frame_id, a := a_det_id, b := b_det_id)) AS fi, max(struct_pack(f := frame_id, a := a_det_id, b := b_det_id)) AS la FROM p GROUP BY ALL HAVING count(*) >= 2),
    d AS (SELECT round_id, det_id, rank, suit FROM {{dets720}})
    SELECT s.round_id, s.seg_id, s.start_frame, s.end_frame, n_keyframes, d0.rank AS pair_rank, fi.f AS start_det_frame, la.f AS end_det_frame, fi.a AS s0_det_id, d0.suit AS s0_suit, fi.b AS s1_det_id, d1.suit AS s1_suit, la.a AS e0_det_id, d2.suit AS e0_suit, la.b AS e1_det_id, d3.suit AS e1_suit
    FROM k JOIN {{segments}} s ON s.round_id = k.round_id AND s.seg_id = k.seg_id JOIN d d0 ON d0.round_id = k.round_id AND d0.det_id = fi.a JOIN d d1 ON d1.round_id = k.round_id AND d1.det_id = fi.b JOIN d d2 ON d2.round_id = k.round_id AND d2.det_id = la.a JOIN d d3 ON d3.round_id = k.round_id AND d3.det_id = la.b""")
def _(t):
    """Records whose keyframes hold both cards of a pair, written and read back."""
    segs = t.segments.where("label = 'split'").select("round_id", "seg_id", "start_frame", "end_frame")
    pairs = point_in_interval_join(pair_self_join(t.dealt.dets720), segs, ["round_id"], "frame_id")
    return a.flatten_pair_records(a.build_pair_records(segs, pairs))


_FILE_LINES = {
    "box": ("SELECT round_id, box_id, class_id, bx, by_, bw, bh FROM (" + _NORMED + ")", ["bx", "by_", "bw", "bh"]),
    "obb": ("SELECT round_id, seat_id AS class_id, " + ", ".join(f"c{k}{x} / CAST({1279 if x == 'x' else 719} AS DOUBLE) AS c{k}{x}" for k in range(4) for x in "xy") + " FROM {seat_obbs}", [f"c{k}{x}" for k in range(4) for x in "xy"]),
    "keypoints": ("SELECT round_id, box_id, class_id, bx, by_, bw, bh, " + ", ".join(f"bx + bw * {k} / CAST(16 AS DOUBLE) AS x{k}, by_ AS y{k}, CAST({2 * (k % 2)} AS DOUBLE) AS v{k}" for k in range(7)) + " FROM (" + _NORMED + ")", ["bx", "by_", "bw", "bh", *[f"{x}{k}" for k in range(7) for x in "xyv"]]),
}
_FILE_SQL = " UNION ALL ".join(f"SELECT '{kind}' AS kind, class_id, [{', '.join(f'CAST(printf({chr(39)}%.6f{chr(39)}, {v}) AS DOUBLE)' for v in values)}] AS numbers FROM ({sql})" for kind, (sql, values) in _FILE_LINES.items())


@query("read_label_files", f"SELECT kind, CAST(class_id AS INTEGER) AS class_id, numbers FROM ({_FILE_SQL})")
def _(t):
    """Label files of lines of 5, 9 and 26 tokens, written as text and read back."""
    out = None
    for kind, (sql, values) in _FILE_LINES.items():
        path = scratch_folder(t.spark, f"labels-{kind}")
        a.format_labels(t.sql(sql), values).select("line").write.text(path)
        rows = a.read_labels(t.spark, path, kind).select(F.lit(kind).alias("kind"), "class_id", "numbers")
        out = rows if out is None else out.unionByName(rows)
    return out


@query("upload_payload_rows", """SELECT CAST(s.round_id AS STRING) AS video, s.seg_id, s.score, c.c_custkey AS task_id, CASE WHEN c.c_custkey IS NULL THEN NULL ELSE
      concat('{"task":', c.c_custkey, ',"label":"', s.label, '","start":', s.start_frame, ',"end":', s.end_frame, '}') END AS payload, CASE WHEN c.c_custkey IS NULL THEN 'unmapped' ELSE 'ready' END AS status
    FROM {segments} s LEFT JOIN (SELECT c_custkey FROM {customer} WHERE c_acctbal > 500) c ON c.c_custkey = s.round_id WHERE s.score > 0.1""")
def _(t):
    tasks = t.customer.where("c_acctbal > 500").select(F.col("c_custkey").cast("string").alias("video"), F.col("c_custkey").alias("task_id"))
    dets = t.segments.withColumn("video", F.col("round_id").cast("string"))
    return a.build_upload_payload(dets, tasks, 0.1).select("video", "seg_id", "score", "task_id", "payload", "status")


@query("task_video_name_from_url", """SELECT page_id, CASE WHEN page_id % 2 = 0 THEN concat('clip-', page_id) ELSE regexp_replace(regexp_extract(url, '([^/]*)$', 1), '\\.[^.]*$', '') END AS video FROM {pages}""")
def _(t):
    coded = F.concat(F.lit("https://h/data?fileuri="), F.base64(F.concat(F.lit("s3://b/x/clip-"), F.col("page_id"), F.lit(".mp4")).cast("binary")))
    rows = t.pages.select("page_id", F.when(F.col("page_id") % 2 == 0, coded).otherwise(F.col("url")).alias("url"))
    return rows.select("page_id", names.video_name_from_url(F.col("url")).alias("video"))
