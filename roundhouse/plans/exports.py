"""Queries of raw exports, raw chunks and the sink of records: what is read was written as JSON from given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from roundhouse.operators.datasets import validate_annotations
from roundhouse.plans.registry import query
from roundhouse.plans.scans import _BOXED, _records
from roundhouse.sources import annotations as a
from roundhouse.sources import exports as e
from roundhouse.sources import records
from roundhouse.storage import forget, scratch_folder, stored

WIDE, HIGH = 1919.0, 1079.0


def _raw_tasks(t):
    """A JSON text per round: ranges of segments and rectangles of boxes in percent, in one list, with fields that come and go; some lines are no JSON."""
    text = lambda *parts: F.concat(*[F.lit(p) if isinstance(p, str) and not p.startswith("$") else F.col(p[1:]).cast("string") if isinstance(p, str) else p for p in parts])
    end = F.when(F.col("seg_id") % 2 == 1, text('"', "$end_frame", '"')).otherwise(F.col("end_frame").cast("string"))
    meta = F.when(F.col("seg_id") % 3 == 0, ',"meta":{"text":["12"]}').when(F.col("seg_id") % 3 == 1, ',"meta":{"text":"7"}').otherwise("")
    ranges = t.segments.select("round_id", F.lit(0).alias("k"), F.col("seg_id").alias("n"), text('{"id":"', "$seg_id", '","type":"timelinelabels","value":{"ranges":[{"start":', "$start_frame", ',"end":', end, '}],"timelinelabels":["', "$label", '"]}', meta, "}").alias("item"))
    percent = lambda c, size: F.format_string("%.9f", c * 100.0 / size)
    frame = lambda i: text('{"frame":', (F.col("anchor_frame") + i).cast("string"), ',"x":', percent(F.col("x1") + i, WIDE), ',"y":', percent(F.col("y1"), HIGH), ',"width":', percent(F.col("x2") - F.col("x1"), WIDE), ',"height":', percent(F.col("y2") - F.col("y1"), HIGH), "}")
    frames = F.array_join(F.transform(F.sequence(F.lit(0), F.col("n_keyframes") - 1), frame), ",")
    boxes = t.boxes.select("round_id", F.lit(1).alias("k"), F.col("box_id").alias("n"), text('{"id":"', "$box_id", '","type":"videorectangle","value":{"labels":["card"],"sequence":[', frames, "]}}").alias("item"))
    empty = boxes.select("round_id", F.lit(2).alias("k"), F.lit(0).cast("bigint").alias("n"), F.lit('{"type":"videorectangle","value":{"sequence":[]}}').alias("item")).distinct()
    rows = ranges.unionByName(boxes).unionByName(empty).groupBy("round_id").agg(F.array_sort(F.collect_list(F.struct("k", "n", "item"))).alias("items"))
    result = F.array_join(F.transform("items", lambda x: x["item"]), ",")
    gone = F.when(F.col("round_id") % 4 == 0, text('{"was_cancelled":true,"result":[', F.get("items", F.lit(0))["item"], "]},")).otherwise("")
    named = F.when(F.col("round_id") % 3 == 0, text('"file_upload":"","data":{"video":"/data/v/', "$round_id", '.mp4"}')).otherwise(text('"file_upload":"', "$round_id", '.mp4"'))
    task = text('{"id":', "$round_id", ",", named, ',"annotations":[', gone, '{"result":[', result, "]}]}")
    return rows.select(task.alias("value")).unionByName(rows.where("round_id % 10 = 0").select(F.concat(F.lit("{broken "), "round_id").alias("value")))


_FIRST = f"SELECT round_id, seg_id, count(*) AS n_boxes, min(box_id) AS box_id FROM ({_BOXED}) GROUP BY ALL"
_RAW_SEGMENTS = f"""SELECT s.round_id, s.seg_id, s.label, s.start_frame, s.end_frame, s.end_frame - s.start_frame AS duration_frames, CASE s.seg_id % 3 WHEN 0 THEN '12' WHEN 1 THEN '7' ELSE '' END AS meta_text,
    CAST(coalesce(f.n_boxes, 0) AS INTEGER) AS n_boxes, b.n_keyframes, b.x1, b.y1, b.x2, b.y2 FROM {{segments}} s LEFT JOIN ({_FIRST}) f ON f.round_id = s.round_id AND f.seg_id = s.seg_id LEFT JOIN {{boxes}} b ON b.round_id = f.round_id AND b.box_id = f.box_id"""


def _written_export(t):
    path = scratch_folder(t.spark, "export")
    _raw_tasks(t).write.text(path)
    return e.export_records(e.read_export(t.spark, path), skip_cancelled=True)


def _segments(t):
    rows = e.record_segments(_written_export(t))
    number = F.regexp_extract("video_name", r"^(\d+)\.mp4$", 1).cast("bigint")
    first = F.get("keyframes", F.lit(0))
    box = e.pixel_box(first, WIDE, HIGH)
    return rows.select(number.alias("round_id"), F.col("id").cast("bigint").alias("seg_id"), F.element_at("labels", 1).alias("label"), "start_frame", "end_frame", "duration_frames", F.array_join("meta_text", " ").alias("meta_text"), "n_boxes", "n_keyframes", *[c.alias(n) for n, c in box.items()])


@query("raw_export_segments", _RAW_SEGMENTS)
def _(t):
    """A raw export written as text, then read: segments of annotations that aren't cancelled, with the boxes that they cover."""
    return _segments(t)


@query("raw_export_checks", f"""WITH a AS ({_RAW_SEGMENTS}), m AS (SELECT round_id, seg_id, label, 'meta_missing' AS rule FROM a WHERE label IN ('initial hands 1st', 'initial hands 2nd', 'discard') AND meta_text = ''
      UNION ALL SELECT round_id, seg_id, label, 'needs_one_box_two_keyframes' FROM a WHERE label IN ('split', 'hit') AND NOT (n_boxes = 1 AND coalesce(n_keyframes, 0) = 2) UNION ALL SELECT round_id, seg_id, label, 'needs_one_box' FROM a WHERE label IN ('tap', 'call for action') AND n_boxes <> 1)
    SELECT * FROM m UNION ALL SELECT DISTINCT round_id, CAST(NULL AS BIGINT), CAST(NULL AS VARCHAR), 'OK' FROM a WHERE round_id NOT IN (SELECT round_id FROM m)""")
def _(t):
    """The rules of annotations over a raw export."""
    return validate_annotations(_segments(t))


@query("raw_chunk_detections", """SELECT round_id, frame_id, det_id, cx, cy, x1, y1, x2, y2, conf, CASE WHEN det_id % 5 = 0 THEN 'U' ELSE rank END AS rank, CASE WHEN det_id % 2 = 0 THEN conf ELSE CAST(0 AS DOUBLE) END AS rank_conf,
    suit, CAST(0.5 AS DOUBLE) AS suit_conf, CASE WHEN det_id % 5 = 0 THEN 'unknown' ELSE 'rank+suit' END AS match_type FROM {detections}""")
def _(t):
    """Detections written as raw chunks of frames in two spellings, then read; det_id is found again by its place in the frame."""
    box, centre, rank = F.array("x1", "y1", "x2", "y2"), F.array("cx", "cy"), F.when(F.col("det_id") % 5 != 0, F.col("rank")).alias("rank")
    old = F.to_json(F.struct(box.alias("bbox"), F.col("conf").alias("confidence"), F.array(centre).alias("polygon_center"), "suit", F.lit(0.5).alias("suit_conf"), rank))
    new = F.to_json(F.struct(box.alias("box"), "conf", centre.alias("polygon_center"), "suit", F.lit(0.5).alias("suit_conf"), rank))
    raw = F.when(F.col("det_id") % 2 == 0, old).otherwise(new).alias("raw")
    frames = t.detections.select("round_id", "frame_id", "det_id", raw).groupBy("round_id", "frame_id").agg(F.array_sort(F.collect_list(F.struct("det_id", "raw"))).alias("dets"))
    frames = frames.select("round_id", "frame_id", F.transform("dets", lambda x: x["det_id"]).alias("ids"), F.concat(F.lit('{"detections":['), F.array_join(F.transform("dets", lambda x: x["raw"]), ","), F.lit("]}")).alias("raw"))
    chunks = frames.groupBy("round_id", F.floor(F.col("frame_id") / 300).alias("chunk")).agg(F.array_sort(F.collect_list(F.struct("frame_id", "ids", "raw"))).alias("f"))
    chunks = chunks.select("round_id", F.transform("f", lambda x: F.struct(x["frame_id"].alias("frame_id"), x["ids"].alias("ids"))).alias("known"), F.concat(F.lit("["), F.array_join(F.transform("f", lambda x: x["raw"]), ","), F.lit("]")).alias("raw"))
    found = e.chunk_detections(chunks)
    frame = F.get("known", F.col("pos"))
    return found.select("round_id", frame["frame_id"].alias("frame_id"), F.get(frame["ids"], F.col("det_no")).alias("det_id"), "cx", "cy", "x1", "y1", "x2", "y2", "conf", "rank", "rank_conf", "suit", "suit_conf", "match_type")


_RECORD = "struct<timeline_segments:array<struct<start_frame:int,id:bigint,end_frame:int,labels:array<string>,duration_frames:int,bounding_boxes:array<struct<frame:int,id:bigint,x1:int,y1:int,x2:int,y2:int>>>>>"


@query("annotation_record_sink", f"""WITH b AS (SELECT *, count(*) OVER (PARTITION BY round_id, seg_id) AS n_boxes, row_number() OVER (PARTITION BY round_id, seg_id ORDER BY anchor_frame, box_id) AS rn FROM ({_BOXED}))
    SELECT s.round_id, s.seg_id, s.start_frame, s.end_frame, s.label, s.end_frame - s.start_frame + 1 AS duration_frames, CAST(n_boxes AS INTEGER) AS n_boxes, anchor_frame AS frame, box_id, x1, y1, x2, y2
    FROM {{segments}} s JOIN b ON s.round_id = b.round_id AND s.seg_id = b.seg_id AND rn = 1 WHERE s.round_id IN (SELECT c_custkey FROM {{customer}})""")
def _(t):
    """Records written as one compressed file per video, half of them twice, and read back. They are nested once, for both runs of the sink."""
    records.use_records(t.spark)
    path = scratch_folder(t.spark, "records")
    nested = stored(_records(t), "nested-records")
    rows = nested.select(F.col("round_id").cast("string").alias("video_name"), F.to_json(F.struct("timeline_segments")).alias("record"))
    for lot in (rows.withColumn("record", F.when(F.xxhash64("video_name") % 2 == 0, F.col("record")).otherwise("{}")), rows.where(F.xxhash64("video_name") % 2 != 0)):
        lot.write.format("annotation_records").option("compression", "gzip").mode("append").save(path)
    forget(nested)
    back = t.spark.read.format("annotation_records").load(path)
    return a.flatten_annotation_records(back.select(F.col("video_name").cast("bigint").alias("round_id"), F.from_json("record", _RECORD)["timeline_segments"].alias("timeline_segments")))
