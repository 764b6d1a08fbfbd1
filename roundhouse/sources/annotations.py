"""Nested annotation, prediction and label files as rows, and back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Tokens of a label line: a box, an oriented box, a box with seven key points.
LABEL_TOKENS = {"box": 5, "obb": 9, "keypoints": 26}
RAW_DETECTION = "struct<bbox:array<double>,box:array<double>,conf:double,confidence:double,polygon_center:string,rank:string,rank_conf:double,suit:string,suit_conf:double,match_type:string>"


def normalize_detection(df: DataFrame, raw: str = "raw") -> DataFrame:
    """Detection JSON of either spelling as columns; centre [x, y] or [[x, y]], unknown rank and suit as U, boxes rounded half to even."""
    d = F.from_json(raw, RAW_DETECTION)
    box = F.coalesce(d["box"], d["bbox"])
    centre = F.from_json(F.regexp_replace(F.regexp_replace(d["polygon_center"], r"^\[\[", "["), r"\]\]$", "]"), "array<double>")
    corner = lambda k: F.bround(F.get(box, F.lit(k))).cast("int")
    return df.withColumns(
        {
            "cx": F.get(centre, F.lit(0)),
            "cy": F.get(centre, F.lit(1)),
            **{n: corner(k) for k, n in enumerate(("x1", "y1", "x2", "y2"))},
            "conf": F.coalesce(d["conf"], d["confidence"], F.lit(0.0)),
            "rank": F.coalesce(d["rank"], F.lit("U")),
            "rank_conf": F.coalesce(d["rank_conf"], F.lit(0.0)),
            "suit": F.coalesce(d["suit"], F.lit("U")),
            "suit_conf": F.coalesce(d["suit_conf"], F.lit(0.0)),
            "match_type": F.coalesce(d["match_type"], F.when(d["rank"].isNotNull(), "matched").otherwise("unmatched")),
        }
    )


def flatten_segment_map(df: DataFrame, raw: str = "raw") -> DataFrame:
    """Rows (video, seq, start_frame, end_frame, label, seg_id) of {video: [segment]} JSON; '.txt' goes from the keys."""
    kind = "map<string,array<struct<start_frame:int,end_frame:int,label:string,seg_id:bigint>>>"
    rows = df.select(F.explode(F.from_json(raw, kind)).alias("video", "items")).select("video", F.posexplode("items").alias("seq", "s"))
    return rows.select(F.regexp_replace("video", r"\.txt$", "").alias("video"), "seq", "s.*")


def flatten_predictions(df: DataFrame, label: str, min_score: float, raw: str = "raw") -> DataFrame:
    """Rows of {video: {detections: [...]}} JSON with the label and at least min_score."""
    kind = "map<string,struct<detections:array<struct<label:string,score:double,start_frame:int,end_frame:int,seg_id:bigint>>>>"
    rows = df.select(F.explode(F.from_json(raw, kind)).alias("video", "p")).select("video", F.explode("p.detections").alias("d")).select("video", "d.*")
    return rows.where((F.col("label") == label) & (F.col("score") >= min_score))


def format_labels(df: DataFrame, values: list[str], cls: str = "class_id") -> DataFrame:
    """Adds `line`: the class and the values with six decimals, parted by spaces."""
    return df.withColumn("line", F.concat_ws(" ", F.col(cls).cast("string"), *[F.format_string("%.6f", F.col(v).cast("double")) for v in values]))


def parse_labels(df: DataFrame, kind: str, line: str = "value") -> DataFrame:
    """Adds class_id and numbers from label lines; lines with another number of tokens have no row."""
    tokens = F.split(F.trim(line), r"\s+")
    rows = df.withColumn("__t", tokens).where(F.size("__t") == LABEL_TOKENS[kind])
    return rows.withColumns({"class_id": F.col("__t")[0].cast("int"), "numbers": F.transform(F.slice("__t", 2, LABEL_TOKENS[kind] - 1), lambda x: x.cast("double"))}).drop("__t")


def read_labels(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """Label files under a path, with each line's file name."""
    return parse_labels(spark.read.text(path).withColumn("file_name", F.col("_metadata.file_name")), kind)


def build_annotation_records(videos: DataFrame, segs: DataFrame, boxes: DataFrame) -> DataFrame:
    """One nested record per video (round_id), also for videos without segments: timeline_segments in order of start, each with the boxes whose anchor_frame it holds.

    Segments and videos are one table that meets the boxes by video alone and is grouped where it lies, so what is nested is never shuffled. Rows of one seg_id share their
    boxes; one without has none.
    """
    row = F.struct(F.monotonically_increasing_id().alias("n"), "start_frame", "end_frame", "label")  # n keeps equal rows apart
    segs = segs.where("round_id is not null").select("round_id", "seg_id", row.alias("__row"))
    rows = segs.unionByName(videos.select("round_id"), allowMissingColumns=True)  # a video is a row of its own, without __row
    box = F.struct(F.col("anchor_frame").alias("frame"), F.col("box_id").alias("id"), "x1", "y1", "x2", "y2")
    held = (F.col("s.round_id") == F.col("b.round_id")) & F.col("anchor_frame").between(F.col("__row.start_frame"), F.col("__row.end_frame")) & F.col("seg_id").isNotNull()
    rows = rows.alias("s").join(boxes.select("round_id", "anchor_frame", box.alias("__box")).alias("b"), held, "left")
    own = rows.groupBy("s.round_id", "seg_id").agg(F.collect_set("__row").alias("__rows"), F.array_sort(F.collect_list("__box")).alias("__boxes"), F.bool_or(F.col("__row").isNull()).alias("__video"))
    boxed = F.when(F.size("__boxes") > 0, F.col("__boxes")).alias("bounding_boxes")
    item = lambda r: F.struct(r["start_frame"].alias("start_frame"), F.col("seg_id").alias("id"), r["end_frame"].alias("end_frame"), F.array(r["label"]).alias("labels"), (r["end_frame"] - r["start_frame"] + 1).alias("duration_frames"), boxed)
    out = own.groupBy("round_id").agg(F.array_sort(F.flatten(F.collect_list(F.transform("__rows", item)))).alias("__line"), F.bool_or("__video").alias("__video")).where("__video")
    return out.select("round_id", F.when(F.size("__line") > 0, F.col("__line")).alias("timeline_segments"))


def flatten_annotation_records(records: DataFrame) -> DataFrame:
    """Segments that have boxes, with the first box."""
    rows = records.select("round_id", F.explode("timeline_segments").alias("s")).where(F.size("s.bounding_boxes") > 0)
    first = F.element_at("s.bounding_boxes", 1)
    return rows.select("round_id", F.col("s.id").alias("seg_id"), "s.start_frame", "s.end_frame", F.element_at("s.labels", 1).alias("label"), "s.duration_frames", F.size("s.bounding_boxes").alias("n_boxes"), first["frame"].alias("frame"), first["id"].alias("box_id"), *[first[x].alias(x) for x in ("x1", "y1", "x2", "y2")])


def build_pair_records(segs: DataFrame, pairs: DataFrame) -> DataFrame:
    """One nested record per video (round_id) of the segments (round_id, seg_id, start_frame, end_frame): one box, with a keyframe per pair of cards.

    pairs: round_id, seg_id, frame_id and a_, b_ det_id, rank, suit, cx, cy.
    """
    card = lambda p: F.struct(*[F.col(f"{p}_{n}").alias(n) for n in ("det_id", "rank", "suit", "cx", "cy")])
    key = F.struct(F.col("frame_id").alias("frame"), F.array(card("a"), card("b")).alias("cards"))
    own = pairs.groupBy("round_id", "seg_id").agg(F.array_sort(F.collect_list(key)).alias("keyframes"))
    rows = segs.join(own, ["round_id", "seg_id"], "left")
    boxes = F.when(F.col("keyframes").isNotNull(), F.array(F.struct("keyframes")))
    item = F.struct("start_frame", F.col("seg_id").alias("id"), "end_frame", boxes.alias("bounding_boxes"))
    return rows.groupBy("round_id").agg(F.array_sort(F.collect_list(item)).alias("timeline_segments"))


def flatten_pair_records(records: DataFrame) -> DataFrame:
    """Segments whose first box has two keyframes or more: both cards at the first and at the last of them."""
    rows = records.select("round_id", F.explode("timeline_segments").alias("s")).where(F.size("s.bounding_boxes") > 0)
    rows = rows.withColumn("k", F.element_at("s.bounding_boxes", 1)["keyframes"]).where(F.size("k") >= 2)
    first, last = F.element_at("k", 1), F.element_at("k", -1)
    cards = [F.get(x["cards"], F.lit(i))[n].alias(f"{side}{i}_{n}") for side, x in (("s", first), ("e", last)) for i in (0, 1) for n in ("det_id", "suit")]
    return rows.select("round_id", F.col("s.id").alias("seg_id"), "s.start_frame", "s.end_frame", F.size("k").alias("n_keyframes"), F.get(first["cards"], F.lit(0))["rank"].alias("pair_rank"), first["frame"].alias("start_det_frame"), last["frame"].alias("end_det_frame"), *cards)


def skip_done(df: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    """The rows whose output doesn't exist yet."""
    return df.join(done.select(*keys).distinct(), keys, "left_anti")


def count_done(df: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    """One row: n_skipped, the rows of df that skip_done leaves out, and n_left."""
    rows = df.select(*keys).join(done.select(*keys).distinct().withColumn("__done", F.lit(True)), keys, "left")
    return rows.agg(F.count_if("__done").alias("n_skipped"), F.count_if(F.col("__done").isNull()).alias("n_left"))


def build_upload_payload(dets: DataFrame, tasks: DataFrame, threshold: float = 0.9) -> DataFrame:
    """Rows above the threshold with their task's id and a JSON payload; rows without a task have status 'unmapped'."""
    rows = dets.where(F.col("score") > threshold).join(tasks, "video", "left")
    body = F.to_json(F.struct(F.col("task_id").alias("task"), "label", F.col("start_frame").alias("start"), F.col("end_frame").alias("end")))
    return rows.withColumns({"payload": F.when(F.col("task_id").isNotNull(), body), "status": F.when(F.col("task_id").isNull(), "unmapped").otherwise("ready")})
