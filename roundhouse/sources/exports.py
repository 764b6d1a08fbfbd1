"""Raw exports of annotation tools and raw detection chunks, whose shape varies, read as VARIANT.

A field may be absent, of another type or spelled in another way; what can't be read is null and harms nothing else. An
annotation's ranges and rectangles stay in its row: they are matched there, without a join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ITEMS = "array<variant>"


def field(value: Column, path: str, kind: str = "string") -> Column:
    return F.try_variant_get(value, f"$.{path}", kind)


def listed(value: Column, path: str) -> Column:
    """The items at a path; none if there is no list."""
    return F.coalesce(field(value, path, ITEMS), F.array().cast(ITEMS))


def texts(value: Column, path: str) -> Column:
    """A list of texts, also where a single text stands for one; none if there is nothing."""
    return F.coalesce(field(value, path, "array<string>"), F.filter(F.array(field(value, path)), lambda x: x.isNotNull()))


def read_export(spark: SparkSession, path: str, lines: bool = True) -> DataFrame:
    """Tasks of the JSON files under a path: file_name, place (in its line or file) and task (VARIANT; null where the text is no JSON).

    A line holds a task or a list of tasks; with lines=False a whole file does, and is one task's work.
    """
    read = F.try_parse_json("value")
    rows = spark.read.text(path, wholetext=not lines).where("trim(value) <> ''").select(F.col("_metadata.file_name").alias("file_name"), read.alias("v"))
    tasks = F.coalesce(F.try_variant_get("v", "$", ITEMS), F.array("v"))
    # outer: else Spark filters by the list's size first, and parses each text again for that
    return rows.select("file_name", F.posexplode_outer(tasks).alias("place", "task")).where("place is not null")


def video_name(task: Column, place: Column) -> Column:
    """The uploaded file's name, else that of the video's path, else video_ and the place."""
    path = F.nullif(field(task, "data.video"), F.lit(""))
    return F.coalesce(F.nullif(field(task, "file_upload"), F.lit("")), F.regexp_extract(path, "[^/]*$", 0), F.concat(F.lit("video_"), place))


def _keyframe(k: Column) -> Column:
    number = lambda name: F.coalesce(field(k, name, "double"), F.lit(0.0)).alias(name)
    return F.struct(F.coalesce(field(k, "frame", "int"), F.lit(0)).alias("frame"), *map(number, ("x", "y", "width", "height", "time", "rotation")))


def rectangles(annotation: Column) -> Column:
    """An annotation's rectangles that have a first keyframe with a frame: that frame, labels, keyframes (in percent of the picture) and id."""
    of_kind = F.filter(listed(annotation, "result"), lambda i: field(i, "type") == "videorectangle")
    box = lambda i: F.struct(field(i, "value.sequence[0].frame", "int").alias("frame"), texts(i, "value.labels").alias("labels"), F.transform(listed(i, "value.sequence"), _keyframe).alias("keyframes"), F.coalesce(field(i, "id"), F.lit("")).alias("id"))
    return F.filter(F.transform(of_kind, box), lambda b: b["frame"].isNotNull())


def bound(value: Column, f) -> Column:
    """f(value), with value computed once, however often f's lambdas read it."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def timeline(annotation: Column, number: Column) -> Column:
    """An annotation's ranges as segments in order of start (equal starts: as they came), each with all rectangles whose first frame it covers; and n_lost, the rectangles that none covers."""
    of_kind = F.filter(listed(annotation, "result"), lambda i: field(i, "type") == "timelinelabels")

    def segments(item: Column, place: Column) -> Column:
        labels, meta, name = texts(item, "value.timelinelabels").alias("labels"), texts(item, "meta.text").alias("meta_text"), F.coalesce(field(item, "id"), F.lit("")).alias("id")

        def segment(r: Column, k: Column) -> Column:
            start, end = field(r, "start", "int"), field(r, "end", "int")
            return F.struct(number.alias("ann_no"), start.alias("start_frame"), place.alias("item_no"), k.alias("range_no"), end.alias("end_frame"), labels, meta, (end - start).alias("duration_frames"), name)

        return F.filter(F.transform(listed(item, "value.ranges"), segment), lambda s: s["start_frame"].isNotNull() & s["end_frame"].isNotNull())

    key = lambda s: F.struct(s["start_frame"], s["item_no"], s["range_no"])
    in_order = F.array_sort(F.flatten(F.transform(of_kind, segments)), lambda a, b: F.when(key(a) < key(b), -1).when(key(a) > key(b), 1).otherwise(0))
    inside = lambda b, s: b["frame"].between(s["start_frame"], s["end_frame"])
    matched = lambda found, boxes: F.transform(found, lambda s: s.withField("bounding_boxes", F.filter(boxes, lambda b: inside(b, s))))
    lost = lambda found, boxes: F.size(F.filter(boxes, lambda b: ~F.exists(found, lambda s: inside(b, s))))
    return bound(rectangles(annotation), lambda boxes: bound(in_order, lambda found: F.struct(matched(found, boxes).alias("segments"), lost(found, boxes).alias("n_lost"))))


def export_records(tasks: DataFrame, skip_cancelled: bool = False) -> DataFrame:
    """One record per task: video_name, video_id, video_path, timeline_segments of all its annotations one after another, and n_unmatched rectangles.

    Cancelled annotations count unless skip_cancelled. Tasks that are no JSON have no record.
    """
    rows = tasks.where("task is not null").withColumn("anns", F.transform(listed(F.col("task"), "annotations"), lambda a, i: F.struct(a.alias("a"), i.alias("i"))))
    if skip_cancelled:
        rows = rows.withColumn("anns", F.filter("anns", lambda x: ~F.coalesce(field(x["a"], "was_cancelled", "boolean"), F.lit(False))))
    rows = rows.withColumn("found", F.transform("anns", lambda x: timeline(x["a"], x["i"])))
    text = lambda path: F.coalesce(field(F.col("task"), path), F.lit(""))
    names = [video_name(F.col("task"), F.col("place")).alias("video_name"), text("id").alias("video_id"), text("data.video").alias("video_path")]
    return rows.select(*names, F.flatten("found.segments").alias("timeline_segments"), F.aggregate("found.n_lost", F.lit(0), lambda n, x: n + x).alias("n_unmatched"))


def record_segments(records: DataFrame) -> DataFrame:
    """One row per segment of records, with its number of boxes, and the keyframes of the first."""
    rows = records.select("video_name", "video_id", F.explode_outer("timeline_segments").alias("s")).where("s is not null")  # outer: as in read_export
    first = F.get("s.bounding_boxes", F.lit(0))
    return rows.select("video_name", "video_id", "s.*", F.size("s.bounding_boxes").alias("n_boxes"), F.when(first.isNotNull(), F.size(first["keyframes"])).alias("n_keyframes"), first["keyframes"].alias("keyframes"))


def pixel_box(keyframe: Column, w: float, h: float) -> dict[str, Column]:
    """A keyframe's box in pixels of a picture of that size, to the nearest pixel."""
    px = lambda v, size: F.floor(v / 100.0 * size + 0.5).cast("int")
    k = keyframe
    return {"x1": px(k["x"], w), "y1": px(k["y"], h), "x2": px(k["x"] + k["width"], w), "y2": px(k["y"] + k["height"], h)}


def chunk_detections(chunks: DataFrame, raw: str = "raw") -> DataFrame:
    """Detections of raw chunks (a JSON list of frames, each with its detections) in one shape: chunks' other columns, pos (the frame's place), det_no and the fields.

    Either spelling of box and confidence is read, the other one where both are there as stated first: bbox, confidence. A centre is a point or a list of points. Absent: box
    and centre are zeros, rank and suit U, rank_conf and suit_conf the value of `confidence`, match_type follows from a rank that isn't empty. A chunk or detection that is no
    JSON of that shape has no row.
    """
    keep = [c for c in chunks.columns if c != raw]
    frames = chunks.select(*keep, F.posexplode(F.try_variant_get(F.try_parse_json(raw), "$", ITEMS)).alias("pos", "frame"))
    rows = frames.select(*keep, "pos", F.posexplode(listed(F.col("frame"), "detections")).alias("det_no", "d"))
    d = F.col("d")
    number = lambda *paths: F.coalesce(*[field(d, p, "double") for p in paths], F.lit(0.0))
    given = lambda name: field(d, name, "variant").isNotNull()
    centre = lambda k: F.when(~given("polygon_center"), 0.0).otherwise(F.coalesce(field(d, f"polygon_center[0][{k}]", "double"), field(d, f"polygon_center[{k}]", "double")))
    corner = lambda k: F.bround(F.when(given("bbox"), field(d, f"bbox[{k}]", "double")).when(given("box"), field(d, f"box[{k}]", "double")).otherwise(0.0)).cast("int")
    kind = F.when(F.coalesce(field(d, "rank"), F.lit("")) != "", "rank+suit").otherwise("unknown")
    return rows.where(F.schema_of_variant("d").startswith("OBJECT")).select(
        *keep, "pos", "det_no", centre(0).alias("cx"), centre(1).alias("cy"), *[corner(k).alias(n) for k, n in enumerate(("x1", "y1", "x2", "y2"))],
        number("confidence", "conf").alias("conf"), F.coalesce(field(d, "rank"), F.lit("U")).alias("rank"), number("rank_conf", "confidence").alias("rank_conf"),
        F.coalesce(field(d, "suit"), F.lit("U")).alias("suit"), number("suit_conf", "confidence").alias("suit_conf"), F.coalesce(field(d, "match_type"), kind).alias("match_type"),
    )
