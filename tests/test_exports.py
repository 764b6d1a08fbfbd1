"""Raw exports read as VARIANT, and the data source of records."""

import json
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from roundhouse.sources import exports, records

RECTANGLES = [
    {"type": "videorectangle", "id": "b1", "value": {"labels": "card", "sequence": [{"frame": 4, "x": 10, "y": 20, "width": 5, "height": 5}, {"x": 11}]}},
    {"type": "videorectangle", "id": "b2", "value": {"sequence": []}},
    {"type": "videorectangle", "id": "b3", "value": {"sequence": [{"frame": 99}]}},
]
RANGES = {"type": "timelinelabels", "id": "q", "value": {"ranges": [{"start": 4, "end": "9"}, {"start": 2, "end": 4}, {"start": None, "end": 4}], "timelinelabels": ["hit"]}, "meta": {"text": "12"}}
CANCELLED = {"was_cancelled": True, "result": [{"type": "timelinelabels", "id": "z", "value": {"ranges": [{"start": 1, "end": 3}], "timelinelabels": ["x"]}, "meta": {"text": ["a", "b"]}}, 5, None]}
TASKS = [
    {"id": 1, "file_upload": "a.mp4", "annotations": [CANCELLED, {"result": [*RECTANGLES, RANGES]}]},
    {"id": "k", "file_upload": "", "data": {"video": "/d/e/b.mp4"}},
    {"annotations": "none", "data": 7},
]


def segment(row):
    return tuple(row[c] for c in ("video_name", "video_id", "ann_no", "id", "start_frame", "end_frame", "labels", "meta_text", "duration_frames", "n_boxes", "n_keyframes"))


def test_export_of_many_shapes(spark):
    base = tempfile.mkdtemp()
    with open(f"{base}/lines.json", "w") as f:
        f.write("\n".join(map(json.dumps, TASKS)) + "\n{bad\n\n")
    os.mkdir(f"{base}/whole")
    with open(f"{base}/whole/list.json", "w") as f:
        json.dump(TASKS, f, indent=1)
    want = [
        ("a.mp4", "1", 0, "z", 1, 3, ["x"], ["a", "b"], 2, 0, None),
        ("a.mp4", "1", 1, "q", 2, 4, ["hit"], ["12"], 2, 1, 2),
        ("a.mp4", "1", 1, "q", 4, 9, ["hit"], ["12"], 5, 1, 2),
    ]
    for path, lines in ((f"{base}/lines.json", True), (f"{base}/whole", False)):
        tasks = exports.read_export(spark, path, lines)
        found = exports.export_records(tasks)
        assert sorted(map(tuple, found.select("video_name", "video_id", "video_path", "n_unmatched").collect())) == sorted([("a.mp4", "1", "", 1), ("b.mp4", "k", "/d/e/b.mp4", 0), (f"video_{0 if lines else 2}", "", "", 0)])
        assert [segment(r) for r in exports.record_segments(found).collect()] == want
        kept = exports.record_segments(exports.export_records(tasks, skip_cancelled=True))
        assert [segment(r) for r in kept.collect()] == want[1:]
        first = kept.select("keyframes", *[c.alias(n) for n, c in exports.pixel_box(F.get("keyframes", F.lit(0)), 1000, 500).items()]).first()
        assert (first["x1"], first["y1"], first["x2"], first["y2"]) == (100, 100, 150, 125) and tuple(first["keyframes"][1]) == (0, 11.0, 0, 0, 0, 0, 0)
    assert tasks.where("task is null").count() == 0 and exports.read_export(spark, f"{base}/lines.json").where("task is null").count() == 1


def slow_detection(d):
    pc = d.get("polygon_center", [0, 0])
    pc = pc[0] if pc and isinstance(pc[0], list) else pc
    box = d.get("bbox", d.get("box", [0, 0, 0, 0]))
    told = "rank+suit" if d.get("rank") else "unknown"
    c = d.get("confidence", 0)
    return (*map(float, pc), *[int(round(v)) for v in box], float(d.get("confidence", d.get("conf", 0))), d.get("rank", "U"), float(d.get("rank_conf", c)), d.get("suit", "U"), float(d.get("suit_conf", c)), d.get("match_type", told))


def test_chunks_of_either_spelling(spark):
    frames = [
        {"detections": [{"bbox": [1.5, 2.5, 3, 4], "confidence": 0.5, "polygon_center": [[7, 8], [9, 9]], "rank": "K"}, {"box": [1, 2, 3, 4], "conf": 0.5, "polygon_center": [7.25, 8], "rank": ""}]},
        {}, {"detections": [{}, {"rank_conf": 0.25, "confidence": 1, "suit": "H", "box": [0, 0, 9, 9], "bbox": [1, 1, 2, 2], "match_type": "m", "conf": 0.1}]},
    ]
    raw = [(1, json.dumps(frames)), (2, "{"), (3, None), (4, '[{"detections":[5,null,[1]]},7,null]')]
    got = exports.chunk_detections(spark.createDataFrame(raw, "chunk long, raw string")).collect()
    want = [(1, p, k, *slow_detection(d)) for p, f in enumerate(frames) for k, d in enumerate(f.get("detections", []))]
    assert sorted(map(tuple, got)) == want


@pytest.fixture
def store(spark):
    records.use_records(spark)
    return tempfile.mkdtemp()


def on_disk(path):
    return sorted(os.path.join(a, x) for a, _, files in os.walk(path) for x in files)


def test_records_are_replaced_whole(spark, store):
    put = lambda rows, mode="append": spark.createDataFrame(rows, "video_name string, record string").repartition(3).write.format("annotation_records").mode(mode).save(store)
    read = lambda: sorted(map(tuple, spark.read.format("annotation_records").load(store).collect()))
    assert read() == []
    rows = [(f"v{i}", json.dumps({"n": i})) for i in range(200)] + [("a/b ü?", "{}"), (None, "{}"), ("null", None)]
    put(rows)
    written = sorted(x for x in rows if None not in x)
    assert read() == written and len(on_disk(store)) == 201
    put([("v7", '{"n":"new"}')])
    put([("v7", '{"n":"new"}')])  # a rerun
    written = sorted([x for x in written if x[0] != "v7"] + [("v7", '{"n":"new"}')])
    assert read() == written
    before = {x: os.stat(x).st_mtime_ns for x in on_disk(store)}
    broken = spark.createDataFrame([(f"v{i}", "1") for i in range(50)], "video_name string, record string").repartition(4)
    broken = broken.withColumn("record", F.when(F.col("video_name") == "v49", F.raise_error(F.lit("stop"))).otherwise(F.col("record")))
    with pytest.raises(Exception, match="stop"):
        broken.write.format("annotation_records").mode("append").save(store)
    assert read() == written and {x: os.stat(x).st_mtime_ns for x in on_disk(store)} == before  # nothing changed and nothing is left behind
    put(rows[:5], "overwrite")
    assert read() == sorted(rows[:5]) and len(on_disk(store)) == 5


def test_filters_prune_files(spark, store):
    spark.createDataFrame([(f"v{i}", "{}") for i in range(100)], "video_name string, record string").write.format("annotation_records").mode("append").save(store)
    all_of = spark.read.format("annotation_records").load(store)
    for one in on_disk(store):
        if not one.endswith(("/v3_annotations.json", "/v5_annotations.json")):
            with open(one, "wb") as f:
                f.write(b"\xff")  # whoever reads it fails
    assert [tuple(r) for r in all_of.where("video_name = 'v3'").collect()] == [("v3", "{}")]
    assert sorted(r[0] for r in all_of.where("video_name in ('v3', 'v5', 'none')").where("record = '{}'").collect()) == ["v3", "v5"]
    assert all_of.where("video_name = 'none'").count() == 0
    assert records.RecordReader(store).partitions().__len__() == records.FOLDERS
