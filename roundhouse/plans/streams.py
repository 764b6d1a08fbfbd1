"""Queries that run as streams over given tables and end."""

from __future__ import annotations

from pyspark.sql import functions as F

from roundhouse.operators.sequences import dedup_spatial
from roundhouse.plans.registry import query
from roundhouse.storage import scratch_folder, stored
from roundhouse.streaming import incremental, timed_tracker, tracker


@query("incremental_rounds", "SELECT round_id, label, count(*) AS n FROM {segments} GROUP BY ALL")
def _(t):
    """Segments arrive in two lots; each run counts what is new, and a third run finds nothing."""
    base = scratch_folder(t.spark, "stream")
    segs = t.segments
    for lot in (0, 1):
        segs.where((F.col("start_frame") >= 300) == bool(lot)).write.mode("append").parquet(f"{base}/in")
        incremental.process_new(t.spark, f"{base}/in", segs.schema, f"{base}/out", f"{base}/checkpoint", incremental.count_labels)
    incremental.process_new(t.spark, f"{base}/in", segs.schema, f"{base}/out", f"{base}/checkpoint", incremental.count_labels)
    return incremental.processed(t.spark, f"{base}/out").groupBy("round_id", "label").agg(F.sum("n").alias("n"))


@query("stream_tracker")
def _(t):
    """Detections arrive in three lots of frames and an end row per round; the rows are the closed tracks. Its batch twin is track_items."""
    base = scratch_folder(t.spark, "stream")
    rows = stored(dedup_spatial(t.dets720).select("round_id", "frame_id", "det_id", "cx", "cy", "conf"), "stream-source")  # read by each lot
    ends = rows.select("round_id").distinct().select("round_id", *[F.lit(None).cast(x.dataType).alias(x.name) for x in rows.schema if x.name != "round_id"])
    for lot in (rows.where("frame_id < 200"), rows.where("frame_id between 200 and 399"), rows.where("frame_id >= 400"), ends):
        lot.write.mode("append").parquet(f"{base}/in")
        stream = t.spark.readStream.schema(rows.schema).parquet(f"{base}/in")
        closed = tracker.track_stream(stream, least_obs=5)
        closed.writeStream.format("parquet").option("path", f"{base}/out").option("checkpointLocation", f"{base}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    return t.spark.read.parquet(f"{base}/out").select("round_id", "first_frame", "last_frame", F.col("n_obs").cast("long").alias("n_obs"))


#: The lot in which a detection arrives: by thirds of its round's frames, but every fiftieth detection of the first two comes with the last, too late.
LOT = "CASE WHEN frame_id >= 400 OR det_id % 50 = 0 THEN 2 WHEN frame_id >= 200 THEN 1 ELSE 0 END"


@query("stream_tracker_timers")
def _(t):
    """Detections arrive in three lots, some late. Nothing says that a round has ended: a row of no round moves the clock, and timers close all. Rows of kind track and late."""
    base = scratch_folder(t.spark, "stream")
    timed_tracker.use_rocksdb(t.spark)
    rows = stored(dedup_spatial(t.dets720).select("round_id", "frame_id", "det_id", "cx", "cy", "conf"), "stream-source").withColumn("lot", F.expr(LOT))  # read by each lot
    rows = rows.withColumn("seen_at", F.timestamp_seconds(F.lit(1_700_000_000) + 10 * F.col("lot")))
    clock = t.spark.range(1).select(*[(F.timestamp_seconds(F.lit(1_700_001_000)) if c == "seen_at" else F.lit(None).cast(rows.schema[c].dataType)).alias(c) for c in rows.columns])
    for lot in (*(rows.where(F.col("lot") == k) for k in range(3)), clock):
        lot.drop("lot").write.mode("append").parquet(f"{base}/in")
        stream = t.spark.readStream.schema(rows.drop("lot").schema).parquet(f"{base}/in")
        out = timed_tracker.track_timed(stream, least_obs=5)
        out.writeStream.format("parquet").option("path", f"{base}/out").option("checkpointLocation", f"{base}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    return t.spark.read.parquet(f"{base}/out").select("round_id", "kind", "det_id", "first_frame", "last_frame", F.col("n_obs").cast("long").alias("n_obs"))
