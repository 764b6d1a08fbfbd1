"""The streams against their batch twins."""

import datetime
import random
import tempfile

from pyspark.sql import functions as F

from roundhouse.operators.sequences import track_items
from roundhouse.streaming import incremental, timed_tracker, tracker


def test_incremental_is_idempotent(spark):
    base = tempfile.mkdtemp()
    df = spark.createDataFrame([(i % 3, "hit") for i in range(30)], "round_id long, label string")
    for lot in (df.limit(10), df.limit(5)):
        lot.write.mode("append").parquet(f"{base}/in")
        for _ in range(2):
            incremental.process_new(spark, f"{base}/in", df.schema, f"{base}/out", f"{base}/cp", incremental.count_labels)
    assert incremental.processed(spark, f"{base}/out").agg(F.sum("n")).first()[0] == 15


def test_stream_tracker_matches_batch(spark):
    base, rnd = tempfile.mkdtemp(), random.Random(7)
    data = [(r, 10 * f, f * 9 + k, 80.0 * k + rnd.randrange(15), 50.0 + rnd.randrange(15), round(rnd.random(), 3)) for r in (1, 2) for f in range(24) for k in range(3) if rnd.random() < 0.8]
    kind = "round_id long, frame_id int, det_id long, cx double, cy double, conf double"
    df = spark.createDataFrame(data, kind).coalesce(1)
    lots = ["frame_id < 80", "frame_id between 80 and 150", "frame_id > 150", "frame_id = 10"]  # the last lot is late
    for lot in lots:
        df.where(lot).coalesce(1).write.mode("append").parquet(f"{base}/in")
        stream = spark.readStream.schema(df.schema).parquet(f"{base}/in")
        out = tracker.track_stream(stream, least_obs=5, least_span=50)
        out.writeStream.format("parquet").option("path", f"{base}/out").option("checkpointLocation", f"{base}/cp").trigger(availableNow=True).start().awaitTermination()
    # a row without det_id ends its round and closes what is live
    spark.createDataFrame([(r, 0, None, None, None, None) for r in (1, 2)], kind).coalesce(1).write.mode("append").parquet(f"{base}/in")
    stream = spark.readStream.schema(df.schema).parquet(f"{base}/in")
    tracker.track_stream(stream, least_obs=5, least_span=50).writeStream.format("parquet").option("path", f"{base}/out").option("checkpointLocation", f"{base}/cp").trigger(availableNow=True).start().awaitTermination()
    got = spark.read.parquet(f"{base}/out")
    batch = track_items(df.withColumns({"rank": F.lit("8"), "suit": F.lit("H")}), least_obs=5, least_span=50)
    want = batch.groupBy("round_id", "track_id").agg(F.min("frame_id").alias("a"), F.max("frame_id").alias("z"), F.count("*").alias("n")).select("round_id", "a", "z", "n")
    assert sorted(map(tuple, got.select("round_id", "first_frame", "last_frame", "n_obs").collect())) == sorted(map(tuple, want.collect()))
    assert got.agg(F.max("late_rows")).first()[0] > 0


KIND = "round_id long, frame_id int, det_id long, cx double, cy double, conf double, seen_at timestamp"


def run_timed(spark, base, **how):
    stream = spark.readStream.schema(KIND).parquet(f"{base}/in")
    out = timed_tracker.track_timed(stream, least_obs=3, least_span=20, **how)
    out.writeStream.format("parquet").option("path", f"{base}/out").option("checkpointLocation", f"{base}/cp").trigger(availableNow=True).start().awaitTermination()
    return sorted((tuple(r) for r in spark.read.schema(timed_tracker.OUT).parquet(f"{base}/out").collect()), key=repr)


def test_silent_rounds_close_by_timer(spark):
    base = tempfile.mkdtemp()
    timed_tracker.use_rocksdb(spark)

    def arrive(rows, second):
        at = datetime.datetime(2025, 1, 1, tzinfo=datetime.timezone.utc) + datetime.timedelta(seconds=second)
        spark.createDataFrame([(*r, at) for r in rows], KIND).coalesce(1).write.mode("append").parquet(f"{base}/in")

    walk = lambda r, frames, x=10.0: [(r, f, 1000 * r + f, x, 20.0, 0.9) for f in frames]
    arrive(walk(1, range(0, 50, 10)) + walk(2, range(0, 50, 10)), 0)
    assert run_timed(spark, base) == []
    arrive(walk(2, range(50, 80, 10)) + walk(1, [20, 30]), 30)  # two rows of round 1 come late, and no track closes
    late = [(1, "late", None, 1020, 20, 20, 1), (1, "late", None, 1030, 30, 30, 1)]
    assert run_timed(spark, base) == late
    arrive(walk(2, [80]), 95)  # 65 seconds after the last row of round 1: its timer fires without a row of it
    first = [(1, "track", 0, None, 0, 40, 5)]
    assert run_timed(spark, base) == sorted(late + first, key=repr)
    assert run_timed(spark, base) == sorted(late + first, key=repr)  # a restart without new rows repeats nothing
    arrive(walk(1, [40]) + walk(2, [90]), 100)  # a closed round is still known: its frame is late
    again = [(1, "late", None, 1040, 40, 40, 1)]
    assert run_timed(spark, base) == sorted(late + first + again, key=repr)
    arrive([(None, None, None, None, None, None)], 500)  # a row of no round closes the rest
    assert run_timed(spark, base) == sorted([*late, *first, *again, (2, "track", 0, None, 0, 90, 10)], key=repr)
    done = [*late, *first, *again, (2, "track", 0, None, 0, 90, 10)]
    for rows, second in (([(None,) * 6], 50_000), (walk(1, range(0, 30, 10)), 50_001), ([(None,) * 6], 60_000)):  # a round that is forgotten begins again
        arrive(rows, second)
        got = run_timed(spark, base)
    assert got == sorted([*done, (1, "track", 0, None, 0, 20, 3)], key=repr)
