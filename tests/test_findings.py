"""Cases of the reviewer's findings: what a plan must not do, and rows that a query left out."""

import math
import os
import random

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

from roundhouse.functions import geometry as g
from roundhouse.operators import aggregates, datasets, joins, scalar, sequences, similarity
from roundhouse.plans import catalog, exports as export_plans, fixtures, scans, streams
from roundhouse.plans.fixtures import GIVEN, TABLES, Inputs
from roundhouse.sources import annotations, exports, records
from roundhouse.storage import stored
from roundhouse.streaming import tracker

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_asof_offset_joins_nothing(spark):
    """A join of the tries with the frames, and of the winners with the rows, was broadcast by its files' size and filled the driver."""
    rnd = random.Random(3)
    seg = [(rnd.choice([1, 2, 3, None]), k, rnd.choice([None, *range(-20, 60)])) for k in range(300)]
    fr = [(rnd.choice([1, 2]), rnd.randrange(-20, 60, 3)) for _ in range(30)]
    left, frames = spark.createDataFrame(seg, "round_id long, seg_id long, at int"), spark.createDataFrame(fr, "round_id long, frame_id int")
    for bucket in (4, 4096):  # narrow buckets: frames reach over several
        out = joins.asof_offset(left, frames, "at", 9, bucket=bucket)
        assert "Join" not in plan(out)
        want = {k: min((f for r2, f in fr if r2 == r and at is not None and abs(f - at) <= 9), key=lambda f: (abs(f - at), f < at), default=None) for r, k, at in seg}
        assert {r["seg_id"]: r["asof_frame"] for r in out.collect()} == want


def twin(con, name, folder):
    for table in GIVEN:
        con.execute(f"CREATE OR REPLACE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    found = con.execute(catalog.ORACLE_SQL[name])
    return [x[0] for x in found.description], found.fetchall()


def test_bins_of_units_without_frames(spark, tmp_path):
    """A last video of six frames: two of its units have no frame and an empty vector, as in the SQL twin."""
    for table in GIVEN:
        if table != "embeddings":
            os.symlink(f"{SF}/{table}.parquet", tmp_path / f"{table}.parquet")
    con = duckdb.connect()
    con.execute(f"COPY (SELECT vec_id, embedding, label FROM (SELECT *, row_number() OVER (ORDER BY vec_id) - 1 AS n FROM '{SF}/embeddings.parquet') WHERE n < 56) TO '{tmp_path}/embeddings.parquet' (FORMAT parquet)")
    columns, want = twin(con, "temporal_bin_features", tmp_path)
    got = catalog.QUERIES["temporal_bin_features"](spark, str(tmp_path)).select(*columns).collect()
    assert sorted(map(tuple, got)) == sorted(want) and sum(not r["vec"] for r in got) == 2


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_pairs_are_followed_without_a_call_per_pair(spark, monkeypatch):
    """A pandas frame per pair took most of the time. Pairs that go on over batches are whole, and batches that go back are cut."""
    monkeypatch.setattr(sequences, "PAIRS_OUT", 3)
    cards = [(1, f, 2 * f + k, 100.0 + 30 * k + f * k, 500.0, "HS"[k], "8") for f in range(40) for k in range(2)]
    dets = spark.createDataFrame(cards, "round_id long, frame_id int, det_id long, cx double, cy double, suit string, rank string")
    pairs = [(1, s, 1, "8", s, 39, 100.0, 500.0, 130.0 + s, 500.0, "H", "S") for s in range(36)]
    kind = "round_id long, seg_id long, pair_no int, pair_rank string, start_frame int, last_frame int, s_ax double, s_ay double, s_bx double, s_by double, s_asuit string, s_bsuit string"
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        out = sequences.track_pair(spark.createDataFrame(pairs, kind), dets)
        assert "FlatMapGroups" not in physical(out)
        got = {r["seg_id"]: (r["n"], r["spread"], r["end_frame"], r["end_a"], r["end_b"], r["max_distance"]) for r in out.collect()}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert got == {s: (40 - s, 35 - s, 39, 78, 79, 69.0) for s in range(36)}


def test_pairs_of_rounds_that_lie_together_are_not_shuffled(spark):
    """Each card was sent five times and once more to its cell; what is dealt by round stays where it is."""
    cards = [(r, f, k, 3.0 * k, 500.0 + k % 7, 3 * k - 40, 400, 3 * k + 40, 600, "H", "8") for r in range(3) for f in range(4) for k in range(30)]
    df = spark.createDataFrame(cards, "round_id long, frame_id int, det_id long, cx double, cy double, x1 int, y1 int, x2 int, y2 int, suit string, rank string")
    out = joins.pair_self_join(df.repartition("round_id"))
    assert physical(out).count("Exchange") == 1
    want = {(r, f, a, b) for r in range(3) for f in range(4) for a in range(30) for b in range(a + 1, 30) if math.hypot(3 * (b - a), b % 7 - a % 7) <= 60 and (80 - 3 * (b - a)) * 200 >= 200}
    assert {tuple(r) for r in out.select("round_id", "frame_id", "a_det_id", "b_det_id").collect()} == want and out.count() == len(want)


def test_detections_of_a_round_lie_together(spark):
    """Derived columns were shuffled beside the given ones, and Spark didn't know that rows numbered per supplier lie together by round."""
    t = Inputs(spark, SF)
    found = physical(t.detections.groupBy("round_id", "frame_id").count())
    assert found.count("Exchange") == 1
    text = spark.sql(TABLES["detections"], lineitem=t.lineitem)
    assert t.detections.schema == text.schema and sorted(map(tuple, t.detections.collect())) == sorted(map(tuple, text.collect()))


def places(spark):
    rnd = random.Random(5)
    rows = [(k, rnd.choice([None, float("nan"), rnd.uniform(400, 1500)]) if k % 10 == 0 else rnd.uniform(400, 1500), rnd.uniform(600, 1000)) for k in range(500)]
    return spark.createDataFrame(rows, "det_id long, cx double, cy double")


def test_seats_are_found_in_steps(spark):
    """As one expression the angle was taken anew for each use of a distance, in a method that the JVM doesn't compile."""
    out = joins.assign_seats_template(places(spark))
    assert plan(out).count("ATAN2") == 1
    assert out.where(~F.col("seat").eqNullSafe(g.nearest_seat(F.col("cx"), F.col("cy")))).count() == 0 and out.select("seat").distinct().count() > 5


def test_a_filter_on_seats_stays_above_the_steps(spark):
    """Below them it was written out in full, and Spark derived variants of it until the driver's memory ended, before a row was read."""
    dets, name = Inputs(spark, SF).detections, "spark.sql.constraintPropagation.enabled"
    kept, before = joins.assign_seats_template(dets).where("seat is not null"), spark.conf.get(name)
    spark.conf.set(name, "false")  # no variants: only where the filter lies
    try:
        assert plan(kept).count("ATAN2") == 1
    finally:
        spark.conf.set(name, before)
    want = dets.withColumn("seat", g.nearest_seat(F.col("cx"), F.col("cy"))).groupBy("seat").count().collect()
    again = joins.assign_seats_template(dets).where("seat is not null").groupBy("seat").count().collect()
    assert sorted(map(tuple, again)) == sorted(tuple(r) for r in want if r["seat"] is not None) and any(r["seat"] is None for r in want)


def test_distances_to_boxes_are_found_in_steps(spark):
    box = "400.0D c0x, 600.0D c0y, 900.0D c1x, 650.0D c1y, 880.0D c2x, 850.0D c2y, 380.0D c3x, 800.0D c3y"
    for corners in (box, ", ".join(f"700.0D c{k}{a}" for k in range(4) for a in "xy")):
        rows = places(spark).selectExpr("*", *[x.replace("D ", "D as ") for x in corners.split(", ")])
        out = scalar.with_obb_distance(rows)
        assert plan(out).count("SQRT") == 4
        assert out.where(~F.col("distance").eqNullSafe(g.obb_distance(F.col("cx"), F.col("cy"), g.corners()))).count() == 0


def test_greedy_matching_is_done_once(spark):
    """The fold over the pairs stood inside the filter of the items, so a frame was matched as often as it has items."""
    kind = "array<struct<i:bigint,x:double,y:double>>"
    df = spark.createDataFrame([([(1, 0.0, 0.0), (2, 50.0, 0.0)], [(3, 1.0, 0.0), (4, 49.0, 0.0), (5, 500.0, 0.0)]), ([], [(6, 0.0, 0.0)]), ([(7, 0.0, 0.0)], [])], f"a {kind}, b {kind}")
    out = df.select(joins.greedy_match(F.col("a"), F.col("b"), 120.0).alias("new"))
    text = plan(out)
    assert text.index("aggregate(") < text.index("filter(b#")  # the argument of the outer lambda, not a part of the inner one
    assert [[x["i"] for x in r["new"]] for r in out.collect()] == [[5], [6], []]


def test_folders_of_records_are_made_once(tmp_path, monkeypatch):
    """Each record asked for its folder anew."""
    made, opened = [], records.opened

    class Store:
        def __init__(self, store):
            self.store = store

        def __getattr__(self, name):
            return getattr(self.store, name)

        def create_dir(self, path, recursive):
            made.append(path)
            self.store.create_dir(path, recursive=recursive)

    monkeypatch.setattr(records, "opened", lambda path: (Store(opened(path)[0]), opened(path)[1]))
    writer = records.RecordWriter(str(tmp_path), False)
    staged = writer.write(iter([{"video_name": str(k), "record": "{}"} for k in range(500)]))
    assert staged.files == 500 and len(made) == len(set(made)) <= records.FOLDERS
    writer.commit([staged])
    assert sum(x.name.endswith(records.ENDING) for x in tmp_path.rglob("*")) == 500


def test_cards_of_a_pair_are_looked_at_in_place():
    """Each frame's cards were copied twice, and all columns of a row became Python objects."""

    class Rows(list):
        def __iter__(self):
            raise AssertionError("copied")

    rows = Rows([(f, 2 * f + k, 100.0 + 30 * k + f * k, 500.0, "HS"[k]) for f in range(40) for k in range(2)] + [(99, 99, 1.0, 1.0, "H")])
    for suits in (("H", "S"), ("U", "U")):
        assert sequences.followed((100.0, 500.0, 130.0, 500.0, *suits), rows) == (40, 35, 39, 78, 79, 69.0)
    assert sequences.followed((900.0, 500.0, 930.0, 500.0, "H", "S"), rows)[:2] == (0, -1)


def test_both_axes_are_followed_in_one_order(spark):
    """The cards were joined with their own count and put in order four times, once per axis and step."""
    rnd = random.Random(11)
    cards = [(r, s, k, rnd.choice([None, 0.0, 2.0, 4.0, 9.0]), rnd.choice([0.0, 1.0, 5.0])) for r in range(40) for s in (0, 1, 2) for k in range(1, rnd.choice([2, 3, 4, 9]))]
    df = spark.createDataFrame(cards, "round_id long, seat_id int, ordinal int, cx double, cy double")
    box = "0.0D c0x, 0.0D c0y, 20.0D c1x, 0.0D c1y, 20.0D c2x, 10.0D c2y, 0.0D c3x, 10.0D c3y"
    obbs = df.selectExpr("round_id", "seat_id", *[x.replace("D ", "D as ") for x in box.split(", ")]).distinct()
    out = sequences.zigzag(df, obbs)
    assert "Union" not in plan(out) and plan(out).count("Join") == 1

    def turn(seat, at):
        before, found = None, []
        for a, b in zip(seat, seat[1:]):
            if a[at] is not None and b[at] is not None and abs(b[at] - a[at]) >= 3:
                way = b[at] > a[at]
                found += [b[2]] if before not in (None, way) else []
                before = way
        return found

    want = {}
    for r in range(40):
        for s in (1, 2):
            seat = sorted(c for c in cards if c[:2] == (r, s)) if len([c for c in cards if c[:2] == (r, s)]) < 3 else sorted((c for c in cards if c[:2] == (r, s)), key=lambda c: c[2])
            whole = [c if c[3] is not None else (*c[:3], None, None) for c in seat]  # without a place there is no projection
            if len(seat) >= 3 and (found := turn(whole, 3) + turn(whole, 4)):
                want[r, s] = min(found)
    assert {(x["round_id"], x["seat_id"]): x["double_ordinal"] for x in out.collect()} == want and len(want) > 5


def test_points_are_not_ordered_after_the_join(spark):
    """A point was copied for each detection of its frame, and the copies were sorted again to be grouped."""
    rnd = random.Random(13)
    at = lambda: rnd.choice([None, float(rnd.randrange(8))])
    dets = [(rnd.randrange(3), rnd.randrange(4), rnd.choice([None, k]), at(), at()) for k in range(60)]
    points = [(rnd.randrange(4), rnd.randrange(4), k, float(rnd.randrange(8)), float(rnd.randrange(8))) for k in range(60)]
    p = spark.createDataFrame(points, "round_id long, frame_id int, k int, px double, py double")
    out = joins.nearest_detection(p, spark.createDataFrame(dets, "round_id long, frame_id int, det_id long, cx double, cy double"), 2.0)
    text = plan(out)
    assert "Aggregate" not in text[: text.index("Join")]
    far = lambda d, x: None if None in d[3:] else math.hypot(d[3] - x[3], d[4] - x[4])
    want = {}
    for x in points:
        near = [(far(d, x), d[2]) for d in dets if d[:2] == x[:2] and d[2] is not None]
        d, i = min(near, key=lambda n: (n[0] is not None, n[0] or 0, n[1]), default=(None, None))  # as in SQL, an unknown distance comes first
        want[x[2]] = (d, i if d is not None and d <= 2 else None)
    got = {r["k"]: (r["distance"], r["det_id"]) for r in out.collect()}
    assert got.keys() == want.keys() and all(got[k][1] == want[k][1] and (got[k][0] is None) == (want[k][0] is None) for k in want)


def test_hashed_search_sends_few_vectors():
    """With probes a query was sent 13 times to each of 22 tables: 308 vectors for a row of 600,000. The chance of a miss and the rows that a query meets hold."""
    for rows, asked in ((600_000, 600_000), (50_000, 50_000), (600_000, 100), (1, 1)):
        longest, most = similarity.plan_hashes(rows, 0.9, 1e-6)
        tables, bits, probe = similarity.plan_search(rows, asked, 0.9, 1e-6)
        same = 1 - math.acos(0.9) / math.pi
        assert (1 - same**bits - probe * bits * (1 - same) * same ** (bits - 1)) ** tables <= 1e-6 and tables <= similarity.MOST_TABLES
        assert tables * (1 + probe * bits) / 2**bits <= longest * (1 + most) / 2**most
        assert tables * (rows + asked * (1 + probe * bits)) <= longest * (rows + asked * (1 + most))
    assert similarity.plan_search(600_000, 600_000, 0.9, 1e-6)[0] * 2 <= 120


def test_annotations_are_validated_in_one_pass(spark, tmp_path):
    """The rows were made twice (a raw export was parsed again for the rounds without a broken rule), and each text and list once more to filter by its size."""
    rows = [(1, 1, "split", None, 1, 2), (1, 2, "discard", "", 0, None), (1, 3, "hit", None, 2, 2), (2, 4, "tap", None, 1, 1), (2, 5, "other", None, 0, None), (3, 6, "tap", None, 0, None)]
    segs = spark.range(1).selectExpr(f"inline(array({', '.join(f'''struct({r} as round_id, {s} as seg_id, '{x}' as label, {'null' if m is None else repr(m)} as meta_text, {n} as n_boxes, {'null' if k is None else k} as n_keyframes)''' for r, s, x, m, n, k in rows)}))")
    out = datasets.validate_annotations(segs)
    assert plan(out).count("Range (") == 1
    assert sorted(map(tuple, out.collect()), key=str) == sorted([(1, 2, "discard", "meta_missing"), (1, 3, "hit", "needs_one_box_two_keyframes"), (2, None, None, "OK"), (3, 6, "tap", "needs_one_box")], key=str)
    task = '{"id":1,"annotations":[{"result":[{"type":"timelinelabels","value":{"ranges":[{"start":1,"end":9}],"timelinelabels":["hit"]}}]}]}'
    (tmp_path / "a.json").write_text(f"{task}\n[]\n{{broken\n[{task},{task}]\n")
    tasks = exports.read_export(spark, str(tmp_path))
    found = exports.record_segments(exports.export_records(tasks))
    assert not any("Filter" in x and "size(" in x for x in plan(found).split("\n"))
    assert found.count() == 3 and tasks.count() == 4


def test_rows_of_a_round_are_ordered_as_pandas_orders_them():
    """Each round of a batch was concatenated, sorted and grouped by pandas, whose calls took longer than the tracker."""
    rnd = random.Random(17)
    rows = [(rnd.choice([None, *range(5)]), rnd.choice([None, k]), rnd.choice([None, 0.5, rnd.random()]), float(k), 1.0) for k in range(200)]
    frames = [pd.DataFrame(rows[a : a + 50], columns=["frame_id", "det_id", "conf", "cx", "cy"]) for a in range(0, 200, 50)]
    want = pd.concat(frames).sort_values(["frame_id", "conf", "det_id"], ascending=[True, False, True])
    want = want[want["det_id"].notna() & want["frame_id"].notna()]
    own = tracker.in_order(tracker.detections(frames))
    assert [r[3] for r in own] == want["cx"].tolist() and len(tracker.detections(frames)) == sum(r[1] is not None for r in rows)
    whole = frames[0].dropna().astype({"frame_id": int, "det_id": int})  # without nulls the ids are whole numbers
    assert all(type(x) is int for r in tracker.detections([whole]) for x in r[:2])


def test_lots_of_a_stream_read_what_is_stored(spark, monkeypatch):
    """Each lot derived and thinned out all detections anew."""
    kept = []
    monkeypatch.setattr(streams, "stored", lambda df, name: kept.append(stored(df, name)) or kept[-1])
    found = catalog.QUERIES["stream_tracker"](spark, SF)
    assert found.count() > 0 and len(kept) == 1 and "Window" not in plan(kept[0])


def test_tips_are_put_in_order_once(spark):
    """Counting a fingertip's frames put the rows in an order of its own, and the windows over frames in a second one."""
    segs = spark.createDataFrame([(1, 1, 0, 4)], "round_id long, seg_id long, start_frame int, end_frame int")
    kps = spark.createDataFrame([(1, f, 0, 8, 0.5, y) for f, y in enumerate([0.70, 0.71, 0.75, 0.72, 0.70])], "round_id long, frame_id int, hand int, kp int, x double, y double")
    out = sequences.tap_motion(segs, kps)
    assert sum("Sort [" in x and "kp#" in x for x in physical(out).split("\n")) == 1
    assert [r["tap_frame"] for r in out.collect()] == [2]


def test_cards_of_a_frame_are_put_in_order_once(spark):
    """Each card was put in order as two wide rows, its own stripe's and a guest's, which spilled."""
    rnd = random.Random(8)
    rows = []
    for k in range(900):
        x, y = rnd.choice([rnd.uniform(-200, 200), rnd.randrange(-4, 5) * 60.0]), rnd.choice([rnd.uniform(-200, 200), rnd.randrange(-4, 5) * 60.0])
        rows.append((rnd.choice([1, 2]), rnd.choice([0, 10]), k, x, y, int(x) - 48, int(y) - 60, int(x) + 48, int(y) + 60, rnd.choice(["8", "K"]), "H", 0.9))
    out = joins.pair_self_join(spark.createDataFrame(rows, "round_id long, frame_id int, det_id long, cx double, cy double, x1 int, y1 int, x2 int, y2 int, rank string, suit string, conf double"))
    below = plan(out).split("Window ", 1)[1]
    assert "Generate" not in below and "Window" not in below
    wide = lambda a, b, k: max(0, min(a[k + 2], b[k + 2]) - max(a[k], b[k]))
    want = [(a[2], b[2]) for a in rows for b in rows if a[2] < b[2] and a[:2] == b[:2] and a[9] == b[9] and math.hypot(a[3] - b[3], a[4] - b[4]) <= 60 and wide(a, b, 5) * wide(a, b, 6) >= 200]
    assert sorted((r["a_det_id"], r["b_det_id"]) for r in out.collect()) == sorted(want) and len(want) > 500


def test_pairs_and_the_next_ones_come_from_one_reading(spark):
    """The pairs were found twice and joined with themselves, and all of them were sent to the hands twice."""
    out = catalog.QUERIES["resolve_pair_identity"](spark, SF)
    assert plan(out).count("Relation [l_orderkey") == 1
    rows = [(1, 0, 1), (1, 0, 2), (1, 10, 3), (1, 10, 4), (1, 20, 5), (1, 40, 6), (2, 10, 7), (None, 0, 8), (None, 10, 9), (1, None, 10)]
    df = spark.createDataFrame(rows, "round_id long, frame_id int, id long")
    got = joins.with_next(df, ["round_id"], {"id": "next"}, 10).collect()
    assert sorted((r["id"], r["next"]) for r in got) == [(1, 3), (1, 4), (2, 3), (2, 4), (3, 5), (4, 5)]
    seen = [(1, 0, 0.1, 0.2, 0.3, 0.4), (1, 10, 0.5, 0.6, 0.7, 0.8), (1, 20, 0.5, None, 0.7, 0.8), (None, 0, 0.1, 0.2, 0.3, 0.4), (None, 10, 0.1, 0.2, 0.3, 0.4)]
    hands = spark.createDataFrame(seen, "round_id long, frame_id int, h0x double, h0y double, h1x double, h1y double")
    assert [tuple(r) for r in joins.hands_and_next(hands, 10).collect()] == [(1, 0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8)]


def test_split_cards_are_found_once(spark):
    """Detections were numbered five times, twice of them only to look up the cards of a passing pair's end."""
    out = catalog.QUERIES["verify_split"](spark, SF)
    assert "Relation [l_orderkey" not in plan(out)
    cards = [(1, f, 2 * f + k, 100.0 + 30 * k + f * k, 500.0, "HS"[k], "8") for f in range(9) for k in range(2)]
    alone = [(1, 3, 90, 300.0, 500.0, "H", "K"), (1, 4, 91, 300.0, 500.0, "H", "K"), (2, 3, 92, 300.0, 500.0, "H", "8"), (1, 20, 93, 100.0, 500.0, "H", "8"), (1, 3, 94, 100.0, 500.0, "H", None), (1, 3, 95, 100.0, 500.0, "H", None)]
    dets = spark.createDataFrame(cards + alone, "round_id long, frame_id int, det_id long, cx double, cy double, suit string, rank string")
    paired = sequences.paired_cards(dets)
    assert sorted(r["det_id"] for r in paired.collect()) == sorted(c[2] for c in cards)
    kind = "round_id long, seg_id long, pair_no int, pair_rank string, start_frame int, last_frame int, s_ax double, s_ay double, s_bx double, s_by double, s_asuit string, s_bsuit string"
    pairs = spark.createDataFrame([(1, s, 1, "8", s, 30, 100.0, 500.0, 130.0 + s, 500.0, "H", "S") for s in (0, 6)], kind)
    got, short = sequences.track_pair(pairs, paired, ends=True).orderBy("seg_id").collect()
    assert tuple(got)[3:] == (9, 4, 8, 16, 17, 38.0, 100.0, 500.0, "H", 138.0, 500.0, "S")
    assert tuple(short)[3:5] == (3, -1) and set(tuple(short)[5:]) == {None}
    assert [tuple(r) for r in sequences.track_pair(pairs, dets).orderBy("seg_id").collect()] == [tuple(got)[:9], tuple(short)[:9]]


def test_entries_come_from_the_votes(spark):
    """All detections were numbered again and joined with their tracks' seats to find the first frame inside the box."""
    assert plan(catalog.QUERIES["seat_entry_ordinal"](spark, SF)).count("Relation [l_orderkey") == 2  # the tracks' and that of the rounds with boxes
    t = Inputs(spark, SF)
    near = t.tracks.withColumns({"cx": F.col("cx") + F.when(F.col("frame_id") < 300, 40 * (F.col("track_id") % 9)).otherwise(0), "cy": F.col("cy") - F.when(F.col("det_id") % 2 == 0, 130).otherwise(0)})
    for tracks in (t.tracks, near):
        seats = stored(aggregates.seat_vote(tracks, t.seat_obbs, entry=True).where("seat_id is not null"), "seats")
        want = sequences.seat_ordinal(tracks, seats.select("round_id", "track_id", "seat_id"), t.seat_obbs)
        got = sequences.in_order_of_entry(seats.select("round_id", "track_id", "seat_id", "entry_frame"))
        assert sorted(map(tuple, got.select(*want.columns).collect())) == sorted(map(tuple, want.collect()))
        assert seats.where("seat_via = 'nearest'").count() or tracks is t.tracks


def test_a_card_is_one_column_of_the_order(spark):
    """Each range computed the card anew, so a row that was put in order held it three times and spilled."""
    out = joins.pair_self_join(Inputs(spark, SF).dets720)
    assert "_w0" not in plan(out) and out.count() == 2584


@pytest.mark.parametrize("name", ["dedup_pairs_by_cluster", "greedy_hand_card_assignment", "rolling_median_spread", "same_rank_pairs", "resolve_pair_identity", "annotation_pair_read_back"])
def test_detections_are_dealt_by_their_count(spark, monkeypatch, name):
    """Tasks were filled by packed size or by a set number of partitions, whatever the rows take when they are put in order."""
    few = catalog.QUERIES[name](spark, SF)
    assert "RepartitionByExpression" not in plan(few)
    monkeypatch.setattr(fixtures, "TASK_ROWS", 500)
    many = catalog.QUERIES[name](spark, SF)
    assert plan(many).count("RepartitionByExpression [l_suppkey") == 1 and ", 12" in plan(many)
    assert physical(many).count("Exchange hashpartitioning(l_suppkey") == 1
    assert sorted(map(repr, many.collect())) == sorted(map(repr, few.collect()))


def test_few_enough_tasks_to_write_rows_as_they_come():
    """With 720 tasks for 216 million lines, what the readers shuffled was held, ordered and spilled whole."""
    assert [fixtures.tasks_for(n) for n in (0, 300_001, 36_000_000, 216_000_000, 600_000_000)] == [0, 2, 120, 200, 500]


def test_nested_boxes_are_not_shuffled(spark, monkeypatch):
    """Boxes were shuffled by segment when they were nested, and with their segments by video, where they had lain before; tasks were filled whatever the boxes take."""
    name, before = "spark.sql.autoBroadcastJoinThreshold", spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set(name, "-1")
    try:
        few = scans._records(Inputs(spark, SF))
        monkeypatch.setattr(fixtures, "TASK_ROWS", 500)
        many = scans._records(Inputs(spark, SF))
        assert [physical(x).count("Exchange") for x in (few, many)] == [2, 2]  # segments with videos, lines
        assert physical(many).count(", 12)") == 2 and sorted(map(repr, many.collect())) == sorted(map(repr, few.collect()))
    finally:
        spark.conf.set(name, before)


def test_records_of_odd_segments(spark):
    """Rows of one seg_id share their boxes and stay as many as they are; a segment or box without a number, a place or a video has none."""
    segs = [(1, 1, 0, 9, "a"), (1, 1, 5, 20, "b"), (1, 2, 0, 9, "a"), (1, 2, 0, 9, "a"), (1, None, 0, 99, "c"), (1, 3, None, 9, None), (1, 4, 30, 40, "d"), (2, 1, 0, 9, "a"), (None, 1, 0, 99, "a"), (4, 1, 0, 9, "a")]
    boxes = [(1, 7, 5, 0, 0, 1, 1), (1, 6, 9, 0, 0, 2, 2), (1, 8, None, 0, 0, 3, 3), (1, 9, 20, 0, 0, 4, 4), (None, 1, 5, 0, 0, 5, 5), (5, 1, 5, 0, 0, 6, 6)]
    out = annotations.build_annotation_records(spark.createDataFrame([(1,), (1,), (2,), (3,)], "round_id long"), spark.createDataFrame(segs, "round_id long, seg_id long, start_frame int, end_frame int, label string"), spark.createDataFrame(boxes, "round_id long, box_id long, anchor_frame int, x1 int, y1 int, x2 int, y2 int"))
    own = {}
    for r, k, a, z, _ in segs:
        own.setdefault((r, k), []).extend((f, i, x1, y1, x2, y2) for v, i, f, x1, y1, x2, y2 in boxes if None not in (r, k, a, f) and v == r and a <= f <= z)
    want = {v: sorted(((a, k, z, [t], None if a is None else z - a + 1, sorted(own[r, k]) or None) for r, k, a, z, t in segs if r == v), key=repr) or None for v in (1, 2, 3)}
    plain = lambda s: (*s[:5], s["bounding_boxes"] and [tuple(b) for b in s["bounding_boxes"]])
    rows = out.collect()
    assert len(rows) == 3 and {r["round_id"]: r["timeline_segments"] and sorted(map(plain, r["timeline_segments"]), key=repr) for r in rows} == want
    starts = [s["start_frame"] for s in next(r for r in rows if r["round_id"] == 1)["timeline_segments"]]
    assert starts == [None, 0, 0, 0, 0, 5, 30]


def test_compressed_records_replace_plain_ones(spark, tmp_path):
    """Files were several times as large as they need to be; a record keeps its name, whichever way it is written."""
    records.use_records(spark)
    long = '{"a":"' + "ü0123456789" * 1000 + '"}'

    def put(rows, **options):
        spark.createDataFrame(rows, "video_name string, record string").write.format("annotation_records").options(**options).mode("append").save(str(tmp_path))

    read = lambda: dict(map(tuple, spark.read.format("annotation_records").load(str(tmp_path)).where("video_name in ('a', 'b')").collect()))
    size = lambda v: (tmp_path / records.place_of(v)).stat().st_size
    put([("a", long), ("b", "{}")], compression="gzip")
    assert read() == {"a": long, "b": "{}"} and size("a") < len(long) / 10 and size("b") == 2
    put([("a", long), ("b", "")])
    assert read() == {"a": long, "b": ""} and size("a") == len(long.encode())
    put([("a", long + " "), ("b", long)], compression="GZIP")
    assert read() == {"a": long + " ", "b": long} and size("a") < len(long) / 10
    with pytest.raises(Exception, match="none or gzip"):
        put([("a", "{}")], compression="lz9")
    assert read()["a"] == long + " "


def test_records_of_the_sink_are_nested_once(spark, monkeypatch):
    """Both runs of the sink shuffled and nested all boxes anew."""
    kept, folders = [], []
    monkeypatch.setattr(export_plans, "stored", lambda df, name: kept.append(stored(df, name)) or kept[-1])
    monkeypatch.setattr(export_plans, "scratch_folder", lambda s, name, real=export_plans.scratch_folder: folders.append(real(s, name)) or folders[-1])
    rows = catalog.QUERIES["annotation_record_sink"](spark, SF).count()
    files = [os.path.join(a, x) for a, _, names in os.walk(folders[0]) for x in names if x.endswith(records.ENDING)]
    assert rows > 0 and len(kept) == 1 and not os.path.exists(kept[0].stored_at) and len(files) == Inputs(spark, SF).customer.count()
    heads = [open(x, "rb").read(2) for x in files]
    assert set(heads) == {b"\x1f\x8b", b"{}"}
