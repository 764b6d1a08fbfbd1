"""Hand-computed cases, plain loops beside the stateful operators, and properties."""

import itertools
import math
import os
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from roundhouse.functions import geometry as g
from roundhouse.operators import aggregates, datasets, joins, picks, pipelines, scalar, sequences
from roundhouse.plans import catalog
from roundhouse.plans.fixtures import Inputs
from roundhouse.sources import annotations, names

SF = "/root/testdata/sf0.001"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: [(x is not None, x) for x in r])


def test_names(spark):
    df = spark.createDataFrame([("2025-10-01_06-05-15_000001_000300_card.json",), ("bad_name.json",), ("a_b_c_d_e.json",), (None,)], "file_name string")
    assert rows(names.parse_asset_name(df).drop("file_name")) == [("2025-10-01_06-05-15", 1, 300)]
    df = spark.createDataFrame([("r_f1_f22.png",), ("r.png",)], "file_name string")
    assert rows(names.parse_frame_name(df).select("round_name", "frame_id", "status")) == [(None, None, "bad_filename"), ("r_f1", 22, "ok")]


def test_detection_spellings(spark):
    raw = ['{"bbox":[1.5,2.5,3,4],"confidence":0.5,"polygon_center":[[7,8]]}', '{"box":[1,2,3,4],"conf":0.5,"polygon_center":[7,8],"rank":"K"}', "{}"]
    out = annotations.normalize_detection(spark.createDataFrame([(x,) for x in raw], "raw string")).collect()
    assert (out[0]["x1"], out[0]["y1"], out[0]["cx"], out[0]["rank"], out[0]["match_type"]) == (2, 2, 7.0, "U", "unmatched")  # halves to even
    assert (out[1]["rank"], out[1]["match_type"], out[1]["cy"]) == ("K", "matched", 8.0)
    assert out[2]["cx"] is None and out[2]["conf"] == 0.0


def test_duration_boundary(spark):
    df = spark.createDataFrame([(1, 0, 28, "hit"), (2, 0, 29, "hit"), (3, 0, 99, "tap")], "seg_id long, start_frame int, end_frame int, label string")
    assert rows(scalar.stage_duration(df, ["hit"], 30).select("seg_id", "passed", "reason")) == [(1, False, "duration=29 < 30"), (2, True, None)]


def test_half_even_and_slots(spark):
    df = spark.createDataFrame([(25.0, "C1"), (35.0, "C7"), (5.0, "C8"), (15.0, "x")], "x double, s string")
    assert [r[0] for r in df.select(g.grid_key(F.col("x"))).collect()] == [20, 40, 0, 20]
    assert [r[0] for r in df.select(scalar.parse_slot(F.col("s"))).collect()] == [0, 6, -1, -1]


def test_obb(spark):
    box = "0.0 c0x, 0.0 c0y, 10.0 c1x, 0.0 c1y, 10.0 c2x, 5.0 c2y, 0.0 c3x, 5.0 c3y"
    df = spark.sql(f"select *, {', '.join(x.rpartition(' ')[0] + ' as ' + x.rpartition(' ')[2] for x in box.split(', '))} from values (5.0D, 2.0D), (13.0D, 9.0D), (10.0D, 5.0D) as t(px, py)")
    p = (F.col("px"), F.col("py"))
    out = df.select(g.point_in_obb(*p, g.corners()), g.obb_distance(*p, g.corners()), g.project_obb(*p, g.corners(), "long"), g.upright_frame(*p, g.corners())[1]).collect()
    assert [tuple(r) for r in out] == [(True, 0.0, 5.0, 2.0), (False, 5.0, 13.0, 9.0), (True, 0.0, 10.0, 5.0)]


def test_degenerate_edge(spark):
    df = spark.sql("select " + ", ".join(f"1.0D as c{k}{a}" for k in range(4) for a in "xy") + ", 4.0D as px, 5.0D as py")
    assert df.select(g.segment_distance(F.col("px"), F.col("py"), (F.col("c0x"), F.col("c0y")), (F.col("c1x"), F.col("c1y")))).first()[0] == 5.0
    assert df.select(g.upright_frame(F.col("px"), F.col("py"), g.corners())[0]).first()[0] is None


def test_offset_order():
    assert joins.offsets(2) == [0, 1, -1, 2, -2]


def test_asof(spark):
    seg = spark.createDataFrame([(1, 1, 10, 20), (1, 2, 30, 40), (2, 3, 0, 5)], "round_id long, seg_id long, start_frame int, end_frame int")
    fr = spark.createDataFrame([(1, 9), (1, 12), (1, 18), (1, 31)], "round_id long, frame_id int")
    assert [r[-1] for r in joins.asof_frame(seg, fr, "start_frame", "before").orderBy("seg_id").collect()] == [12, 31, None]
    assert [r["asof_frame"] for r in joins.asof_offset(seg, fr, "start_frame", 2).orderBy("seg_id").collect()] == [9, 31, None]
    tie = spark.createDataFrame([(1, 11), (1, 9)], "round_id long, frame_id int")
    assert joins.asof_offset(seg.where("seg_id = 1"), tie, "start_frame", 2).first()["asof_frame"] == 11  # + before -


def test_bucketed_overlap_join(spark):
    rnd = random.Random(1)
    a = [(k, s, s + rnd.randrange(60)) for k, s in ((rnd.randrange(3), rnd.randrange(300)) for _ in range(60))]
    df = spark.createDataFrame([(*x, i) for i, x in enumerate(a)], "k long, s int, e int, i long")
    other = df.selectExpr("k", "s as s2", "e as e2", "i as j")
    plain = joins.interval_overlap_join(df, other, ["k"], ("s", "e"), ("s2", "e2"))
    dealt = joins.interval_overlap_join(df, other, ["k"], ("s", "e"), ("s2", "e2"), bucket=25)
    assert rows(plain.select("i", "j")) == rows(dealt.select("i", "j"))


def greedy(start, end, limit):
    pairs = sorted((math.dist(e[1:], s[1:]), e[0], s[0]) for e in end for s in start)
    used_e, used_s = set(), set()
    for d, e, s in pairs:
        if d <= limit and e not in used_e and s not in used_s:
            used_e.add(e)
            used_s.add(s)
    return sorted(e[0] for e in end if e[0] not in used_e)


def test_greedy_matching(spark):
    rnd = random.Random(2)
    cases = []
    for _ in range(30):
        make = lambda: [(i, float(rnd.randrange(200)), float(rnd.randrange(200))) for i in range(rnd.randrange(6))]
        cases.append((make(), make()))
    kind = "a array<struct<i:bigint,x:double,y:double>>, b array<struct<i:bigint,x:double,y:double>>"
    out = spark.createDataFrame(cases, kind).select(F.transform(joins.greedy_match(F.col("a"), F.col("b"), 120.0), lambda x: x["i"])).collect()
    assert [sorted(r[0]) for r in out] == [greedy(a, b, 120.0) for a, b in cases]


def test_majority_ties_go_to_first_seen(spark):
    df = spark.createDataFrame([(1, 3, "a"), (1, 1, "b"), (1, 4, "a"), (1, 2, "b")], "k long, seq int, v string")
    assert rows(aggregates.majority(df, ["k"], ["v"], ["seq"])) == [(1, "b", 2)]


def test_top1_of_many_rows_in_tiles(spark, monkeypatch):
    rnd = np.random.default_rng(4)
    a, b = np.round(rnd.normal(size=(300, 3)), 1), np.round(rnd.normal(size=(50, 3)), 1)
    a[7], b[9] = b[3], b[3]  # a tie
    q = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(a)], "q_id long, q_vec array<double>")
    gal = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(b)], "g_id long, g_vec array<double>")
    unit = lambda x: x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-8)
    scores = np.floor(unit(a) @ unit(b).T * 10000 + 0.5) / 10000
    want = [(i, float(scores[i].max()), int(scores[i].argmax())) for i in range(300)]
    monkeypatch.setattr(joins, "TILE", 7, raising=False)
    assert rows(joins.top1_similarity(q, gal)) == want
    sizes = []
    apply = type(q.groupBy())
    real = apply.applyInArrow

    def seen(self, f, kind):
        sizes.append(self._df.where("query").groupBy("part", "block").count().agg(F.max("count")).first()[0])
        return real(self, f, kind)

    monkeypatch.setattr(apply, "applyInArrow", seen)
    assert rows(joins.top1_similarity(q, gal, floats=18)) == want  # 50 parts; 16 would hold 19 queries or more
    assert len(sizes) == 1 and sizes[0] <= 18


def test_hard_negatives_in_runs(spark, monkeypatch):
    rnd = np.random.default_rng(5)
    v = {i * i: rnd.normal(size=3) for i in range(40)}
    df = spark.createDataFrame([(i, 1 if i % 2 else 2, x.tolist()) for i, x in v.items()], "id long, label_id int, vec array<double>").repartition(3)
    cos = lambda x, y: float(np.floor(x @ y / np.sqrt((x @ x) * (y @ y)) * 10000 + 0.5) / 10000)
    found = {r["q_id"]: r for r in datasets.mine_hard_negatives(df, 1).collect()}
    assert set(found) == {i for i in v if i % 2} == {r["pos_id"] for r in found.values()}  # a ring: each is the positive of one
    for i, r in found.items():
        assert r["pos_id"] != i and r["pos"] == cos(v[i], v[r["pos_id"]])
        assert r["neg"] == max(cos(v[i], v[k]) for k in v if k % 2 == 0)
    assert [r["pos"] for r in datasets.mine_hard_negatives(df.where("id in (0, 1, 4)"), 1).collect()] == [None]


def test_top1_blocks_equal_broadcast(spark):
    rnd = np.random.default_rng(3)
    q = spark.createDataFrame([(i, rnd.normal(size=4).tolist()) for i in range(20)], "q_id long, q_vec array<double>")
    gal = spark.createDataFrame([(i, rnd.normal(size=4).tolist()) for i in range(30)], "g_id long, g_vec array<double>")
    assert rows(joins.top1_similarity(q, gal)) == rows(joins.top1_similarity(q, gal, rows=7))


def test_coverage(spark):
    r = spark.createDataFrame([(1, 1, 1, 600), (2, 1, 1, 900), (3, 2, 1, 10)], "round_id long, video_id long, start_1idx int, end_1idx int")
    c = spark.createDataFrame([(1, 0), (1, 300), (1, 900)], "video_id long, chunk_start int")
    assert rows(aggregates.coverage(r, c)) == [(1, 600, 600, "full"), (2, 900, 600, "partial"), (3, 10, 0, "no_match")]


def loop_tracks(dets, reach=35.0, recency=75, least_obs=3, least_span=20):
    tracks = []
    for frame, own in itertools.groupby(sorted(dets, key=lambda d: (d[0], -d[4], d[1])), key=lambda d: d[0]):
        taken = set()
        for d in own:
            near = [(math.dist(t[-1][2:4], d[2:4]), k) for k, t in enumerate(tracks) if k not in taken and frame - t[-1][0] <= recency and t[-1][0] < frame or (k not in taken and t[-1][0] == frame and len(t) > 0)]
            best = min(near, default=None)
            if best and best[0] <= reach:
                tracks[best[1]].append(d)
                taken.add(best[1])
            else:
                tracks.append([d])
    return [sorted(x[1] for x in t) for t in tracks if len(t) >= least_obs and t[-1][0] - t[0][0] >= least_span]


def test_tracker_against_loop(spark):
    rnd = random.Random(4)
    dets = [(10 * f, f * 20 + k, 60.0 * k + rnd.randrange(20), 100.0 + rnd.randrange(30), rnd.random()) for f in range(20) for k in range(rnd.randrange(5))]
    df = spark.createDataFrame([(1, f, i, x, y, "8", "H", c) for f, i, x, y, c in dets], "round_id long, frame_id int, det_id long, cx double, cy double, rank string, suit string, conf double")
    found = sequences.track_items(df, least_obs=3, least_span=20).collect()
    got = {}
    for r in found:
        got.setdefault(r["track_id"], []).append(r["det_id"])
    assert sorted(sorted(x) for x in got.values()) == sorted(loop_tracks(dets))


def test_follow_pair():
    frames = pd.DataFrame([(1, 1, 1, f, 2 * f + k, 100.0 + k * (20 + 5 * f), 500.0, "HD"[k], "8") for f in range(8) for k in (0, 1)], columns=["round_id", "seg_id", "pair_no", "frame_id", "det_id", "cx", "cy", "suit", "rank_norm"])
    frames = frames.assign(pair_rank="8", s_ax=100.0, s_ay=500.0, s_bx=120.0, s_by=500.0, s_asuit="H", s_bsuit="D")
    out = sequences.follow_pair(frames).iloc[0]
    assert (out["n"], out["spread"], out["end_frame"], out["max_distance"]) == (8, 15, 7, 55.0)
    assert sequences.follow_pair(frames[frames["frame_id"] < 4]).iloc[0]["spread"] == -1


def test_two_piles():
    p = np.array([[0.0, 0], [1, 0], [10, 0], [11, 0], [12, 1]])
    assert sequences.two_piles(p, np.array([0])).tolist() == [1, 1, 2, 2, 2]
    assert sequences.two_piles(np.concatenate([p, p[:1], p[::-1]]), np.array([0, 5, 6])).tolist() == [1, 1, 2, 2, 2, 1, 2, 2, 2, 1, 1]


def test_tap_needs_dips_on_both_sides(spark):
    seg = spark.createDataFrame([(1, 1, 0, 4)], "round_id long, seg_id long, start_frame int, end_frame int")
    make = lambda ys: spark.createDataFrame([(1, f, 0, 8, 0.5, y) for f, y in enumerate(ys)], "round_id long, frame_id int, hand int, kp int, x double, y double")
    assert [r["tap_frame"] for r in sequences.tap_motion(seg, make([0.70, 0.71, 0.75, 0.72, 0.70])).collect()] == [2]
    assert sequences.tap_motion(seg, make([0.70, 0.71, 0.75, 0.74, 0.74])).count() == 0
    assert sequences.tap_motion(seg, make([0.70, 0.71, 0.75, 0.70])).count() == 0  # a frame is missing


def test_nms_properties(spark):
    rnd = random.Random(5)
    data = [(1, i, s, s + 10 + rnd.randrange(30), round(rnd.random(), 2)) for i, s in enumerate(rnd.randrange(100) for _ in range(40))]
    df = spark.createDataFrame(data, "g long, seg_id long, start_frame int, end_frame int, score double")
    kept = sequences.nms_1d(df, ["g"], topn=99).collect()

    def iou(a, b):
        shared = max(0, min(a["end_frame"], b["end_frame"]) - max(a["start_frame"], b["start_frame"]))
        return shared / ((a["end_frame"] - a["start_frame"]) + (b["end_frame"] - b["start_frame"]) - shared)

    assert kept and all(iou(a, b) <= 0.3 for a, b in itertools.combinations(kept, 2))
    assert max(data, key=lambda x: x[4])[4] == max(r["score"] for r in kept)


def test_frame_labels_first_wins(spark):
    seg = spark.createDataFrame([(1, 0, "background", 1, 5), (1, 1, "hit", 2, 3), (1, 2, "tap", 3, 4), (1, 3, "x", 0, 0)], "round_id long, seq int, label string, start_frame int, end_frame int")
    out = sequences.frame_labels(seg, spark.createDataFrame([(1, 5)], "round_id long, n int"))
    assert [r["label"] for r in out.orderBy("frame_id").collect()] == ["background", "hit", "hit", "tap", "background"]


def test_bins_fill_empty(spark):
    f = spark.createDataFrame([(1, k, [float(k)]) for k in range(4)], "video_id int, frame_idx int, embedding array<double>")
    u = spark.createDataFrame([(1, 1, 3)], "video_id int, start_frame int, end_frame int")
    assert sequences.temporal_bins(u, f, 4).first()["vec"] == [1.0, 1.0, 1.0, 2.0]


def test_splits(spark):
    df = spark.createDataFrame([(i, i % 7, i % 4 == 0) for i in range(200)], "id long, video long, positive boolean")
    h = datasets.split_hashed(df, "video")
    by = h.groupBy("video").agg(F.count_distinct("split").alias("n")).collect()
    assert all(r["n"] == 1 for r in by) and h.where("split = 'test'").count() > 0
    s = datasets.split_stratified(df, "positive", ["id"], 0.2)
    assert {(r["positive"]): r["n"] for r in s.where("split = 'val'").groupBy("positive").agg(F.count("*").alias("n")).collect()} == {True: 10, False: 30}
    k = datasets.kfold_stratified(df, "positive", ["id"])
    assert {r["n"] for r in k.where("positive").groupBy("fold").agg(F.count("*").alias("n")).collect()} == {10}
    assert rows(s) == rows(datasets.split_stratified(df.repartition(7), "positive", ["id"], 0.2))


def test_balanced(spark):
    df = spark.createDataFrame([(i, "hit" if i % 3 == 0 else "x") for i in range(90)], "id long, label string")
    u = picks.balanced_union(df.where("label = 'hit'"), df.where("label = 'x'"), ["id"])
    assert {r["source"]: r["count"] for r in u.groupBy("source").count().collect()} == {"human": 30, "auto": 30}
    b = picks.balanced_batches(df, ["id"], F.col("label") == "hit", 8, 0.25)
    assert [tuple(r) for r in b.groupBy("batch").agg(F.count_if("is_focus").alias("f"), F.count_distinct("id").alias("n")).orderBy("batch").collect()] == [(k, 2, 8) for k in range(30)]
    few = picks.balanced_batches(df.where("id < 30"), ["id"], F.col("id") == 0, 8, 0.25)  # one focus item has to fill two slots
    assert few.where("is_focus").count() == 8 and few.where("not is_focus").count() == 24


def test_jitter_stays_inside(spark):
    df = spark.createDataFrame([(i, i * 5, i * 5 + 20) for i in range(20)], "seg_id long, start_frame int, end_frame int")
    out = sequences.jitter(df, last=F.lit(100)).collect()
    assert all(0 <= r["start_frame"] <= r["end_frame"] <= 100 for r in out)
    assert sum(r["copy"] == 0 for r in out) == 20  # the originals, clipped


def test_conservation(spark):
    from roundhouse.plans.fixtures import Inputs

    t = Inputs(spark, "/root/testdata/sf0.001")
    cards = t.detections.select("round_id").distinct()
    out = pipelines.verify_hit(t.segments, t.dets720, cards)
    n = t.segments.where("label in ('hit', 'dealer hits')").count()
    assert out.count() == n and out.where("passed").count() + out.where("stage is not null").count() == n


def test_window_classifier_learns(spark):
    rnd = np.random.default_rng(6)
    data = [(i, int(i % 2), (rnd.normal(size=3) + 3 * (i % 2)).tolist()) for i in range(200)]
    df = spark.createDataFrame(data, "id long, label_id int, vec array<double>")
    out = datasets.score_windows(datasets.fit_window_classifier(df.where("id < 150")), df.where("id >= 150"), 1)
    assert out.where((F.col("score") > 0.5) == (F.col("label_id") == 1)).count() >= 47
    mlp = datasets.score_windows(datasets.fit_window_classifier(df.where("id < 150"), layers=(4,)), df.where("id >= 150"), 1)
    assert mlp.where((F.col("score") > 0.5) == (F.col("label_id") == 1)).count() >= 40


def test_empty_inputs(spark):
    seg = spark.createDataFrame([], "round_id long, seg_id long, start_frame int, end_frame int, label string, score double")
    det = spark.createDataFrame([], "round_id long, frame_id int, det_id long, cx double, cy double, x1 int, y1 int, x2 int, y2 int, rank string, suit string, conf double")
    assert sequences.nms_1d(seg, ["round_id"]).count() == 0
    assert sequences.track_items(det).count() == 0
    assert joins.pair_self_join(det).count() == 0
    assert aggregates.meta_text(seg, det).count() == 0


@pytest.mark.parametrize("two_sided", [False, True])
def test_fan(spark, two_sided):
    cards = spark.createDataFrame([(1, 1, 1, 0.0, 0.0), (1, 1, 2, 10.0, 0.0), (1, 1, 3, 20.0, 8.0)], "round_id long, seat_id int, ordinal int, cx double, cy double")
    assert sequences.fan_double(cards, two_sided).count() == int(two_sided)  # the turn is to the other side


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables here")
def test_piles_of_every_frame(spark):
    dets = Inputs(spark, SF).dets720
    found = catalog.QUERIES["two_means_piles"](spark, SF)
    assert found.count() == dets.count()
    seats = dets.select(F.col("round_id") * 1000 + F.col("frame_id"), (F.col("det_id") % 3).cast("int")).distinct()
    assert rows(found.select("round_id", "seat_id").distinct()) == rows(seats)
