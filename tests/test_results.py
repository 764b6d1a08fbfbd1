"""Results that once were wrong, and edge cases of the operators that bring them."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from roundhouse.operators import aggregates, datasets, joins, picks, pipelines, sequences


def test_windows_of_a_very_long_video(spark):
    """A video of more than 100,000 frames shares no window with the next one."""
    rng = np.random.default_rng(4)
    vecs = {7: rng.standard_normal((100_020, 3)), 8: rng.standard_normal((30, 3))}
    rows = [(v, i, [float(y) for y in x]) for v, m in vecs.items() for i, x in enumerate(m)]
    features = spark.createDataFrame(rows, "video_id int, frame_idx int, embedding array<double>")
    gallery = spark.createDataFrame([(k, [float(y) for y in rng.standard_normal(6)]) for k in range(5)], "g_id long, g_vec array<double>")
    none = features.limit(0).select("video_id")
    ids = spark.createDataFrame([(7, 70)], "video_id int, task_id long")
    out = pipelines.detect_actions(features, gallery, none, ids, threshold=-1.0, topn=3).collect()
    matrix = np.array([r["g_vec"] for r in gallery.orderBy("g_id").collect()])
    matrix /= np.linalg.norm(matrix, axis=1, keepdims=True)
    for v in (7, 8):
        own = sorted((r for r in out if r["video_id"] == v), key=lambda r: r["rank"])
        assert [r["rank"] for r in own] == [1, 2, 3][: len(own)] and len(own) >= 2 and {r["task_id"] for r in own} == {70 if v == 7 else None}
        for r in own:
            a = r["start_frame"]
            q = np.concatenate([vecs[v][a : a + 5].mean(0), vecs[v][a + 5 : a + 10].mean(0)])
            sims = matrix @ (q / np.linalg.norm(q))
            assert r["g_id"] == sims.argmax() and abs(r["score"] - sims.max()) < 1e-4


def test_six_significant_digits(spark):
    values = [0.1234567, 0.5, 0.0, 1.0, -0.25, 0.00012345678, 0.0001, 0.00009999996, 1e-7, 123456.7, 999999.6, 1234567.0, 0.9999999, 12.5, -0.0000123456, 1 / 3, 100.0]
    got = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double").select("i", datasets.six_digits(F.col("v")).alias("t")).orderBy("i").collect()
    assert [r["t"] for r in got] == [f"{v:.6g}" for v in values]
    box = spark.createDataFrame([(1, *[123.4567] * 8)], "class_id int, " + ", ".join(f"c{k}{a} double" for k in range(4) for a in "xy"))
    assert datasets.obb_label_lines(box, 1000.0, 1000.0).first()["obb_line"] == "1 " + " ".join(["0.123457"] * 8)


def test_latest_annotation_by_creation(spark):
    kind = "task_id long, ann_seq long, was_cancelled boolean, n_results int, updated_at string, created_at string"
    rows = [(1, 0, False, 1, None, "2025-02-01"), (1, 1, False, 1, "2025-01-01", "2025-03-01"), (2, 0, False, 1, "", "2025-02-01"), (2, 1, False, 1, None, None), (3, 0, True, 1, "2025-09-09", None), (3, 1, None, 1, None, ""), (4, 0, False, 0, "2025-01-01", None)]
    df = spark.createDataFrame(rows, kind)
    assert sorted(map(tuple, aggregates.latest_annotation(df).collect())) == [(1, 0, 1, "2025-02-01"), (2, 0, 1, "2025-02-01"), (3, 1, 1, "")]
    assert sorted(r[1] for r in aggregates.latest_annotation(df.drop("created_at")).collect()) == [1, 1, 1]


def test_split_seat_of_very_many_cards(spark):
    """The spare card of the first one's rank lies after a thousand others."""
    cards = [(1, 1, 1, "8", 10.0, 50.0, False), (1, 1, 2, "8", 60.0, 50.0, True)] + [(1, 1, k, "3", 20.0, 50.0, True) for k in range(3, 1200)] + [(1, 1, 1200, "8", 15.0, 50.0, True)]
    obb = [(1, 1, 0.0, 0.0, 100.0, 0.0, 100.0, 100.0, 0.0, 100.0)]
    df = spark.createDataFrame(cards, "round_id long, seat_id int, ordinal int, rank string, cx double, cy double, alive boolean")
    boxes = spark.createDataFrame(obb, "round_id long, seat_id int, " + ", ".join(f"c{k}{a} double" for k in range(4) for a in "xy"))
    assert [tuple(r) for r in sequences.split_seats(df, boxes).select("first_ordinal", "second_ordinal").collect()] == [(1200, 2)]


def test_label_round_gives_centres_and_confidence(spark):
    rnd, data = random.Random(5), []
    for r in (1, 2):
        for f in range(0, 100, 5):
            for k in range(3):
                data.append((r, f, 1000 * r + 10 * f + k, 400.0 + 90 * k + rnd.random(), 480.0 + rnd.random(), "8K3"[k], "HDS"[k], round(0.5 + rnd.random() / 2, 3)))
    dets = spark.createDataFrame(data, "round_id long, frame_id int, det_id long, cx double, cy double, rank string, suit string, conf double")
    corners = ", ".join(f"c{k}{a} double" for k in range(4) for a in "xy")
    obbs = spark.createDataFrame([(r, k, 360.0 + 90 * k, 440.0, 440.0 + 90 * k, 440.0, 440.0 + 90 * k, 520.0, 360.0 + 90 * k, 520.0) for r in (1, 2) for k in range(3)], f"round_id long, seat_id int, {corners}")
    out = pipelines.label_round(dets, obbs, least_obs=5).collect()
    assert len(out) == 6
    for row in out:
        own = sorted(d for d in data if d[0] == row["round_id"] and d[5] == row["rank"])
        assert (row["first_frame"], row["last_frame"], row["n_obs"]) == (own[0][1], own[-1][1], len(own))
        for name, value in (("first_x", own[0][3]), ("first_y", own[0][4]), ("last_x", own[-1][3]), ("last_y", own[-1][4]), ("mean_conf", np.mean([d[7] for d in own]))):
            assert abs(row[name] - value) <= 1e-4


def test_boxes_of_seats_against_loops(spark):
    rnd = random.Random(6)
    boxes = []
    for r in (1, 2):
        for k in (0, 1, 2, 5, 7) if r == 1 else (3,):
            x, y, turn = rnd.uniform(0, 300), rnd.uniform(0, 300), rnd.uniform(0, 6)
            c, s = math.cos(turn), math.sin(turn)
            boxes.append((r, k, *[v for dx, dy in ((0, 0), (80, 0), (80, 50), (0, 50)) for v in (x + dx * c - dy * s, y + dx * s + dy * c)]))
    boxes.append((1, 6, *[150.0] * 8))  # a box that is a point
    points = [(rnd.choice([1, 1, 1, 2, 3]), i, rnd.uniform(-50, 350), rnd.uniform(-50, 350)) for i in range(600)] + [(1, 9000, 150.0, 160.0), (1, 9001, None, 1.0)]
    kind = "round_id long, seat_id int, " + ", ".join(f"c{k}{a} double" for k in range(4) for a in "xy")
    p, o = spark.createDataFrame(points, "round_id long, det_id long, cx double, cy double"), spark.createDataFrame(boxes, kind)
    got = {r["det_id"]: (r["seat_id"], r["inside"], r["holding"]) for r in joins.assign_seats_obb(p, o).collect()}

    def place(x, y, box):
        q = [(box[2 * k], box[2 * k + 1]) for k in range(4)]
        (ox, oy), (ax, ay), _, (bx, by) = q
        u, v = (x - ox) * (ax - ox) + (y - oy) * (ay - oy), (x - ox) * (bx - ox) + (y - oy) * (by - oy)
        if 0 <= u <= (ax - ox) ** 2 + (ay - oy) ** 2 and 0 <= v <= (bx - ox) ** 2 + (by - oy) ** 2:
            return False, 0.0
        far = []
        for (sx, sy), (tx, ty) in zip(q, q[1:] + q[:1]):
            size = (tx - sx) ** 2 + (ty - sy) ** 2
            t = max(0, min(1, ((x - sx) * (tx - sx) + (y - sy) * (ty - sy)) / size)) if size else 0
            far.append(math.hypot(x - sx - t * (tx - sx), y - sy - t * (ty - sy)))
        return True, min(far)

    for r, i, x, y in points:
        found = [] if x is None else sorted((*place(x, y, b[2:]), b[1]) for b in boxes if b[0] == r)
        near = [f for f in found if not f[0] or f[1] <= 30]
        assert got[i][0] == (near[0][2] if near else None) and got[i][1] == (not near[0][0] if near else None)
        assert sorted(got[i][2]) == sorted(f[2] for f in found if not f[0])
    with pytest.raises(Exception, match="no such seat: 9"):
        joins.assign_seats_obb(p, o.withColumn("seat_id", F.lit(9))).collect()
    with pytest.raises(Exception, match="two boxes of seat 3"):
        joins.assign_seats_obb(p, o.where("seat_id = 3").unionByName(o.where("seat_id = 3"))).collect()


def test_pairs_by_cells_are_all_pairs(spark):
    rnd = random.Random(7)
    cards = [(1, f, 100 * f + i, x, y, int(x) - 20, int(y) - 30, int(x) + 20, int(y) + 30, rnd.choice("HDSC"), rnd.choice(["8", "K", "10", "U"])) for f in range(6) for i, (x, y) in enumerate((rnd.uniform(-200, 200), rnd.uniform(-200, 200)) for _ in range(60))]
    df = spark.createDataFrame(cards, "round_id long, frame_id int, det_id long, cx double, cy double, x1 int, y1 int, x2 int, y2 int, suit string, rank string")
    norm = {"K": "T", "10": "T", "8": "8"}
    want = set()
    for a in cards:
        for b in cards:
            if a[1] == b[1] and a[2] < b[2] and norm.get(a[10]) and norm.get(a[10]) == norm.get(b[10]) and math.dist(a[3:5], b[3:5]) <= 60:
                wide, high = min(a[7], b[7]) - max(a[5], b[5]), min(a[8], b[8]) - max(a[6], b[6])
                if wide > 0 and high > 0 and wide * high >= 200:
                    want.add((a[1], a[2], b[2], a[3], b[3]))
    got = [tuple(r) for r in joins.pair_self_join(df).select("frame_id", "a_det_id", "b_det_id", "a_cx", "b_cx").collect()]
    assert len(got) == len(want) > 50 and set(got) == want


@pytest.mark.parametrize("bins", [2, 7, 1024])
def test_percentiles_in_two_passes(spark, bins):
    rnd, data = random.Random(8), []
    for group, n in (("a", 301), ("b", 40), ("c", 1), (None, 12)):
        data += [(group, rnd.choice([1.0, 2.0, rnd.gauss(0, 1), rnd.expovariate(0.001)])) for _ in range(n)] + [(group, None)]
    data += [("same", 5.0)] * 50
    df = spark.createDataFrame(data, "g string, v double").repartition(4)
    for share in (0.0, 0.25, 0.5, 0.75, 1.0):
        got = {r["g"]: r["p"] for r in aggregates.exact_percentile(df, ["g"], "v", share, "p", bins).collect()}
        want = {k: np.percentile([v for x, v in data if x == k and v is not None], 100 * share) for k in {x for x, _ in data}}
        assert got.keys() == want.keys() and all(math.isclose(got[k], want[k], rel_tol=1e-12, abs_tol=1e-12) for k in want)
    assert aggregates.exact_percentile(df, [], "v", 0.5, "p").count() == 1 and aggregates.exact_percentile(df.limit(0), ["g"], "v", 0.5, "p").count() == 0


def test_thresholds_in_one_pass(spark):
    rnd = random.Random(9)
    data = [(rnd.choice([0.1, 0.5, rnd.random()]), rnd.random() < 0.3) for _ in range(500)] + [(None, True), (0.5, None)]
    df = spark.createDataFrame(data, "score double, positive boolean")
    known = [x for x in data if None not in x]
    for r in aggregates.pr_at(df, [0.9, 0.1, 0.5, 2.0, -1.0]).collect():
        t = r["threshold"]
        tp, fp = (sum(s >= t and p == q for s, p in known) for q in (True, False))
        fn, tn = (sum(s < t and p == q for s, p in known) for q in (True, False))
        precision, recall = tp / (tp + fp) if tp + fp else 0, tp / (tp + fn)
        want = ((tp + tn) / len(known), precision, recall, 2 * precision * recall / (precision + recall) if precision + recall else 0)
        assert all(abs(a - b) < 1e-4 for a, b in zip((r["accuracy"], r["precision"], r["recall"], r["f1"]), want))
    assert aggregates.pr_at(df, [0.9, 0.1, 0.5, 2.0, -1.0]).count() == 5 and aggregates.pr_at(df.limit(0), [0.5]).count() == 0


def test_places_of_many_rows(spark, monkeypatch):
    """More parts of the hash give the same places."""
    df = spark.range(3000).withColumn("g", F.col("id") % 3)
    want = sorted(map(tuple, picks.with_place(df, ["g"], ["id"], 1).select("id", "__place", "__size").collect()))
    monkeypatch.setattr(picks, "PART_ROWS", 0.01)
    assert sorted(map(tuple, picks.with_place(df, ["g"], ["id"], 1).select("id", "__place", "__size").collect())) == want
