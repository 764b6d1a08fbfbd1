"""Checksums of the derived tables at the smallest scale, computed by hand beforehand in both engines."""

import os

import pytest
from pyspark.sql import functions as F

from roundhouse.operators import joins, scalar
from roundhouse.plans.fixtures import Inputs

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables here")


@pytest.fixture(scope="module")
def t(spark):
    return Inputs(spark, SF)


def test_detections(t):
    d = t.detections
    assert tuple(d.agg(F.count("*"), F.count_distinct("round_id"), F.sum("cx").cast("long"), F.sum(F.col("cy") * F.col("det_id")).cast("long")).first()) == (6000, 10, 5561371, 1321197666)
    assert tuple(d.groupBy("round_id", "frame_id").count().agg(F.count("*"), F.max("count")).first()) == (600, 19)


def test_zones(t):
    d = scalar.scale_dets(t.detections)
    assert [d.where(scalar.in_zone(z)).count() for z in ("dealer", "hit", "tap")] == [954, 4706, 2980]


def test_pairs(t):
    assert joins.pair_self_join(t.dets720, max_distance=1e9, min_overlap=-1).count() == 3828
    assert joins.pair_self_join(t.dets720).count() == 2584


def test_seats(t):
    found = {r["seat"]: r["count"] for r in joins.assign_seats_template(t.detections).groupBy("seat").count().collect() if r["seat"] is not None}
    assert found == {0: 1462, 1: 509, 2: 960, 5: 501, 6: 513, 7: 1182}


def test_segments_and_hands(t):
    n = {r["label"]: r["count"] for r in t.segments.groupBy("label").count().collect()}
    assert [n[x] for x in ("hit", "call for action", "split", "tap", "dealer hits", "initial hands 1st", "clean hand")] == [140, 139, 136, 136, 141, 77, 77]
    assert tuple(t.hands.agg(F.count("*"), F.count_distinct("frame_id"), F.count_if(F.col("x8") == 0)).first()) == (1500, 75, 82)


def test_chunks(t):
    s = joins.chunk_slices(t.rounds, t.chunks)
    assert tuple(s.agg(F.count("*"), F.count_distinct("round_id"), F.sum(F.col("slice_to") - F.col("slice_from"))).first()) == (560, 122, 142041)


def test_others(t):
    assert tuple(t.keypoints.agg(F.count("*"), F.count_distinct("kp_label")).first()) == (6000, 9)
    assert tuple(t.tasks.agg(F.count("*"), F.count("updated_at"), F.count("created_at"), F.count_if("was_cancelled")).first()) == (87, 50, 75, 18)
    assert tuple(t.frame_text.agg(F.count("*"), F.count_distinct("round_id"), F.count_if(F.col("text").startswith("GAME PAUS3D"))).first()) == (200, 50, 23)
    assert tuple(t.boxes.agg(F.count("*"), F.sum("x1"), F.sum("y2")).first()) == (2425, 2140080, 1917666)
