"""Operators for tables that are too large for the plain way, against it."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from roundhouse.operators import joins, sequences, similarity


def vectors(spark, rows, prefix):
    return spark.createDataFrame([(i, [float(y) for y in x]) for i, x in rows], f"{prefix}_id long, {prefix}_vec array<double>")


def near(rng, base, cosine):
    """A vector at that cosine to base."""
    noise = rng.standard_normal(len(base))
    noise -= noise @ base / (base @ base) * base
    return cosine * base / np.linalg.norm(base) + np.sqrt(1 - cosine**2) * noise / np.linalg.norm(noise)


def test_hashed_search_finds_what_full_search_finds(spark):
    rng = np.random.default_rng(1)
    gallery = rng.standard_normal((6000, 24))
    gallery[5000:] = gallery[0]  # a bucket of very many equal vectors
    asked = [(k, near(rng, gallery[rng.integers(5000)], c)) for k, c in enumerate(np.repeat([0.8, 0.85, 0.9, 0.97, 1.0], 200))]
    asked += [(2000 + k, gallery[0]) for k in range(150)] + [(3000, -gallery[0])]
    g, q = vectors(spark, list(enumerate(gallery)), "g"), vectors(spark, asked, "q")
    want = {r["q_id"]: (r["best"], r["g_id"]) for r in joins.top1_similarity(q, g).collect() if r["best"] >= 0.8}
    got = {r["q_id"]: (r["best"], r["g_id"]) for r in similarity.top1_similarity_hashed(q, g, least=0.8, miss=0.01, block_rows=100).collect()}
    assert got.keys() <= want.keys() and all(v[0] <= want[k][0] for k, v in got.items())
    found = [got.get(k) == v for k, v in want.items()]
    assert len(want) > 1000 and sum(found) / len(found) >= 0.98
    assert all(got[k] == want[k] for k in range(2000, 2150)) and got[2000][1] == 0
    empty = similarity.top1_similarity_hashed(q, g.limit(0))
    assert empty.count() == 0 and similarity.top1_similarity_hashed(q.limit(0), g).count() == 0


def test_hashed_search_meets_few_rows(spark):
    """Eight times the gallery: the full search compares eight times as much for a query, the hashed one hardly more."""
    rng, met = np.random.default_rng(2), []
    q = vectors(spark, [(k, rng.standard_normal(32)) for k in range(200)], "q").toDF("id", "vec")
    for n in (4000, 32000):
        g = vectors(spark, list(enumerate(rng.standard_normal((n, 32)))), "g").toDF("id", "vec")
        tables, bits = similarity.plan_hashes(n, 0.9, 0.01, bucket_rows=64)
        hit = similarity.buckets(similarity.keyed(g, tables, bits, 1, False, False), similarity.keyed(q, tables, bits, 1, True, False), 1000)
        met.append(hit.agg(F.sum(F.col("own") * F.col("asked"))).first()[0] / 200 / n)
    assert met[1] < 0.4 * met[0]


def test_plan_of_hashes():
    for rows in (1, 300, 10**6):
        tables, bits = similarity.plan_hashes(rows, 0.95, 0.001)
        same = 1 - np.arccos(0.95) / np.pi
        assert (1 - same**bits - bits * (1 - same) * same ** (bits - 1)) ** tables <= 0.001
    assert similarity.plan_hashes(10**6, 1.0, 0.001)[0] == 1
    with pytest.raises(ValueError, match="compare in full"):
        similarity.plan_hashes(10**9, 0.3, 1e-9)


def slow_nms(rows, iou, topn):
    kept = []
    for score, s, i, e in sorted((-r[3], r[1], r[0], r[2]) for r in rows):
        over = [(max(0, min(e, k[2]) - max(s, k[1])), k) for k in kept]
        if len(kept) < topn and not any((union := (e - s) + (k[2] - k[1]) - o) > 0 and o / union > iou for o, k in over):
            kept.append((i, s, e, -score))
    return [(n, *k) for n, k in enumerate(kept)]


@pytest.mark.parametrize("most", [0, 20, 10**9])
def test_suppression_by_rounds(spark, most):
    rnd, data = random.Random(3), []
    for group, n in (("a", 400), ("b", 30), ("c", 1)):
        for i in range(n):
            s = rnd.randrange(900 if group == "a" else 5000)
            data.append((group, i, s, s + rnd.choice([0, 5, 30, 60]), round(rnd.random(), 2)))
    data += [("same", i, 10, 40, rnd.choice([0.1, 0.5])) for i in range(200)]  # equal intervals
    data += [("slope", i, 4 * i, 4 * i + 40, 1 - i / 100) for i in range(40)]  # each is beaten by the one before
    df = spark.createDataFrame(data, "g string, seg_id long, start_frame int, end_frame int, score double")
    for iou, topn in ((0.3, 10), (0.0, 1000), (1.0, 5)):
        got = sorted(tuple(r) for r in sequences.nms_1d(df, ["g"], iou, topn, most).collect())
        want = sorted((g, *k) for g in {x[0] for x in data} for k in slow_nms([x[1:] for x in data if x[0] == g], iou, topn))
        assert got == want
    assert sequences.nms_1d(df.limit(0), ["g"], most=most).count() == 0
