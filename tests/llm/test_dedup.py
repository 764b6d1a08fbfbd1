"""Exact, near and line deduplication against brute force, and their awkward inputs."""

import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from roundhouse.llm import exact_dedup, line_dedup, near_dedup

KIND = "doc_id long, text string"
WORDS = [f"w{i}" for i in range(400)]


def prose(rnd, n):
    return " ".join(rnd.choice(WORDS) for _ in range(n))


def edited(rnd, text, n):
    words = text.split()
    for i in rnd.sample(range(len(words)), n):
        words[i] = rnd.choice(WORDS) + "x"
    return " ".join(words)


def corpus(rnd):
    out = []
    for _ in range(12):
        base = prose(rnd, 120)
        out += [base, edited(rnd, base, 1), edited(rnd, base, 2), edited(rnd, base, 4), base.upper() + "!"]
    family = prose(rnd, 150)
    out += [edited(rnd, family, rnd.randrange(1, 6)) for _ in range(40)]
    return [(7 * i + 3, x) for i, x in enumerate(out)] + [(1000, None), (1001, ""), (1002, "one two"), (1003, "one two"), (None, "no id"), (1004, "word " * 30_000)]


def brute_classes(docs):
    docs = [(i, t) for i, t in docs if i is not None]
    found = [near_dedup.weighted_sets([t or ""]) for _, t in docs]
    every = near_dedup.weighted_sets([t or "" for _, t in [*docs, (None, "no id")]])
    counts = np.stack([np.bincount(near_dedup.buckets_of(every[1], k), minlength=1 << near_dedup.DF_BITS) for k in range(near_dedup.DF_ROWS)])
    idf = near_dedup.idf_table(counts, len(np.unique(every[0])))
    sets = [near_dedup.unpack(near_dedup.pack(x[1], x[2]).tobytes(), idf) if len(x[1]) else None for x in found]
    comp = {i: i for i, _ in docs}
    for (a, x), (b, y) in itertools.combinations([(i, s) for (i, _), s in zip(docs, sets, strict=True) if s is not None], 2):
        if near_dedup.weighted_jaccard(*x, *y) >= near_dedup.SIMILARITY:
            old, new = max(comp[a], comp[b]), min(comp[a], comp[b])
            comp = {k: new if v == old else v for k, v in comp.items()}
    return comp


@pytest.mark.parametrize("agree", [near_dedup.AGREE, 0])
def test_near_classes_equal_brute_force(spark, agree):
    docs = corpus(random.Random(1))
    df = spark.createDataFrame([(*x, 1, "z") for x in docs], KIND + ", id long, comp string")
    got = {r["doc_id"]: r["class_id"] for r in near_dedup.classes(df, agree).collect()}
    assert got == brute_classes(docs)
    kept = near_dedup.keep_one(df)
    assert kept.columns == df.columns
    assert sorted(r["doc_id"] for r in kept.collect() if r["doc_id"] is not None) == sorted({v for v in got.values()})
    assert kept.where("doc_id is null").count() == 1


def test_recall_by_similarity(spark):
    """Pairs of texts of their own words, by their true similarity: those of 0.8 or more are found, no other one is linked."""
    rnd = random.Random(9)
    docs, true = [], {}
    for i in range(240):
        base = " ".join(f"p{i}w{rnd.randrange(500)}" for _ in range(150))
        docs += [(2 * i, base), (2 * i + 1, edited(rnd, base, i % 8))]
    spread = near_dedup.weighted_sets([t for _, t in docs])
    counts = np.stack([np.bincount(near_dedup.buckets_of(spread[1], k), minlength=1 << near_dedup.DF_BITS) for k in range(near_dedup.DF_ROWS)])
    idf = near_dedup.idf_table(counts, len(docs))
    sets = {d: near_dedup.unpack(near_dedup.pack(spread[1][spread[0] == k], spread[2][spread[0] == k]).tobytes(), idf) for k, (d, _) in enumerate(docs)}
    for i in range(0, 480, 2):
        true[i] = near_dedup.weighted_jaccard(*sets[i], *sets[i + 1])
    got = {r["doc_id"]: r["class_id"] for r in near_dedup.classes(spark.createDataFrame(docs, KIND)).collect()}
    for low, high, least in ((0.8, 0.9, 0.95), (0.9, 1.01, 0.99)):
        own = [i for i, x in true.items() if low <= x < high]
        found = sum(got[i + 1] == i for i in own)
        print(f"similarity {low} to {high}: {found} of {len(own)} pairs found")
        assert len(own) > 20 and found >= least * len(own)
    assert not [i for i, x in true.items() if x < 0.8 and got[i + 1] == i]
    assert [i for i, x in true.items() if x < 0.8]


def test_near_repeated_ids_and_empty(spark):
    df = spark.createDataFrame([(1, "a b c d e f"), (1, "u v w x y z"), (2, "u v w x y z")], KIND)
    assert sorted((r[0], r[1]) for r in near_dedup.classes(df).collect()) == [(1, 1), (2, 1)]
    assert near_dedup.classes(df.limit(0)).count() == 0


def test_icws_estimates_weighted_jaccard():
    rnd = np.random.default_rng(2)
    keys = np.sort(rnd.integers(0, 1 << 52, 600, dtype=np.uint64))
    w = rnd.uniform(0.5, 3, 600).astype(np.float32)
    a, b = np.arange(600) < 500, np.arange(600) >= 100
    doc = np.concatenate([np.zeros(500, np.int64), np.ones(500, np.int64)])
    _, samples = near_dedup.icws(doc, np.concatenate([keys[a], keys[b]]), np.concatenate([w[a], w[b]]))
    true = near_dedup.weighted_jaccard(keys[a], w[a], keys[b], w[b])
    assert abs((samples[0] == samples[1]).mean() - true) < 0.17


def test_pack_large_counts():
    shingle, tf = np.array([5, 9], np.uint64), np.array([10_000, 2])
    s, w = near_dedup.unpack(near_dedup.pack(shingle, tf).tobytes(), np.ones((near_dedup.DF_ROWS, 1 << near_dedup.DF_BITS), np.float32))
    assert s.tolist() == [5, 9] and w.tolist() == [10_000, 2]


def test_blocks_split_large_buckets(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOCK_NODES", 8)
    docs = corpus(random.Random(3))
    got = {r["doc_id"]: r["class_id"] for r in near_dedup.classes(spark.createDataFrame(docs, KIND)).collect()}
    assert got == brute_classes(docs)


def test_blocks_are_bounded_by_bytes(spark, monkeypatch):
    """Nodes of many shingles are dealt into more blocks; the classes stay the same."""
    monkeypatch.setattr(near_dedup, "BLOCK_BYTES", 2000)
    docs = corpus(random.Random(4))
    got = {r["doc_id"]: r["class_id"] for r in near_dedup.classes(spark.createDataFrame(docs, KIND)).collect()}
    assert got == brute_classes(docs)
    members = spark.createDataFrame([(1, i, i) for i in range(40)] + [(2, i, 0) for i in range(40)] + [(2, 77, 77)], "key long, id long, comp long")
    nodes = spark.createDataFrame([(i, b"", [1], 1000) for i in [*range(40), 77]], "id long, prints binary, bands array<long>, size long")
    found = near_dedup.blocks_of(members.join(nodes.select("id", "size"), "id"), nodes).groupBy("key", "i", "j").count().collect()
    assert max(r["count"] for r in found) <= 20 and len([r for r in found if r["key"] == 1]) > 100


def exact_cases(spark):
    data = [(3, "a", "x"), (1, "a", "y"), (9, "b", "z"), (2, None, "n"), (4, "", "n"), (5, "c", "r"), (5, "c", "r"), (None, "c", "q"), (None, "d", "q"), (7, "A", "k")]
    return spark.createDataFrame(data, "doc_id long, text string, digest string")


@pytest.mark.parametrize("largest", [True, False])
@pytest.mark.parametrize(("memtable_rows", "small"), [(2, 200_000), (100_000, 0)])
def test_exact(spark, largest, memtable_rows, small):
    df = exact_cases(spark).withColumn("__body", F.lit(1)).withColumn("__keep", F.col("text"))
    how = {"largest": largest, "memtable_rows": memtable_rows, "small": small}
    rows = exact_dedup.assign(df, **how).collect()
    assert len(rows) == df.count()
    pick = max if largest else min
    groups = {}
    for r in df.collect():
        groups.setdefault(r["text"] or "", []).append(r["doc_id"])
    import hashlib

    by = {hashlib.sha256(k.encode()).hexdigest(): v for k, v in groups.items()}
    for r in rows:
        ids = by[r["text_sha256"]]
        assert r["group_size"] == len(ids)
        assert r["keep_id"] == pick((x for x in ids if x is not None), default=None)
    assert sum(r["kept"] for r in rows) == len(groups)
    kept = exact_dedup.keep_one(df, **how)
    assert kept.columns == df.columns and kept.count() == len(groups)


def test_exact_digest_collisions_are_split(spark):
    df = exact_cases(spark)
    rows = exact_dedup.assign(df, digest=lambda c: F.lower(F.sha2(F.lower(c), 256))).collect()
    assert sum(r["kept"] for r in rows) == len({r["text"] or "" for r in df.collect()})
    assert exact_dedup.assign(df.limit(0)).count() == 0


def test_exact_long_texts_and_filter(spark):
    long = "long text " * 300_000
    df = spark.createDataFrame([(1, long), (2, long + "x"), (3, long), *[(10 + i, f"text {i % 700}") for i in range(1000)]], KIND)
    rows = {r["doc_id"]: r for r in exact_dedup.assign(df, memtable_rows=50).collect()}
    assert [(rows[i]["keep_id"], rows[i]["group_size"]) for i in (1, 2, 3)] == [(3, 2), (2, 1), (3, 2)]
    assert sum(r["kept"] for r in rows.values()) == 702
    docs, index = exact_dedup.indexed(df)
    known = {r["__doc_id"] for r in exact_dedup.probed(docs.select("__doc_id", "__digest"), index).where("__hit").collect()}
    copies = {i for i, r in rows.items() if r["group_size"] > 1}
    assert copies <= known and len(known - copies) < 10


def distance_one(a, b):
    if a == b:
        return True
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    if abs(len(a) - len(b)) != 1:
        return False
    long, short = (a, b) if len(a) > len(b) else (b, a)
    return any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


@pytest.mark.parametrize(("long", "least"), [(2048, 5), (9, 5), (2048, 2)])
def test_lines_equal_brute_force(spark, monkeypatch, long, least):
    monkeypatch.setattr(line_dedup, "LONG", long)
    rnd = random.Random(4)
    docs = []
    bases = [[rnd.choice(WORDS[:30]) for _ in range(rnd.randrange(2, 16))] for _ in range(25)] + [["a"] * 6, ["a", "b"] * 3]
    for i in range(60):
        lines = []
        for _ in range(rnd.randrange(4)):
            w = list(rnd.choice(bases))
            move = rnd.randrange(5)
            at = rnd.randrange(len(w))
            if move == 0:
                w[at] = "new"
            elif move == 1 and len(w) > 1:
                del w[at]
            elif move == 2:
                w.insert(at, "more")
            elif move == 3 and len(w) > 3:
                w[0], w[-1] = w[-1], w[0]
            lines.append("  ".join(w) if rnd.random() < 0.2 else " ".join(w) + "\t")
        docs.append((i, "\n".join(lines)))
    docs += [(100, None), (101, "\n \n"), (102, " ".join(WORDS)), (103, " ".join(WORDS) + " end")]
    df = spark.createDataFrame([(*d, "x") for d in docs], KIND + ", key string")
    lines = [(d, n, x.split()) for d, t in docs for n, x in enumerate((t or "").split("\n")) if x.split()]
    want = []
    for d, n, w in lines:
        near = [(e, m) for e, m, v in lines if v == w or (len(w) >= least and len(v) >= least and distance_one(w, v))]
        want.append((d, n, len(w), *min(near), (d, n) == min(near)))
    assert sorted(map(tuple, line_dedup.dedup_lines(df, least).collect())) == sorted(want)
    assert line_dedup.dedup_lines(df.limit(0)).count() == 0
