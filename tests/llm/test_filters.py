"""Quality rules, quality classifier, toxicity and URL filters."""

import datetime
import os
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from roundhouse.llm import common, quality_model, quality_rules, toxicity, url_filter
from roundhouse.llm.textgrid import WordGrid, shingles

SF = "/root/testdata/sf0.01"
KIND = "doc_id long, text string"
ODD = [(1, None), (2, ""), (3, " \t\n"), (4, "one"), (4, "one"), (None, "x"), (5, "wort " * 50_000), (6, "🙂 ## | ! é́")]


def odd(spark):
    return spark.createDataFrame([(*x, "c") for x in ODD], KIND + ", stats string")


def slow_repeat_words(words):
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    hit = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(3)}
    return len(hit)


def test_base_statistics():
    rnd = random.Random(1)
    for _ in range(200):
        text = "".join(rnd.choice(["a ", "b ", "c\t", "d\n", "#", "é ", "\x0b", " ", "\x85", "|$ "]) for _ in range(rnd.randrange(40)))
        words = [w for w in __import__("re").split("[\x20\x09-\x0d]+", text) if w]
        got = quality_rules.statistics(text)
        lines = [x for x in text.split("\n") if __import__("re").search("[^\x20\x09-\x0d]", x)]
        want = (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), sum(x in lines[:i] for i, x in enumerate(lines)), slow_repeat_words(words))
        assert got[:5] == want


def test_rules_fit_and_odd_rows(spark):
    rnd = random.Random(2)
    good = [(i, " ".join(rnd.choice(["alpha", "beta", "gamma", "delta"]) + str(rnd.randrange(9)) for _ in range(90)) + ".") for i in range(80)]
    bad = [(i + 100, " ".join(rnd.choice(["ab", "cd", "ef"]) + "###$$$" + str(rnd.randrange(50)) for _ in range(90))) for i in range(20)]
    df = spark.createDataFrame([(*x, "c") for x in good + bad], KIND + ", stats string").unionByName(odd(spark))
    out = {(r["doc_id"], i): r for i, r in enumerate(quality_rules.judge(df, keep=["doc_id"]).collect())}
    kept = {k[0] for k, r in out.items() if r["__quality"]["kept"]}
    assert kept == set(range(80))
    clash = df.withColumn("__quality", df["doc_id"]).withColumn("__input", df["text"]).withColumn("__stats", df["doc_id"])
    assert quality_rules.keep_good(clash).columns == clash.columns
    assert {r["doc_id"] for r in quality_rules.keep_good(clash).collect()} == kept
    assert quality_rules.judge(clash).columns == [*[c for c in clash.columns if c != "__quality"], "__quality"]
    assert quality_rules.judge(df.limit(0)).count() == 0


def test_em_prefers_agreeing_votes():
    prior, logs = quality_rules.fit([([0] * len(quality_rules.RULES), 90), ([-1, -1] + [0] * (len(quality_rules.RULES) - 2), 10)])
    assert prior > 0 and logs[0][-1] < 0 and logs[0][0] >= 0
    assert quality_rules.fit([])[0] == 0.0


def plain_em(patterns, rounds):
    """Expectation maximisation as in quality_rules.fit, in loops."""
    good = [1 / (1 + math.exp(-(2 + 0.25 * v.count(1) - 4 * v.count(-1)))) for v, _ in patterns]
    total = sum(n for _, n in patterns)
    for _ in range(rounds):
        prior = min(max(sum(g * n for g, (_, n) in zip(good, patterns, strict=True)) / total, 0.5), 0.98)
        logs = []
        for r in range(len(patterns[0][0])):
            seen = [{x: 1.0 for x in (-1, 0, 1)} for _ in (0, 1)]
            for g, (v, n) in zip(good, patterns, strict=True):
                seen[0][v[r]] += g * n
                seen[1][v[r]] += (1 - g) * n
            own = {x: math.log(seen[0][x] / sum(seen[0].values())) - math.log(seen[1][x] / sum(seen[1].values())) for x in (-1, 0, 1)}
            logs.append({-1: min(own[-1], 0), 0: own[0], 1: max(own[1], 0)})
        odds = [math.log(prior / (1 - prior)) + sum(logs[r][x] for r, x in enumerate(v)) for v, _ in patterns]
        good = [1 / (1 + math.exp(-min(max(o, -40), 40))) for o in odds]
    return math.log(prior / (1 - prior)), logs


def test_em_equals_plain_loops():
    rnd = random.Random(6)
    patterns = [([rnd.choice([-1, 0, 0, 1]) for _ in quality_rules.RULES], rnd.randrange(1, 200)) for _ in range(40)]
    prior, logs = quality_rules.fit(patterns, 25)
    want, tables = plain_em(patterns, 25)
    assert abs(prior - want) < 1e-9
    assert all(abs(logs[r][x] - t[x]) < 1e-9 for r, t in enumerate(tables) for x in (-1, 0, 1))


def labelled(spark, label):
    return common.labelled(spark, SF, label)


def auc(rows, label):
    y, s = np.array([r[label] for r in rows]), np.array([r["score"] for r in rows])
    return np.mean([(a > b) + 0.5 * (a == b) for a in s[y == 1] for b in s[y == 0]])


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables here")
def test_quality_classifier_held_out(spark):
    docs = common.table(spark, SF, "documents")
    out = quality_model.scored(*quality_model.fit_documents(docs, labelled(spark, "quality")))
    rows = out.where("held_out").join(common.table(spark, SF, "labels"), "doc_id").collect()
    assert auc(rows, "quality") > 0.9 and all(0 <= r["score"] <= 1 for r in rows)


def test_quality_classifier_odd(spark):
    none = spark.createDataFrame([], "doc_id long, label int")
    out = quality_model.scored(*quality_model.fit_documents(odd(spark), none)).collect()
    assert [(r["score"], r["predicted"]) for r in out] == [(0.5, 1)] * len(ODD)
    labels = spark.createDataFrame([(i, i % 2) for i in range(1, 7)], "doc_id long, label int")
    assert quality_model.keep_good(odd(spark), labels).columns == odd(spark).columns
    assert quality_model.scored(*quality_model.fit_documents(odd(spark).limit(0), labels)).count() == 0


def test_partition_sums_equal_one_system(spark):
    rnd = np.random.default_rng(3)
    x = rnd.normal(size=(400, quality_model.FEATURES)).astype(np.float32)
    rows = spark.createDataFrame([(bytearray(v.tobytes()), int(v[0] + v[1] > 0), 1 + i % 4) for i, v in enumerate(x)], "stats binary, label int, fold int").repartition(5)
    model = quality_model.fit(rows)
    z = model.cosines(x.astype(float))
    y = np.array([int(v[0] + v[1] > 0) for v in x])
    direct = np.linalg.solve(z.T @ z + quality_model.RIDGE * np.eye(z.shape[1]), z.T @ y)
    assert np.allclose(model.weights[:, 4], direct, atol=1e-6)
    assert (np.diff(model.level) >= 0).all()
    assert ((model.score(x.astype(float)) > 0.5) == y).mean() > 0.9


def test_isotonic():
    at, level = quality_model.isotonic(np.array([0.0, 1, 2, 3]), np.array([1.0, 0, 5, 9]), np.array([10.0, 10, 10, 10]))
    assert len(at) == 3 and (np.diff(level) > 0).all()


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables here")
def test_toxicity_held_out(spark):
    docs = common.table(spark, "/root/testdata/sf0.1", "documents")
    labels = common.labelled(spark, "/root/testdata/sf0.1", "toxic")
    out = toxicity.score(docs, toxicity.fit(docs, labels))
    rows = out.where("held_out").join(common.table(spark, "/root/testdata/sf0.1", "labels"), "doc_id").collect()
    hit = [r["predicted"] for r in rows if r["toxic"] == 1]
    clean = [r["predicted"] for r in rows if r["toxic"] == 0]
    assert np.mean(hit) > 0.8 and np.mean(clean) < 0.02


def lexicon(words):
    grid = WordGrid([" ".join(words)])
    return np.sort(toxicity.pieces(grid)[0])


def test_grammar_scores_clauses():
    lex = toxicity.Lookup(lexicon(["idiot"]))
    s = lambda text: sum(toxicity.clause_scores(toxicity.clause_events([text], lex)[1]))
    assert s("an idiot") == 1.0 and s("nothing here") == 0.0 and s("") == 0.0
    assert s("you are an idiot") > s("an idiot") > s("not an idiot") > 0
    assert s("it was said an idiot") < s("an idiot")
    assert s("kill you") > 0 and s("kill time") == 0.0
    assert s("an idiot. an idiot") == 2.0


def test_composition_equals_the_machines_one_by_one():
    rnd, parts = random.Random(5), toxicity._grammar()
    composed = toxicity.Composed(parts)
    for _ in range(3000):
        classes = [rnd.choice([0, 0, 1, 2, 3, 4, 5]) for _ in range(rnd.randrange(1, 14))]
        counts, accepted = [0] * len(toxicity.EVENTS), False
        for machine in parts:
            state = 0
            for c in classes:
                state, event = machine.arcs.get((state, c), (state, None))
                if event is not None:
                    counts[event] += 1
            accepted |= state in machine.final
        assert composed.events(classes) == (counts if accepted else None)


def test_weights_are_learned_and_keep_their_signs():
    rnd = np.random.default_rng(3)
    events = np.zeros((4000, len(toxicity.EVENTS) + 1))
    hit = rnd.random(4000) < 0.5
    events[hit, toxicity.FIRST] = events[hit, -1] = 1
    events[hit & (rnd.random(4000) < 0.5), toxicity.NEGATED] = 1  # an insult that is negated says nothing here
    y = (hit & (events[:, toxicity.NEGATED] == 0) & (rnd.random(4000) < 0.95)).astype(float)
    weights, slope, _ = toxicity.learn_weights(events, y, np.ones(4000))
    assert weights[toxicity.NEGATED] < toxicity.PRIOR[toxicity.NEGATED] and slope > 0
    assert (np.sign(weights) * np.sign(toxicity.PRIOR) >= 0).all() and weights[toxicity.AT_TARGET] == toxicity.PRIOR[toxicity.AT_TARGET]


def test_words_with_apostrophes_are_no_loose_letters():
    lex = toxicity.Lookup(lexicon(["idiot"]))
    s = lambda text: sum(toxicity.clause_scores(toxicity.clause_events([text], lex)[1]))
    assert s("je t'aime idiot") == s("je aime idiot")
    assert s("he isn't an idiot") < s("he is an idiot")


def test_toxicity_odd(spark):
    none = spark.createDataFrame([], "doc_id long, label int")
    rows = toxicity.score(odd(spark), toxicity.fit(odd(spark), none)).collect()
    assert len(rows) == len(ODD) and {r["predicted"] for r in rows} == {0}
    assert toxicity.score(odd(spark).limit(0), toxicity.fit(odd(spark), none)).count() == 0


def test_word_grid():
    import re

    texts = ["Über die Brücke, 42 x_y!", "", "a", "é́ b", "x" * 5000]
    grid = WordGrid(texts)
    assert grid.words_per_text().tolist() == [5, 0, 1, 2, 1]
    low = WordGrid([t.lower() for t in texts])
    assert grid.hashes.tolist() == low.hashes.tolist()
    words = [w for t in texts for w in re.findall(r"[\ẃ]+", t.lower())]
    assert len(set(words)) == len(set(grid.hashes.tolist()))
    runs, doc = shingles(WordGrid(["a b c d e f", "b c d e f", "a b"]), 5)
    assert doc.tolist() == [0, 0, 1, 2] and runs[1] == runs[2] and runs[0] != runs[3]


DAY = datetime.date


def entries(spark):
    rows = [("ads", "x.org", DAY(2024, 1, 10), "add"), ("ads", "x.org", DAY(2024, 2, 1), "remove"), ("ads", "x.org", DAY(2024, 3, 1), "add"), ("bad", "a.x.org/p", DAY(2024, 1, 1), "add"),
            ("ads", "y.org", DAY(2024, 1, 1), "add"), ("ads", "y.org", DAY(2024, 1, 1), "remove"), (None, "z.org", DAY(2024, 1, 1), "add"), ("ads", "z.org", None, "add")]
    return spark.createDataFrame(rows, "list string, pattern string, day date, action string")


@pytest.mark.parametrize("small", [200_000, 0])
def test_url_filter(spark, small):
    pages = [
        (1, "https://a.x.org/p/q?u=1", DAY(2024, 1, 15)), (2, "http://user@X.ORG:80/", DAY(2024, 1, 10)), (3, "http://x.org/", DAY(2024, 1, 9)), (4, "http://x.org/", DAY(2024, 2, 1)), (5, "http://x.org/", DAY(2025, 1, 1)),
        (6, "http://y.org", DAY(2024, 5, 1)), (7, None, DAY(2024, 5, 1)), (8, "nonsense", DAY(2024, 5, 1)), (9, "http://x.org", None), (10, "http://a.x.org/pp", DAY(2024, 1, 15)), (1, "https://a.x.org/p/q?u=1", DAY(2024, 1, 15)), (11, "http://ax.org/", DAY(2024, 1, 15)), (12, "http://z.org/", DAY(2024, 6, 1)),
    ]
    df = spark.createDataFrame([(*p, "l") for p in pages], "page_id long, url string, fetch_day date, list string")
    out = url_filter.filtered(df, entries(spark), small).collect()
    assert sorted((r["page_id"], r["list"] or "", r["pattern"] or "") for r in out) == sorted(
        [(1, "bad", "a.x.org/p")] * 2 + [(2, "ads", "x.org"), (3, "", ""), (4, "", ""), (5, "ads", "x.org"), (6, "", ""), (7, "", ""), (8, "", ""), (9, "", ""), (10, "ads", "x.org"), (11, "", ""), (12, "", "")]
    )
    assert url_filter.filtered(df.limit(0), entries(spark)).count() == 0
    assert url_filter.filtered(df, entries(spark).limit(0)).where(F.col("blocked")).count() == 0


@pytest.mark.parametrize("small", [200_000, 0])
def test_deep_url_patterns(spark, small):
    rows = [("bad", "x.org/a/b/c/d", DAY(2024, 1, 1), "add"), ("ads", "x.org/a", DAY(2024, 1, 1), "add"), ("old", "x.org/a/b/c/d/e", DAY(2024, 1, 1), "remove")]
    listed = spark.createDataFrame(rows, "list string, pattern string, day date, action string")
    long = "http://x.org/a/b/c/d/" + "e/" * 20_000 + "?" + "q" * 100_000
    pages = [(5, long), (6, "http://" + "s." * 300 + "x.org/a"), (7, "http://org/a"), (1, "http://x.org/a/b/c/d/e/f?q=1"), (2, "http://w.x.org/a//b/c/d"), (3, "http://x.org/a/b/c/dd"), (4, "http://x.org/b/a/b/c/d")]
    df = spark.createDataFrame([(*p, DAY(2024, 2, 1)) for p in pages], "page_id long, url string, fetch_day date")
    out = url_filter.filtered(df, listed, small).collect()
    assert sorted((r["page_id"], r["pattern"] or "") for r in out) == [(1, "x.org/a/b/c/d"), (2, "x.org/a/b/c/d"), (3, "x.org/a"), (4, ""), (5, "x.org/a/b/c/d"), (6, "x.org/a"), (7, "")]


def test_slices_keep_every_row_in_order():
    import pyarrow as pa

    texts = ["a" * 50, None, "", "b" * 500, "c", "d" * 90]
    batch = pa.RecordBatch.from_arrays([pa.array(range(6)), pa.array(texts)], names=["i", "t"])
    for limit in (1, 60, 100, 10_000):
        parts = list(common.slices([batch, batch.slice(2, 3), batch.slice(0, 0)], 1, limit))
        assert [x for p in parts for x in p.column(0).to_pylist()] == [0, 1, 2, 3, 4, 5, 2, 3, 4]
        assert all(p.num_rows == 1 or sum(len(x or "") for x in p.column(1).to_pylist()) <= limit for p in parts)
