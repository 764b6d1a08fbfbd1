"""The pipeline's stages, and the SQL twins of the operators' queries."""

import os
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from test_dedup import brute_classes
from tokenizers import Tokenizer

import corpus_pipeline
from roundhouse.llm import common, quality_model, quality_rules, queries
from roundhouse.plans.fixtures import GIVEN

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables here")


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    before = docs.count()
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        if name == "packing":
            assert out.select("doc_id").distinct().count() == docs.count()
            break
        assert out.columns == docs.columns
        assert 0 < out.count() <= before
        docs, before = out, out.count()


def test_run(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "quality_classifier", "exact_dedup", "minhash_near_dedup", "packing"]
    assert corpus_pipeline.run(spark, SF).count() > 0


def plain_rules(texts):
    """Which texts the quality rules keep, from whole-text statistics, vote patterns and posteriors in loops."""
    names = [x.split()[0] for x in quality_rules.STATS.split(", ")]
    stats = [dict(zip(names, quality_rules.statistics(x or ""), strict=True)) for x in texts]
    failed = [s["n_words"] < 50 or 100 * s["n_repeat_words"] > 50 * s["n_words"] for s in stats]

    def votes(s):
        out = []
        for share, good, bad in quality_rules.RULES.values():
            x = eval(share, {"greatest": max}, s)
            out.append(-1 if bad is not None and x >= bad else 1 if good is not None and x <= good else 0)
        return out

    seen = [votes(s) for s in stats]
    counts = Counter(tuple(v) for v, bad in zip(seen, failed, strict=True) if not bad)
    prior, logs = quality_rules.fit(sorted((list(v), n) for v, n in counts.items()))
    return [not bad and prior + sum(logs[r][x] for r, x in enumerate(v)) >= 0 for v, bad in zip(seen, failed, strict=True)]


def test_every_stage_equals_plain_loops(spark):
    """Each stage on what the one before has kept, against decisions made text by text."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)

    def rows(df):
        return sorted((r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect())

    def check(name, wanted):
        out = stages[name](spark, docs, SF)
        assert rows(out) == sorted(wanted)
        return out

    own = rows(docs)
    docs = check("quality_rules", [x for x, good in zip(own, plain_rules([t for _, t in own]), strict=True) if good])
    own = rows(docs)
    _, model = quality_model.fit_documents(docs, common.labelled(spark, SF, "quality"))
    good = model.score(quality_model.statistics_batches([t or "" for _, t in own])) >= quality_model.GOOD
    docs = check("quality_classifier", [x for x, k in zip(own, good, strict=True) if k])
    largest = {}
    for i, t in rows(docs):
        largest[t] = max(i, largest.get(t, i))
    docs = check("exact_dedup", [(i, t) for t, i in largest.items()])
    own = rows(docs)
    least = brute_classes(own)
    docs = check("minhash_near_dedup", [x for x in own if least[x[0]] == x[0]])
    library = Tokenizer.from_file(queries.tokenizer_path())
    pieces = defaultdict(list)
    for r in stages["packing"](spark, docs, SF).collect():
        pieces[r["doc_id"]].append(r)
    for i, t in rows(docs):
        ids = np.array([*library.encode(t or "", add_special_tokens=False).ids, 1], np.uint32)
        own = sorted(pieces.pop(i), key=lambda r: r["start"])
        assert [r["start"] for r in own] == [0, *np.cumsum([r["length"] for r in own])[:-1]] and sum(r["length"] for r in own) == len(ids)
        assert all(r["ids_crc32"] == zlib.crc32(ids[r["start"] : r["start"] + r["length"]].tobytes()) for r in own)
    assert not pieces


def test_run_on_odd_rows(spark, tmp_path):
    """Nulls in any column, empty and very long texts, repeated rows, ties, extra and clashing columns; then an empty table."""
    words = [f"word{i % 97} and{i % 31}" for i in range(400)]
    good = ". ".join(" ".join(words[k : k + 12]) for k in range(0, 400, 12)) + "."
    rows = [(1, good, "en"), (1, good, "en"), (2, good, None), (None, good, "en"), (None, None, None), (3, None, "de"), (4, "", "en"), (5, " \n\t", "en"), (6, good.replace("word5", "other"), "fr"), (7, good + " end " * 100_000, "en"), (None, "a null id. " + good[:-9], "en")]
    docs = spark.createDataFrame([(*x, 1, "c") for x in rows], "doc_id long, text string, lang string, __stats long, __quality string")
    labels = spark.createDataFrame([(1, 1, 0), (6, 0, 0), (None, 1, None)], "doc_id long, quality int, toxic int")
    for name, table in (("documents", docs), ("labels", labels)):
        table.write.parquet(f"{tmp_path}/odd/{name}.parquet")
        table.limit(0).write.parquet(f"{tmp_path}/empty/{name}.parquet")
    out = [r["doc_id"] for r in corpus_pipeline.run(spark, f"{tmp_path}/odd").select("doc_id").distinct().collect()]
    assert not {3, 4, 5} & set(out) and 1 not in out and len(out) == len(set(out))  # without words; 2 is the largest id of the text of 1
    assert corpus_pipeline.run(spark, f"{tmp_path}/empty").count() == 0


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_sql_twins(spark, name):
    frame = queries.QUERIES[name](spark, SF)
    con = duckdb.connect()
    for table in GIVEN:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    found = con.execute(queries.ORACLE_SQL[name])
    columns = [x[0] for x in found.description]
    assert sorted(columns) == sorted(frame.columns)
    plain = lambda v: v if v is None or isinstance(v, bool) else str(v)
    want = sorted(repr([plain(r[columns.index(n)]) for n in sorted(columns)]) for r in found.fetchall())
    assert sorted(repr([plain(r[n]) for n in sorted(columns)]) for r in frame.collect()) == want
