"""Divergence of sources: how far the term counts of each source are from those of the other sources of its language.

Every task counts terms and the documents that hold them by (lang, source) and sends what it has whenever its tables are
full, so neither a hot source nor a hot word is one task's work. A language keeps the terms of at least `least`
documents. Counts become shares in parts of a billion: p = 1 + floor(10**9 (count + 2) / (N + 2 V)), where N is the sum
of a group's counts and V the number of kept terms; f(p, q) = floor((p - q)**2 / (p + q)). All is exact: numerators
beyond 64 bits are Python's or decimal integers.

The sum of f over all kept terms of each pair of sources is taken over run-length columns. The vocabulary is reordered so
that terms with equal counts in all sources lie together: terms with the same column of counts become one entry with a
length (added up before the shuffle), and entries are sorted by that column. Each source is then a short list of runs of
equal counts; the runs of a pair are intersected, and f is multiplied by the length of each piece. Zeros are runs too.

Null text, lang and source count as ''. Every occurring (lang, source) is a group, also without terms; a language
without kept terms has value 0 for its pairs and no term rows. Repeated rows are documents each; extra columns are passed
over; ties are ranked by item in UTF-8 order; an empty table gives an empty result. The result has a row for each pair
of sources of a language, so the table of groups, whose square that is, goes to every task.
"""

from __future__ import annotations

from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roundhouse.llm.common import few, slices, small_batches, stored
from roundhouse.llm.terms import LETTERS, terms_of

#: Documents that must hold a term of the vocabulary.
LEAST = 10
#: Ranks of the term part.
TOP = 10
UNIT = 10**9
#: Terms that a task counts before it sends them on, some 60 MB.
ENTRIES = 250_000
#: Groups that may be broadcast, about 50 bytes each.
SMALL = 100_000
_ROWS = 50_000
_COUNTS = "lang string, source string, term string, n long, docs long"


def count_terms(batches, limit: int = ENTRIES):
    """(lang, source, text) -> (lang, source, term, n, docs), added up over stretches of a task's rows."""
    n, docs, size = defaultdict(Counter), defaultdict(Counter), 0

    def flush():
        for (lang, source), own in n.items():
            terms, held = list(own), docs[lang, source]
            for at in range(0, len(terms), _ROWS):
                part = terms[at : at + _ROWS]
                keys = [pa.array([x] * len(part), pa.string()) for x in (lang, source)]
                numbers = [pa.array([c[t] for t in part], pa.int64()) for c in (own, held)]
                yield pa.RecordBatch.from_arrays([*keys, pa.array(part, pa.binary()).cast(pa.string()), *numbers], names=["lang", "source", "term", "n", "docs"])
        n.clear()
        docs.clear()

    for batch in slices(batches, 2):
        keys = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)
        for key, text in zip(keys, batch.column(2).cast(pa.binary()).to_pylist(), strict=True):
            own, seen = n[key], set()
            size -= len(own)
            for words in terms_of(text, LETTERS):
                own.update(words)
                seen.update(words)
            docs[key].update(seen)
            size += len(own)
            if size >= limit:
                yield from flush()
                size = 0
    yield from flush()


def vocabulary(docs: DataFrame, least: int = LEAST, limit: int = ENTRIES) -> DataFrame:
    """lang, term, total (occurrences in the language) and cols (source and occurrences n, by source) of each kept term, stored.

    Counts are dealt by (lang, term) once; both sums and the choice of terms follow in the same tasks. A term's cols are one per source at most.
    """
    rows = small_batches(docs).select("lang", "source", "text").mapInArrow(lambda it: count_terms(it, limit), _COUNTS).repartition("lang", "term")
    counts = rows.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    terms = counts.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("total"), F.array_sort(F.collect_list(F.struct("source", "n"))).alias("cols"))
    return stored(terms.where(F.col("docs") >= least).select("lang", "term", "total", "cols"), "divergence-terms")


def group_stats(groups: DataFrame, terms: DataFrame) -> DataFrame:
    """lang, source, n (the sum of the group's counts), lang_n (that of the language) and v (its kept terms), stored."""
    own = terms.select("lang", F.inline("cols")).groupBy("lang", "source").agg(F.sum("n").alias("n"))
    whole = terms.groupBy("lang").agg(F.sum("total").alias("lang_n"), F.count("*").alias("v"))
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    return stored(groups.join(own, ["lang", "source"], "left").join(whole, "lang", "left").select("lang", "source", zero("n"), zero("lang_n"), zero("v")), "divergence-groups")


def share(count: Column, n: Column, v: Column) -> Column:
    """p, as a long. The numerator is a decimal: it outgrows 64 bits from some nine billion occurrences on."""
    return F.call_function("div", F.lit(UNIT).cast("decimal(10,0)") * (count + 2).cast("decimal(20,0)"), (n + 2 * v).cast("decimal(20,0)")) + 1


def distance(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), p + q)


def shares(counts: np.ndarray, n: int, v: int) -> np.ndarray:
    """p of each count; each different count is divided once, in integers of any size."""
    own, place = np.unique(counts, return_inverse=True)
    return np.array([1 + UNIT * (c + 2) // (n + 2 * v) for c in own.tolist()], np.int64)[place]


def runs_of(column: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Run-length encoding of a column of entries that end at `ends`: the end and the count of each run."""
    last = np.append(np.flatnonzero(column[1:] != column[:-1]), len(column) - 1)
    return ends[last], column[last]


def meet(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> int:
    """The sum of f over two run-length columns of shares: pieces between the boundaries of either, each times its length."""
    ends = np.union1d(a[0], b[0])
    p, q = (x[1][np.searchsorted(x[0], ends)] for x in (a, b))
    gap = p - q
    return int((gap * gap // (p + q) * np.diff(ends, prepend=0)).sum())


def sum_pairs(batches, groups: dict[str, dict[str, tuple[int, int]]]):
    """(lang, cols, length), sorted -> (lang, source, other, value) for source < other: the sums over this task's entries."""
    sums: Counter = Counter()
    for batch in batches:
        langs = batch.column(0).dictionary_encode()
        lengths = batch.column(2).to_numpy()
        for code, lang in enumerate(langs.dictionary.to_pylist()):
            rows = np.flatnonzero(langs.indices.to_numpy() == code)
            ends = np.cumsum(lengths[rows])
            cols = batch.column(1).take(pa.array(rows))
            entry, flat = pc.list_parent_indices(cols).to_numpy(), pc.list_flatten(cols)
            source, n = flat.field(0).dictionary_encode(), flat.field(1).to_numpy()
            by_source, codes = np.argsort(source.indices.to_numpy(), kind="stable"), {x: k for k, x in enumerate(source.dictionary.to_pylist())}
            bound = np.concatenate([[0], np.cumsum(np.bincount(source.indices.to_numpy(), minlength=len(codes)))])
            encoded = []
            for name, (group_n, v) in groups[lang].items():
                column = np.zeros(len(rows), np.int64)
                if name in codes:
                    at = by_source[bound[codes[name]] : bound[codes[name] + 1]]
                    column[entry[at]] = n[at]
                end, count = runs_of(column, ends)
                encoded.append((name, (end, shares(count, group_n, v))))
            for k, (name, own) in enumerate(encoded):
                for other, theirs in encoded[k + 1 :]:
                    sums[lang, name, other] += meet(own, theirs)
    keys = list(sums)
    columns = [pa.array([key[k] for key in keys], pa.string()) for k in range(3)]
    yield pa.RecordBatch.from_arrays([*columns, pa.array([sums[key] for key in keys], pa.int64())], names=["lang", "source", "other", "value"])


def pairs(terms: DataFrame, stats: DataFrame) -> DataFrame:
    """lang, source, item (each other source of the language), value."""
    groups: dict[str, dict[str, tuple[int, int]]] = defaultdict(dict)
    for r in stats.orderBy("lang", "source").collect():  # one row per group; the result has its square
        groups[r["lang"]][r["source"]] = (r["n"], r["v"])
    known = dict(groups)
    entries = terms.groupBy("lang", "cols").agg(F.count("*").alias("length")).sortWithinPartitions("lang", "cols")
    found = entries.mapInArrow(lambda it: sum_pairs(it, known), "lang string, source string, other string, value long")
    found = found.groupBy("lang", "source", "other").agg(F.sum("value").alias("value"))
    found = stored(found, "divergence-pairs")
    found = found.select("lang", "source", F.col("other").alias("item"), "value").unionByName(found.select("lang", F.col("other").alias("source"), F.col("source").alias("item"), "value"))
    bare = stats.where("v = 0").select("lang", "source")
    bare = bare.join(bare.withColumnRenamed("source", "item"), "lang").where("source <> item").withColumn("value", F.lit(0).cast("long"))
    return found.unionByName(bare)


def typical(terms: DataFrame, stats: DataFrame) -> DataFrame:
    """lang, source, item, value of the kept terms that a group has and uses more than its language does."""
    rows = terms.select("lang", F.col("term").alias("item"), "total", F.inline(F.col("cols")).alias("source", "count")).join(few(stats, SMALL), ["lang", "source"])
    rows = rows.withColumns({"p": share(F.col("count"), F.col("n"), F.col("v")), "q": share(F.col("total"), F.col("lang_n"), F.col("v"))}).where("p > q")
    return rows.select("lang", "source", "item", distance(F.col("p"), F.col("q")).alias("value"))


def ranked(rows: DataFrame, part: str) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return rows.withColumn("rank", F.row_number().over(order)).select("lang", "source", F.lit(part).alias("part"), "item", "value", "rank")


def audit(df: DataFrame, least: int = LEAST, top: int = TOP, limit: int = ENTRIES) -> DataFrame:
    """lang, source, part, item, value, rank: all other sources of the language (part pair) and the `top` terms that stand out (part term)."""
    given = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    docs = df.select(given("lang"), given("source"), given("text"))
    terms = vocabulary(docs, least, limit)
    stats = group_stats(docs.select("lang", "source").distinct(), terms)
    return ranked(pairs(terms, stats), "pair").unionByName(ranked(typical(terms, stats), "term").where(F.col("rank") <= top))
