"""URL filters by a temporal list join, in DataFrame functions alone.

List entries are dated: on a day a pattern (a domain, or a domain with a path prefix) is added to or removed
from a list. The entries of a pattern become validity intervals, from one entry to the next. Every capture is
joined, as of its fetch time, with the entries that were active then: a capture offers each parent domain of
its host, alone and with each leading part of its path, as join keys, so a pattern is an equality and the
interval a condition on the matched rows.

Of the active entries of a capture the longest pattern decides, of equal patterns the list that sorts first.
A null or unreadable URL matches nothing and is kept. Entries without a day or pattern are ignored; of entries
of one list, pattern and day a removal counts. Repeated captures get a row each; extra columns are passed over; empty
tables give an empty result (captures) or keep everything (entries).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def host_of(url: Column) -> Column:
    """The host in lower case, without port and user; empty if there is none."""
    return F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]+)", 1))


def path_of(url: Column) -> Column:
    return F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*(/[^?#]*)", 1)


def intervals(entries: DataFrame) -> DataFrame:
    """list, pattern, valid_from, valid_to (null: still valid), from list, pattern, day and action (add or remove)."""
    known = entries.where("list is not null and pattern is not null and day is not null")
    daily = known.groupBy("list", "pattern", "day").agg(F.max("action").alias("action"))  # 'remove' sorts after 'add'
    order = Window.partitionBy("list", "pattern").orderBy("day")
    return daily.withColumn("valid_to", F.lead("day").over(order)).where("action = 'add'").select("list", "pattern", F.col("day").alias("valid_from"), "valid_to")


def path_parts(pattern: Column) -> Column:
    """Parts of a pattern's path."""
    return F.size(F.filter(F.split(pattern, "/"), lambda x: x != "")) - 1


def host_labels(pattern: Column) -> Column:
    """Labels of a pattern's domain."""
    return F.size(F.split(F.substring_index(pattern, "/", 1), r"\."))


def patterns_of(host: Column, path: Column, deepest: int, fewest: int = 1) -> Column:
    """All patterns that can match: every suffix of the host at a dot with `fewest` labels or more, alone and with up to `deepest` leading path parts."""
    labels = F.split(host, r"\.")
    starts = F.when(F.size(labels) >= fewest, F.sequence(F.lit(1), F.greatest(F.size(labels) - fewest + 1, F.lit(1)))).otherwise(F.array().cast("array<int>"))
    suffixes = F.transform(starts, lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    parts = F.filter(F.split(path, "/"), lambda x: x != "")
    count = F.least(F.size(parts), F.lit(deepest))
    heads = F.transform(F.sequence(F.lit(0), count), lambda k: F.when(k == 0, F.lit("")).otherwise(F.concat(F.lit("/"), F.array_join(F.slice(parts, 1, F.greatest(k, F.lit(1))), "/"))))
    return F.when(host != "", F.flatten(F.transform(suffixes, lambda s: F.transform(heads, lambda h: F.concat(s, h)))))


def filtered(captures: DataFrame, entries: DataFrame, small: int = 200_000) -> DataFrame:
    """page_id, fetch_day, host, blocked, list, pattern of every capture (page_id, url, fetch_day).

    Few active intervals (`small`) are broadcast; more are joined by a shuffle on the pattern, where skewed hosts are split by adaptive execution. A capture offers as many path parts as the
    deepest active pattern has, and no domain of fewer labels than any pattern's, so that not every capture meets at its top-level domain. Captures that share host, path and day are judged once.
    """
    active = intervals(entries)
    size = active.agg(F.count("*").alias("n"), F.greatest(F.max(path_parts(F.col("pattern"))), F.lit(0)).alias("deepest"), F.coalesce(F.min(host_labels(F.col("pattern"))), F.lit(1)).alias("fewest")).first()
    if size["n"] <= small:
        active = F.broadcast(active)
    place = ["__host", "__path", "fetch_day"]
    pages = captures.withColumns({"__host": host_of(F.col("url")), "__path": path_of(F.col("url"))}).select("page_id", *place)
    keys = pages.where("__host <> '' and fetch_day is not null").select(*place).distinct()
    keys = keys.withColumn("pattern", F.explode(patterns_of(F.col("__host"), F.col("__path"), size["deepest"], size["fewest"])))
    hits = keys.join(active, "pattern").where("valid_from <= fetch_day and (valid_to is null or fetch_day < valid_to)")
    best = hits.groupBy(*place).agg(F.min(F.struct((-F.length("pattern")).alias("size"), "list", "pattern")).alias("best"))
    out = pages.join(best, place, "left").withColumn("host", F.coalesce("__host", F.lit("")))
    return out.select("page_id", "fetch_day", "host", F.col("best").isNotNull().alias("blocked"), F.col("best.list").alias("list"), F.col("best.pattern").alias("pattern"))
