"""Quality rules as weak supervision.

Every rule looks at one statistic of a text and votes good (1), bad (-1) or abstains (0). Expectation
maximisation over the counts of vote patterns estimates how often each rule votes what under either
class, and the posterior probability of the good class replaces a chain of hard filters.

Null and empty texts have no words: they fail the base checks. Repeated rows get equal results, and an empty
table gives an empty result. Extra columns are passed on, whatever their names are; only a column with the name
of judge's result gives way to it.
"""

from __future__ import annotations

import math
from collections import defaultdict
from functools import cache
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roundhouse.llm.common import slices, stored, texts_of, unused, with_input

SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
STATS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_lines long, n_upper long, n_digits long, n_shouts long, n_pipes long, n_closed_lines long"

#: Name -> the share it looks at, the most that is good, the least that is bad (None: it never votes so).
RULES: dict[str, tuple[str, float | None, float | None]] = {
    "symbols": ("n_symbols / greatest(word_chars, 1)", None, 0.04),
    "marked_words": ("n_symbols / greatest(n_words, 1)", None, 0.50),
    "pipes": ("n_pipes / greatest(n_words, 1)", None, 0.10),
    "repeats": ("n_repeat_words / greatest(n_words, 1)", 0.05, 0.30),
    "dup_lines": ("n_dup_lines / greatest(n_lines, 1)", None, 0.30),
    "upper": ("n_upper / greatest(word_chars, 1)", 0.12, 0.40),
    "digits": ("n_digits / greatest(word_chars, 1)", None, 0.20),
    "shouts": ("n_shouts / greatest(n_words, 1)", None, 0.20),
    "long_words": ("word_chars / greatest(n_words, 1)", None, 14.0),
    "short_words": ("n_words / greatest(word_chars, 1)", None, 0.45),
    "open_lines": ("1 - n_closed_lines / greatest(n_lines, 1)", 0.30, 0.90),
}


@cache
def _upper() -> np.ndarray:
    return np.fromiter((chr(x).isupper() for x in range(0x20001)), bool, 0x20001)


def upper_letters(text: str) -> int:
    """Upper-case letters; there are none from 0x20000 on."""
    if text.isascii():
        points = np.frombuffer(text.encode(), np.uint8)
        return int(np.count_nonzero((points >= 65) & (points <= 90)))
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return int(np.count_nonzero(_upper()[np.minimum(points, 0x20000)]))


def repeat_words(words: list[bytes], width: int = 3) -> int:
    """Words inside a window of `width` words that stands in the text twice or more."""
    n = len(words)
    if n <= width:
        return 0
    seen: dict[bytes, int] = defaultdict(count().__next__)
    ids = np.fromiter(map(seen.__getitem__, words), np.int64, n)
    if len(seen) < 1 << 21:
        keys = ids[: n - width + 1].copy()
        for k in range(1, width):
            keys |= ids[k : n - width + 1 + k] << (21 * k)
        order = np.sort(keys)
        twice = order[1:][order[1:] == order[:-1]]
        if not len(twice):
            return 0
        again = np.isin(keys, twice)
    else:
        keys = np.stack([ids[k : n - width + 1 + k] for k in range(width)], 1)
        _, kinds, counts = np.unique(keys, axis=0, return_inverse=True, return_counts=True)
        again = counts[kinds.reshape(-1)] > 1
    covered = np.zeros(n, bool)
    for k in range(width):
        covered[k : n - width + 1 + k] |= again
    return int(covered.sum())


def statistics(text: str) -> tuple[int, ...]:
    """The columns of STATS for one whole text."""
    words = text.encode("utf-8", "surrogatepass").split()  # bytes.split() parts at \x20 and \x09-\x0D alone
    lines = [x for x in text.split("\n") if x.strip(SPACES)]
    return (
        len(words),
        len(text) - sum(map(text.count, SPACES)),
        sum(map(text.count, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeat_words(words),
        len(lines),
        upper_letters(text),
        sum(map(text.count, "0123456789")),
        text.count("!"),
        text.count("|"),
        sum(x.rstrip(SPACES)[-1] in ".!?\"'”»…:;" for x in lines),
    )


def with_statistics(df: DataFrame, text: str = "text", keep: list[str] | None = None, to: str = "__stats") -> DataFrame:
    """df's columns `keep` (all by default) and a struct column of STATS."""
    keep = df.columns if keep is None else keep
    kind = F.expr(f"cast(null as struct<{', '.join(x.strip().replace(' ', ':') for x in STATS.split(','))}>)")
    schema = df.limit(0).select(*[F.col(f"`{c}`") for c in keep], kind.alias(to)).schema
    names = [x.strip().split()[0] for x in STATS.split(",")]
    rows, at = with_input(df, keep, text)

    def add(batches):
        for batch in slices(batches, at):
            found = np.array([statistics(x) for x in texts_of(batch.column(at))], np.int64)
            stats = pa.StructArray.from_arrays([pa.array(found[:, k]) for k in range(len(names))], names=names)
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], stats], names=[*keep, to])

    return rows.mapInArrow(add, schema)


def vote(name: str, at: str = "__stats") -> Column:
    share, good, bad = RULES[name]
    share = f"({share})"
    for column in ("n_symbols", "word_chars", "n_pipes", "n_words", "n_repeat_words", "n_dup_lines", "n_lines", "n_upper", "n_digits", "n_shouts", "n_closed_lines"):
        share = share.replace(f"{column} ", f"{at}.{column} ").replace(f"({column},", f"({at}.{column},")
    cases = (f" when {share} >= {bad} then -1" if bad is not None else "") + (f" when {share} <= {good} then 1" if good is not None else "")
    return F.expr(f"case{cases} else 0 end")


def votes(at: str = "__stats") -> Column:
    return F.array(*[vote(x, at) for x in RULES])


def fit(patterns: list[tuple[list[int], int]], rounds: int = 60) -> tuple[float, list[dict[int, float]]]:
    """The log odds of the good class before any vote, and of each rule's three outcomes.

    patterns: vote lists with their counts; there are at most 3 ** rules of them, whatever the input.
    """
    if not patterns:
        return 0.0, [{-1: 0.0, 0: 0.0, 1: 0.0} for _ in RULES]
    seen = np.array([v for v, _ in patterns])
    count = np.array([float(n) for _, n in patterns])
    onehot = np.stack([seen == v for v in (-1, 0, 1)], 2).astype(float)
    start = 1 / (1 + np.exp(-(2.0 + 0.25 * (seen == 1).sum(1) - 4.0 * (seen == -1).sum(1))))
    good = start
    for _ in range(rounds):
        prior = min(max((good * count).sum() / count.sum(), 0.5), 0.98)
        odds = np.full(len(count), math.log(prior / (1 - prior)))
        tables = []
        for weight in (good * count, (1 - good) * count):
            outcome = np.einsum("p,prv->rv", weight, onehot) + 1.0
            tables.append(outcome / outcome.sum(1, keepdims=True))
        logs = np.log(tables[0]) - np.log(tables[1])
        # a bad vote never speaks for the good class, nor a good vote against it
        logs[:, 0] = np.minimum(logs[:, 0], 0)
        logs[:, 2] = np.maximum(logs[:, 2], 0)
        odds = odds + np.einsum("prv,rv->p", onehot, logs)
        good = 1 / (1 + np.exp(-np.clip(odds, -40, 40)))
    return math.log(prior / (1 - prior)), [{-1: float(x[0]), 0: float(x[1]), 1: float(x[2])} for x in logs]


def posterior(model: tuple[float, list[dict[int, float]]], at: str = "__stats") -> Column:
    """The probability of the good class, from a struct column of STATS."""
    odds = F.lit(float(model[0]))
    for name, logs in zip(RULES, model[1], strict=True):
        v = vote(name, at)
        odds = odds + F.when(v == 1, F.lit(logs[1])).when(v == -1, F.lit(logs[-1])).otherwise(F.lit(logs[0]))
    return 1 / (1 + F.exp(-odds))


def base_failed(at: str = "__stats") -> Column:
    return F.expr(f"{at}.n_words < 50 or 100 * {at}.n_repeat_words > 50 * {at}.n_words")


def fit_rules(rows: DataFrame, at: str = "__stats") -> tuple[float, list[dict[int, float]]]:
    """Rule weights from every row of with_statistics(); the driver gets one row per vote pattern."""
    found = rows.where(~base_failed(at)).groupBy(votes(at).alias("votes")).count().collect()
    return fit(sorted((list(r["votes"]), r["count"]) for r in found))


def judge(df: DataFrame, text: str = "text", threshold: float = 0.5, keep: list[str] | None = None, to: str = "__quality") -> DataFrame:
    """df's columns `keep` (all by default) and a struct column `to`: STATS, quality_p (posterior), base_failed and kept.

    Texts are read once: the rows are written with their statistics, which both the fit and the verdicts read.
    """
    keep = [c for c in (df.columns if keep is None else keep) if c.lower() != to.lower()]
    rows = stored(with_statistics(df, text, keep, to), "quality-rules")
    p, failed = posterior(fit_rules(rows, to), to), base_failed(to)
    verdict = {"quality_p": p, "base_failed": failed, "kept": ~failed & (p >= threshold)}
    return rows.withColumn(to, F.struct(f"{to}.*", *[v.alias(k) for k, v in verdict.items()]))


def keep_good(df: DataFrame, text: str = "text", threshold: float = 0.5) -> DataFrame:
    """The rows whose text is kept, with df's columns."""
    to = unused("__quality", df.columns)
    return judge(df, text, threshold, to=to).where(f"{to}.kept").select(*[F.col(f"`{c}`") for c in df.columns])
