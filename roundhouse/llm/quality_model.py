"""Quality classifier: random Fourier features of document statistics, ridge regression, isotonic calibration.

Twenty statistics of a text are standardised and mapped to cosines of random projections, which approximate a
Gaussian kernel. Tasks add up their parts of the normal equations, one system for each of four folds of the
labelled rows; models without one fold (the sum minus that fold) give the scores on which the isotonic
calibration is fitted, and the model of all folds is used.

Null and empty texts have statistics of zero and a score like any other. Without labelled rows every score
is 0.5. Repeated rows count as often as they come; extra columns are passed over; an empty table gives an
empty result.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roundhouse.llm.common import fold, slices, spans, stored, sum_blocks, texts_of, unused, with_input
from roundhouse.llm.textgrid import WordGrid, shingles

FEATURES, FREQUENCIES, RIDGE, BINS = 20, 256, 3.0, 1024
GOOD = 0.3
_KINDS = 11


@cache
def _kinds() -> np.ndarray:
    """Code point -> other, lower, upper, digit, space, newline, symbol, '!', '|', sentence end, other mark."""
    out = np.ones(0x20001, np.int8)  # from 0x20000 on there are only letters
    for point in range(0x20000):
        out[point] = 0
        c = chr(point)
        if c == "\n":
            out[point] = 5
        elif c in "!|":
            out[point] = 7 + "!|".index(c)
        elif c in "#*$%&<>@^~=+_{}[]\\/":
            out[point] = 6
        elif c in ".?…":
            out[point] = 9
        elif c.isspace():
            out[point] = 4
        elif c.isdigit():
            out[point] = 3
        elif c.isupper():
            out[point] = 2
        elif c.isalpha():
            out[point] = 1
        elif point > 32:
            out[point] = 10
    return out


def statistics(texts: list[str]) -> np.ndarray:
    """FEATURES numbers for each of some whole texts."""
    n = len(texts)
    grid = WordGrid(texts)
    kinds = _kinds()[np.minimum(grid.points, 0x20000)]
    begins = np.concatenate([[0], grid.text_ends[:-1]])
    doc_of_char = np.repeat(np.arange(n), grid.text_ends - begins)
    by_kind = np.bincount(doc_of_char * _KINDS + kinds, minlength=n * _KINDS).reshape(n, _KINDS).astype(float)
    by_kind[:, 5] -= 1  # each text was given a last line end
    words = grid.words_per_text().astype(float)
    some = np.maximum(words, 1)
    size = (grid.ends - grid.starts).astype(float)
    total = np.bincount(grid.doc, weights=size, minlength=n)
    square = np.bincount(grid.doc, weights=size * size, minlength=n)
    mean = total / some

    def repeated(hashes: np.ndarray, doc: np.ndarray, room: np.ndarray) -> np.ndarray:
        keys = np.sort((doc.astype(np.uint64) << np.uint64(44)) | (hashes >> np.uint64(20)))
        fresh = keys[np.concatenate([[True], keys[1:] != keys[:-1]])] if len(keys) else keys
        return 1 - np.bincount((fresh >> np.uint64(44)).astype(np.int64), minlength=n) / np.maximum(room, 1)

    runs, run_doc = shingles(grid, 3)
    ends = np.flatnonzero(grid.points == 10)
    starts = np.concatenate([[0], ends[:-1] + 1])
    filled = ends > starts
    line_doc = np.searchsorted(grid.text_ends, starts, side="right")[filled]
    lines = np.bincount(line_doc, minlength=n).astype(float)
    closed = np.bincount(line_doc, weights=np.isin(kinds[ends[filled] - 1], (7, 9)), minlength=n)
    first_upper = np.bincount(grid.doc, weights=kinds[grid.starts] == 2, minlength=n)
    longest = np.zeros(n)
    np.maximum.at(longest, grid.doc, size)
    chars = np.maximum(by_kind.sum(1) - by_kind[:, 4] - by_kind[:, 5], 1)
    out = np.stack(
        [
            np.log1p(words), mean, np.sqrt(np.maximum(square / some - mean * mean, 0)), np.log1p(longest),
            *[by_kind[:, k] / chars for k in (0, 2, 3, 6, 9, 10)],
            by_kind[:, 7] / some, by_kind[:, 8] / some, by_kind[:, 6] / some,
            repeated(grid.hashes, grid.doc, words), repeated(runs, run_doc, np.bincount(run_doc, minlength=n)),
            repeated(grid.hash_of(starts[filled], ends[filled]), line_doc, lines),
            closed / np.maximum(lines, 1), np.log1p(words / np.maximum(lines, 1)), first_upper / some, np.log1p(lines),
        ],
        1,
    )
    return np.where((words > 0)[:, None], out, 0).astype(np.float32)


def statistics_batches(texts: list[str]) -> np.ndarray:
    return np.concatenate([np.zeros((0, FEATURES), np.float32), *[statistics(texts[a:b][k : k + 4096]) for a, b in spans(texts) for k in range(0, b - a, 4096)]])


def described(df: DataFrame, keep: list[str], text: str = "text", to: str = "stats") -> DataFrame:
    """df's columns `keep` and the statistics of each text, packed as float32."""
    schema = df.limit(0).select(*[F.col(f"`{c}`") for c in keep], F.lit(b"").alias(to)).schema
    rows, at = with_input(df, keep, text)

    def run(batches):
        for batch in slices(batches, at):
            found = statistics_batches(texts_of(batch.column(at)))
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], pa.array([x.tobytes() for x in found], pa.binary())], names=[*keep, to])

    return rows.mapInArrow(run, schema)


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray  # a column per model: without fold 1 to 4, and of all folds
    at: np.ndarray  # raw scores and their calibrated probabilities
    level: np.ndarray

    @staticmethod
    def projection() -> tuple[np.ndarray, np.ndarray]:
        random = np.random.default_rng(20)
        return random.normal(0, np.sqrt(2 / FEATURES), (FEATURES, FREQUENCIES)), random.uniform(0, 2 * np.pi, FREQUENCIES)

    def cosines(self, stats: np.ndarray) -> np.ndarray:
        w, b = self.projection()
        z = np.clip((stats - self.mean) / self.scale, -6, 6)
        return np.concatenate([np.sqrt(2 / FREQUENCIES) * np.cos(z @ w + b), np.ones((len(z), 1))], 1)

    def raw(self, stats: np.ndarray, model: int = 4) -> np.ndarray:
        return self.cosines(stats) @ self.weights[:, model]

    def score(self, stats: np.ndarray) -> np.ndarray:
        """Calibrated probabilities; a thousandth of the raw score parts equal ones."""
        if not len(self.at):
            return np.full(len(stats), 0.5)
        raw = self.raw(stats)
        return 0.999 * np.interp(raw, self.at, self.level) + 0.001 / (1 + np.exp(-np.clip(raw, -30, 30)))


def unpacked(column) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.float32).reshape(-1, FEATURES).astype(np.float64)


def blocks_of(df: DataFrame, parts) -> dict[int, np.ndarray]:
    """Sums over all rows of what parts(batch) gives: pairs (block, vector)."""

    def run(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, v in parts(batch):
                sums[k] = sums.get(k, 0) + v
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([np.ascontiguousarray(x).tobytes() for x in sums.values()], pa.binary())], names=["block", "vector"])

    return sum_blocks(df.mapInArrow(run, "block int, vector binary"))


def isotonic(x: np.ndarray, good: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: places and their non-decreasing shares of good rows."""
    pools: list[list[float]] = []
    for a, g, n in zip(x, good, count, strict=True):
        pools.append([a * n, g, n])
        while len(pools) > 1 and pools[-2][1] * pools[-1][2] >= pools[-1][1] * pools[-2][2]:
            last = pools.pop()
            pools[-1] = [p + q for p, q in zip(pools[-1], last, strict=True)]
    return np.array([p[0] / p[2] for p in pools]), np.array([(p[1] + 0.5) / (p[2] + 1) for p in pools])


def fit(rows: DataFrame) -> Model:
    """rows: stats, label (0 or 1) and fold (1 to 4). Everything that reaches the driver has a fixed size."""
    moments = blocks_of(rows.select("stats"), lambda b: [(0, np.concatenate([[b.num_rows], (s := unpacked(b.column(0))).sum(0), (s * s).sum(0)]))])
    empty = Model(np.zeros(FEATURES), np.ones(FEATURES), np.zeros((FREQUENCIES + 1, 5)), np.zeros(0), np.zeros(0))
    if not moments or moments[0][0] == 0:
        return empty
    n, total, square = moments[0][0], moments[0][1 : FEATURES + 1], moments[0][FEATURES + 1 :]
    model = Model(total / n, np.sqrt(np.maximum(square / n - (total / n) ** 2, 1e-8)), empty.weights.copy(), empty.at, empty.level)
    size = FREQUENCIES + 1

    def system(batch):
        z, y, part = model.cosines(unpacked(batch.column(0))), batch.column(1).to_numpy(), batch.column(2).to_numpy()
        for f in np.unique(part):
            own, t = z[part == f], y[part == f]
            full = np.concatenate([own.T @ own, (own.T @ t)[:, None]], 1)
            for k in range(0, size, 32):
                yield int(f) * 1000 + k, full[k : k + 32].reshape(-1)

    found = blocks_of(rows.select("stats", "label", "fold"), system)
    systems = np.zeros((5, size, size + 1))
    for block, vector in found.items():
        part = vector.reshape(-1, size + 1)
        systems[block // 1000, block % 1000 : block % 1000 + len(part)] = part
    total = systems.sum(0)
    for k in range(5):
        own = total - systems[k + 1] if k < 4 else total
        model.weights[:, k] = np.linalg.solve(own[:, :size] + RIDGE * np.eye(size), own[:, size])

    def held(batches):
        for batch in batches:
            s, part = unpacked(batch.column(0)), batch.column(2).to_numpy()
            raw = np.zeros(len(s))
            for f in np.unique(part):
                raw[part == f] = model.raw(s[part == f], int(f) - 1)
            yield pa.RecordBatch.from_arrays([pa.array(np.clip(np.floor((raw + 1) / 3 * BINS), 0, BINS - 1).astype(np.int32)), batch.column(1)], names=["bin", "label"])

    bins = rows.select("stats", "label", "fold").mapInArrow(held, "bin int, label int").groupBy("bin").agg(F.count("*").alias("n"), F.sum("label").alias("good")).orderBy("bin").collect()
    x = (np.array([r["bin"] for r in bins]) + 0.5) / BINS * 3 - 1
    model.at, model.level = isotonic(x, np.array([r["good"] for r in bins], float), np.array([r["n"] for r in bins], float))
    return model


def fit_documents(df: DataFrame, labels: DataFrame, keep: list[str] | None = None, to: str = "stats") -> tuple[DataFrame, Model]:
    """(stored columns `keep` of every row with its statistics, model). labels: doc_id, label, from labelled()."""
    rows = stored(described(df, ["doc_id"] if keep is None else keep, to=to), "quality-statistics")
    own = rows.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(f"`{to}`").alias("stats")).join(labels, "doc_id")
    return rows, fit(own.select("stats", F.col("label").cast("int"), fold("doc_id").cast("int").alias("fold")).where("fold > 0"))


def scored(rows: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score, predicted for each row of fit_documents()."""

    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(model.score(unpacked(batch.column(1))))], names=["doc_id", "score"])

    out = rows.select(F.col("doc_id").cast("long"), "stats").mapInArrow(run, "doc_id long, score double")
    return out.select("doc_id", (fold("doc_id") == 0).alias("held_out"), "score", F.when(F.col("score") >= GOOD, 1).otherwise(0).alias("predicted"))


def keep_good(df: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows that the classifier accepts, with df's columns. Texts are read once: the rows are written with their statistics."""
    to = unused("__stats", df.columns)
    rows, model = fit_documents(df, labels, df.columns, to)
    at, schema = len(df.columns), rows.schema

    def run(batches):
        for batch in batches:
            yield batch.filter(pa.array(model.score(unpacked(batch.column(at))) >= GOOD))

    return rows.mapInArrow(run, schema).drop(to)
