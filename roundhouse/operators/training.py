"""Training on balanced draws: every step is one batch of the sampler, whose gradients are summed in tasks.

The model is a perceptron with one hidden layer (or none): softmax over classes, cross-entropy, Adam. The batches of an
epoch are drawn by picks.balanced_batches and written once, a folder per batch; a step reads its folder alone. Its tasks
turn rows into one gradient each, which are added up in a few tasks; the driver holds the model and one gradient.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roundhouse.operators.picks import balanced_batches
from roundhouse.storage import scratch_folder

#: Rows of a batch that a task turns into a gradient at a time.
STEP_ROWS = 8192
#: Tasks that add up the gradients of a step.
ADDERS = 8


@dataclass
class Model:
    """Inputs are scaled by mean and spread; weights and biases of one or two layers."""

    mean: np.ndarray
    spread: np.ndarray
    layers: list[tuple[np.ndarray, np.ndarray]]

    def scaled(self, x: np.ndarray) -> np.ndarray:
        return (x - self.mean) / self.spread

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        return forward(self.layers, self.scaled(x))[-1]


def start_layers(sizes: list[int], seed: int) -> list[tuple[np.ndarray, np.ndarray]]:
    rng = np.random.default_rng(seed)
    return [(rng.standard_normal((a, b)) * np.sqrt(2.0 / a), np.zeros(b)) for a, b in zip(sizes, sizes[1:])]


def forward(layers: list[tuple[np.ndarray, np.ndarray]], x: np.ndarray) -> list[np.ndarray]:
    """The values of each layer; the last are probabilities."""
    out = [x]
    for k, (w, b) in enumerate(layers):
        z = out[-1] @ w + b
        if k + 1 < len(layers):
            out.append(np.maximum(z, 0))
        else:
            z = np.exp(z - z.max(1, keepdims=True))
            out.append(z / z.sum(1, keepdims=True))
    return out


def gradient(layers: list[tuple[np.ndarray, np.ndarray]], x: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """One vector: rows, summed cross-entropy, and the summed gradients of all weights and biases in order."""
    values = forward(layers, x)
    p = values[-1]
    loss = -np.log(np.maximum(p[np.arange(len(x)), labels], 1e-300)).sum()
    back = p.copy()
    back[np.arange(len(x)), labels] -= 1
    parts: list[np.ndarray] = []
    for k in range(len(layers) - 1, -1, -1):
        parts = [(values[k].T @ back).ravel(), back.sum(0), *parts]
        if k:
            back = (back @ layers[k][0].T) * (values[k] > 0)
    return np.concatenate([[len(x), loss], *parts])


class Adam:
    def __init__(self, rate: float, decay: float = 1e-4):
        self.rate, self.decay, self.t, self.m, self.v = rate, decay, 0, 0.0, 0.0

    def step(self, layers: list[tuple[np.ndarray, np.ndarray]], summed: np.ndarray, rate: float) -> list[tuple[np.ndarray, np.ndarray]]:
        flat = np.concatenate([x.ravel() for layer in layers for x in layer])
        g = summed[2:] / summed[0] + self.decay * flat
        self.t += 1
        self.m, self.v = 0.9 * self.m + 0.1 * g, 0.999 * self.v + 0.001 * g * g
        flat = flat - rate * (self.m / (1 - 0.9**self.t)) / (np.sqrt(self.v / (1 - 0.999**self.t)) + 1e-8)
        out, at = [], 0
        for w, b in layers:
            out.append((flat[at : at + w.size].reshape(w.shape), flat[at + w.size : at + w.size + b.size]))
            at += w.size + b.size
        return out


def _vectors(column) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def batch_gradient(rows: DataFrame, model: Model, tasks: int) -> np.ndarray:
    """The summed gradient of one batch (label int, vec array<double>) that lies in about `tasks` tasks."""

    def make(batches):
        total = None
        for batch in batches:
            for at in range(0, batch.num_rows, STEP_ROWS):
                part = batch.slice(at, STEP_ROWS)
                own = gradient(model.layers, model.scaled(_vectors(part.column(1))), part.column(0).to_numpy())
                total = own if total is None else total + own
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["part"])

    def add(batches):
        total = 0
        for batch in batches:
            for part in batch.column(0).to_pylist():
                total = total + np.frombuffer(part)
        if not isinstance(total, int):
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["part"])

    parts = rows.select("label", "vec").mapInArrow(make, "part binary")
    if tasks > ADDERS:
        parts = parts.repartition(ADDERS).mapInArrow(add, "part binary")
    return sum(np.frombuffer(r["part"]) for r in parts.collect())


def scaling(items: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Mean and spread of each number of vec, from sums over all items; a constant number has spread 1."""

    def sums(batches):
        n, one, two = 0, 0.0, 0.0
        for batch in batches:
            if batch.num_rows:
                x = _vectors(batch.column(0))
                n, one, two = n + len(x), one + x.sum(0), two + (x * x).sum(0)
        if n:
            yield pa.RecordBatch.from_arrays([pa.array([np.concatenate([[n], one, two]).tobytes()], pa.binary())], names=["part"])

    total = sum(np.frombuffer(r["part"]) for r in items.select(F.col("vec").cast("array<double>")).mapInArrow(sums, "part binary").toLocalIterator())
    if isinstance(total, int):
        raise ValueError("no items to learn from")
    n, (one, two) = total[0], np.split(total[1:], 2)
    spread = np.sqrt(np.maximum(two / n - (one / n) ** 2, 0))
    return one / n, np.where(spread > 1e-12, spread, 1.0)


def fit_balanced(items: DataFrame, ids: list[str], focus: int, classes: int, batch: int = 64, fraction: float = 0.25, epochs: int = 10, hidden: int = 0, rate: float = 0.01, seed: int = 42) -> Model:
    """A classifier of items (ids, label_id from 0, vec), learned on batches of which a share of `fraction` has the label `focus`; the rate falls by a cosine.

    Items of the other labels fill the rest, as rare as they are. Each epoch draws anew. The same items, seed and sizes give the same model but for the order of sums.
    """
    items = items.where("vec is not null and label_id is not null").select(*ids, "label_id", F.col("vec").cast("array<double>").alias("vec"))
    mean, spread = scaling(items)
    model = Model(mean, spread, start_layers([len(mean), *([hidden] if hidden else []), classes], seed))
    adam, spark, tasks = Adam(rate), items.sparkSession, 1 + batch // STEP_ROWS
    for epoch in range(epochs):
        path = scratch_folder(spark, "batches")
        drawn = balanced_batches(items, ids, F.col("label_id") == focus, batch, fraction, seed + epoch).select("batch", F.col("label_id").cast("int").alias("label"), "vec")
        drawn.repartition("batch", F.pmod(F.xxhash64("vec"), F.lit(tasks))).write.partitionBy("batch").parquet(path)
        known = spark.read.schema("label int, vec array<double>, batch long").parquet(path)
        now = rate * (0.01 + 0.99 * (1 + np.cos(np.pi * epoch / epochs)) / 2)
        for number in sorted(r[0] for r in known.select("batch").distinct().collect()):  # the folders' names
            model.layers = adam.step(model.layers, batch_gradient(known.where(F.col("batch") == number), model, tasks), now)
    return model


def with_probability(model: Model, items: DataFrame, label_id: int, name: str = "score") -> DataFrame:
    """items with the probability of label_id; null where vec is null."""
    names = items.columns
    rows = items.select(*[F.col(f"`{c}`") for c in names], F.col("vec").cast("array<double>").alias("__vec"))
    schema = items.withColumn(name, F.lit(None).cast("double")).schema

    def score(batches):
        for batch in batches:
            known = batch.column(len(names)).is_valid().to_numpy(zero_copy_only=False)
            out = np.zeros(batch.num_rows)
            if known.any():
                out[known] = model.probabilities(_vectors(batch.column(len(names)).filter(pa.array(known))))[:, label_id]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(names)], pa.array(out, mask=~known)], names=[*names, name])

    return rows.mapInArrow(score, schema)
