"""Training on balanced draws against a plain loop over the same batches."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from roundhouse.operators import training
from roundhouse.operators.picks import balanced_batches


def items_of(spark, n, seed):
    rng = np.random.default_rng(seed)
    labels = np.where(rng.random(n) < 0.06, 1, rng.choice([0, 2], n))
    centres = np.array([[0.0, 0, 0, 0, 1], [2, 2, 0, 0, 1], [-2, 1, 1, 0, 1]])
    rows = [(i, int(k), (centres[k] + rng.standard_normal(5) * [1, 1, 1, 3, 0]).tolist()) for i, k in enumerate(labels)]
    return rows, spark.createDataFrame(rows, "id long, label_id int, vec array<double>").repartition(3)


def plain_fit(rows, drawn, hidden, epochs, rate, seed):
    """Softmax regression or a perceptron by one row after another."""
    x = {i: np.array(v) for i, _, v in rows}
    label = {i: k for i, k, _ in rows}
    all_x = np.stack(list(x.values()))
    mean, spread = all_x.mean(0), all_x.std(0)
    spread[spread < 1e-9] = 1
    layers = [list(y) for y in training.start_layers([5, *([hidden] if hidden else []), 3], seed)]
    m = [[np.zeros_like(a) for a in y] for y in layers]
    v = [[np.zeros_like(a) for a in y] for y in layers]
    t = 0
    for epoch in range(epochs):
        now = rate * (0.01 + 0.99 * (1 + np.cos(np.pi * epoch / epochs)) / 2)
        for ids in drawn[epoch]:
            t += 1
            total = [[np.zeros_like(a) for a in y] for y in layers]
            for i in ids:
                a = [(x[i] - mean) / spread]
                for k, (w, b) in enumerate(layers):
                    z = a[-1] @ w + b
                    a.append(np.maximum(z, 0) if k + 1 < len(layers) else np.exp(z) / np.exp(z).sum())
                back = a[-1] - np.eye(3)[label[i]]
                for k in range(len(layers) - 1, -1, -1):
                    total[k][0] += np.outer(a[k], back)
                    total[k][1] += back
                    back = (layers[k][0] @ back) * (a[k] > 0)
            for k, layer in enumerate(layers):
                for j in (0, 1):
                    g = total[k][j] / len(ids) + 1e-4 * layer[j]
                    m[k][j] = 0.9 * m[k][j] + 0.1 * g
                    v[k][j] = 0.999 * v[k][j] + 0.001 * g * g
                    layer[j] = layer[j] - now * (m[k][j] / (1 - 0.9**t)) / (np.sqrt(v[k][j] / (1 - 0.999**t)) + 1e-8)
    return layers


@pytest.mark.parametrize("hidden", [0, 4])
def test_training_equals_a_plain_loop(spark, hidden):
    rows, df = items_of(spark, 150, 1)
    epochs, drawn = 2, []
    for epoch in range(epochs):
        batches = balanced_batches(df, ["id"], F.col("label_id") == 1, 16, 0.25, 42 + epoch)
        own = {}
        for r in batches.select("batch", "id", "is_focus").collect():
            own.setdefault(r["batch"], []).append(r["id"])
            assert r["is_focus"] == (rows[r["id"]][1] == 1)
        assert all(len(x) == 16 and sum(rows[i][1] == 1 for i in x) == 4 for x in own.values())
        drawn.append([own[k] for k in sorted(own)])
    model = training.fit_balanced(df, ["id"], 1, 3, batch=16, epochs=epochs, hidden=hidden, rate=0.05)
    for (w, b), (w2, b2) in zip(model.layers, plain_fit(rows, drawn, hidden, epochs, 0.05, 42), strict=True):
        assert np.allclose(w, w2, atol=1e-9) and np.allclose(b, b2, atol=1e-9)


def test_held_out_rows_are_told_apart(spark):
    _, df = items_of(spark, 600, 2)
    model = training.fit_balanced(df, ["id"], 1, 3, batch=64, epochs=8, rate=0.1)
    rows, held = items_of(spark, 600, 3)
    held = held.unionByName(spark.createDataFrame([(9999, 0, None)], held.schema))
    scored = training.with_probability(model, held, 1).collect()
    assert [r["score"] for r in scored if r["id"] == 9999] == [None]
    score = {r["id"]: r["score"] for r in scored}
    right = np.mean([(score[i] >= 0.5) == (k == 1) for i, k, _ in rows])
    found = np.mean([score[i] >= 0.5 for i, k, _ in rows if k == 1])
    assert right > 0.9 and found > 0.75  # a class of 6 % of the rows, learned on batches with a quarter of it
    with pytest.raises(ValueError, match="no items"):
        training.fit_balanced(df.limit(0), ["id"], 1, 3)
