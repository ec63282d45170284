"""A dense classifier trained by passes over a table.

Each step is one pass: every task adds up the gradient of its rows, the sums are added
in a tree, and the driver takes one Adam step on the weights.  Rows stay in the
table, so memory depends on the weights alone and a lost executor costs
its part of one pass; the steps don't depend on how rows are partitioned, up to rounding.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagecut.ml.models import batch_predict_udf
from pagecut.ml.tuning import _summed


@dataclass
class DenseNetwork:
    """Layers of weights (inputs, outputs) and biases; ReLU between them, one sigmoid at the end."""
    weights: list[np.ndarray]
    biases: list[np.ndarray]
    #: State of the optimiser, to go on from here: steps taken, first and second moments.
    steps: int = 0
    moments: tuple[np.ndarray, np.ndarray] | None = field(default=None, repr=False)

    @classmethod
    def seeded(cls, sizes: list[int], seed: int) -> DenseNetwork:
        rng = np.random.default_rng(seed)
        return cls([rng.normal(0, np.sqrt(2 / a), (a, b)) for a, b in zip(sizes, sizes[1:])], [np.zeros(b) for b in sizes[1:]])

    def forward(self, x: np.ndarray) -> list[np.ndarray]:
        """Activations by layer; the last are logits."""
        found = [x]
        for i, (w, b) in enumerate(zip(self.weights, self.biases)):
            z = found[-1] @ w + b
            found.append(np.maximum(z, 0) if i < len(self.weights) - 1 else z)
        return found

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.forward(x)[-1][:, 0], -500, 500)))

    def slope(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Summed gradient of the log-loss, flat."""
        acts = self.forward(x)
        error = (1 / (1 + np.exp(-np.clip(acts[-1], -500, 500)))) - y[:, None]
        parts = []
        for i in reversed(range(len(self.weights))):
            parts[:0] = [(acts[i].T @ error).ravel(), error.sum(axis=0)]
            if i:
                error = (error @ self.weights[i].T) * (acts[i] > 0)
        return np.concatenate(parts)

    def flat(self) -> np.ndarray:
        return np.concatenate([p.ravel() for pair in zip(self.weights, self.biases) for p in pair])

    def with_flat(self, flat: np.ndarray, **state) -> DenseNetwork:
        weights, biases, at = [], [], 0
        for w, b in zip(self.weights, self.biases):
            weights.append(flat[at:at + w.size].reshape(w.shape))
            biases.append(flat[at + w.size:at + w.size + b.size])
            at += w.size + b.size
        return DenseNetwork(weights, biases, **state)

    def save(self, spark: SparkSession, path: str) -> None:
        """One JSON row with the shapes and all numbers, exact to the last bit."""
        moments = [m.tolist() for m in self.moments] if self.moments else None
        row = json.dumps({"sizes": [w.shape[0] for w in self.weights] + [1], "flat": self.flat().tolist(), "steps": self.steps, "moments": moments})
        spark.createDataFrame([(row,)], "value string").coalesce(1).write.mode("overwrite").text(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> DenseNetwork:
        row = json.loads(spark.read.text(path).first()["value"])
        moments = tuple(np.array(m) for m in row["moments"]) if row["moments"] else None
        return cls.seeded(row["sizes"], 0).with_flat(np.array(row["flat"]), steps=row["steps"], moments=moments)

    def transform(self, rows: DataFrame, features: str = "features", out: str = "probability") -> DataFrame:
        """``rows`` with the probability of class 1; the weights reach each Python worker once."""
        net = self
        score = batch_predict_udf(lambda: net.probability, "double", input_tensor_shapes=[[self.weights[0].shape[0]]])
        return rows.withColumn(out, score(F.col(features).cast("array<double>")))


def fit_dense(rows: DataFrame, hidden: tuple[int, ...] = (16,), iterations: int = 40, rate: float = 0.02, seed: int = 42,
              valid: DataFrame | None = None, features: str = "features", label: str = "label",
              start: DenseNetwork | None = None) -> tuple[DenseNetwork, DenseNetwork, list[tuple[int, str, float]]]:
    """(last network, best network, history) after ``iterations`` steps on ``rows``.

    The same pass that gives a step's gradient measures the network before the step on ``valid``:
    ``history`` has (iteration, metric, value) with ``loss``, ``val_loss`` and ``val_accuracy``, and the best network
    is that of the least ``val_loss`` (of the least ``loss`` without ``valid``).  ``start`` goes on from a
    network with its optimiser's state, exactly as if it had not stopped.
    """
    part = lambda df, k: df.select(F.col(features).cast("array<double>").alias("x"), F.col(label).cast("double").alias("y"),
                                   F.lit(k).alias("k"))
    data = part(rows, 0) if valid is None else part(rows, 0).unionByName(part(valid, 1))
    spark, first = rows.sparkSession, rows.select(F.size(features)).first()
    if first is None:
        raise ValueError("no rows to learn from")
    net = start or DenseNetwork.seeded([first[0], *hidden, 1], seed)
    flat = net.flat()
    one, two = net.moments or (np.zeros_like(flat), np.zeros_like(flat))
    history, best, least = [], net, np.inf

    def measured(net: DenseNetwork) -> np.ndarray:
        shared = spark.sparkContext.broadcast(net)

        def body(x, y, k):
            p = np.clip(shared.value.probability(x), 1e-12, 1 - 1e-12)
            loss, right, learn = -(y * np.log(p) + (1 - y) * np.log1p(-p)), (p > 0.5) == (y > 0.5), k == 0
            figures = [learn.sum(), loss[learn].sum(), (~learn).sum(), loss[~learn].sum(), right[~learn].sum()]
            return np.concatenate([shared.value.slope(x[learn], y[learn]), figures])
        try:
            return _summed(data, body, (len(flat) + 5,))
        finally:
            shared.unpersist()

    def note(i: int, found: np.ndarray, net: DenseNetwork):
        nonlocal best, least
        n, loss, n_valid, val_loss, right = found[-5:]
        seen = {"loss": loss / max(n, 1)} | ({"val_loss": val_loss / n_valid, "val_accuracy": right / n_valid} if n_valid else {})
        history.extend((i, name, float(value)) for name, value in seen.items())
        value = seen.get("val_loss", seen["loss"])
        if value < least:
            best, least = net, value

    for i in range(net.steps, net.steps + iterations):
        found = measured(net)
        note(i, found, net)
        g = found[:-5] / max(found[-5], 1)
        one, two = 0.9 * one + 0.1 * g, 0.999 * two + 0.001 * g * g
        flat = flat - rate * (one / (1 - 0.9 ** (i + 1))) / (np.sqrt(two / (1 - 0.999 ** (i + 1))) + 1e-8)
        net = net.with_flat(flat, steps=i + 1, moments=(one, two))
    note(net.steps, measured(net), net)
    return net, best, history
