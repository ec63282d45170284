"""Cross-validation: all settings in one pass per iteration, or a fit for each.

``joint_paths`` follows every (fold, regularisation) model of a grid at once: one
pass over the rows gives the gradients of all of them, and the iteration limits
of the grid are places on the same path.  ``cross_validate`` fits any Spark ML
estimator once for each fold and setting, in threads that do not share
properties.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

import numpy as np
import pyarrow as pa
from pyspark import TaskContext, inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagecut.operators.prefix import running_sums
from pagecut.session import materialize

#: Partial sums added up in one task; passes that estimate the largest curvature, and the margin put on top.
FAN, POWER_STEPS, MARGIN = 32, 8, 1.1


@dataclass(frozen=True)
class Setting:
    """One point of the grid."""
    regParam: float
    elasticNetParam: float
    maxIter: int


def run_apart(spark: SparkSession, tasks: Sequence[Callable], parallelism: int) -> list:
    """Results of ``tasks``, run in threads that each hold a copy of the local properties of their own.

    One copy shared by several threads is not enough: an SQL execution sets and
    clears its id there while another thread reads it.
    """
    apart = [inheritable_thread_target(spark)(task) for task in tasks]
    with ThreadPool(max(1, min(parallelism, len(apart)))) as pool:
        return pool.map(lambda task: task(), apart, chunksize=1)


def cross_validate(train: DataFrame, estimator, settings: Sequence[Setting], evaluator, fold: str = "fold",
                   folds: int = 3, parallelism: int = 4) -> list[list[float]]:
    """Metric of every setting (rows) on every fold: ``estimator`` is fitted on the other folds."""
    def task(setting, k):
        params = {estimator.getParam(name): value for name, value in vars(setting).items()}
        return lambda: evaluator.evaluate(estimator.fit(train.where(F.col(fold) != k), params).transform(train.where(F.col(fold) == k)))

    found = run_apart(train.sparkSession, [task(s, k) for s in settings for k in range(folds)], parallelism)
    return [found[i:i + folds] for i in range(0, len(found), folds)]


def _summed(rows: DataFrame, body: Callable, shape: tuple[int, ...]) -> np.ndarray:
    """Sum of ``body(features, label, fold)`` over all rows, an array of ``shape``.

    A task adds up its rows; partial sums are added in a tree, so the driver
    receives at most ``FAN`` arrays.
    """
    spark = rows.sparkSession
    tasks = 2 * spark.sparkContext.defaultParallelism

    def partial(batches):
        total = np.zeros(shape)
        for b in batches:
            x = b.column(0)
            width = len(x[0]) if len(x) else 0
            total += body(x.flatten().to_numpy().reshape(-1, width), b.column(1).to_numpy(), b.column(2).to_numpy()) if width else 0
        yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()]), pa.array([total.tobytes()], pa.binary())], ["part", "data"])

    def add(group: pa.Table) -> pa.Table:
        parts = group.sort_by("part")
        total = np.sum([np.frombuffer(d, np.float64) for d in parts["data"].to_pylist()], axis=0)
        return pa.table({"part": [parts["part"][0].as_py() // FAN], "data": pa.array([total.tobytes()], pa.binary())})

    sums = rows.coalesce(tasks).mapInArrow(partial, "part long, data binary")
    while tasks > FAN:
        sums = sums.groupBy(F.expr(f"part div {FAN}")).applyInArrow(add, "part long, data binary")
        tasks = -(-tasks // FAN)
    found = sorted((r["part"], bytes(r["data"])) for r in sums.collect())
    return np.sum([np.frombuffer(d, np.float64) for _, d in found], axis=0).reshape(shape)


def joint_paths(rows: DataFrame, regularisation: Sequence[tuple[float, float]], stops: Sequence[int], folds: int = 3,
                features: str = "features", label: str = "label", fold: str = "fold") -> dict[int, np.ndarray]:
    """Weights of logistic models by iteration: ``{stop: array (folds, settings, 1 + d)}``, the intercept first.

    ``features`` is an array of scaled doubles.  Model (k, s) learns from the rows outside
    fold k with regularisation s = (strength, share of the absolute penalty); fold -1
    of a row keeps it in all models.  Accelerated proximal gradient steps, each from one pass over
    the rows for all models; only weights and their gradients reach the driver.
    """
    spark = rows.sparkSession
    data = rows.select(F.col(features).cast("array<double>"), F.col(label).cast("double"), F.col(fold).cast("int"))
    n_features = data.select(F.size(features)).first()
    if n_features is None:
        raise ValueError("no rows to learn from")
    d, n_settings = n_features[0] + 1, len(regularisation)
    outside = lambda k: (k[:, None] != np.arange(folds)).astype(np.float64)

    def passes(make):
        def body_of(state):
            shared = spark.sparkContext.broadcast(state)
            try:
                return _summed(data, lambda x, y, k: make(shared.value, np.c_[np.ones(len(x)), x], y, outside(k)), make_shape(state))
            finally:
                shared.unpersist()
        return body_of

    make_shape = lambda state: (*state.shape[:-1], d)
    n_rows = _summed(data, lambda x, y, k: outside(k).sum(axis=0), (folds,))
    n_rows = np.maximum(n_rows, 1)
    # the largest curvature of each fold's rows bounds the step
    curve = passes(lambda v, x, y, out: np.einsum("nk,nd->kd", (x @ v.T) * out, x))
    v = np.ones((folds, d)) / np.sqrt(d)
    for _ in range(POWER_STEPS):
        v = curve(v) / n_rows[:, None]
        top = np.linalg.norm(v, axis=1)
        v /= np.maximum(top, 1e-300)[:, None]
    strength, share = (np.array(c, np.float64) for c in zip(*regularisation))
    smooth, sparse = strength * (1 - share), strength * share
    step = 1 / (MARGIN * top[:, None] / 4 + smooth)

    def slope(w, x, y, out):
        z = x @ w.reshape(-1, d).T
        error = (1 / (1 + np.exp(-np.clip(z, -500, 500))) - y[:, None]) * np.repeat(out, n_settings, axis=1)
        return (error.T @ x).reshape(w.shape)

    gradient, penalised = passes(slope), np.r_[0.0, np.ones(d - 1)]
    w = ahead = np.zeros((folds, n_settings, d))
    pace, found = 1.0, {}
    for i in range(1, max(stops) + 1):
        g = gradient(ahead) / n_rows[:, None, None] + smooth[:, None] * ahead * penalised
        moved = ahead - step[..., None] * g
        cut = step[..., None] * sparse[:, None] * penalised
        new = np.sign(moved) * np.maximum(np.abs(moved) - cut, 0)
        after = (1 + np.sqrt(1 + 4 * pace * pace)) / 2
        ahead, w, pace = new + (pace - 1) / after * (new - w), new, after
        if i in stops:
            found[i] = w.copy()
    return found


def held_out_auc(rows: DataFrame, paths: dict[int, np.ndarray], features: str = "features", label: str = "label",
                 fold: str = "fold") -> dict[tuple[int, int], list[float]]:
    """Exact area under ROC of every model on its own fold: ``{(stop, setting): [one value a fold]}``.

    All models of a fold score a row at once; ties count one half.  A fold without both classes gives 0.5.
    """
    stops = sorted(paths)
    weights = np.stack([paths[s] for s in stops], axis=1)  # fold, stop, setting, 1 + d
    shared = rows.sparkSession.sparkContext.broadcast(weights)

    def score(batches):
        for b in batches:
            if not b.num_rows:
                continue
            x = b.column(0).flatten().to_numpy().reshape(b.num_rows, -1)
            w = shared.value[b.column(2).to_numpy()].reshape(b.num_rows, -1, x.shape[1] + 1)
            z = np.einsum("nmd,nd->nm", w[..., 1:], x) + w[..., 0]
            yield pa.RecordBatch.from_arrays([b.column(2), b.column(1), pa.array(list(z), pa.list_(pa.float64()))], ["fold", "y", "z"])

    data = rows.select(F.col(features).cast("array<double>"), F.col(label).cast("int"), F.col(fold).cast("int")).where(F.col(fold) >= 0)
    scored = data.mapInArrow(score, "fold int, y int, z array<double>").select("fold", "y", F.posexplode("z").alias("model", "score"))
    counts = materialize(scored.groupBy("fold", "model", "score").agg(F.sum((F.col("y") == 1).cast("long")).alias("pos"),
                                                                      F.sum((F.col("y") != 1).cast("long")).alias("neg")), "scores")
    ranked = running_sums(counts, {"below": F.col("neg")}, ["score"], ["fold", "model"])
    area = ranked.groupBy("fold", "model").agg(
        F.sum(F.col("pos") * (F.col("below") - F.col("neg") / 2)).alias("area"), F.sum("pos").alias("p"), F.sum("neg").alias("n"))
    found = {(r["fold"], r["model"]): r["area"] / (r["p"] * r["n"]) if r["p"] * r["n"] else 0.5 for r in area.collect()}
    folds, n_settings = weights.shape[0], weights.shape[2]
    return {(stop, s): [found.get((k, i * n_settings + s), 0.5) for k in range(folds)]
            for i, stop in enumerate(stops) for s in range(n_settings)}
