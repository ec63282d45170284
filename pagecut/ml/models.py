"""Training, tuning, scoring and model storage on Spark ML.

Features stay ``array<float>`` in tables and become vectors with
``array_to_vector`` (a JVM expression, no Python UDF).  Defaults follow the
reference job: StandardScaler (mean and std), LogisticRegression with
``maxIter=20, regParam=0.1, elasticNetParam=0.8``, and a 3 x 3 x 3 grid with
3-fold cross-validation on the area under ROC.
"""

from __future__ import annotations

import numpy as np
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, MultilayerPerceptronClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import array_to_vector, predict_batch_udf, vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagecut.ml import tuning
from pagecut.ml.tuning import Setting
from pagecut.session import path_status

# Fixed values from the reference job.
LR_MAX_ITER = 20
LR_REG_PARAM = 0.1
LR_ELASTIC_NET = 0.8
GRID_REG_PARAM = [0.01, 0.1, 0.5]
GRID_ELASTIC_NET = [0.0, 0.5, 1.0]
GRID_MAX_ITER = [10, 20, 50]
CV_FOLDS = 3


def to_vector(df: DataFrame, features: str = "features", out: str = "features_vector") -> DataFrame:
    """``array<float>`` -> ML vector (JVM-side ``array_to_vector``)."""
    return df.withColumn(out, array_to_vector(F.col(features)))


def assemble(df: DataFrame, inputs: list[str], out: str = "features_vector") -> DataFrame:
    """VectorAssembler over numeric (or vector) columns; arrays go through
    ``to_vector`` first because the assembler rejects them."""
    return VectorAssembler(inputCols=inputs, outputCol=out, handleInvalid="keep").transform(df)


def scaler(input_col: str = "features_vector", output_col: str = "scaled_features") -> StandardScaler:
    return StandardScaler(inputCol=input_col, outputCol=output_col, withStd=True, withMean=True)


def scaler_moments(model, spark: SparkSession) -> DataFrame:
    """``(dim, mean, std)`` of a fitted StandardScaler (one row per dimension)."""
    mean = model.mean.toArray().tolist()
    std = model.std.toArray().tolist()
    return spark.createDataFrame([(i, float(m), float(s)) for i, (m, s) in enumerate(zip(mean, std))],
                                 "dim int, mean double, std double")


def logistic(features: str = "scaled_features", label: str = "label", weight: str | None = None,
             max_iter: int = LR_MAX_ITER, reg: float = LR_REG_PARAM,
             elastic: float = LR_ELASTIC_NET) -> LogisticRegression:
    lr = LogisticRegression(featuresCol=features, labelCol=label, maxIter=max_iter, regParam=reg,
                            elasticNetParam=elastic)
    if weight:
        lr.setWeightCol(weight)
    return lr


def mlp(n_features: int, hidden: tuple[int, ...] = (16,), features: str = "scaled_features",
        label: str = "label", max_iter: int = 60, seed: int = 42) -> MultilayerPerceptronClassifier:
    """Dense neural classifier ``[d, *hidden, 2]`` (no convolution or dropout)."""
    return MultilayerPerceptronClassifier(featuresCol=features, labelCol=label,
                                          layers=[n_features, *hidden, 2], maxIter=max_iter, seed=seed)


def pipeline(classifier, features: str = "features") -> Pipeline:
    """Scaler + classifier over ``features_vector``; call on ``to_vector`` output."""
    return Pipeline(stages=[scaler(), classifier])


def joined(*fitted) -> PipelineModel:
    """One saved-and-loaded unit from stages that were fitted on different rows."""
    return PipelineModel(stages=list(fitted))


def evaluate_all(pred: DataFrame, label: str = "label") -> dict[str, float]:
    """Accuracy, weightedPrecision, weightedRecall, f1 (weighted) and exact
    areaUnderROC of a scored DataFrame, from two passes: one pair-count
    aggregate and one AUC aggregate (equal to the Spark ML evaluators, see
    ``evaluator_metrics``)."""
    from pagecut.operators import metrics as M
    scored = pred.select(F.col(label).cast("double").alias("label"),
                         F.col("prediction").cast("double").alias("prediction"),
                         vector_to_array("probability")[1].alias("score"))
    out = M.weighted_metrics(scored).first().asDict()
    out["areaUnderROC"] = M.roc_auc(scored).first()["auc"]
    return {k: float(v) for k, v in out.items()}


def evaluator_metrics(pred: DataFrame, label: str = "label") -> dict[str, float]:
    """The same metrics from Spark ML's evaluators (one job per metric).

    The area is taken over the probability, as in ``evaluate_all``: the raw outputs of a
    network's two classes order the rows otherwise."""
    out = {}
    for m in ("accuracy", "weightedPrecision", "weightedRecall", "f1"):
        out[m] = MulticlassClassificationEvaluator(labelCol=label, metricName=m).evaluate(pred)
    out["areaUnderROC"] = BinaryClassificationEvaluator(
        labelCol=label, rawPredictionCol="probability", metricName="areaUnderROC",
        numBins=0).evaluate(pred)
    return out


def param_grid() -> list[Setting]:
    """The 27 settings: regularisation strength, elastic net share, iterations."""
    return [Setting(r, e, i) for r in GRID_REG_PARAM for e in GRID_ELASTIC_NET for i in GRID_MAX_ITER]


def cross_validated(train: DataFrame, label: str = "label", fold: str = "fold", features: str = "scaled_features",
                    method: str = "joint", parallelism: int = 4) -> list[tuple[Setting, list[float]]]:
    """Area under ROC of the grid's settings on every fold.

    ``joint``: all settings of all folds in one pass per iteration (``features`` is
    an array column); ``separate``: a Spark ML fit for each fold and setting (a vector
    column), the area from the evaluator.
    """
    grid = param_grid()
    if method == "separate":
        evaluator = BinaryClassificationEvaluator(labelCol=label, metricName="areaUnderROC")
        found = tuning.cross_validate(train, logistic(features=features, label=label), grid, evaluator, fold, CV_FOLDS, parallelism)
        return list(zip(grid, found))
    kinds = list(dict.fromkeys((s.regParam, s.elasticNetParam) for s in grid))
    paths = tuning.joint_paths(train, kinds, GRID_MAX_ITER, CV_FOLDS, features, label, fold)
    areas = tuning.held_out_auc(train, paths, features, label, fold)
    return [(s, areas[s.maxIter, kinds.index((s.regParam, s.elasticNetParam))]) for s in grid]


def grid_table(found: list[tuple[Setting, list[float]]], spark: SparkSession) -> DataFrame:
    """``(regParam, elasticNetParam, maxIter, avg_auc, rank, is_best)``, one row per setting; equal areas rank in grid order."""
    areas = [float(np.mean(a)) for _, a in found]
    rank = {i: n for n, i in enumerate(sorted(range(len(found)), key=lambda i: (-areas[i], i)), 1)}
    return spark.createDataFrame([(s.regParam, s.elasticNetParam, s.maxIter, areas[i], rank[i], rank[i] == 1) for i, (s, _) in enumerate(found)],
                                 "regParam double, elasticNetParam double, maxIter int, avg_auc double, rank int, is_best boolean")


def save_model(model, path: str, overwrite: bool = True) -> None:
    """Save; without ``overwrite`` an existing path is an error."""
    (model.write().overwrite() if overwrite else model.write()).save(path)


def load_model(path: str) -> PipelineModel:
    """Load a saved pipeline, with a clear error when the path does not exist."""
    if path_status(SparkSession.getActiveSession(), path) is None:
        raise FileNotFoundError(f"model not found: {path}")
    return PipelineModel.load(path)


def linear_score(features: Column, weights: list[float], bias: float) -> Column:
    """Fixed-weight linear model: ``sigmoid(w . x + b)`` (JVM expression)."""
    from pagecut.functions.arrays import dot
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-(dot(features, weights) + F.lit(bias))))


def batch_predict_udf(make_predict_fn, return_type: str = "double", batch_size: int = 512,
                      input_tensor_shapes=None):
    """Arrow-batched inference with any external model: ``make_predict_fn`` is
    called once per Python worker and returns ``predict(np.ndarray) -> np.ndarray``."""
    from pyspark.sql import types as T
    rt = T._parse_datatype_string(return_type)
    return predict_batch_udf(make_predict_fn, return_type=rt, batch_size=batch_size,
                             input_tensor_shapes=input_tensor_shapes)


def numpy_linear_model(weights: list[float], bias: float, dim: int):
    """``make_predict_fn`` for a NumPy logistic model (stand-in for a network)."""
    w = np.asarray(weights, dtype=np.float64)

    def make():
        def predict(x: np.ndarray) -> np.ndarray:
            z = x.reshape(-1, dim).astype(np.float64) @ w + bias
            return 1.0 / (1.0 + np.exp(-z))
        return predict
    return make


def history_table(model, spark: SparkSession) -> DataFrame:
    """``(iteration, metric, value)`` from a fitted LR's objective history."""
    lr_model = model.stages[-1] if hasattr(model, "stages") else model
    hist = lr_model.summary.objectiveHistory
    return spark.createDataFrame([(i, "loss", float(v)) for i, v in enumerate(hist)],
                                 "iteration int, metric string, value double")


def drop_validation_metrics(history: DataFrame, metric: str = "metric") -> DataFrame:
    """Training-side metrics only: names not starting with ``val_``."""
    return history.where(~F.col(metric).startswith("val_"))


def last_per_metric(history: DataFrame) -> DataFrame:
    """Final value of each metric (highest iteration)."""
    return history.groupBy("metric").agg(F.max_by("value", "iteration").alias("value"),
                                         F.max("iteration").alias("iteration"))


def best_model(candidates: dict, metrics: dict[str, float], higher_is_better: bool = True):
    """Pick the fitted model with the best validation metric."""
    key = (max if higher_is_better else min)(metrics, key=metrics.get)
    return key, candidates[key]
