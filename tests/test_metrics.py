import itertools
import random

from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from conftest import rows
from pagecut.operators import metrics as M


def _brute_auc(data):
    pos = [s for y, s in data if y == 1]
    neg = [s for y, s in data if y == 0]
    tot = sum(1.0 if p > n else 0.5 if p == n else 0.0 for p, n in itertools.product(pos, neg))
    return tot / (len(pos) * len(neg))


def test_auc_with_ties_matches_pairs(spark):
    rnd = random.Random(1)
    data = [(rnd.randint(0, 1), float(rnd.randint(0, 20))) for _ in range(400)]
    df = spark.createDataFrame(data, "label int, score double")
    for strat in ("window", "chunked"):
        got = M.roc_auc(df, strategy=strat).first()["auc"]
        assert abs(got - _brute_auc(data)) < 1e-12


def test_roc_curve_trapezoid_equals_auc_and_evaluator(spark):
    rnd = random.Random(2)
    data = [(rnd.randint(0, 1), round(rnd.random(), 2)) for _ in range(300)]
    df = spark.createDataFrame(data, "label int, score double")
    pts = sorted((r["fpr"], r["tpr"]) for r in M.roc_curve(df, strategy="chunked").collect())
    area = sum((x2 - x1) * (y1 + y2) / 2 for (x1, y1), (x2, y2) in zip(pts, pts[1:]))
    auc = M.roc_auc(df).first()["auc"]
    assert abs(area - auc) < 1e-12
    ev = df.select("label", F.array(-F.col("score"), F.col("score")).alias("a"))
    from pyspark.ml.functions import array_to_vector
    ev = ev.select(F.col("label").cast("double").alias("label"), array_to_vector("a").alias("rawPrediction"))
    spark_auc = BinaryClassificationEvaluator(numBins=0).evaluate(ev)
    assert abs(spark_auc - auc) < 1e-9


def test_confusion_matrix_includes_zero_cells(spark):
    df = spark.createDataFrame([(0, 0), (0, 0), (1, 0)], "label int, prediction int")
    assert rows(M.confusion_matrix(df)) == [(0, 0, 2), (0, 1, 0), (1, 0, 1), (1, 1, 0)]


def test_zero_division_and_absent_class(spark):
    df = spark.createDataFrame([(0, 0), (0, 0)], "label int, prediction int")
    b = M.binary_metrics(df).first()
    assert (b["accuracy"], b["precision"], b["recall"]) == (1.0, 0.0, 0.0)
    rep = {r["row"]: r for r in M.classification_report(df).collect()}
    assert rep["accuracy"]["f1"] == 1.0 and rep["0"]["precision"] == 1.0


def test_weighted_metrics_equal_evaluator(spark):
    rnd = random.Random(5)
    data = [(float(rnd.randint(0, 2)), float(rnd.randint(0, 2))) for _ in range(200)]
    df = spark.createDataFrame(data, "label double, prediction double")
    ours = M.weighted_metrics(df).first().asDict()
    for m in ("accuracy", "weightedPrecision", "weightedRecall", "f1"):
        ev = MulticlassClassificationEvaluator(metricName=m).evaluate(df)
        assert abs(ev - ours[m]) < 1e-12, m


def test_set_prf_matches_python_sets(spark):
    pred = spark.createDataFrame([("a", 0), ("a", 3), ("a", 3), ("b", 1)], "b string, p int")
    true = spark.createDataFrame([("a", 0), ("a", 5), ("c", 2)], "b string, p int")
    got = {r["b"]: (r["precision"], r["recall"], r["f1"]) for r in M.set_prf(pred, true, "b", "p").collect()}
    assert got["a"] == (0.5, 0.5, 0.5)
    assert got["b"] == (0.0, 0.0, 0.0) and got["c"] == (0.0, 0.0, 0.0)


def test_log_loss_clips(spark):
    df = spark.createDataFrame([(1, 0.0), (0, 1.0)], "y int, p double")
    v = M.log_loss(df, "y", F.col("p")).first()["log_loss"]
    assert abs(v - 16.11809565095832) < 1e-6


def test_class_weights(spark):
    df = spark.createDataFrame([(0,)] * 9 + [(1,)], "y int")
    w = {r["y"]: r["weight"] for r in M.class_weights_balanced(df, "y").collect()}
    assert abs(w[0] - 10 / 18) < 1e-12 and abs(w[1] - 5.0) < 1e-12
    r = {r["y"]: r["weight"] for r in M.class_weights_ratio(df, "y").collect()}
    assert r == {0: 1.0, 1: 9.0}


def test_error_table_layout(spark):
    df = spark.createDataFrame([("a.pdf", 3, 1, 0, 0.4), ("a.pdf", 4, 1, 1, 0.9)],
                               "b string, p int, label int, prediction int, score double")
    t = M.error_table(df, "label", "prediction", "score", "b", "p")
    assert t.columns == ["True_Label", "Predicted_Label", "Confidence", "PDF_Name", "Page_Number"]
    assert rows(t, "PDF_Name", "Page_Number") == [("a.pdf", 3)]


def test_report_error_rate_is_fraction(spark):
    df = spark.createDataFrame([(1, 1, 0.9), (0, 1, 0.6), (0, 0, 0.1), (1, 1, 0.8)],
                               "label int, prediction int, score double")
    mp = M.eval_report(df).first()["model_performance"]
    assert mp["error_rate"] == 0.25 and mp["accuracy"] == 0.75 and mp["total_samples"] == 4
