import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from conftest import SF_MID
from pagecut.ml import models
from pagecut.plans import standins as S
from pagecut.plans.jobs import train
from pagecut.session import scratch_path


def _rows(spark):
    return S.embedding_rows(spark, SF_MID).select("vec_id", "y", F.col("embedding").alias("features"))


def test_lr_learns_with_oversampling(spark):
    on = train(_rows(spark), "vec_id", "y").metrics["areaUnderROC"]
    off = train(_rows(spark), "vec_id", "y", oversample=False).metrics["areaUnderROC"]
    assert on > 0.85 and on > off


def test_saved_model_reloads_equal(spark):
    path = scratch_path(spark, "m")
    res = train(_rows(spark), "vec_id", "y", model_path=path)
    again = models.load_model(path).transform(res.test_predictions.select("vec_id", "features_vector"))
    a = {r["vec_id"]: r["p"] for r in res.test_predictions.select("vec_id", vector_to_array("probability")[1].alias("p")).collect()}
    b = {r["vec_id"]: r["p"] for r in again.select("vec_id", vector_to_array("probability")[1].alias("p")).collect()}
    assert a.keys() == b.keys() and max(abs(a[k] - b[k]) for k in a) < 1e-12
    with pytest.raises(Exception):
        models.save_model(res.model, path, overwrite=False)
    with pytest.raises(FileNotFoundError):
        models.load_model(path + "-missing")


def test_mlp_learns(spark):
    m = train(_rows(spark), "vec_id", "y", classifier=models.mlp(64, (16,))).metrics
    assert m["areaUnderROC"] > 0.85


def test_zero_variance_feature_scales_to_zero(spark):
    df = spark.createDataFrame([(i, [1.0, float(i)]) for i in range(5)], "id int, f array<double>")
    v = models.to_vector(df, "f")
    out = models.scaler().fit(v).transform(v).select(vector_to_array("scaled_features").alias("s")).collect()
    assert all(r["s"][0] == 0.0 for r in out)


def test_evaluate_job_writes_flat_errors(spark):
    from pagecut.plans.jobs import evaluate
    res = train(_rows(spark), "vec_id", "y")
    pred = res.test_predictions.withColumn("score", vector_to_array("probability")[1]) \
        .withColumn("prediction", F.col("prediction").cast("int"))
    out = scratch_path(spark, "eval")
    rep = evaluate(pred, out_dir=out).first()
    assert 0.85 < rep["model_performance"]["auc_roc"] <= 1.0
    assert spark.read.option("header", True).csv(f"{out}/errors").columns[:2] == ["vec_id", "label"]


def test_dataframe_metrics_equal_evaluators(spark):
    res = train(_rows(spark), "vec_id", "y")
    ours = res.metrics
    theirs = models.evaluator_metrics(res.test_predictions)
    for k in theirs:
        assert abs(ours[k] - theirs[k]) < 1e-9, k


def test_tune_grid_and_held_out(spark):
    from pagecut.plans.jobs import tune
    res = tune(_rows(spark), "vec_id", "y")
    g = res.grid.collect()
    assert len(g) == 27 and sum(r["is_best"] for r in g) == 1 and sorted(r["rank"] for r in g) == list(range(1, 28))
    assert max(g, key=lambda r: r["avg_auc"])["avg_auc"] == next(r["avg_auc"] for r in g if r["is_best"])
    assert {r["regParam"] for r in g} == {0.01, 0.1, 0.5} and {r["maxIter"] for r in g} == {10, 20, 50}
    assert res.held_out_auc > 0.85


def test_tasks_keep_their_properties_apart(spark):
    """Concurrent fits on one session: none sees another's execution id (20 rounds)."""
    from pagecut.ml.tuning import run_apart
    rows = models.to_vector(_rows(spark).limit(60).cache())
    fit = lambda: models.logistic("features_vector", "y", max_iter=2).fit(rows).intercept
    for _ in range(20):
        found = run_apart(spark, [fit] * 8, 8)
        assert len(found) == 8 and max(found) - min(found) < 1e-9


def test_joint_paths_reach_the_separate_fits(spark):
    from pagecut.ml.tuning import held_out_auc, joint_paths
    from pagecut.operators.metrics import roc_auc
    from pagecut.operators.sampling import fold_column
    data = models.to_vector(_rows(spark)).withColumn("fold", fold_column(F.col("vec_id"), 3, 42))
    data = models.scaler().fit(data).transform(data).withColumn("scaled", vector_to_array("scaled_features")).cache()
    kinds = [(0.1, 0.0), (0.05, 0.5), (0.02, 1.0)]
    paths = joint_paths(data, kinds, [5, 250], 3, "scaled", "y")
    areas = held_out_auc(data, paths, "scaled", "y")
    for s, (reg, elastic) in enumerate(kinds):
        lr = models.logistic(label="y", max_iter=500, reg=reg, elastic=elastic).setTol(1e-10).setStandardization(False)
        fitted = lr.fit(data.where("fold != 1"))
        ours = paths[250][1, s]
        assert abs(ours[0] - fitted.intercept) < 1e-3 and max(abs(ours[1:] - fitted.coefficients.toArray())) < 1e-3
        pred = fitted.transform(data.where("fold = 1")).select(F.col("y").alias("label"), vector_to_array("rawPrediction")[1].alias("score"))
        assert abs(areas[250, s][1] - roc_auc(pred).first()["auc"]) < 2e-3


def test_separate_fits_rank_the_grid_alike(spark, monkeypatch):
    from pagecut.plans.jobs import tune
    monkeypatch.setattr(models, "GRID_REG_PARAM", [0.01, 0.5])
    monkeypatch.setattr(models, "GRID_ELASTIC_NET", [0.0, 1.0])
    monkeypatch.setattr(models, "GRID_MAX_ITER", [50])
    a, b = ({(r["regParam"], r["elasticNetParam"]): r["avg_auc"] for r in tune(_rows(spark), "vec_id", "y", method=m).grid.collect()}
            for m in ("joint", "separate"))
    assert a.keys() == b.keys() and all(abs(a[k] - b[k]) < 0.03 for k in a)


def test_class_weights_instead_of_oversampling(spark):
    for mode in ("balanced", "ratio"):
        assert train(_rows(spark), "vec_id", "y", class_weights=mode).metrics["areaUnderROC"] > 0.85


def test_threshold_changes_predictions(spark):
    from pagecut.plans.jobs import score_pages
    path = scratch_path(spark, "m")
    train(_rows(spark), "vec_id", "y", model_path=path)
    lo = score_pages(_rows(spark), path, threshold=0.01).where("prediction = 1").count()
    hi = score_pages(_rows(spark), path, threshold=0.99).where("prediction = 1").count()
    assert lo > hi
