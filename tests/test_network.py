"""Dense training by passes and the model registry."""

import numpy as np
import pytest

from pagecut.ml.network import DenseNetwork, fit_dense
from pagecut.ml.registry import ModelRegistry
from pagecut.session import scratch_path


def test_gradient_is_the_slope_of_the_loss():
    rng = np.random.default_rng(1)
    net, x, y = DenseNetwork.seeded([4, 5, 3, 1], 2), rng.normal(size=(9, 4)), rng.integers(0, 2, 9).astype(float)

    def loss(flat):
        p = net.with_flat(flat).probability(x)
        return -(y * np.log(p) + (1 - y) * np.log(1 - p)).sum()

    flat, slope = net.flat(), net.slope(x, y)
    for i in range(0, len(flat), 3):
        step = np.zeros(len(flat))
        step[i] = 1e-5
        assert abs((loss(flat + step) - loss(flat - step)) / 2e-5 - slope[i]) < 1e-5


def test_best_network_by_validation(spark):
    rng = np.random.default_rng(5)
    rows = [([float(a), float(b)], int(a * b > 0)) for a, b in rng.uniform(-1, 1, (300, 2))]
    df = spark.createDataFrame(rows, "features array<double>, label int")
    last, best, history = fit_dense(df.limit(200), hidden=(8,), iterations=25, rate=0.3, valid=df.subtract(df.limit(200)))
    val = {i: v for i, m, v in history if m == "val_loss"}
    assert len(val) == 26 and min(val, key=val.get) == best.steps and last.steps == 25
    assert {m for _, m, _ in history} == {"loss", "val_loss", "val_accuracy"}
    path = scratch_path(spark, "net")
    best.save(spark, path)
    again = DenseNetwork.load(spark, path)
    assert (again.flat() == best.flat()).all() and again.steps == best.steps
    got = [r.probability for r in again.transform(df.limit(5)).collect()]
    assert np.allclose(got, best.probability(np.array([r.features for r in df.limit(5).collect()])))
    with pytest.raises(ValueError):
        fit_dense(df.limit(0))


def test_registry(spark):
    reg = ModelRegistry(spark, scratch_path(spark, "registry"))
    assert reg.current() is None and reg.versions().count() == 0
    with pytest.raises(LookupError):
        reg.best("auc")
    save = lambda name: lambda path: DenseNetwork.seeded([2, 1], name).save(spark, path)
    for name, auc in ((1, 0.7), (2, 0.9), (3, 0.9), (4, float("nan"))):
        reg.publish(save(name), {"auc": auc, "loss": 1 - auc}, f"v{name}")
    assert reg.best("auc") == "v2" and reg.best("loss", higher_is_better=False) == "v2"
    for version in ("v1", "v2"):
        reg.promote(version)
        assert reg.current() == version and (DenseNetwork.load(spark, reg.path()).flat() == DenseNetwork.seeded([2, 1], int(version[1])).flat()).all()
    with pytest.raises(FileExistsError):
        reg.publish(save(1), {"auc": 1.0}, "v1")
    with pytest.raises(FileNotFoundError):
        reg.promote("v9")
    with pytest.raises(ZeroDivisionError):
        reg.publish(lambda path: 1 / 0, {"auc": 1.0}, "broken")
    assert reg.versions().select("version").distinct().count() == 4 and reg.current() == "v2"
