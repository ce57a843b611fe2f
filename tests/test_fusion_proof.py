"""The classifier's proof: its gradient against NumPy, stationarity, held-out rows, size check."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from shardloom.errors import RunFault
from shardloom.operators import fusion as fu


def table(spark, n=300, width=5, classes=3, seed=3):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, width))
    y = (x[:, 0] > 0).astype(int) + (x[:, 1] > 0.5).astype(int)
    y = np.minimum(y, classes - 1)
    rows = [(i, x[i].tolist(), int(y[i])) for i in range(n)]
    return spark.createDataFrame(rows, "vec_id long, features array<double>, label int"), x, y


def test_gradient_equals_numpy(spark):
    df, x, y = table(spark)
    model = fu.fit_classifier(df, "features", "label", max_steps=3)
    grad, n = fu.gradient(model, df, "features", "label")
    w, b = model.coefficientMatrix.toArray(), model.interceptVector.toArray()
    logits = x @ w.T + b
    p = np.exp(logits - logits.max(1, keepdims=True))
    p /= p.sum(1, keepdims=True)
    r = p - np.eye(w.shape[0])[y]
    expected = np.hstack([r.T @ x / len(x) + fu.WEIGHT_DECAY * w, r.mean(0)[:, None]])
    assert n == len(x)
    assert np.allclose(grad, expected, atol=1e-12)
    # Three steps are far from the optimum; a full fit is stationary.
    assert np.abs(grad).max() > fu.TOLERANCE
    full = fu.fit_classifier(df, "features", "label")
    assert np.abs(fu.gradient(full, df, "features", "label")[0]).max() <= fu.TOLERANCE


def test_size_is_checked_before_the_fit(spark, monkeypatch):
    df, _, _ = table(spark, n=20)
    monkeypatch.setattr(fu, "MOST_COEFFICIENTS", 3 * 6 - 1)
    with pytest.raises(RunFault, match="too many coefficients"):
        fu.fit_classifier(df, "features", "label")


def test_held_out_rows_stay_out(spark):
    from shardloom.workloads import models

    df, _, _ = table(spark, n=50)
    assert df.filter(models._held_out()).count() == 10
    assert df.filter(~models._held_out()).filter(F.col("vec_id") % 5 == 4).count() == 0
