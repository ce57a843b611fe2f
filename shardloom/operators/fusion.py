"""Late fusion of two feature vectors and a distributed classifier on top."""

from __future__ import annotations

import numpy as np
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shardloom.errors import RunFault
from shardloom.functions.arrays import layer_norm

# Training defaults.
WEIGHT_DECAY = 1e-4
MAX_STEPS = 100

#: Coefficients (classes x (width + 1)) the driver may hold: weights come back to it after each step.
MOST_COEFFICIENTS = 4_000_000
#: Largest gradient component of a stationary fit.
TOLERANCE = 1e-4


def fuse(first: Column, second: Column) -> Column:
    """Both vectors end to end, normalised per row."""
    doubles = [F.transform(v, lambda x: x.cast("double")) for v in (first, second)]
    return layer_norm(F.concat(*doubles))


def check_size(classes: int, width: int) -> None:
    """Raise before a fit whose weights would not fit the driver's share."""
    if classes * (width + 1) > MOST_COEFFICIENTS:
        raise RunFault(
            "too many coefficients for the driver", classes=classes, width=width, most=MOST_COEFFICIENTS
        )


def fit_classifier(
    df: DataFrame, features: str, label: str, max_steps: int = MAX_STEPS, decay: float = WEIGHT_DECAY
) -> LogisticRegressionModel:
    """Multinomial classifier; gradients are summed on the executors, weights come back. Raises
    :class:`RunFault` before fitting if classes x width is beyond ``MOST_COEFFICIENTS``."""
    classes, width = df.agg(F.max(label), F.max(F.size(features))).first()
    check_size(int(classes or 0) + 1, int(width or 0))
    learner = LogisticRegression(
        family="multinomial", maxIter=max_steps, regParam=decay, standardization=False
    )
    prepared = df.select(
        array_to_vector(F.col(features)).alias("features"), F.col(label).cast("double").alias("label")
    )
    return learner.fit(prepared)


def gradient(
    model: LogisticRegressionModel, df: DataFrame, features: str, label: str, decay: float = WEIGHT_DECAY
) -> tuple[np.ndarray, int]:
    """Gradient of the fitted objective (mean cross-entropy plus ``decay / 2`` times the squared
    weights) at the model, as classes x (width + 1) with the intercept last, and the rows it covers.
    Every row adds (softmax - one-hot) times (features, 1); one aggregation sums them all."""
    scored = apply_classifier(model, df.select(features, label), features)
    top = F.array_max("logits")
    shifted = F.transform("logits", lambda v: F.exp(v - top))
    total = F.aggregate(shifted, F.lit(0.0), lambda acc, v: acc + v)
    residual = F.transform(shifted, lambda v, k: v / total - (k == F.col(label)).cast("double"))
    extended = F.concat(F.col(features).cast("array<double>"), F.array(F.lit(1.0)))
    outer = F.flatten(F.transform(residual, lambda r: F.transform(extended, lambda x: r * x)))
    summed = scored.select(array_to_vector(outer).alias("_g")).agg(
        Summarizer.sum(F.col("_g")).alias("_sum"), F.count("*").alias("_n")
    ).first()
    weights = model.coefficientMatrix.toArray()
    classes, width = weights.shape
    n = summed["_n"]
    if not n:
        return np.zeros((classes, width + 1)), 0
    mean = np.asarray(summed["_sum"].toArray()).reshape(classes, width + 1) / n
    mean[:, :width] += decay * weights
    return mean, n


def apply_classifier(model: LogisticRegressionModel, df: DataFrame, features: str) -> DataFrame:
    """Add ``logits`` (raw class scores) to ``df``."""
    prepared = df.withColumn("_features", array_to_vector(F.col(features)))
    model = model.copy()
    model.setFeaturesCol("_features").setRawPredictionCol("_raw")
    model.setProbabilityCol("").setPredictionCol("")
    scored = model.transform(prepared)
    return scored.withColumn("logits", vector_to_array("_raw")).drop("_features", "_raw")
