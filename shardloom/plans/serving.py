"""Batch scoring: validate, decode, score, rank, respond."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegressionModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shardloom.functions.checks import decode_base64, request_rules
from shardloom.operators import fusion, guard, scoring
from shardloom.plans.training import features


@dataclass(frozen=True)
class Scored:
    responses: DataFrame
    rejected: DataFrame  # (request_id, reason)


def score(
    requests: DataFrame,
    model: LogisticRegressionModel,
    names: DataFrame,
    model_version: str,
    **sizes,
) -> Scored:
    """Nested responses of the valid requests, and a reason for each of the others.

    ``names`` is (label, subject_id). A request is rejected for a broken rule or for an image that is
    empty or cannot be read.
    """
    valid, broken = guard.separate(requests, request_rules())
    images = valid.select(
        "request_id",
        "top_k",
        decode_base64(F.col("iris_b64")).alias("iris_bytes"),
        decode_base64(F.col("fingerprint_b64")).alias("fingerprint_bytes"),
    )
    vectors = features(images, keep=("request_id", "top_k"), **sizes)
    scored = fusion.apply_classifier(model, vectors.filter(F.col("error").isNull()), "features")
    answered = scoring.responses(scored, "logits", F.col("top_k"), names, model_version)
    reasons = broken.select("request_id", F.array_join("violations", ",").alias("reason"))
    unread = vectors.filter(F.col("error").isNotNull())
    rejected = reasons.unionByName(unread.select("request_id", F.col("error").alias("reason")))
    return Scored(answered, rejected)
