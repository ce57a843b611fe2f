"""Training run: decode, fuse, fit, evaluate, provenance, registration."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegressionModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shardloom.functions.hashing import config_hash
from shardloom.operators import fusion, media, registry, scoring, splits


@dataclass(frozen=True)
class TrainedRun:
    """A fitted model with its one-row manifest and the samples that could not be decoded."""

    model: LogisticRegressionModel
    manifest: DataFrame
    rejected: DataFrame


def features(
    frames: DataFrame, iris_size=media.IRIS_SIZE, fingerprint_size=media.FINGERPRINT_SIZE, keep=None
) -> DataFrame:
    """(keep columns, error, features): both decoded tiles fused into one normalised vector."""
    options = {} if keep is None else {"keep": keep}
    tiles = media.decode_frames(frames, iris_size, fingerprint_size, **options)
    fused = fusion.fuse(F.col("iris"), F.col("fingerprint"))
    return tiles.withColumn("features", fused).drop("iris", "fingerprint")


def train(
    frames: DataFrame,
    run_id: str,
    git_sha: str,
    config: Column,
    log_offset: Column,
    profile: str = "cluster",
    model_name: str = "late_fusion",
    max_steps: int = fusion.MAX_STEPS,
    decay: float = fusion.WEIGHT_DECAY,
    **sizes,
) -> TrainedRun:
    """Fit on the train split, evaluate on val, and describe the run.

    ``config`` is the map :func:`config_hash` takes; ``log_offset`` the data position, as a scalar
    column (``manifest.stamp``). Each split is filtered before its media are decoded.
    """
    fitted_on = features(splits.only_split(frames, "train"), **sizes)
    good = fitted_on.filter(F.col("error").isNull())
    model = fusion.fit_classifier(good, "features", "label", max_steps, decay)
    held_out = features(splits.only_split(frames, "val"), **sizes)
    scored = fusion.apply_classifier(model, held_out.filter(F.col("error").isNull()), "features")
    measured = scoring.evaluate(scored, "logits", "label")
    manifest = measured.select(
        *registry.run_manifest(
            run_id=F.lit(run_id),
            git_sha=F.lit(git_sha),
            config_hash=config_hash(config),
            log_offset=log_offset,
            profile=F.lit(profile),
            model_name=F.lit(model_name),
            classes=F.lit(model.numClasses),
            max_steps=F.lit(max_steps),
            best_val_loss=F.col("val_loss"),
            created_at=F.current_timestamp(),
            extra_tags=F.create_map(F.lit("val_accuracy"), F.col("val_accuracy").cast("string")),
        )
    )
    rejected = fitted_on.unionByName(held_out).filter(F.col("error").isNotNull()).drop("features")
    return TrainedRun(model, manifest, rejected)
