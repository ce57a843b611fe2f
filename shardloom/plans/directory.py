"""Frames from a media directory: pair, label, split."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shardloom.functions.hashing import path_order, path_stem
from shardloom.operators import pairing, splits
from shardloom.sources.shards import build_frames


def list_subjects(media: DataFrame) -> DataFrame:
    """Sorted ``shard_id`` of the subjects that have both modalities; each subject is a shard."""
    sides = [media.filter(F.col("modality") == m) for m in pairing.MODALITIES]
    return pairing.common_subjects(*sides).select(F.col("subject_id").alias("shard_id")).orderBy("shard_id")


def frames_from_media(media: DataFrame, requested: DataFrame | None = None, strict: bool = True) -> DataFrame:
    """Frame table of a scanned media directory, or of the requested subjects (``shard_id``).

    Every iris image is paired with its subject's first fingerprint. Labels count all subjects with
    both modalities, requested or not, and splits follow the iris images' path order per subject.
    ``strict`` raises for a missing modality root and for a requested subject without both sides.
    """
    iris, prints = (media.filter(F.col("modality") == m) for m in pairing.MODALITIES)
    subjects = list_subjects(media)
    if strict:
        pairing.missing_roots(media, strict=True)
        if requested is not None:
            pairing.shards_not_found(requested, subjects, strict=True)
    labels = splits.encode_labels(subjects.select(F.col("shard_id").alias("subject_id")))
    pairs = pairing.pair(iris, prints)
    if requested is not None:
        wanted = requested.select(F.col("shard_id").alias("subject_id"))
        pairs = pairs.join(wanted, "subject_id", "left_semi")
    pairs = pairs.withColumn("_at", path_order(F.col("iris_path")))
    labelled = splits.with_labels(splits.stratified(pairs, "subject_id", ["_at"]), labels)
    return build_frames(
        labelled.withColumns(
            {
                "sample_id": F.concat_ws("_", "subject_id", path_stem(F.col("iris_path"))),
                "source_shard": F.col("subject_id"),
            }
        )
    )
