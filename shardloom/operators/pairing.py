"""Pairing of the two modalities and reports of what is missing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shardloom.errors import PairFault, ScanFault
from shardloom.functions.hashing import path_order
from shardloom.session import BROADCAST_BYTES, BROADCAST_ROWS, counted, value_rows, weighed

MODALITIES = ("iris", "fingerprint")


def common_subjects(iris: DataFrame, fingerprint: DataFrame) -> DataFrame:
    """Subjects present in both modalities."""
    return iris.select("subject_id").intersect(fingerprint.select("subject_id"))


def pair(iris: DataFrame, fingerprint: DataFrame) -> DataFrame:
    """Every iris image with its subject's first fingerprint in path order.

    Both inputs are (subject_id, path, content). The first path is found on keys alone, with
    map-side combine; contents are joined last. The joined side has one row per subject: it is
    broadcast if its contents weigh little, which leaves the iris images where they are; otherwise
    both sides shuffle and AQE's skew join splits a hot subject on the iris side.
    """
    ordered = fingerprint.withColumn("_at", path_order(F.col("path")))
    first, subjects = counted(ordered.groupBy("subject_id").agg(F.min("_at").alias("_at")))
    few = subjects <= BROADCAST_ROWS
    chosen = ordered.join(F.broadcast(first) if few else first, ["subject_id", "_at"]).select(
        "subject_id",
        F.col("path").alias("fingerprint_path"),
        F.col("content").alias("fingerprint_bytes"),
    )
    if few:
        chosen, _, weight = weighed(chosen, "fingerprint_bytes")
        if weight <= BROADCAST_BYTES:
            chosen = F.broadcast(chosen)
    return iris.select(
        "subject_id", F.col("path").alias("iris_path"), F.col("content").alias("iris_bytes")
    ).join(chosen, "subject_id")


def missing_modality(
    iris: DataFrame,
    fingerprint: DataFrame,
    subjects: DataFrame | None = None,
    root: str = "",
    strict: bool = False,
) -> DataFrame:
    """(subject_id, modality, path) for every subject that lacks one; iris is reported first.

    ``subjects`` adds known subjects (folders) that may lack images on both sides.
    """
    seen = iris.select("subject_id", F.lit(1).alias("_iris"), F.lit(0).alias("_finger"))
    seen = seen.unionByName(
        fingerprint.select("subject_id", F.lit(0).alias("_iris"), F.lit(1).alias("_finger"))
    )
    if subjects is not None:
        seen = seen.unionByName(
            subjects.select("subject_id", F.lit(0).alias("_iris"), F.lit(0).alias("_finger"))
        )
    # One aggregation does the full outer join: partial sums shrink a hot subject before the shuffle.
    sides = seen.groupBy("subject_id").agg(
        F.max("_iris").alias("_iris"), F.max("_finger").alias("_finger")
    )
    modality = F.when(F.col("_iris") == 0, MODALITIES[0]).when(F.col("_finger") == 0, MODALITIES[1])
    missing = sides.select("subject_id", modality.alias("modality")).filter(
        F.col("modality").isNotNull()
    )
    missing = missing.withColumn(
        "path", F.concat(F.lit(root), F.col("modality"), F.lit("/"), F.col("subject_id"))
    )
    if strict:
        row = missing.orderBy("subject_id").first()
        if row:
            raise PairFault("a subject lacks a modality", **row.asDict())
    return missing


def missing_roots(
    media: DataFrame, expected: Sequence[str] = MODALITIES, location: str = "", strict: bool = False
) -> DataFrame:
    """Expected modality roots that hold no file."""
    wanted = value_rows(media.sparkSession, "modality", expected)
    absent = wanted.join(media.select("modality").distinct(), "modality", "left_anti")
    if strict:
        row = absent.orderBy("modality").first()
        if row:
            raise ScanFault("a modality has no files", modality=row["modality"], location=location)
    return absent


def shards_not_found(
    requested: DataFrame, listing: DataFrame, location: str = "", strict: bool = False
) -> DataFrame:
    """Requested shard ids that are not listed."""
    absent = requested.select("shard_id").distinct().join(
        listing.select("shard_id"), "shard_id", "left_anti"
    )
    if strict:
        row = absent.orderBy("shard_id").first()
        if row:
            raise ScanFault("a shard is not there", shard_id=row["shard_id"], location=location)
    return absent
