"""Train/val/test splits, shard assignment, labels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shardloom.operators.ordering import join_null_safe, placed, positions
from shardloom.session import BROADCAST_ROWS, measured

# The shares carved out of every subject (or shard).
VAL_FRACTION = 0.15
TEST_FRACTION = 0.05


def split_sizes(n: Column, test: float, val: float, at_least: int, keep_train: bool):
    """(test rows, validation rows) of a group of ``n``; shares truncate in double arithmetic.

    ``keep_train`` leaves one row for training, giving up validation rows before test rows.
    """
    n_test = F.greatest(F.lit(at_least), F.floor(n * F.lit(test)))
    n_val = F.greatest(F.lit(at_least), F.floor(n * F.lit(val)))
    if keep_train:
        n_val = F.greatest(F.lit(0), F.least(n_val, n - 1 - n_test))
        n_test = F.greatest(F.lit(0), F.least(n_test, n - 1 - n_val))
    return n_test.cast("bigint"), n_val.cast("bigint")


def _sized(
    df: DataFrame, group: str, order: Sequence[str], shares: dict
) -> tuple[DataFrame, int]:
    rows, groups = placed(df.select(group, *order), order, [group])
    n_test, n_val = split_sizes(F.col("n"), **shares)
    return rows.withColumn("_tests", n_test).withColumn("_held", n_test + n_val), groups


def _shares(given: dict) -> dict:
    usual = {"test": TEST_FRACTION, "val": VAL_FRACTION, "at_least": 0, "keep_train": True}
    return {**usual, **given}


def split_index(df: DataFrame, group: str, order: Sequence[str], **shares) -> DataFrame:
    """(group, order columns, pos, n, split): first rows to test, next to val, the rest to train."""
    split = (
        F.when(F.col("pos") < F.col("_tests"), "test")
        .when(F.col("pos") < F.col("_held"), "val")
        .otherwise("train")
    )
    sized, _ = _sized(df, group, order, _shares(shares))
    return sized.withColumn("split", split).drop("_tests", "_held")


def assign_splits(df: DataFrame, group: str, order: Sequence[str], **shares) -> DataFrame:
    """Add ``split`` to full rows without moving them.

    Only the key columns are ordered. Each group's last test key and last validation key then decide
    the split of every row by comparison, so the wide rows meet one small row per group and are not
    shuffled while there are few enough groups to broadcast.
    """
    sized, groups = _sized(df, group, order, _shares(shares))
    key, pos = F.struct(*order), F.col("pos")
    last_test, last_held = pos == F.col("_tests") - 1, pos == F.col("_held") - 1
    cuts = (
        sized.filter(last_test | last_held)  # at most two rows per group
        .groupBy(group)
        .agg(F.max(F.when(last_test, key)).alias("_test"), F.max(key).alias("_val"))
    )
    if groups <= BROADCAST_ROWS:
        cuts = F.broadcast(cuts)
    split = F.when(key <= F.col("_test"), "test").when(key <= F.col("_val"), "val")
    return (
        join_null_safe(df, cuts, [group], "left")
        .withColumn("split", split.otherwise("train"))
        .drop("_test", "_val")
    )


def stratified(df: DataFrame, subject: str, order: Sequence[str], **shares) -> DataFrame:
    """Every subject contributes its own slices, and at least one training row."""
    return assign_splits(df, subject, order, **{"at_least": 0, "keep_train": True, **shares})


def per_shard(df: DataFrame, shard: str, order: Sequence[str], **shares) -> DataFrame:
    """Slices per shard, at least one test and one validation row each."""
    return assign_splits(df, shard, order, **{"at_least": 1, "keep_train": False, **shares})


def only_split(df: DataFrame, split: str) -> DataFrame:
    return df.filter(F.col("split") == split)


def split_counts(df: DataFrame, *by: str) -> DataFrame:
    return df.groupBy(*(by or ("split",))).agg(F.count("*").alias("n_rows"))


def encode_labels(subjects: DataFrame, subject: str = "subject_id") -> DataFrame:
    """(subject, label): ordinal among all distinct subjects in sorted order."""
    ordered = positions(subjects.select(subject).distinct(), [subject])
    return ordered.select(subject, F.col("pos").alias("label"))


def with_labels(df: DataFrame, labels: DataFrame, subject: str = "subject_id") -> DataFrame:
    """Add the label of every row's subject; a subject without one keeps its rows, unlabelled."""
    return df.join(measured(labels), subject, "left")


def num_classes(df: DataFrame) -> DataFrame:
    """One row: highest label plus one, and the number of different labels."""
    return df.agg(
        (F.max("label") + 1).cast("bigint").alias("num_classes"),
        F.countDistinct("label").alias("distinct_labels"),
    )


def assign_shards(subjects: DataFrame, shards: int, subject: str = "subject_id") -> DataFrame:
    """(subject, ordinal, shard_index): contiguous runs of ``max(1, subjects // shards)``; the last
    shard takes the remainder. With more shards than subjects the surplus stays empty."""
    ordered = positions(subjects.select(subject).distinct(), [subject])
    size = F.greatest(F.lit(1), F.floor(F.col("n") / shards))
    index = F.least(F.floor(F.col("pos") / size), F.lit(shards - 1)).cast("bigint")
    return ordered.select(subject, F.col("pos").alias("ordinal"), index.alias("shard_index"))
