"""Rank-disjoint sampling, batches, selections by step."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shardloom.operators.ordering import positions

DEFAULT_BATCH = 32
LOG_EVERY, CHECKPOINT_EVERY = 10, 100


def sharded_index(
    df: DataFrame,
    key: str,
    world: int,
    seed: int = 0,
    epoch: int = 0,
    shuffle: bool = True,
    drop_last: bool = False,
) -> DataFrame:
    """(key, pos, rank, slot): equal, disjoint sample lists for ``world`` readers.

    The order is that of MD5(seed + epoch, key), or of the key itself without ``shuffle``. A short
    tail is filled by wrapping around to the front, as often as needed, or cut with ``drop_last``.
    """
    slim = df.select(key)
    if shuffle:
        slim = slim.withColumn(
            "_draw", F.md5(F.concat_ws(":", F.lit(str(seed + epoch)), F.col(key).cast("string")))
        )
        placed = positions(slim, ["_draw", key]).drop("_draw")
    else:
        placed = positions(slim, [key])
    n = F.col("n")
    rounded = F.floor(n / world) if drop_last else F.ceil(n / world)
    total = (rounded * world).cast("bigint")
    if drop_last:
        taken = placed.filter(F.col("pos") < total)
    else:
        taken = placed.withColumn("pos", F.explode(F.sequence(F.col("pos"), total - 1, n)))
    return taken.select(
        key,
        "pos",
        (F.col("pos") % world).cast("bigint").alias("rank"),
        F.floor(F.col("pos") / world).cast("bigint").alias("slot"),
    )


def of_rank(index: DataFrame, rank: int) -> DataFrame:
    return index.filter(F.col("rank") == rank)


def make_batches(
    df: DataFrame,
    order: Sequence[str],
    group: Sequence[str] = (),
    batch_size: int = DEFAULT_BATCH,
    drop_last: bool = False,
    carry: Sequence[str] = (),
) -> DataFrame:
    """(group, order, carry, batch_id, slot): consecutive batches; ``drop_last`` leaves out a short tail.

    ``carry`` names slim columns that go along, which saves joining them back."""
    placed = positions(df.select(*group, *order, *carry), order, group)
    if drop_last:
        placed = placed.filter(F.col("pos") < F.col("n") - F.col("n") % batch_size)
    return placed.select(
        *group,
        *order,
        *carry,
        F.floor(F.col("pos") / batch_size).cast("bigint").alias("batch_id"),
        (F.col("pos") % batch_size).cast("bigint").alias("slot"),
    )


def logged_step(step: Column, every: int = LOG_EVERY) -> Column:
    """Steps that are logged, step 0 included."""
    return step % every == 0


def checkpoint_step(step: Column, every: int = CHECKPOINT_EVERY) -> Column:
    """Steps that are checkpointed; the run's final row is added by :func:`sample_steps`."""
    return (step > 0) & (step % every == 0)


def sample_steps(
    metrics: DataFrame,
    run: str,
    step: str,
    log_every: int = LOG_EVERY,
    checkpoint_every: int = CHECKPOINT_EVERY,
) -> DataFrame:
    """Rows to log and to checkpoint, tagged ``log`` / ``checkpoint``, and one ``final`` per run."""
    s = F.col(step)
    kinds = F.array_compact(
        F.array(
            F.when(logged_step(s, log_every), F.lit("log")),
            F.when(checkpoint_step(s, checkpoint_every), F.lit("checkpoint")),
        )
    )
    picked = metrics.select(run, s.alias("step"), F.explode(kinds).alias("kind"))
    last = metrics.groupBy(run).agg(F.max(step).alias("step"))
    return picked.unionByName(last.withColumn("kind", F.lit("final")))
