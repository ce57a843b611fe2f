"""Positions and neighbours of ordered rows that hold up when one group owns most rows.

``row_number`` over a plain window sends a whole group to one task. Here rows are range-partitioned
on (group, order), so a large group spreads over many partitions; each row's index inside its own
sorted partition is turned into a position by adding the rows that precede the partition. Only one
summary row per (partition, group) is moved for that.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shardloom.functions.intervals import micros_of
from shardloom.session import BROADCAST_ROWS, counted, durable

_PARTITION_BITS = 33  # monotonically_increasing_id: partition index above, row index below


def join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner"):
    """Join in which null keys match each other, so that no row of ``left`` is lost to a null."""
    renamed = right.withColumnsRenamed({k: f"_{k}_right" for k in keys})
    conditions = [F.col(k).eqNullSafe(F.col(f"_{k}_right")) for k in keys]
    joined = left.join(renamed, reduce(lambda a, b: a & b, conditions), how)
    return joined.drop(*[f"_{k}_right" for k in keys])


def positions(
    df: DataFrame, order: Sequence[str], group: Sequence[str] = (), partitions: int | None = None
) -> DataFrame:
    """Add ``pos`` (0-based, in ``order`` within ``group``) and ``n`` (rows of the group).

    ``order`` must be unique within a group. Pass only the columns the positions are needed with:
    the rows are written once to the shared folder, because range boundaries come from a sample and
    a recomputed partition could otherwise draw different ones.
    """
    return placed(df, order, group, partitions)[0]


def placed(
    df: DataFrame, order: Sequence[str], group: Sequence[str] = (), partitions: int | None = None
) -> tuple[DataFrame, int]:
    """:func:`positions` and an upper bound of the number of groups."""
    group, order = list(group), list(order)
    count = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = durable(
        df.repartitionByRange(count, *group, *order)
        .sortWithinPartitions(*group, *order)
        .withColumn("_row", F.monotonically_increasing_id())
    )
    ranged = ranged.withColumn("_part", F.shiftright("_row", _PARTITION_BITS)).withColumn(
        "_row", F.col("_row").bitwiseAND((1 << _PARTITION_BITS) - 1)
    )
    # One row per (partition, group): at most partitions + groups rows in all.
    pieces = ranged.groupBy("_part", *group).agg(
        F.min("_row").alias("_first"), F.count("*").alias("_rows")
    )
    pieces_of_group = Window.partitionBy(*group)
    before = pieces_of_group.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    pieces = pieces.select(
        "_part",
        *group,
        (F.coalesce(F.sum("_rows").over(before), F.lit(0)) - F.col("_first")).alias("_shift"),
        F.sum("_rows").over(pieces_of_group).alias("n"),
    )
    if group:
        pieces, bound = counted(pieces)
    else:
        bound = count
    if bound <= BROADCAST_ROWS:
        pieces = F.broadcast(pieces)
    numbered = join_null_safe(ranged, pieces, ["_part", *group])
    numbered = numbered.withColumn("pos", F.col("_row") + F.col("_shift"))
    return numbered.drop("_part", "_row", "_shift"), bound


def time_bucket(time: str, width: str) -> Column:
    """Number of the interval of ``width`` that a time falls into; null for null, unlike a window, which
    would leave such rows out."""
    micros = F.unix_micros(F.col(time).cast("timestamp"))
    return F.floor(micros / F.lit(micros_of(width)))


HOT_ROWS = 1_000_000
SAMPLE = 0.01


def hot_keys(df: DataFrame, key: Sequence[str], rows: int = HOT_ROWS, sample: float = SAMPLE):
    """(keys with about ``rows`` rows or more, how many), from a seeded sample; stored."""
    drawn = df.select(*key).sample(sample, seed=17) if sample < 1 else df.select(*key)
    counts = drawn.groupBy(*key).agg(F.count("*").alias("_rows"))
    return counted(counts.filter(F.col("_rows") >= rows * sample).select(*key))


def neighbour(
    df: DataFrame,
    key: Sequence[str],
    time: str,
    tie: str,
    value: Column,
    bucket: Column,
    name: str,
    following: bool = False,
    hot_rows: int = HOT_ROWS,
    sample: float = SAMPLE,
) -> DataFrame:
    """Add ``name``: ``value`` of the previous (or following) row of the same ``key``.

    Rows are ordered by ``time`` then ``tie``. Keys of usual size are sorted whole. A hot key's rows
    are sorted per ``bucket``, a coarse and ordered function of ``time`` (an hour, say), so the key
    is spread over the cluster; ``bucket`` must be null exactly where ``time`` is, and such rows come
    first. Which keys count as hot changes the speed, never the result.
    """
    key = list(key)
    step, side = (F.lead, 1) if following else (F.lag, -1)
    work = df.withColumn("_value", value)
    hot, found = hot_keys(df, key, hot_rows, sample)
    if not found:
        whole = Window.partitionBy(*key).orderBy(time, tie)
        return work.withColumn(name, step("_value").over(whole)).drop("_value")

    if found <= BROADCAST_ROWS:
        hot = F.broadcast(hot)
    marked = join_null_safe(work, hot.withColumn("_hot", F.lit(True)), key, "left")
    work = marked.withColumns({"_bucket": F.when(F.col("_hot"), bucket), "_edge": F.lit(0)})
    nearest = (F.min_by if following else F.max_by)(F.col("_value"), F.struct(time, tie))
    across = Window.partitionBy(*key).orderBy("_bucket")
    edges = (
        work.filter("_hot")
        .groupBy(*key, "_bucket")
        .agg(nearest.alias("_nearest"))
        .select(*key, "_bucket", step("_nearest").over(across).alias("_value"), F.lit(side).alias("_edge"))
    )
    # The neighbouring bucket's edge value joins the bucket as one more row, before or after all
    # others, so the wide side is shuffled once and needs no join.
    ordered = Window.partitionBy(*key, "_bucket").orderBy("_edge", time, tie)
    return (
        work.unionByName(edges, allowMissingColumns=True)
        .withColumn(name, step("_value").over(ordered))
        .filter(F.col("_edge") == 0)
        .drop("_hot", "_bucket", "_value", "_edge")
    )
