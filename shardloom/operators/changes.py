"""File change events to delta records: quiet periods, existence, one ADD per settled file."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shardloom.functions.hashing import content_hash, path_stem, record_checksum
from shardloom.operators.ordering import HOT_ROWS, neighbour, time_bucket
from shardloom.schemas import ADD, RECORD_VERSION

# Fixed value: the quiet period after which a changed file counts as settled.
DEBOUNCE = "250 milliseconds"
EDGE_BUCKET = "10 minutes"


def debounce(
    events: DataFrame,
    gap: str = DEBOUNCE,
    time: str = "ts",
    tie: str = "event_id",
    bucket: str = EDGE_BUCKET,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """The last event of every quiet period of a path.

    An event survives when the next one of its path is more than ``gap`` later. A path with very many
    events is compared within time buckets, which spreads it over the cluster.
    """
    width = time_bucket(time, bucket)
    seen = neighbour(
        events, ["path"], time, tie, F.col(time), width, "_next", following=True, hot_rows=hot_rows
    )
    quiet = F.col("_next").isNull() | (F.col("_next") > F.col(time) + F.expr(f"INTERVAL {gap}"))
    return seen.filter(quiet).drop("_next")


def still_there(settled: DataFrame, listing: DataFrame) -> DataFrame:
    """Drop settled paths that no longer exist in the current listing of ``path``."""
    return settled.join(listing.select("path"), "path", "left_semi")


def change_records(settled: DataFrame, time: str = "ts", content: str = "content") -> DataFrame:
    """One ADD per settled file. The row count is unknown until the file is parsed, hence 0.

    The file's digest goes to ``content_checksum``; ``record_checksum`` stays an identity check.
    """
    shard = path_stem(F.col("path"))
    return settled.select(
        F.lit(RECORD_VERSION).alias("schema_version"),
        shard.alias("shard_id"),
        F.lit(ADD).alias("operation"),
        "path",
        F.octet_length(content).cast("bigint").alias("byte_size"),
        F.lit(0).cast("bigint").alias("num_rows"),
        record_checksum(shard, F.lit(ADD), F.col("path")).alias("record_checksum"),
        content_hash(F.col(content)).alias("content_checksum"),
        F.col(time).alias("timestamp"),
    )
