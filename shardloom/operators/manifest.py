"""Delta log and manifest: checks, folding, planning, committing, time travel."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shardloom.errors import LogFault
from shardloom.functions.hashing import record_checksum
from shardloom.operators.ordering import positions
from shardloom.schemas import ADD, COMMIT, RECORD, RECORD_VERSION, REMOVE, UPDATE
from shardloom.session import BROADCAST_ROWS, counted

INCREMENTAL, FULL_SCAN = "incremental", "full_scan"


def _identity_checksum() -> Column:
    return record_checksum(F.col("shard_id"), F.col("operation"), F.col("path"))


def fill_checksum(records: DataFrame) -> DataFrame:
    """Compute ``record_checksum`` where it is missing or empty."""
    given = F.col("record_checksum")
    return records.withColumn(
        "record_checksum", F.when(F.length(given) > 0, given).otherwise(_identity_checksum())
    )


def checksum_holds() -> Column:
    """Whether a record's checksum is that of its contents; never null."""
    return F.col("record_checksum").eqNullSafe(_identity_checksum())


def corrupt_records(records: DataFrame) -> DataFrame:
    """Records whose stored checksum does not match their contents."""
    return records.filter(~checksum_holds())


def replay(records: DataFrame, from_offset: int | Column = 0, strict: bool = False) -> DataFrame:
    """Verified records after ``from_offset`` in log order.

    ``strict`` raises on the first corrupt record at or after that offset; otherwise corrupt records
    are left out here and reported by :func:`corrupt_records`.
    """
    tail = records.filter(F.col("offset") > from_offset)
    if strict:
        first = corrupt_records(tail).orderBy("offset").select("offset", "shard_id").head()
        if first:
            raise LogFault("a record is not what was written", **first.asDict())
        return tail.orderBy("offset")
    return tail.filter(F.col("record_checksum") == _identity_checksum()).orderBy("offset")


def log_offset(records: DataFrame) -> DataFrame:
    """One row: number of records and highest offset, which agree on a complete log."""
    return records.agg(
        F.count("*").alias("records"), F.coalesce(F.max("offset"), F.lit(0)).alias("last_offset")
    )


def stamp(records: DataFrame, condition: Column | None = None) -> Column:
    """Log position as a scalar column: highest offset, optionally of matching records only."""
    chosen = records if condition is None else records.filter(condition)
    return chosen.agg(F.coalesce(F.max("offset"), F.lit(0))).scalar()


def append_records(log: DataFrame, batch: DataFrame, order: list[str]) -> DataFrame:
    """Number a batch from the log's end on, in ``order``, and fill its checksums."""
    numbered = positions(batch, order).withColumn("offset", stamp(log) + F.col("pos") + 1)
    return fill_checksum(numbered.drop("pos", "n"))


def commit_records(shards: DataFrame, at: Column) -> DataFrame:
    """COMMIT records (without offsets) for a table of ``shard_id``; path repeats the shard."""
    return shards.select(
        F.lit(RECORD_VERSION).alias("schema_version"),
        "shard_id",
        F.lit(COMMIT).alias("operation"),
        F.col("shard_id").alias("path"),
        F.lit(0).cast("bigint").alias("byte_size"),
        F.lit(0).cast("bigint").alias("num_rows"),
        F.lit(None).cast("string").alias("record_checksum"),
        F.lit(None).cast("string").alias("content_checksum"),
        at.alias("timestamp"),
    )


def fold_state(records: DataFrame, as_of: int | Column | None = None) -> DataFrame:
    """Per shard: the last change, a removal included, and the last commit.

    One aggregation with map-side combine, so a shard with most of the records costs one partial
    row per task. Only offsets decide, so records may arrive in any order. ``as_of`` keeps records
    up to that offset.
    """
    if as_of is not None:
        records = records.filter(F.col("offset") <= as_of)
    is_commit = F.col("operation") == COMMIT
    change = F.struct("operation", "path", "byte_size", "num_rows")
    offset = F.col("offset")
    folded = records.groupBy("shard_id").agg(
        F.max_by(change, F.when(~is_commit, offset)).alias("last"),
        F.max(F.when(~is_commit, offset)).alias("last_offset"),
        F.max(F.when(is_commit, offset)).alias("commit_offset"),
        F.max_by("timestamp", F.when(is_commit, offset)).alias("committed_at"),
    )
    return folded.select("shard_id", "last.*", "last_offset", "commit_offset", "committed_at")


def manifest_of(state: DataFrame) -> DataFrame:
    """The live shards of a state; ingested where the last commit follows the last change.

    Removed shards and shards with commits only (never announced) are not part of it.
    """
    ingested = F.coalesce(F.col("commit_offset") > F.col("last_offset"), F.lit(False))
    return state.filter(F.col("operation") != REMOVE).select(
        "shard_id",
        "path",
        "byte_size",
        "num_rows",
        ingested.alias("ingested"),
        F.when(ingested, F.col("committed_at")).alias("ingested_at"),
        "last_offset",
        F.when(ingested, F.col("commit_offset")).alias("commit_offset"),
    )


def fold(records: DataFrame, as_of: int | Column | None = None) -> DataFrame:
    """Current manifest of a log: last ADD/UPDATE per shard, gone after REMOVE, ingested after COMMIT."""
    return manifest_of(fold_state(records, as_of))


def as_records(state: DataFrame) -> DataFrame:
    """The shortest log that folds to ``state``: at most one change and one commit a shard."""
    change = F.when(
        F.col("last_offset").isNotNull(),
        F.struct(
            F.col("last_offset").alias("offset"),
            F.col("operation").alias("operation"),
            F.lit(None).cast("timestamp").alias("timestamp"),
        ),
    )
    commit = F.when(
        F.col("commit_offset").isNotNull(),
        F.struct(
            F.col("commit_offset").alias("offset"),
            F.lit(COMMIT).alias("operation"),
            F.col("committed_at").alias("timestamp"),
        ),
    )
    rows = F.explode(F.array_compact(F.array(change, commit))).alias("r")
    kept = ["shard_id", "path", "byte_size", "num_rows"]
    return state.select(*kept, rows).select(*kept, "r.*")


def merge_state(state: DataFrame, records: DataFrame) -> DataFrame:
    """Bring a stored state up to date; a repeated or late batch of records changes nothing else.

    The state keeps removed shards, so an older ADD that arrives late does not bring one back.
    """
    known = as_records(state)
    return fold_state(known.unionByName(records.select(known.columns)))


def pending(manifest: DataFrame) -> DataFrame:
    return manifest.filter(~F.col("ingested"))


def plan(manifest: DataFrame, strategy: str = INCREMENTAL) -> DataFrame:
    """Shards to read next, in the order of their last change."""
    chosen = {INCREMENTAL: pending, FULL_SCAN: lambda m: m}[strategy](manifest)
    return chosen.orderBy("last_offset")


def mark_ingested(manifest: DataFrame, shards: DataFrame, at: Column) -> DataFrame:
    """Set ``ingested`` for the listed shards; ids the manifest does not know are ignored."""
    done = shards.select("shard_id", F.lit(True).alias("_done")).distinct()
    hit = F.coalesce(F.col("_done"), F.lit(False))
    return (
        manifest.join(done, "shard_id", "left")
        .withColumn("ingested", F.col("ingested") | hit)
        .withColumn("ingested_at", F.when(hit, at).otherwise(F.col("ingested_at")))
        .drop("_done")
    )


def planned_rows(
    frames: DataFrame, planned: DataFrame, on_empty: str = "none", known: int | None = None
) -> DataFrame:
    """Rows of the planned shards.

    ``known`` is the number of planned shards where the plan is stored already. With ``on_empty="all"`` an empty plan reads everything, which a run that must never train on
    nothing may ask for; by default an empty plan reads nothing.
    """
    keys = planned.select(F.col("shard_id").alias("source_shard"))
    if known is None:
        keys, known = counted(keys)
    if on_empty == "all" and known == 0:
        return frames
    # Few shards are broadcast, so frames stay where they are. Spark prunes partitions at run time
    # only if the other side has a filter that looks selective; this one is true for every id.
    keys = keys.filter(F.col("source_shard") >= "")
    if known <= BROADCAST_ROWS:
        keys = F.broadcast(keys)
    return frames.join(keys, "source_shard", "left_semi")


def empty_log(spark) -> DataFrame:
    return spark.createDataFrame([], RECORD)


__all__ = [
    "ADD", "UPDATE", "REMOVE", "COMMIT", "INCREMENTAL", "FULL_SCAN", "append_records", "as_records",
    "commit_records", "corrupt_records", "empty_log", "fill_checksum", "fold", "fold_state",
    "log_offset", "manifest_of", "mark_ingested", "merge_state", "pending", "plan", "planned_rows",
    "replay", "stamp",
]
