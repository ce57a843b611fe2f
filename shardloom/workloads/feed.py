"""Change feed: debounce, change records, and the streaming jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shardloom.operators import changes as c
from shardloom.operators import manifest as m
from shardloom.session import new_folder
from shardloom.streaming import changes as sc
from shardloom.streaming import manifest as sm
from shardloom.streaming import lags as sl
from shardloom.workloads import tables as t
from shardloom.workloads.metrics import SLIDE, WINDOW
from shardloom.workloads.metrics import SQL as LAG_SQL

# The stand-in events of a user are hours apart, so the quiet period is hours long as well.
GAP = "6 hours"
EDGE = "1 day"


def _file_events(events: DataFrame) -> DataFrame:
    """Every event as a change of its user's shard file; the content is the event's properties."""
    return events.select(
        F.concat(F.lit("shards/"), F.col("user_id").cast("string"), F.lit(".parquet")).alias("path"),
        "ts",
        "event_id",
        F.col("props").alias("content"),
    )


def _listing(spark: SparkSession, folder: str) -> DataFrame:
    """Files that exist now: the shards of the current manifest."""
    live = m.fold(t.log(spark, folder))
    return live.select(F.concat(F.lit("shards/"), "shard_id", F.lit(".parquet")).alias("path"))


def _settled(spark: SparkSession, folder: str) -> DataFrame:
    return c.debounce(_file_events(t.table(spark, folder, "events")), GAP, bucket=EDGE)


def cdc_debounce(spark: SparkSession, folder: str) -> DataFrame:
    """Settled files that still exist."""
    settled = c.still_there(_settled(spark, folder), _listing(spark, folder))
    return settled.select("path", "event_id", "ts")


def _show(records: DataFrame) -> DataFrame:
    return records.select(
        "shard_id", "operation", "path", "byte_size", "num_rows", "record_checksum",
        "content_checksum", F.col("timestamp").cast("timestamp_ntz").alias("settled_at"),
    )


def cdc_records(spark: SparkSession, folder: str) -> DataFrame:
    return _show(c.change_records(_settled(spark, folder)))


def _event_stream(spark: SparkSession, folder: str) -> DataFrame:
    # The pattern matches a single file as well as a folder of files.
    path = f"{folder}/event[s].parquet"
    stream = sc.read_files(spark, path, t.table(spark, folder, "events").schema)
    return stream.withColumn("ts", F.col("ts").cast("timestamp"))


def cdc_stream(spark: SparkSession, folder: str) -> DataFrame:
    """The change feed as a stream, run to its end; equals ``cdc_records``."""
    out = new_folder(spark, "feed")
    live = _file_events(_event_stream(spark, folder))
    # A path of its own, a century on: closes the last sessions without touching any of them.
    far = spark.range(1).select(
        F.lit("sentinel").alias("path"),
        F.lit("2124-01-01 00:00:00").cast("timestamp").alias("ts"),
        F.lit(-1).cast("bigint").alias("event_id"),
        F.lit("").alias("content"),
    )
    far.limit(0).write.parquet(f"{out}/sentinel")
    flush = sc.read_files(spark, f"{out}/sentinel", far.schema)
    settled = sc.settled(live.unionByName(flush), GAP)
    records = c.change_records(settled)
    sc.drain(records, far, f"{out}/sentinel", f"{out}/records", f"{out}/checkpoint")
    return _show(spark.read.parquet(f"{out}/records").filter(F.col("path") != "sentinel"))


def manifest_stream(spark: SparkSession, folder: str) -> DataFrame:
    """The manifest kept by a stream over the log; equals ``manifest_fold``."""
    out = new_folder(spark, "manifest")
    t.log(spark, folder).repartition(4, "offset").write.parquet(f"{out}/log")
    schema = t.log(spark, folder).schema
    records = sc.read_files(spark, f"{out}/log", schema, files_per_batch=2)
    sm.maintain(records, f"{out}/snapshots", f"{out}/checkpoint", once=True).awaitTermination()
    return t.show_manifest(sm.snapshot(spark, f"{out}/snapshots"))


def lag_sliding_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Rolling lag totals kept by a stream, run to its end; equals ``lag_sliding``."""
    out = new_folder(spark, "lags")
    live = _event_stream(spark, folder).select("event_type", "ts", (F.col("value") / 100).alias("lag"))
    far = spark.range(1).select(
        F.lit("sentinel").alias("event_type"),
        F.lit("2124-01-01 00:00:00").cast("timestamp").alias("ts"),
        F.lit(0.0).alias("lag"),
    )
    far.limit(0).write.parquet(f"{out}/sentinel")
    flush = sc.read_files(spark, f"{out}/sentinel", far.schema)
    rates = sl.sliding_rate(live.unionByName(flush), ["event_type"], "ts", "lag", WINDOW, SLIDE)
    sc.drain(rates, far, f"{out}/sentinel", f"{out}/rates", f"{out}/checkpoint")
    found = spark.read.parquet(f"{out}/rates").filter(F.col("event_type") != "sentinel")
    return found.select(
        "event_type", F.col("window_start").cast("timestamp_ntz").alias("window_start"), "n",
        F.round("total", 6).alias("total"), F.round("per_second", 6).alias("per_second"),
    )


QUERIES = {
    "lag_sliding_stream": lag_sliding_stream,
    "cdc_debounce": cdc_debounce,
    "cdc_records": cdc_records,
    "cdc_stream": cdc_stream,
    "manifest_stream": manifest_stream,
}

_SETTLED_SQL = """
file_events AS (
  SELECT 'shards/' || user_id || '.parquet' AS path, ts, event_id, props AS content,
         CAST(user_id AS VARCHAR) AS shard_id,
         lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS next_ts
  FROM events
),
settled AS (
  SELECT * FROM file_events WHERE next_ts IS NULL OR next_ts > ts + INTERVAL 6 HOUR
)"""

_RECORDS_SQL = t.with_ctes(
    _SETTLED_SQL,
    body="""
SELECT shard_id, 'ADD' AS operation, path, CAST(strlen(content) AS BIGINT) AS byte_size,
       CAST(0 AS BIGINT) AS num_rows, sha256(shard_id || ':ADD:' || path) AS record_checksum,
       sha256(content) AS content_checksum, ts AS settled_at
FROM settled""",
)

SQL = {
    "lag_sliding_stream": LAG_SQL["lag_sliding"],
    "cdc_debounce": t.with_ctes(
        t.MANIFEST_SQL,
        _SETTLED_SQL,
        body="""
SELECT path, event_id, ts FROM settled WHERE shard_id IN (SELECT shard_id FROM manifest)""",
    ),
    "cdc_records": _RECORDS_SQL,
    "cdc_stream": _RECORDS_SQL,
    "manifest_stream": t.with_ctes(
        t.MANIFEST_SQL,
        body=" SELECT shard_id, path, byte_size, num_rows, ingested, ingested_at, last_offset FROM manifest",
    ),
}
