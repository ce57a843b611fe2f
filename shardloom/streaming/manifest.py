"""Continuous manifest maintenance with keyed state that a batch touches only where it must.

The state (one row per shard: last change, last commit) is kept in buckets of shard ids. A micro-batch
folds its records, reads the latest version of just the buckets its shards fall in, merges, and
writes those buckets as a new version; a small commit row per touched bucket, written last, makes the
version visible. The work of a batch thus follows the batch, not the whole manifest. Readers take,
per bucket, the newest committed version (up to a requested one). Compaction deletes bucket versions
older than the newest ``keep`` of that bucket.

Versions count up from what is committed, not from the stream's batch ids: a new checkpoint over an
old folder continues the stored state, and a batch repeated after a failure merges the same records
again, which changes nothing (the fold keeps the record with the highest offset per shard). Records
may arrive in any order; removed shards stay in the state, so a late ADD does not bring one back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from shardloom.operators.manifest import fold_state, manifest_of, merge_state
from shardloom.schemas import MANIFEST_STATE

#: Buckets of shard ids; choose so that a bucket's state is a small file.
BUCKETS = 256
#: Versions of a bucket that compaction keeps.
KEEP = 2

_COMMITS = T.StructType([T.StructField("bucket", T.IntegerType()), T.StructField("v", T.LongType())])
_STATE = T.StructType([*MANIFEST_STATE.fields, T.StructField("bucket", T.IntegerType()), T.StructField("v", T.LongType())])


def _bucket(buckets: int):
    return F.pmod(F.xxhash64("shard_id"), F.lit(buckets)).cast("int")


def _filesystem(spark: SparkSession, path: str):
    jvm = spark._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def _exists(spark: SparkSession, path: str) -> bool:
    filesystem, hadoop_path = _filesystem(spark, path)
    return bool(filesystem.exists(hadoop_path))


def commits(spark: SparkSession, folder: str) -> DataFrame:
    """(bucket, v): which buckets each committed version wrote."""
    if not _exists(spark, f"{folder}/commits"):
        return spark.createDataFrame([], _COMMITS)
    return spark.read.schema(_COMMITS).parquet(f"{folder}/commits")


def _newest(spark: SparkSession, folder: str, version: int | None = None) -> DataFrame:
    """Per bucket the newest committed version, up to ``version``."""
    done = commits(spark, folder)
    if version is not None:
        done = done.filter(F.col("v") <= version)
    return done.groupBy("bucket").agg(F.max("v").alias("v"))


def _read(spark: SparkSession, folder: str, chosen: DataFrame) -> DataFrame:
    """State rows of the chosen (bucket, v); the join on partition columns prunes all others."""
    if not _exists(spark, f"{folder}/state"):
        return spark.createDataFrame([], MANIFEST_STATE)
    state = spark.read.schema(_STATE).option("basePath", f"{folder}/state").parquet(f"{folder}/state")
    return state.join(F.broadcast(chosen), ["bucket", "v"], "left_semi").select(*MANIFEST_STATE.names)


def compact(spark: SparkSession, folder: str, keep: int = KEEP) -> int:
    """Delete bucket versions older than the newest ``keep`` of their bucket; returns how many."""
    done = commits(spark, folder)
    rank = F.row_number().over(Window.partitionBy("bucket").orderBy(F.desc("v")))
    old = done.withColumn("_rank", rank).filter(F.col("_rank") > keep)
    removed = 0
    for row in old.select("bucket", "v").toLocalIterator():
        filesystem, path = _filesystem(spark, f"{folder}/state/v={row['v']}/bucket={row['bucket']}")
        removed += bool(filesystem.delete(path, True))
    return removed


def step_batch(batch: DataFrame, folder: str, buckets: int = BUCKETS, keep: int = KEEP) -> int | None:
    """Merge one micro-batch of records into the stored state; returns the version written."""
    spark = batch.sparkSession
    batch = batch.persist()
    try:
        touched = [r["bucket"] for r in batch.select(_bucket(buckets).alias("bucket")).distinct().collect()]
        if not touched:
            return None
        newest = _newest(spark, folder)
        version = newest.agg(F.coalesce(F.max("v") + 1, F.lit(0))).first()[0]
        prior = _read(spark, folder, newest.filter(F.col("bucket").isin(touched)))
        merged = merge_state(prior, batch).select(*MANIFEST_STATE.names).withColumn("bucket", _bucket(buckets))
        merged.write.mode("overwrite").partitionBy("bucket").parquet(f"{folder}/state/v={version}")
        marks = spark.createDataFrame([(b,) for b in touched], "bucket int")
        marks.coalesce(1).write.mode("overwrite").parquet(f"{folder}/commits/v={version}")
        compact(spark, folder, keep)
        return version
    finally:
        batch.unpersist()


def maintain(
    records: DataFrame,
    folder: str,
    checkpoint: str,
    once: bool = False,
    interval: str = "10 seconds",
    buckets: int = BUCKETS,
    keep: int = KEEP,
) -> StreamingQuery:
    """Fold every micro-batch into the touched buckets of the stored state (see the module)."""

    def step(batch: DataFrame, batch_id: int) -> None:
        step_batch(batch, folder, buckets, keep)

    writer = records.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if once else writer.trigger(processingTime=interval)
    return writer.start()


def stored_state(spark: SparkSession, folder: str, version: int | None = None) -> DataFrame:
    """The stored state as committed up to ``version`` (the newest by default)."""
    return _read(spark, folder, _newest(spark, folder, version))


def snapshot(spark: SparkSession, folder: str, version: int | None = None) -> DataFrame:
    """The manifest of a stored state."""
    return manifest_of(stored_state(spark, folder, version))
