"""Frame tables stored as shards."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shardloom.functions.hashing import path_stem
from shardloom.operators.manifest import planned_rows
from shardloom.operators.pairing import shards_not_found
from shardloom.schemas import FRAME
from shardloom.session import value_rows

ROWS_PER_FILE = 1_000_000


def list_files(spark: SparkSession, root: str, pattern: str = "*.parquet") -> DataFrame:
    """(path, length, modificationTime) below ``root``; file contents are not read."""
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", "true")
        .load(root)
        .select("path", "length", "modificationTime")
    )


def list_shards(spark: SparkSession, root: str, pattern: str = "*.parquet") -> DataFrame:
    """Sorted ``shard_id`` of ``<root>/<id>.parquet`` files or ``source_shard=<id>`` folders."""
    in_folder = F.regexp_extract("path", r"/source_shard=([^/]+)/", 1)
    stem = path_stem(F.col("path"))
    shard = F.when(F.length(in_folder) > 0, in_folder).otherwise(stem)
    return list_files(spark, root, pattern).select(shard.alias("shard_id")).distinct().orderBy("shard_id")


def keys_with_prefix(listing: DataFrame, prefix: str) -> DataFrame:
    return listing.filter(F.col("shard_id").startswith(prefix)).orderBy("shard_id")


def existing(wanted: DataFrame, listing: DataFrame) -> DataFrame:
    return wanted.join(listing.select("shard_id"), "shard_id", "left_semi")


def build_frames(df: DataFrame, schema: T.StructType = FRAME) -> DataFrame:
    """Project to the fixed schema; a missing optional column gets its default."""
    defaults = {"schema_version": F.lit(1), "split": F.lit("train"), "source_shard": F.lit("")}
    chosen = []
    for field in schema.fields:
        value = F.col(field.name) if field.name in df.columns else defaults[field.name]
        chosen.append(value.cast(field.dataType).alias(field.name, metadata=field.metadata or {}))
    return df.select(*chosen)


def empty_frames(spark: SparkSession) -> DataFrame:
    """What an empty shard list reads: no rows, full schema."""
    return spark.createDataFrame([], FRAME)


def scan(spark: SparkSession, root: str, requested: DataFrame, strict: bool = False) -> DataFrame:
    """Rows of the requested shards from a folder written by :func:`write_shards`.

    The shard list joins on the partition column, so partitions that are not asked for are pruned at
    run time. ``strict`` raises for the first requested shard that does not exist.
    """
    if strict:
        shards_not_found(requested, list_shards(spark, root), root, strict=True)
    frames = spark.read.schema(FRAME).parquet(root)
    return planned_rows(frames, requested).select(*FRAME.names)


def scan_files(spark: SparkSession, root: str, shard_ids: list[str], strict: bool = True) -> DataFrame:
    """Rows of ``<root>/<id>.parquet`` for a short list of ids."""
    if not shard_ids:
        return empty_frames(spark)
    if strict:
        wanted = value_rows(spark, "shard_id", shard_ids)
        shards_not_found(wanted, list_shards(spark, root), root, strict=True)
    return spark.read.schema(FRAME).parquet(*[f"{root}/{s}.parquet" for s in shard_ids])


def union_shards(*tables: DataFrame) -> DataFrame:
    """All rows of all tables, matched by column name."""
    first, *rest = tables
    for table in rest:
        first = first.unionByName(table)
    return first


def write_shards(df: DataFrame, root: str, rows_per_file: int = ROWS_PER_FILE, mode: str = "append") -> int:
    """Write frames partitioned by ``source_shard``; returns the rows written.

    The rebalance hint brings a shard's rows together into few files, splits a hot shard over several
    tasks and packs small ones, by the sizes AQE measures.
    """
    seen = Observation("written")
    (
        df.observe(seen, F.count(F.lit(1)).alias("rows"))
        .hint("rebalance", "source_shard")
        .write.mode(mode)
        .option("compression", "snappy")
        .option("maxRecordsPerFile", rows_per_file)
        .partitionBy("source_shard")
        .parquet(root)
    )
    return seen.get["rows"]


def shards_to_write(wanted: DataFrame, listing: DataFrame) -> DataFrame:
    """Wanted shards that are not there yet; present ones are kept as they are."""
    return wanted.join(listing.select("shard_id").distinct(), "shard_id", "left_anti")


def write_missing(df: DataFrame, root: str, listing: DataFrame) -> int:
    keys = listing.select(F.col("shard_id").alias("source_shard")).distinct()
    return write_shards(df.join(keys, "source_shard", "left_anti"), root)
