"""Session set-up and the one shared folder every durable intermediate goes to."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def build_session(
    app: str = "shardloom", master: str | None = None, partitions: int | None = None, **conf: str
) -> SparkSession:
    """Session with the settings the operators rely on: UTC, AQE and skew-join handling.

    ``partitions`` sets ``spark.sql.shuffle.partitions``; leave it unset on a cluster so its own
    setting holds. AQE coalesces small partitions, so a high value is safe.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
    }
    if partitions:
        settings["spark.sql.shuffle.partitions"] = str(partitions)
    settings.update(conf)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The cluster's checkpoint folder. Where the session names none, a temporary one on a single
    machine; on a cluster that would be a folder the executors don't share, so it is refused."""
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(named)
        return named
    if sc.getCheckpointDir() is None:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="shardloom-"))
    return sc.getCheckpointDir()


def new_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh path below the shared folder, visible to every executor."""
    return f"{shared_folder(spark).rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def value_rows(spark: SparkSession, column: str, values: Iterable[str]) -> DataFrame:
    """A short list of strings as a one-column table, built in the JVM."""
    array = F.array(*[F.lit(v) for v in values]).cast("array<string>")
    return spark.range(1).select(F.explode(array).alias(column))


def stored(df: DataFrame, purpose: str = "stored") -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back: computed once, column-pruned
    and with statistics on every later read, and safe from lost executors."""
    path = new_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def durable(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and cut its lineage; survives the loss of executors."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


# Limits of a broadcast side: rows of short keys, and bytes where a side carries contents.
BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 64 * 1024 * 1024


def counted(df: DataFrame) -> tuple[DataFrame, int]:
    """Like :func:`durable`, with the number of rows observed while they were written."""
    fixed, rows, _ = weighed(df)
    return fixed, rows


def weighed(df: DataFrame, content: str | None = None) -> tuple[DataFrame, int, int]:
    """Like :func:`counted`, with the summed length of ``content`` as well."""
    size = F.lit(0) if content is None else F.coalesce(F.sum(F.octet_length(content)), F.lit(0))
    seen = Observation("written")
    watched = df.observe(seen, F.count(F.lit(1)).alias("rows"), size.cast("bigint").alias("bytes"))
    fixed = durable(watched)
    return fixed, seen.get["rows"], seen.get["bytes"]


def row_bytes(df: DataFrame) -> Column:
    """About how many bytes a row takes: texts and binaries by their length, nested values as JSON."""
    total = F.lit(0)
    for name, kind in df.dtypes:
        if kind in ("string", "binary"):
            size = F.coalesce(F.octet_length(F.col(name)), F.lit(0))
        elif kind.startswith(("array", "map", "struct")):
            size = F.coalesce(F.octet_length(F.to_json(F.struct(F.col(name)))), F.lit(0))
        else:
            size = F.lit(8)
        total = total + size
    return total


def measured(df: DataFrame) -> DataFrame:
    """A side for a join, broadcast only if its rows and bytes, as written, allow.

    Catalyst cannot estimate a side that comes out of an aggregation and would shuffle the large one
    before AQE knows better. The side is written down, so the count and the join see the same rows
    and nothing is computed twice. Above the limit the join shuffles as usual.
    """
    seen = Observation("weighed")
    fixed = durable(
        df.observe(
            seen,
            F.count(F.lit(1)).alias("rows"),
            F.coalesce(F.sum(row_bytes(df)), F.lit(0)).cast("bigint").alias("bytes"),
        )
    )
    small = seen.get["rows"] <= BROADCAST_ROWS and seen.get["bytes"] <= BROADCAST_BYTES
    return F.broadcast(fixed) if small else fixed
