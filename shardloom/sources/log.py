"""Delta log as NDJSON or Parquet, and provenance output."""

from __future__ import annotations

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shardloom.errors import LogFault, RunFault
from shardloom.operators.guard import row_version
from shardloom.operators.manifest import checksum_holds
from shardloom.operators.registry import run_tags
from shardloom.schemas import RECORD, RECORD_VERSION, REQUEST
from shardloom.session import durable

BAD_LINE = "_corrupt_record"
JSON_TIME = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}  # keep microseconds


def write_log(records: DataFrame, path: str, mode: str = "append") -> None:
    """Append numbered records; the commit protocol makes the batch visible at once."""
    records.select(*RECORD.names).write.mode(mode).options(**JSON_TIME).json(path)


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """Records of an NDJSON log plus ``_corrupt_record`` for lines that are not JSON.

    Blank lines and unknown fields are dropped; a missing version counts as the first one.
    """
    schema = T.StructType([*RECORD.fields, T.StructField(BAD_LINE, T.StringType())])
    reader = spark.read.schema(schema).option("mode", "PERMISSIVE")
    rows = reader.option("columnNameOfCorruptRecord", BAD_LINE).json(path)
    return rows.withColumn("schema_version", row_version())


def readable(log: DataFrame, supported: int = RECORD_VERSION) -> DataFrame:
    """Rows that parsed and whose version is supported; :func:`rejects` has the others. A manifest
    should be folded from :func:`trusted` rows."""
    good = F.col(BAD_LINE).isNull() & (F.col("schema_version") <= supported)
    return log.filter(good).drop(BAD_LINE)


def rejects(log: DataFrame, supported: int = RECORD_VERSION) -> DataFrame:
    """Lines that must not be folded, with a ``reason``: ``torn`` (not JSON), ``newer`` (a version this
    library does not read) or ``tampered`` (the checksum is not that of the record)."""
    reason = (
        F.when(F.col(BAD_LINE).isNotNull(), "torn")
        .when(F.col("schema_version") > supported, "newer")
        .when(F.col("record_checksum").isNull() | ~checksum_holds(), "tampered")
    )
    return log.withColumn("reason", reason).filter(F.col("reason").isNotNull())


def trusted(log: DataFrame, supported: int = RECORD_VERSION) -> DataFrame:
    """The records of a log in which nothing is to be rejected; raises on the first line that is."""
    first = rejects(log, supported).orderBy(F.col("offset").asc_nulls_last()).head()
    if first:
        raise LogFault(
            "a line of the log cannot be used", offset=first["offset"], shard_id=first["shard_id"], cause=first["reason"]
        )
    return log.drop(BAD_LINE)


def record_json(fields: list[str] | None = None):
    """One record as a JSON line."""
    return F.to_json(F.struct(*(fields or RECORD.names)), JSON_TIME)


def parse_record(line):
    return F.from_json(line, RECORD)


def read_requests(spark: SparkSession, path: str) -> DataFrame:
    """Scoring requests; a missing ``top_k`` or version takes its default of 1."""
    rows = spark.read.schema(REQUEST).json(path)
    return rows.fillna({"top_k": 1, "schema_version": 1})


def write_provenance(manifest: DataFrame, path: str) -> None:
    """Write a run manifest as JSON and its tags as rows; a failure of either aborts the run.

    ``manifest`` holds the rows of the runs being closed. Rows of earlier runs in ``path`` stay.
    """
    try:
        # Stored first: both outputs must show the same values, whatever the rows are made of.
        manifest = durable(manifest)
        manifest.write.mode("append").option("ignoreNullFields", "false").json(f"{path}/run_manifest")
        run_tags(manifest).write.mode("append").parquet(f"{path}/run_tags")
    except PySparkException as error:
        raise RunFault(f"run manifest not stored: {error}", path=path) from error
