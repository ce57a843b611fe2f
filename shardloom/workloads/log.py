"""Delta log and manifest."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shardloom.functions.checks import broken_rules, record_rules
from shardloom.functions.hashing import record_checksum
from shardloom.operators import manifest as m
from shardloom.schemas import ADD, RECORD
from shardloom.session import new_folder
from shardloom.sources.log import parse_record, read_log, record_json, rejects
from shardloom.workloads import tables as t

HALFWAY = "2024-01-16 00:00:00"


def log_append(spark: SparkSession, folder: str) -> DataFrame:
    """Append one ADD record per document to the log."""
    batch = t.samples(spark, folder).select(
        F.lit(1).alias("schema_version"),
        F.col("source_shard").alias("shard_id"),
        F.lit(ADD).alias("operation"),
        F.concat_ws("/", "subject_id", "sample_id").alias("path"),
        F.col("n_chars").alias("byte_size"),
        F.lit(1).cast("bigint").alias("num_rows"),
        F.lit("").alias("record_checksum"),
        "sample_id",
    )
    appended = m.append_records(t.log(spark, folder), batch, ["sample_id"])
    return appended.select("offset", "shard_id", "operation", "path", "byte_size", "record_checksum")


def _tampered(spark: SparkSession, folder: str) -> DataFrame:
    """Records of small events carry the checksum of another operation."""
    other = record_checksum(F.col("shard_id"), F.lower("operation"), F.col("path"))
    bad = F.col("byte_size") < 500
    return t.log(spark, folder).withColumn(
        "record_checksum", F.when(bad, other).otherwise(F.col("record_checksum"))
    )


def log_replay(spark: SparkSession, folder: str) -> DataFrame:
    """Verified records after the position the log had halfway through the period."""
    records = _tampered(spark, folder)
    from_offset = m.stamp(records, F.col("timestamp") < F.lit(HALFWAY).cast("timestamp"))
    return m.replay(records, from_offset).select("offset", "shard_id", "operation", "path")


def log_checksum(spark: SparkSession, folder: str) -> DataFrame:
    empty = t.log(spark, folder).withColumn("record_checksum", F.lit(""))
    return m.fill_checksum(empty).select("offset", "record_checksum")


def log_corrupt_rows(spark: SparkSession, folder: str) -> DataFrame:
    return m.corrupt_records(_tampered(spark, folder)).select("offset", "shard_id", "record_checksum")


def log_reject(spark: SparkSession, folder: str) -> DataFrame:
    """Lines of a written log that must not be folded, by reason: every 50th line is cut short, every
    60th is of a later version, and small records are tampered with."""
    records = _tampered(spark, folder).withColumn(
        "schema_version", F.when(F.col("offset") % 60 == 7, 99).otherwise(F.col("schema_version"))
    )
    line = record_json()
    torn = F.when(F.col("offset") % 50 == 3, F.substring(line, 1, 40)).otherwise(line)
    path = new_folder(spark, "log-lines")
    records.select(torn.alias("value")).write.text(path)
    return rejects(read_log(spark, path)).groupBy("reason").agg(
        F.count("*").alias("n"), F.sum("offset").alias("offsets")
    )


def record_validate(spark: SparkSession, folder: str) -> DataFrame:
    """Broken rules of every record; a commit is no change of a shard."""
    rules = F.array_join(broken_rules(record_rules()), ",")
    return t.log(spark, folder).select("offset", rules.alias("violations"))


def log_offset(spark: SparkSession, folder: str) -> DataFrame:
    return m.log_offset(t.log(spark, folder))


def log_json_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """Encode every record as a JSON line and parse it back."""
    lines = t.log(spark, folder).select(record_json(RECORD.names).alias("line"))
    return lines.select(parse_record(F.col("line")).alias("r")).select(
        "r.offset", "r.shard_id", "r.operation", "r.path", "r.byte_size", "r.num_rows",
        F.col("r.timestamp").cast("timestamp_ntz").alias("recorded_at"),
    )


def manifest_fold(spark: SparkSession, folder: str) -> DataFrame:
    return t.show_manifest(m.fold(t.log(spark, folder)))


def manifest_as_of(spark: SparkSession, folder: str) -> DataFrame:
    """The manifest a run stamped halfway through the period would have seen."""
    records = t.log(spark, folder)
    stamp = m.stamp(records, F.col("timestamp") < F.lit(HALFWAY).cast("timestamp"))
    return t.show_manifest(m.fold(records, as_of=stamp))


def manifest_commit(spark: SparkSession, folder: str) -> DataFrame:
    """Commit every shard that has documents; numbers without a manifest entry are ignored."""
    manifest = m.fold(t.log(spark, folder))
    shards = t.samples(spark, folder).select(F.col("source_shard").alias("shard_id"))
    at = F.lit("2024-02-01 00:00:00").cast("timestamp")
    return t.show_manifest(m.mark_ingested(manifest, shards, at))


def plan_incremental(spark: SparkSession, folder: str) -> DataFrame:
    return m.plan(m.fold(t.log(spark, folder))).select("shard_id", "last_offset")


def plan_full_scan(spark: SparkSession, folder: str) -> DataFrame:
    return m.plan(m.fold(t.log(spark, folder)), m.FULL_SCAN).select("shard_id", "last_offset")


QUERIES = {
    "log_append": log_append,
    "log_replay": log_replay,
    "log_checksum": log_checksum,
    "log_corrupt_rows": log_corrupt_rows,
    "log_reject": log_reject,
    "record_validate": record_validate,
    "log_offset": log_offset,
    "log_json_roundtrip": log_json_roundtrip,
    "manifest_fold": manifest_fold,
    "manifest_as_of": manifest_as_of,
    "manifest_commit": manifest_commit,
    "plan_incremental": plan_incremental,
    "plan_full_scan": plan_full_scan,
}

_SHOW = "shard_id, path, byte_size, num_rows, ingested, ingested_at, last_offset"

SQL = {
    "log_append": t.with_ctes(
        t.SAMPLES_SQL,
        body="""
SELECT (SELECT max(event_id + 1) FROM events) + row_number() OVER (ORDER BY sample_id) AS "offset",
       source_shard AS shard_id, 'ADD' AS operation, subject_id || '/' || sample_id AS path,
       n_chars AS byte_size,
       sha256(source_shard || ':ADD:' || subject_id || '/' || sample_id) AS record_checksum
FROM samples""",
    ),
    "log_replay": t.with_ctes(
        t.LOG_SQL,
        body=f"""
SELECT "offset", shard_id, operation, path FROM log
WHERE "offset" > (SELECT max("offset") FROM log WHERE "timestamp" < TIMESTAMP '{HALFWAY}')
  AND byte_size >= 500""",
    ),
    "log_checksum": t.with_ctes(
        t.LOG_SQL,
        body="""
SELECT "offset", sha256(shard_id || ':' || operation || ':' || path) AS record_checksum FROM log""",
    ),
    "log_corrupt_rows": t.with_ctes(
        t.LOG_SQL,
        body="""
SELECT "offset", shard_id, sha256(shard_id || ':' || lower(operation) || ':' || path) AS record_checksum
FROM log WHERE byte_size < 500""",
    ),
    "log_reject": t.with_ctes(
        t.LOG_SQL,
        body="""
SELECT CASE WHEN "offset" % 50 = 3 THEN 'torn' WHEN "offset" % 60 = 7 THEN 'newer' ELSE 'tampered' END AS reason,
       count(*) AS n,
       CAST(sum(CASE WHEN "offset" % 50 <> 3 THEN "offset" END) AS BIGINT) AS offsets
FROM log WHERE "offset" % 50 = 3 OR "offset" % 60 = 7 OR byte_size < 500 GROUP BY 1""",
    ),
    "record_validate": """
SELECT event_id + 1 AS "offset", CASE event_type WHEN 'view' THEN 'operation' ELSE '' END AS violations
FROM events""",
    "log_offset": "SELECT count(*) AS records, max(event_id + 1) AS last_offset FROM events",
    "log_json_roundtrip": t.with_ctes(
        t.LOG_SQL,
        body="""
SELECT "offset", shard_id, operation, path, byte_size, num_rows,
       "timestamp" AS recorded_at FROM log""",
    ),
    "manifest_fold": t.with_ctes(t.MANIFEST_SQL, body=f" SELECT {_SHOW} FROM manifest"),
    "manifest_as_of": t.with_ctes(
        t.LOG_SQL,
        f"""
seen AS (
  SELECT * FROM log WHERE "offset" <=
    (SELECT max("offset") FROM log WHERE "timestamp" < TIMESTAMP '{HALFWAY}')
)""",
        t.FOLD_SQL.format(log="seen"),
        body=f" SELECT {_SHOW} FROM manifest",
    ),
    "manifest_commit": t.with_ctes(
        t.MANIFEST_SQL,
        t.SAMPLES_SQL,
        """
done AS (SELECT DISTINCT source_shard AS shard_id FROM samples)""",
        body="""
SELECT m.shard_id, path, byte_size, num_rows, ingested OR d.shard_id IS NOT NULL AS ingested,
       CASE WHEN d.shard_id IS NOT NULL THEN TIMESTAMP '2024-02-01 00:00:00' ELSE ingested_at END
         AS ingested_at, last_offset
FROM manifest m LEFT JOIN done d ON d.shard_id = m.shard_id""",
    ),
    "plan_incremental": t.with_ctes(
        t.MANIFEST_SQL,
        body=" SELECT shard_id, last_offset FROM manifest WHERE NOT ingested ORDER BY last_offset",
    ),
    "plan_full_scan": t.with_ctes(
        t.MANIFEST_SQL, body=" SELECT shard_id, last_offset FROM manifest ORDER BY last_offset"
    ),
}
