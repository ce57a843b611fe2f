"""How the stand-in tables play the library's roles, in Spark and in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shardloom.functions.hashing import record_checksum


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def zero_padded(column: str):
    """Text that sorts like the number."""
    return F.lpad(F.col(column).cast("string"), 12, "0")


# --- delta log: one record per event ---------------------------------------------------------------

LOG_COLUMNS = {
    "offset": "event_id + 1",
    "shard_id": "CAST(user_id AS STRING)",
    "operation": (
        "CASE event_type WHEN 'signup' THEN 'ADD' WHEN 'error' THEN 'REMOVE'"
        " WHEN 'view' THEN 'COMMIT' ELSE 'UPDATE' END"
    ),
    "path": "event_type",
    "byte_size": "CAST(round(value * 100) AS BIGINT)",
    "num_rows": "CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT)",
}


def log(spark: SparkSession, folder: str) -> DataFrame:
    """Events as delta records: sign-ups add, views commit, errors remove, all others update."""
    columns = [F.expr(e).alias(c) for c, e in LOG_COLUMNS.items()]
    records = table(spark, folder, "events").select(
        F.lit(1).alias("schema_version"), *columns, F.col("ts").cast("timestamp").alias("timestamp")
    )
    checksum = record_checksum(F.col("shard_id"), F.col("operation"), F.col("path"))
    return records.withColumn("record_checksum", checksum).withColumn(
        "content_checksum", F.lit(None).cast("string")
    )


LOG_SQL = """
log AS (
  SELECT event_id + 1 AS "offset", CAST(user_id AS VARCHAR) AS shard_id,
         CASE event_type WHEN 'signup' THEN 'ADD' WHEN 'error' THEN 'REMOVE'
                         WHEN 'view' THEN 'COMMIT' ELSE 'UPDATE' END AS operation,
         event_type AS path, CAST(round(value * 100) AS BIGINT) AS byte_size,
         CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS num_rows, ts AS "timestamp"
  FROM events
)"""

FOLD_SQL = """
changed AS (
  SELECT *, row_number() OVER (PARTITION BY shard_id ORDER BY "offset" DESC) AS newest
  FROM {log} WHERE operation <> 'COMMIT'
),
committed AS (
  SELECT shard_id, max("offset") AS commit_offset, max_by("timestamp", "offset") AS committed_at
  FROM {log} WHERE operation = 'COMMIT' GROUP BY shard_id
),
manifest AS (
  SELECT c.shard_id, c.path, c.byte_size, c.num_rows,
         coalesce(m.commit_offset > c."offset", FALSE) AS ingested,
         CASE WHEN m.commit_offset > c."offset" THEN m.committed_at END AS ingested_at,
         c."offset" AS last_offset
  FROM changed c LEFT JOIN committed m USING (shard_id)
  WHERE c.newest = 1 AND c.operation <> 'REMOVE'
)"""

MANIFEST_SQL = LOG_SQL + "," + FOLD_SQL.format(log="log")


def show_manifest(manifest: DataFrame) -> DataFrame:
    """Manifest with a zone-less time, which compares without a session time zone."""
    return manifest.select(
        "shard_id",
        "path",
        "byte_size",
        "num_rows",
        "ingested",
        F.col("ingested_at").cast("timestamp_ntz").alias("ingested_at"),
        "last_offset",
    )


# --- frames: documents with the vector of the same number -------------------------------------------


def samples(spark: SparkSession, folder: str, text: bool = False) -> DataFrame:
    """Documents as samples: subject is the source, the shard is the source's number."""
    docs = table(spark, folder, "documents")
    return docs.select(
        "doc_id",
        F.col("source").alias("subject_id"),
        zero_padded("doc_id").alias("sample_id"),
        F.regexp_extract("source", "([0-9]+)", 1).alias("source_shard"),
        "lang",
        "n_chars",
        *(["text"] if text else []),
    )


SAMPLES_SQL = """
samples AS (
  SELECT doc_id, source AS subject_id, lpad(CAST(doc_id AS VARCHAR), 12, '0') AS sample_id,
         regexp_extract(source, '([0-9]+)', 1) AS source_shard, lang, n_chars, text
  FROM documents
)"""


def frames(spark: SparkSession, folder: str) -> DataFrame:
    """Frame table: text bytes and, where a vector of that number exists, its label's bytes.

    Long documents carry a newer schema version, so that version checks have something to find.
    """
    vectors = table(spark, folder, "embeddings").select(
        F.col("vec_id").alias("doc_id"), F.col("label").cast("bigint").alias("label")
    )
    joined = samples(spark, folder, text=True).join(vectors, "doc_id", "left")
    return joined.select(
        F.when(F.col("n_chars") > 5000, 2).otherwise(1).alias("schema_version"),
        "subject_id",
        "sample_id",
        F.col("text").cast("binary").alias("iris_bytes"),
        F.col("label").cast("string").cast("binary").alias("fingerprint_bytes"),
        F.coalesce("label", F.lit(0).cast("bigint")).alias("label"),
        F.col("lang").alias("split"),
        "source_shard",
    )


FRAMES_SQL = (
    SAMPLES_SQL
    + """,
frames AS (
  SELECT CASE WHEN n_chars > 5000 THEN 2 ELSE 1 END AS schema_version, subject_id, sample_id,
         encode(text) AS iris_bytes, encode(CAST(v.label AS VARCHAR)) AS fingerprint_bytes,
         CAST(coalesce(v.label, 0) AS BIGINT) AS label, lang AS split, source_shard
  FROM samples s LEFT JOIN embeddings v ON v.vec_id = s.doc_id
)"""
)


# --- listings of the two modalities -------------------------------------------------------------------


def iris_listing(spark: SparkSession, folder: str) -> DataFrame:
    """One iris file per document; the content is its whole text."""
    rows = samples(spark, folder, text=True)
    path = F.concat(F.lit("iris/"), F.col("subject_id"), F.lit("/"), F.col("sample_id"), F.lit(".png"))
    return rows.select("subject_id", path.alias("path"), F.col("text").cast("binary").alias("content"))


def fingerprint_listing(spark: SparkSession, folder: str) -> DataFrame:
    """One fingerprint file per vector; the subject is named after its label."""
    subject = F.concat(F.lit("src"), F.col("label").cast("string"))
    path = F.concat(F.lit("fingerprint/"), subject, F.lit("/"), zero_padded("vec_id"), F.lit(".png"))
    digest = F.sha2(F.col("vec_id").cast("string").cast("binary"), 256)
    return table(spark, folder, "embeddings").select(
        subject.alias("subject_id"), path.alias("path"), digest.cast("binary").alias("content")
    )


LISTINGS_SQL = """
iris AS (
  SELECT source AS subject_id, 'iris/' || source || '/' || lpad(CAST(doc_id AS VARCHAR), 12, '0')
         || '.png' AS path, text AS content FROM documents
),
fingerprint AS (
  SELECT 'src' || label AS subject_id, 'fingerprint/src' || label || '/'
         || lpad(CAST(vec_id AS VARCHAR), 12, '0') || '.png' AS path,
         sha256(CAST(vec_id AS VARCHAR)) AS content FROM embeddings
)"""


def with_ctes(*ctes: str, body: str) -> str:
    return "WITH " + ",".join(ctes) + body


def rounded(*names: str, digits: int = 6) -> dict:
    return {n: F.round(F.col(n), digits) for n in names}
