"""Frame tables: scans, splits, sampling, pairing, validation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shardloom.functions import hashing as h
from shardloom.functions.checks import broken_rules, frame_rules
from shardloom.operators import guard as g
from shardloom.operators import manifest as m
from shardloom.operators import pairing as p
from shardloom.operators import sampling as sp
from shardloom.operators import splits as s
from shardloom.plans.incremental import planned_split_counts
from shardloom.schemas import FRAME
from shardloom.session import new_folder
from shardloom.sources import shards
from shardloom.sources.footers import footers
from shardloom.workloads import tables as t

WORLD, SEED, EPOCH = 7, 42, 3
BATCH = 32
SHARD_SEED = 42


def _plan(spark: SparkSession, folder: str) -> DataFrame:
    return m.plan(m.fold(t.log(spark, folder)))


def _stored(spark: SparkSession, folder: str) -> str:
    """Frames written as shards to the shared folder."""
    root = new_folder(spark, "shards")
    shards.write_shards(shards.build_frames(t.frames(spark, folder)), root)
    return root


def shard_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Read the planned shards back from the stored frames."""
    frames = shards.scan(spark, _stored(spark, folder), _plan(spark, folder))
    return frames.select("sample_id", "source_shard", F.length("iris_bytes").alias("iris_length"))


def list_shards(spark: SparkSession, folder: str) -> DataFrame:
    return shards.list_shards(spark, _stored(spark, folder))


def keys_prefix(spark: SparkSession, folder: str) -> DataFrame:
    """Shards in storage whose id begins with a 1."""
    return shards.keys_with_prefix(list_shards(spark, folder), "1")


def keys_exist(spark: SparkSession, folder: str) -> DataFrame:
    """Which of the nations' numbers are shards in storage."""
    wanted = t.table(spark, folder, "nation").select(F.col("n_nationkey").cast("string").alias("shard_id"))
    return shards.existing(wanted, list_shards(spark, folder))


def columnar_write(spark: SparkSession, folder: str) -> DataFrame:
    """Rows per shard after a write and a read back."""
    written = spark.read.schema(FRAME).parquet(_stored(spark, folder))
    return s.split_counts(written, "source_shard")


def empty_plan_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Nothing planned: committing every shard leaves an empty plan, which reads no rows."""
    manifest = m.fold(t.log(spark, folder))
    done = m.mark_ingested(manifest, manifest, F.lit("2024-02-01").cast("timestamp"))
    frames = shards.build_frames(t.frames(spark, folder))
    rows = m.planned_rows(frames, m.plan(done))
    return rows.select("sample_id", "subject_id", "label", "source_shard")


def union_shards(spark: SparkSession, folder: str) -> DataFrame:
    """Documents and vectors as two frame tables, all rows of both."""
    docs = t.samples(spark, folder).select("sample_id", "subject_id", F.lit("iris").alias("modality"))
    vectors = t.table(spark, folder, "embeddings").select(
        F.lit("fingerprint").alias("modality"),
        t.zero_padded("vec_id").alias("sample_id"),
        F.concat(F.lit("src"), F.col("label").cast("string")).alias("subject_id"),
    )
    return shards.union_shards(docs, vectors)


def split_filter(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of one split; the filter reaches the scan."""
    return s.only_split(t.frames(spark, folder), "en").select("sample_id", "subject_id", "split")


def frame_build(spark: SparkSession, folder: str) -> DataFrame:
    built = shards.build_frames(t.frames(spark, folder).drop("schema_version", "split"))
    return built.select(
        "schema_version", "subject_id", "sample_id", "label", "split", "source_shard",
        F.length("iris_bytes").cast("bigint").alias("iris_length"),
        F.length("fingerprint_bytes").cast("bigint").alias("fingerprint_length"),
    )


def derived_keys(spark: SparkSession, folder: str) -> DataFrame:
    """Keys built from a document's number and its iris path."""
    listed = t.iris_listing(spark, folder).select("subject_id", "path")
    stem = h.path_stem(F.col("path"))
    number = stem.cast("bigint")
    return listed.select(
        stem.alias("stem"),
        F.concat_ws("_", "subject_id", stem).alias("sample_id"),
        h.subject_name(number).alias("subject_name"),
        h.sample_name(number, F.length("subject_id")).alias("sample_name"),
        h.shard_name(F.lit(SHARD_SEED), number).alias("shard_name"),
    )


def content_hash(spark: SparkSession, folder: str) -> DataFrame:
    docs = t.table(spark, folder, "documents")
    return docs.select("doc_id", h.content_hash(F.col("text")).alias("content_checksum"))


def shards_to_write(spark: SparkSession, folder: str) -> DataFrame:
    """Every user's shard is wanted; those of ingested manifest entries are there."""

    def named(ids: DataFrame) -> DataFrame:
        return ids.select(
            h.shard_name(F.lit(SHARD_SEED), F.col("shard_id").cast("bigint")).alias("shard_id")
        )

    log = t.log(spark, folder)
    return shards.shards_to_write(
        named(log.select("shard_id").distinct()), named(m.fold(log).filter("ingested"))
    )


def assign_shards(spark: SparkSession, folder: str) -> DataFrame:
    return s.assign_shards(t.samples(spark, folder), 3)


def split_stratified(spark: SparkSession, folder: str) -> DataFrame:
    rows = s.stratified(t.samples(spark, folder), "subject_id", ["sample_id"])
    return rows.select("doc_id", "subject_id", "split")


def split_per_shard(spark: SparkSession, folder: str) -> DataFrame:
    rows = s.per_shard(t.samples(spark, folder), "source_shard", ["sample_id"])
    return rows.select("doc_id", "source_shard", "split")


def split_counts(spark: SparkSession, folder: str) -> DataFrame:
    rows = s.stratified(t.samples(spark, folder), "subject_id", ["sample_id"])
    return s.split_counts(rows, "split")


def label_encode(spark: SparkSession, folder: str) -> DataFrame:
    rows = t.samples(spark, folder)
    return s.with_labels(rows, s.encode_labels(rows)).select("doc_id", "subject_id", "label")


def num_classes(spark: SparkSession, folder: str) -> DataFrame:
    return s.num_classes(t.table(spark, folder, "embeddings"))


def sharded_sample(spark: SparkSession, folder: str) -> DataFrame:
    docs = t.table(spark, folder, "documents")
    return sp.sharded_index(docs, "doc_id", WORLD, SEED, EPOCH)


def sharded_sample_drop_last(spark: SparkSession, folder: str) -> DataFrame:
    docs = t.table(spark, folder, "documents")
    return sp.sharded_index(docs, "doc_id", WORLD, shuffle=False, drop_last=True)


def make_batches(spark: SparkSession, folder: str) -> DataFrame:
    """Full batches per language."""
    docs = t.samples(spark, folder)
    return sp.make_batches(docs, ["doc_id"], ["lang"], BATCH, drop_last=True)


def incremental_scan(spark: SparkSession, folder: str) -> DataFrame:
    rows = m.planned_rows(t.samples(spark, folder), _plan(spark, folder))
    return rows.select("doc_id", "subject_id", "source_shard")


def incremental_split_counts(spark: SparkSession, folder: str) -> DataFrame:
    """The whole ingest run: log, manifest, plan, scan, split, counts."""
    return planned_split_counts(t.log(spark, folder), shards.build_frames(t.frames(spark, folder)))


def shard_not_found(spark: SparkSession, folder: str) -> DataFrame:
    """Planned shards for which no document exists."""
    listing = t.samples(spark, folder).select(F.col("source_shard").alias("shard_id"))
    return p.shards_not_found(_plan(spark, folder), listing)


def upcast_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Bring documents of version 1, 2 or none to version 3."""
    old = t.samples(spark, folder).select(
        "doc_id", "subject_id",
        F.expr("CASE WHEN n_chars > 5000 THEN 2 WHEN n_chars > 500 THEN 1 END").alias("schema_version"),
    )
    migrations = {
        1: lambda col: {"split": F.lit("train")},
        2: lambda col: {"origin": F.upper(col("subject_id")), "split": F.coalesce(col("split"), F.lit("val"))},
    }
    return g.upcast(old, migrations).select("doc_id", "schema_version", "split", "origin")


def version_gate(spark: SparkSession, folder: str) -> DataFrame:
    return g.too_new(t.frames(spark, folder), 1).select("sample_id", "schema_version")


def frame_validate(spark: SparkSession, folder: str) -> DataFrame:
    """Broken rules of every frame; the language is no split, and some fingerprints are missing."""
    rows = shards.build_frames(t.frames(spark, folder))
    return rows.select("sample_id", F.array_join(broken_rules(frame_rules()), ",").alias("violations"))


def schema_guard(spark: SparkSession, folder: str) -> DataFrame:
    return g.table_checks(t.frames(spark, folder))


def planted_shards(spark: SparkSession, folder: str) -> str:
    """All frames written as shards; the first shard's files lack ``fingerprint_bytes`` and the last
    shard's hold ``label`` as text, as an older and a wrong writer would leave them."""
    frames = shards.build_frames(t.frames(spark, folder))
    first, last = frames.agg(F.min("source_shard"), F.max("source_shard")).first()
    root = new_folder(spark, "shards")
    shard = F.col("source_shard")
    shards.write_shards(frames.filter((shard != first) & (shard != last)), root)
    shards.write_shards(frames.filter(shard == first).drop("fingerprint_bytes"), root)
    shards.write_shards(frames.filter(shard == last).withColumn("label", F.col("label").cast("string")), root)
    return root


def schema_differences(spark: SparkSession, folder: str) -> DataFrame:
    """Columns that written shards' own files lack or hold with another type, read from their footers."""
    found = g.file_differences(footers(spark, planted_shards(spark, folder)))
    return found.select("shard_id", "column", "problem").distinct()


def pair_modalities(spark: SparkSession, folder: str) -> DataFrame:
    pairs = p.pair(t.iris_listing(spark, folder), t.fingerprint_listing(spark, folder))
    return pairs.select(
        "subject_id", "iris_path", "fingerprint_path",
        F.length("iris_bytes").cast("bigint").alias("iris_length"),
        F.sha2("fingerprint_bytes", 256).alias("fingerprint_hash"),
    )


def common_subjects(spark: SparkSession, folder: str) -> DataFrame:
    return p.common_subjects(t.iris_listing(spark, folder), t.fingerprint_listing(spark, folder))


def missing_modality(spark: SparkSession, folder: str) -> DataFrame:
    return p.missing_modality(t.iris_listing(spark, folder), t.fingerprint_listing(spark, folder))


def missing_roots(spark: SparkSession, folder: str) -> DataFrame:
    """Roots expected of a dataset of three modalities, of which the tables hold two."""
    media = shards.union_shards(
        t.iris_listing(spark, folder).select(F.lit("iris").alias("modality")),
        t.fingerprint_listing(spark, folder).select(F.lit("fingerprint").alias("modality")),
    )
    return p.missing_roots(media, [*p.MODALITIES, "palm"])


QUERIES = {
    fn.__name__: fn
    for fn in (
        shard_scan, list_shards, keys_prefix, keys_exist, columnar_write, empty_plan_scan, union_shards, split_filter, schema_differences,
        frame_build, derived_keys, content_hash, shards_to_write, assign_shards, split_stratified,
        split_per_shard, split_counts, label_encode, num_classes, sharded_sample,
        sharded_sample_drop_last, make_batches, incremental_scan, incremental_split_counts,
        shard_not_found, upcast_rows, version_gate, frame_validate, schema_guard, pair_modalities, common_subjects,
        missing_modality, missing_roots,
    )
}

_PLANNED = "(SELECT shard_id FROM manifest WHERE NOT ingested)"
_KEYED_SQL = """
keyed AS (
  SELECT doc_id, source, lpad(CAST(doc_id AS VARCHAR), 12, '0') AS stem,
         sha256(unhex(lpad(printf('%X', 42), 8, '0') || lpad(printf('%X', doc_id), 8, '0'))) AS digest
  FROM documents
)"""


def _split_sql(group: str, at_least: int, rows: str = "samples") -> str:
    share = "greatest({least}, CAST(floor(count(*) OVER (PARTITION BY {g}) * CAST({f} AS DOUBLE)) AS BIGINT))"
    test = share.format(least=at_least, g=group, f=s.TEST_FRACTION)
    val = share.format(least=at_least, g=group, f=s.VAL_FRACTION)
    return f"""
placed AS (
  SELECT *, row_number() OVER (PARTITION BY {group} ORDER BY sample_id) - 1 AS pos,
         {test} AS n_test, {val} AS n_val
  FROM {rows}
),
split_rows AS (
  SELECT *, CASE WHEN pos < n_test THEN 'test' WHEN pos < n_test + n_val THEN 'val'
                 ELSE 'train' END AS assigned
  FROM placed
)"""


_SPLIT_BY_SUBJECT = (t.SAMPLES_SQL, _split_sql("subject_id", 0))

SQL = {
    "shard_scan": t.with_ctes(
        t.MANIFEST_SQL,
        t.FRAMES_SQL,
        body=f"""
SELECT sample_id, source_shard, CAST(octet_length(iris_bytes) AS INTEGER) AS iris_length
FROM frames WHERE source_shard IN {_PLANNED}""",
    ),
    "list_shards": t.with_ctes(
        t.SAMPLES_SQL, body=" SELECT DISTINCT source_shard AS shard_id FROM samples ORDER BY 1"
    ),
    "keys_prefix": t.with_ctes(
        t.SAMPLES_SQL,
        body=" SELECT DISTINCT source_shard AS shard_id FROM samples WHERE starts_with(source_shard, '1')",
    ),
    "keys_exist": t.with_ctes(
        t.SAMPLES_SQL,
        body="""
SELECT CAST(n_nationkey AS VARCHAR) AS shard_id FROM nation
WHERE CAST(n_nationkey AS VARCHAR) IN (SELECT source_shard FROM samples)""",
    ),
    "columnar_write": t.with_ctes(
        t.SAMPLES_SQL, body=" SELECT source_shard, count(*) AS n_rows FROM samples GROUP BY source_shard"
    ),
    "empty_plan_scan": t.with_ctes(
        t.FRAMES_SQL, body=" SELECT sample_id, subject_id, label, source_shard FROM frames WHERE FALSE"
    ),
    "union_shards": t.with_ctes(
        t.SAMPLES_SQL,
        body="""
SELECT sample_id, subject_id, 'iris' AS modality FROM samples UNION ALL
SELECT lpad(CAST(vec_id AS VARCHAR), 12, '0'), 'src' || label, 'fingerprint' FROM embeddings""",
    ),
    "split_filter": t.with_ctes(
        t.FRAMES_SQL, body=" SELECT sample_id, subject_id, split FROM frames WHERE split = 'en'"
    ),
    "frame_build": t.with_ctes(
        t.FRAMES_SQL,
        body="""
SELECT CAST(1 AS INTEGER) AS schema_version, subject_id, sample_id, label, 'train' AS split,
       source_shard, octet_length(iris_bytes) AS iris_length,
       octet_length(fingerprint_bytes) AS fingerprint_length FROM frames""",
    ),
    "derived_keys": t.with_ctes(
        _KEYED_SQL,
        body="""
SELECT stem, source || '_' || stem AS sample_id, printf('S%04d', doc_id) AS subject_name,
       printf('S%04d_s%02d', doc_id, length(source)) AS sample_name,
       printf('shard_%04d_', doc_id) || substr(digest, 1, 8) AS shard_name FROM keyed""",
    ),
    "content_hash": "SELECT doc_id, sha256(text) AS content_checksum FROM documents",
    "shards_to_write": t.with_ctes(
        t.MANIFEST_SQL,
        """
wanted AS (SELECT DISTINCT user_id FROM events
           WHERE CAST(user_id AS VARCHAR) NOT IN (SELECT shard_id FROM manifest WHERE ingested))""",
        body="""
SELECT printf('shard_%04d_', user_id) || substr(sha256(unhex(
         lpad(printf('%X', 42), 8, '0') || lpad(printf('%X', user_id), 8, '0'))), 1, 8) AS shard_id
FROM wanted""",
    ),
    "assign_shards": """
WITH subjects AS (
  SELECT source AS subject_id, row_number() OVER (ORDER BY source) - 1 AS ordinal,
         greatest(1, count(*) OVER () // 3) AS size
  FROM (SELECT DISTINCT source FROM documents)
)
SELECT subject_id, ordinal, least(ordinal // size, 2) AS shard_index FROM subjects""",
    "split_stratified": t.with_ctes(
        *_SPLIT_BY_SUBJECT, body=" SELECT doc_id, subject_id, assigned AS split FROM split_rows"
    ),
    "split_per_shard": t.with_ctes(
        t.SAMPLES_SQL,
        _split_sql("source_shard", 1),
        body=" SELECT doc_id, source_shard, assigned AS split FROM split_rows",
    ),
    "split_counts": t.with_ctes(
        *_SPLIT_BY_SUBJECT,
        body=" SELECT assigned AS split, count(*) AS n_rows FROM split_rows GROUP BY assigned",
    ),
    "label_encode": """
SELECT doc_id, source AS subject_id, dense_rank() OVER (ORDER BY source) - 1 AS label FROM documents""",
    "num_classes": """
SELECT CAST(max(label) + 1 AS BIGINT) AS num_classes, count(DISTINCT label) AS distinct_labels
FROM embeddings""",
    "sharded_sample": """
WITH drawn AS (
  SELECT doc_id, row_number() OVER (ORDER BY md5('45:' || doc_id), doc_id) - 1 AS pos FROM documents
),
size AS (SELECT count(*) AS n, CAST(ceil(count(*) / 7.0) AS BIGINT) * 7 AS total FROM documents),
filled AS (
  SELECT doc_id, pos FROM drawn UNION ALL
  SELECT doc_id, pos + n FROM drawn, size WHERE pos < total - n
)
SELECT doc_id, pos, pos % 7 AS rank, pos // 7 AS slot FROM filled""",
    "sharded_sample_drop_last": """
WITH drawn AS (
  SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS pos, count(*) OVER () AS n FROM documents
)
SELECT doc_id, pos, pos % 7 AS rank, pos // 7 AS slot FROM drawn WHERE pos < n // 7 * 7""",
    "make_batches": """
WITH placed AS (
  SELECT lang, doc_id, row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1 AS pos,
         count(*) OVER (PARTITION BY lang) AS n FROM documents
)
SELECT lang, doc_id, pos // 32 AS batch_id, pos % 32 AS slot FROM placed WHERE pos < n - n % 32""",
    "incremental_scan": t.with_ctes(
        t.MANIFEST_SQL,
        t.SAMPLES_SQL,
        body=f" SELECT doc_id, subject_id, source_shard FROM samples WHERE source_shard IN {_PLANNED}",
    ),
    "incremental_split_counts": t.with_ctes(
        t.MANIFEST_SQL,
        t.SAMPLES_SQL,
        f"""
planned AS (SELECT * FROM samples WHERE source_shard IN {_PLANNED})""",
        _split_sql("subject_id", 0, "planned"),
        body="""
SELECT subject_id, assigned AS split, count(*) AS n_rows FROM split_rows GROUP BY ALL""",
    ),
    "shard_not_found": t.with_ctes(
        t.MANIFEST_SQL,
        t.SAMPLES_SQL,
        body="""
SELECT shard_id FROM manifest WHERE NOT ingested
  AND shard_id NOT IN (SELECT source_shard FROM samples)""",
    ),
    "upcast_rows": """
SELECT doc_id, CAST(3 AS INTEGER) AS schema_version,
       CASE WHEN n_chars > 5000 THEN 'val' ELSE 'train' END AS split, upper(source) AS origin
FROM documents""",
    "version_gate": t.with_ctes(
        t.FRAMES_SQL, body=" SELECT sample_id, schema_version FROM frames WHERE schema_version > 1"
    ),
    "frame_validate": t.with_ctes(
        t.FRAMES_SQL,
        body="""
SELECT sample_id, concat_ws(',', CASE WHEN octet_length(iris_bytes) = 0 THEN 'iris_bytes' END,
         CASE WHEN fingerprint_bytes IS NULL THEN 'fingerprint_bytes' END, 'split') AS violations
FROM frames""",
    ),
    "schema_guard": t.with_ctes(
        t.FRAMES_SQL,
        """
checks AS (
  SELECT 'max_version' AS check_name, CAST(max(schema_version) AS BIGINT) AS found, 1 AS lim FROM frames
  UNION ALL SELECT 'null_iris_bytes', count(*) FILTER (iris_bytes IS NULL), 0 FROM frames
  UNION ALL SELECT 'empty_iris_bytes', count(*) FILTER (octet_length(iris_bytes) = 0), 0 FROM frames
  UNION ALL SELECT 'null_fingerprint_bytes', count(*) FILTER (fingerprint_bytes IS NULL), 0 FROM frames
  UNION ALL SELECT 'empty_fingerprint_bytes',
                   count(*) FILTER (octet_length(fingerprint_bytes) = 0), 0 FROM frames
)""",
        body=" SELECT check_name, found, found <= lim AS passed FROM checks",
    ),
    "schema_differences": t.with_ctes(
        t.SAMPLES_SQL,
        body="""
SELECT min(source_shard) AS shard_id, 'fingerprint_bytes' AS "column", 'missing' AS problem FROM samples
UNION ALL
SELECT max(source_shard), 'label', 'string, not bigint' FROM samples""",
    ),
    "pair_modalities": t.with_ctes(
        t.LISTINGS_SQL,
        """
first_print AS (
  SELECT subject_id, min(path) AS path, min_by(content, path) AS content FROM fingerprint
  GROUP BY subject_id
)""",
        body="""
SELECT i.subject_id, i.path AS iris_path, f.path AS fingerprint_path,
       octet_length(encode(i.content)) AS iris_length, sha256(f.content) AS fingerprint_hash
FROM iris i JOIN first_print f ON f.subject_id = i.subject_id""",
    ),
    "common_subjects": t.with_ctes(
        t.LISTINGS_SQL,
        body=" SELECT subject_id FROM iris INTERSECT SELECT subject_id FROM fingerprint",
    ),
    "missing_modality": t.with_ctes(
        t.LISTINGS_SQL,
        body="""
SELECT coalesce(i.subject_id, f.subject_id) AS subject_id,
       CASE WHEN i.subject_id IS NULL THEN 'iris' ELSE 'fingerprint' END AS modality,
       CASE WHEN i.subject_id IS NULL THEN 'iris' ELSE 'fingerprint' END || '/'
         || coalesce(i.subject_id, f.subject_id) AS path
FROM (SELECT DISTINCT subject_id FROM iris) i
FULL JOIN (SELECT DISTINCT subject_id FROM fingerprint) f ON f.subject_id = i.subject_id
WHERE i.subject_id IS NULL OR f.subject_id IS NULL""",
    ),
    "missing_roots": t.with_ctes(
        t.LISTINGS_SQL,
        body="""
SELECT modality FROM (VALUES ('iris'), ('fingerprint'), ('palm')) AS w(modality)
EXCEPT (SELECT 'iris' FROM iris UNION ALL SELECT 'fingerprint' FROM fingerprint)""",
    ),
}
