"""Fixed schemas of the data model, their versions, and the version column's metadata."""

from __future__ import annotations

from pyspark.sql import types as T

FRAME_VERSION = 1
RECORD_VERSION = 1
MANIFEST_VERSION = 1
REQUEST_VERSION = 1

SPLITS = ("train", "val", "test")
ADD, UPDATE, REMOVE, COMMIT = "ADD", "UPDATE", "REMOVE", "COMMIT"
OPERATIONS = (ADD, UPDATE, REMOVE)


def _version_field(schema: str, version: int) -> T.StructField:
    return T.StructField(
        "schema_version",
        T.IntegerType(),
        metadata={"schema_name": schema, "schema_version": str(version)},
    )


FRAME = T.StructType(
    [
        _version_field("Frame", FRAME_VERSION),
        T.StructField("subject_id", T.StringType()),
        T.StructField("sample_id", T.StringType()),
        T.StructField("iris_bytes", T.BinaryType()),
        T.StructField("fingerprint_bytes", T.BinaryType()),
        T.StructField("label", T.LongType()),
        T.StructField("split", T.StringType()),
        T.StructField("source_shard", T.StringType()),
    ]
)

# ``record_checksum`` covers the record's identity and ``content_checksum`` the file's bytes; one
# column for both would make every record of the change feed look corrupt on replay.
RECORD = T.StructType(
    [
        _version_field("DeltaRecord", RECORD_VERSION),
        T.StructField("offset", T.LongType()),
        T.StructField("shard_id", T.StringType()),
        T.StructField("operation", T.StringType()),
        T.StructField("path", T.StringType()),
        T.StructField("byte_size", T.LongType()),
        T.StructField("num_rows", T.LongType()),
        T.StructField("record_checksum", T.StringType()),
        T.StructField("content_checksum", T.StringType()),
        T.StructField("timestamp", T.TimestampType()),
    ]
)

# What the continuous fold stores per shard; removed shards stay, marked by their operation.
MANIFEST_STATE = T.StructType(
    [
        T.StructField("shard_id", T.StringType()),
        T.StructField("operation", T.StringType()),
        T.StructField("path", T.StringType()),
        T.StructField("byte_size", T.LongType()),
        T.StructField("num_rows", T.LongType()),
        T.StructField("last_offset", T.LongType()),
        T.StructField("commit_offset", T.LongType()),
        T.StructField("committed_at", T.TimestampType()),
    ]
)

REQUEST = T.StructType(
    [
        _version_field("PredictRequest", REQUEST_VERSION),
        T.StructField("request_id", T.StringType()),
        T.StructField("iris_b64", T.StringType()),
        T.StructField("fingerprint_b64", T.StringType()),
        T.StructField("top_k", T.IntegerType()),
    ]
)
