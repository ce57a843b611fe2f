"""Record-level checks; each yields the names of the rules a row breaks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from shardloom.schemas import OPERATIONS, SPLITS

# The accepted alphabet and padding of strict base64, and the request's top-k range.
BASE64_PATTERN = r"^[A-Za-z0-9+/]*={0,2}\z"
MIN_TOP_K, MAX_TOP_K = 1, 10


def is_base64(text: Column) -> Column:
    """Strict base64: alphabet, trailing padding only, length a multiple of four."""
    return F.coalesce(text.rlike(BASE64_PATTERN) & (F.length(text) % 4 == 0), F.lit(False))


def encode_base64(content: Column) -> Column:
    """Base64 in one line; Spark's own function may break lines every 76 characters."""
    return F.translate(F.base64(content.cast("binary")), "\r\n", "")


def decode_base64(text: Column) -> Column:
    """Decoded bytes, null when the text is not strict base64."""
    return F.when(is_base64(text), F.unbase64(text))


def broken_rules(rules: dict[str, Column]) -> Column:
    """Names of the rules that are false or null for the row, in rule order."""
    return F.array_compact(
        F.array(
            *[
                F.when(~F.coalesce(holds, F.lit(False)), F.lit(name))
                for name, holds in rules.items()
            ]
        )
    )


def request_rules() -> dict[str, Column]:
    return {
        "request_id": F.col("request_id").isNotNull(),
        "iris_b64": is_base64(F.col("iris_b64")),
        "fingerprint_b64": is_base64(F.col("fingerprint_b64")),
        "top_k": F.col("top_k").between(MIN_TOP_K, MAX_TOP_K),
    }


def record_rules() -> dict[str, Column]:
    return {
        "schema_version": F.col("schema_version") >= 1,
        "shard_id": F.col("shard_id").isNotNull(),
        "operation": F.col("operation").isin(*OPERATIONS),
        "path": F.col("path").isNotNull(),
        "byte_size": F.col("byte_size") >= 0,
        "num_rows": F.col("num_rows") >= 0,
    }


def manifest_rules() -> dict[str, Column]:
    return {
        "shard_id": F.col("shard_id").isNotNull(),
        "path": F.col("path").isNotNull(),
        "byte_size": F.col("byte_size") >= 0,
        "num_rows": F.col("num_rows") >= 0,
        "ingested": F.col("ingested").isNotNull(),
    }


def run_rules() -> dict[str, Column]:
    return {
        "run_id": F.col("run_id").isNotNull(),
        "git_sha": F.col("git_sha").isNotNull(),
        "config_hash": F.col("config_hash").isNotNull(),
        "delta_log_offset": F.col("delta_log_offset") >= 0,
        "profile": F.col("profile").isNotNull(),
        "model_name": F.col("model_name").isNotNull(),
        "num_classes": F.col("num_classes") >= 1,
        "max_steps": F.col("max_steps") >= 1,
    }


def candidate_rules() -> dict[str, Column]:
    return {
        "rank": F.col("rank") >= 1,
        "subject_id": F.col("subject_id").isNotNull(),
        "label": F.col("label") >= 0,
        "confidence": F.col("confidence").between(0.0, 1.0),
    }


def frame_rules() -> dict[str, Column]:
    return {
        "schema_version": F.col("schema_version") >= 1,
        "subject_id": F.col("subject_id").isNotNull(),
        "sample_id": F.col("sample_id").isNotNull(),
        "iris_bytes": F.length("iris_bytes") > 0,
        "fingerprint_bytes": F.length("fingerprint_bytes") > 0,
        "label": F.col("label") >= 0,
        "split": F.col("split").isin(*SPLITS),
    }
