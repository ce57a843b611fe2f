"""The registered queries: every operator on its whole table, in the columns its contract names."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shardloom.llm import alignment, decontaminate, licenses, lm_scoring, merkle, metric_join, mixing, quality_model, quality_rules, sharding, simhash, substrings, tokens

from shardloom.llm.frames import stored
from shardloom.llm.sql import SQL  # noqa: F401  registered with the queries


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _documents(spark: SparkSession, folder: str) -> DataFrame:
    return _table(spark, folder, "documents")


def op1_quality(spark: SparkSession, folder: str) -> DataFrame:
    fold = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4))
    scored = quality_model.score(
        _documents(spark, folder), _table(spark, folder, "labels"), fold != 2, keep=["doc_id"]
    )
    held_out = F.coalesce(fold == 2, F.lit(False))
    return scored.select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted")
    )


def op2_lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    fold = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5))
    docs = _documents(spark, folder).withColumn("held_out", F.coalesce(fold == 1, F.lit(False)))
    return lm_scoring.score(docs, ~F.col("held_out"), keep=["doc_id", "held_out"])


def op3_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    items = _table(spark, folder, "benchmark")
    return decontaminate.find(_documents(spark, folder), items, keep=["doc_id"])


def op4_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    path = str(public_tokenizers.path("piece_bpe_32k.model"))
    return tokens.count_tokens(_documents(spark, folder), path, keep=["doc_id"])


#: Documents as a tree of files: a folder a source, one in it for a language, and in that one for 50
#: numbers each, whose first document plays the folder's licence file.
FILE_PATH = (
    "concat_ws('/', coalesce(source, 'none'), coalesce(lang, 'none'), CAST(doc_id DIV 50 AS STRING),"
    " CASE WHEN doc_id % 50 = 0 THEN 'LICENSE' ELSE concat(CAST(doc_id AS STRING), '.txt') END)"
)


def op5_licenses(spark: SparkSession, folder: str) -> DataFrame:
    files = _documents(spark, folder).withColumn("path", F.expr(FILE_PATH))
    scanned = licenses.scan(files, keep=["doc_id", "path"])
    return scanned.select("doc_id", "path", "licence", "cosine", "via", "licence_directory")


def op6_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    judged = quality_rules.judge(_documents(spark, folder), keep=["doc_id"])
    counts = [F.col(c) for c in quality_rules.COUNTS]
    return judged.select("doc_id", *counts, "base_failed", "kept", F.col("posterior"))


def op7_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.place(_documents(spark, folder)).select("doc_id", "slot", "shard")


def op8_simhash(spark: SparkSession, folder: str) -> DataFrame:
    marked = stored(simhash.fingerprints(_documents(spark, folder), keep=["doc_id"]), "simhash")
    named = simhash.components(marked)
    return named.select("doc_id", simhash.hex_of().alias("fingerprint"), "component_id")


def op9_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    cleaned = substrings.remove_repeats(_documents(spark, folder), keep=["doc_id"])
    digest = F.sha2(F.col("kept_text").cast("binary"), 256)
    return cleaned.select("doc_id", "n_words", "n_removed", digest.alias("kept_sha256"))


def op10_mixing(spark: SparkSession, folder: str) -> DataFrame:
    sized = mixing.sizes(_documents(spark, folder)).select("doc_id", "source", "size")
    rows = mixing.taken_by_row(mixing.units_of(sized, ["doc_id"]))
    return rows.select("doc_id", "size", "source_size", "target", "taken", "source")


def op11_embedding_dedup(spark: SparkSession, folder: str) -> DataFrame:
    linked = metric_join.links(_table(spark, folder, "embeddings"), keep=["vec_id"])
    return linked.select("vec_id", "n_links", "component_id", "kept")


def op12_token_alignment(spark: SparkSession, folder: str) -> DataFrame:
    a_path, b_path, ranks = (str(public_tokenizers.path(f)) for f in (alignment.A_FILE, alignment.B_FILE, alignment.A_RANKS))
    aligned = alignment.align(_documents(spark, folder), a_path, b_path, keep=["doc_id"], a_ranks=ranks)
    return aligned.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256",
    )


def op13_merkle(spark: SparkSession, folder: str) -> DataFrame:
    docs = _documents(spark, folder)
    tampered = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(3)) == 0
    lowered = F.when(tampered, F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    built = merkle.build(docs, altered={"text": lowered.otherwise(F.col("text"))}, keep=["doc_id"])
    return built.select(
        "doc_id", "leaf", "subroot", "root", F.sha2("proof", 256).alias("proof_sha256"), "folded_root", "verified"
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality": op1_quality,
    "op2_lm_scoring": op2_lm_scoring,
    "op3_decontamination": op3_decontamination,
    "op4_token_counts": op4_token_counts,
    "op5_licenses": op5_licenses,
    "op6_quality_rules": op6_quality_rules,
    "op7_sharding": op7_sharding,
    "op8_simhash": op8_simhash,
    "op9_substring_dedup": op9_substring_dedup,
    "op10_mixing": op10_mixing,
    "op11_embedding_dedup": op11_embedding_dedup,
    "op12_token_alignment": op12_token_alignment,
    "op13_merkle": op13_merkle,
}
