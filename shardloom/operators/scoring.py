"""Scoring: softmax top-k, names, nested responses, evaluation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shardloom.functions.arrays import argmax, softmax
from shardloom.functions.hashing import subject_name
from shardloom.schemas import REQUEST_VERSION
from shardloom.session import durable

CONFIDENCE_DIGITS = 6


def top_candidates(probabilities: Column, k: Column | int) -> Column:
    """Array of (rank, label, confidence), best first, ties by lower label; at most all classes.

    Sorting happens inside the row, so no shuffle is needed.
    """
    k = F.lit(k) if isinstance(k, int) else k
    scored = F.transform(
        probabilities, lambda p, i: F.struct((-p).alias("neg"), i.cast("bigint").alias("label"))
    )
    best = F.slice(F.array_sort(scored), F.lit(1), F.least(k, F.size(probabilities)))
    return F.transform(
        best,
        lambda c, i: F.struct(
            (i + 1).cast("int").alias("rank"),
            c["label"].alias("label"),
            F.round(-c["neg"], CONFIDENCE_DIGITS).alias("confidence"),
        ),
    )


def _named(candidates: DataFrame, names: DataFrame) -> DataFrame:
    """Add ``subject_id`` by label; labels without a name get the default one."""
    known = names.select("label", F.col("subject_id").alias("_name"))
    name = F.coalesce("_name", subject_name(F.col("label")))
    return candidates.join(known, "label", "left").withColumn("subject_id", name).drop("_name")


def top_k(df: DataFrame, key: list[str], logits: str, k: Column | int, names: DataFrame) -> DataFrame:
    """(key columns, rank, label, subject_id, confidence), one row per candidate.

    ``names`` is (label, subject_id) with unique labels.
    """
    ranked = df.select(*key, F.explode(top_candidates(softmax(F.col(logits)), k)).alias("c"))
    named = _named(ranked.select(*key, "c.*"), names)
    return named.select(*key, "rank", "label", "subject_id", "confidence")


def responses(
    requests: DataFrame,
    logits: str,
    k: Column | int,
    names: DataFrame,
    model_version: str,
    latency_ms: Column | None = None,
) -> DataFrame:
    """One nested response per scored request.

    Candidates are gathered per request row, not per ``request_id``, because callers may repeat an
    id; a row has at most ``k`` of them. The short candidate lists are stored with their row numbers,
    so that a retried task cannot number them anew. ``latency_ms`` is null unless measured.
    """
    latency = F.lit(None).cast("double") if latency_ms is None else latency_ms
    ranked = requests.select(
        "request_id",
        latency.alias("latency_ms"),
        top_candidates(softmax(F.col(logits)), k).alias("candidates"),
    )
    stored = durable(ranked.withColumn("_row", F.monotonically_increasing_id()))
    row = ["_row", "request_id", "latency_ms"]
    listed = _named(stored.select(*row, F.explode("candidates").alias("c")).select(*row, "c.*"), names)
    entry = F.struct("rank", "subject_id", "label", "confidence")
    gathered = listed.groupBy(*row).agg(F.sort_array(F.collect_list(entry)).alias("predictions"))
    return gathered.select(
        F.lit(REQUEST_VERSION).alias("schema_version"),
        "request_id",
        "predictions",
        F.lit(model_version).alias("model_version"),
        "latency_ms",
    )


def response_json(nested: DataFrame) -> DataFrame:
    return nested.select("request_id", F.to_json(F.struct(*nested.columns)).alias("body"))


def _loss(logits: str, label: str) -> Column:
    """Cross-entropy of one row by the log-sum-exp form, which does not underflow."""
    values = F.col(logits)
    top = F.array_max(values).cast("double")
    exps = F.aggregate(values, F.lit(0.0), lambda s, x: s + F.exp(x.cast("double") - top))
    return top + F.log(exps) - F.get(values, F.col(label)).cast("double")


def with_outcome(df: DataFrame, logits: str, label: str) -> DataFrame:
    hit = (argmax(F.col(logits)) == F.col(label)).cast("double")
    return df.withColumns({"loss": _loss(logits, label), "correct": hit})


def evaluate(df: DataFrame, logits: str, label: str) -> DataFrame:
    """One row: n, n_unscored, val_loss, val_accuracy; both NaN without samples.

    A row whose label has no logit counts as a wrong answer and has no loss; ``n_unscored`` says how
    many such rows there are, so that a loss over fewer rows than ``n`` is seen."""
    nan = F.lit(float("nan"))
    scored = with_outcome(df.select(logits, label), logits, label)
    return scored.agg(
        F.count("*").alias("n"),
        F.count_if(F.col("loss").isNull()).alias("n_unscored"),
        F.coalesce(F.avg("loss"), nan).alias("val_loss"),
        F.coalesce(F.avg("correct"), nan).alias("val_accuracy"),
    )


def batch_metrics(df: DataFrame, batch: str, logits: str, label: str) -> DataFrame:
    return batch_averages(with_outcome(df.select(batch, logits, label), logits, label), batch)


def batch_averages(outcome: DataFrame, batch: str) -> DataFrame:
    """(batch, n, loss, accuracy) from rows of :func:`with_outcome`."""
    return outcome.groupBy(batch).agg(
        F.count("*").alias("n"), F.avg("loss").alias("loss"), F.avg("correct").alias("accuracy")
    )
