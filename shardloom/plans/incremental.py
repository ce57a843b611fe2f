"""The ingest run: log, manifest, plan, scan, validation, split, commit."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shardloom.operators import guard as g
from shardloom.operators import manifest as m
from shardloom.operators import splits
from shardloom.session import counted


@dataclass(frozen=True)
class IngestRun:
    """Results of one run; ``planned`` is fixed, the others are lazy."""

    planned: DataFrame
    frames: DataFrame
    commit: DataFrame


def ingest(
    log: DataFrame,
    frames: DataFrame,
    at: Column | None = None,
    strategy: str = m.INCREMENTAL,
    on_empty: str = "none",
    strict: bool = True,
    footers: DataFrame | None = None,
) -> IngestRun:
    """Fold the log, plan, read the planned rows, validate them, split them per subject.

    ``commit`` holds the records to append once the frames have been used successfully. With
    ``strict`` a violation raises before anything is returned: the planned files' own columns and
    types where ``footers`` (``sources.footers``) are given, then versions and null media, counted
    while the split reads the rows, so no pass is spent on checking.
    """
    # Written down: scan and commit must name the same shards even if the log grows meanwhile.
    planned, shards = counted(m.plan(m.fold(log), strategy))
    rows = m.planned_rows(frames, planned, on_empty, known=shards)
    if strict and footers is not None:
        g.guard_files(footers, planned)
    if strict:
        g.guard_columns(rows.schema)
        rows, seen = g.observed_checks(rows)
    # A sample's id may repeat over folders and shards; its contents tell such rows apart.
    rows = rows.drop("split").withColumn("_content", F.xxhash64("iris_bytes", "fingerprint_bytes"))
    order = ["sample_id", "source_shard", "_content"]
    split = splits.stratified(rows, "subject_id", order).drop("_content")
    if strict:
        g.judge_observed(seen)
    commit = m.commit_records(planned, F.current_timestamp() if at is None else at)
    return IngestRun(planned, split, commit)


def planned_split_counts(log: DataFrame, frames: DataFrame) -> DataFrame:
    """Rows per subject and split of what an incremental run would train on."""
    run = ingest(log, frames, strict=False)
    return splits.split_counts(run.frames, "subject_id", "split")
