"""Run registry and run manifests as tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from shardloom.errors import RegistryFault
from shardloom.operators.ordering import join_null_safe, positions
from shardloom.schemas import MANIFEST_VERSION


def register(batch: DataFrame, order: str, registry: DataFrame | None = None) -> DataFrame:
    """Give each row of ``batch`` the next version of its ``name``, in ``order``.

    Returns the new registry rows with ``version`` and ``uri``; append them to the registry table.
    """
    numbered = positions(batch, [order], ["name"]).withColumn("version", F.col("pos") + 1)
    if registry is not None:
        known = registry.groupBy("name").agg(F.max("version").alias("_known"))
        numbered = (
            join_null_safe(numbered, known, ["name"], "left")
            .withColumn("version", F.col("version") + F.coalesce("_known", F.lit(0)))
            .drop("_known")
        )
    uri = F.concat(F.lit("models:/"), F.col("name"), F.lit("/"), F.col("version").cast("string"))
    return numbered.drop("pos", "n").withColumn("uri", uri)


def latest(registry: DataFrame) -> DataFrame:
    """(name, version, uri) of the highest version of every name, compared as numbers."""
    number = F.col("version").cast("bigint")
    return registry.groupBy("name").agg(
        F.max(number).alias("version"), F.max_by("uri", number).alias("uri")
    )


def latest_uri(registry: DataFrame, name: str) -> str:
    row = latest(registry.filter(F.col("name") == name)).first()
    if row is None:
        raise RegistryFault("no version of this name", name=name)
    return row["uri"]


def find(registry: DataFrame, uri: str) -> Row:
    """The registry row of a version URI."""
    row = registry.filter(F.col("uri") == uri).first()
    if row is None:
        raise RegistryFault("no such version", uri=uri)
    return row


def list_versions(registry: DataFrame, name: str | None = None) -> DataFrame:
    """Versions in descending numeric order, of one name or per name."""
    if name is not None:
        registry = registry.filter(F.col("name") == name)
    return registry.orderBy("name", F.col("version").cast("bigint").desc())


def latest_checkpoint(listing: DataFrame, by: str) -> DataFrame:
    """(by, step, path) of the highest step; ``listing`` is (by, step, path)."""
    return listing.groupBy(by).agg(
        F.max("step").alias("step"), F.max_by("path", F.col("step")).alias("path")
    )


def run_manifest(
    run_id: Column,
    git_sha: Column,
    config_hash: Column,
    log_offset: Column,
    profile: Column,
    model_name: Column,
    classes: Column,
    max_steps: Column,
    best_val_loss: Column,
    created_at: Column,
    extra_tags: Column,
) -> list[Column]:
    """Columns of a run manifest, for one run or a table of runs."""
    return [
        F.lit(MANIFEST_VERSION).alias("schema_version"),
        run_id.alias("run_id"),
        git_sha.alias("git_sha"),
        config_hash.alias("config_hash"),
        log_offset.cast("bigint").alias("delta_log_offset"),
        profile.alias("profile"),
        model_name.alias("model_name"),
        classes.cast("bigint").alias("num_classes"),
        max_steps.cast("bigint").alias("max_steps"),
        best_val_loss.cast("double").alias("best_val_loss"),
        created_at.alias("created_at"),
        extra_tags.alias("extra_tags"),
    ]


# The manifest fields that become tags.
TAG_FIELDS = (
    "run_id",
    "git_sha",
    "config_hash",
    "delta_log_offset",
    "profile",
    "model_name",
    "schema_version",
)


def tag_map() -> Column:
    """Flat string map of a run manifest; extra tags win over fields of the same name."""
    pairs = [c for f in TAG_FIELDS for c in (F.lit(f), F.col(f).cast("string"))]
    extra = F.coalesce(F.col("extra_tags"), F.create_map().cast("map<string,string>"))
    own = F.map_filter(F.create_map(*pairs), lambda k, v: ~F.map_contains_key(extra, k))
    return F.map_concat(own, extra)


def run_tags(manifests: DataFrame) -> DataFrame:
    """(run_id, key, value), one row per tag."""
    return manifests.select("run_id", F.explode(tag_map()).alias("key", "value"))
