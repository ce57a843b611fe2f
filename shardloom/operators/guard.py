"""Schema evolution and validation."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shardloom.errors import GuardFault, VersionFault
from shardloom.functions.checks import broken_rules
from shardloom.schemas import FRAME, FRAME_VERSION

Migration = Callable[[Callable[[str], Column]], dict[str, Column]]

MEDIA_COLUMNS = ("iris_bytes", "fingerprint_bytes")


def row_version() -> Column:
    """A row's schema version; a missing one counts as 1."""
    return F.coalesce(F.col("schema_version"), F.lit(1)).cast("int")


def upcast(df: DataFrame, migrations: dict[int, Migration]) -> DataFrame:
    """Bring old rows forward, one version at a time, in ascending order.

    A migration returns ``{column: expression}`` for rows at its version; the version moves up by
    one unless the migration sets ``schema_version`` itself. Columns that no older row has are null
    until their step sets them.
    """
    df = df.withColumn("schema_version", row_version())
    for version in sorted(migrations):
        changes = {"schema_version": F.lit(version + 1), **migrations[version](F.col)}
        due = F.col("schema_version") == version
        kept = {c: F.col(c) if c in df.columns else F.lit(None) for c in changes}
        df = df.withColumns({c: F.when(due, e).otherwise(kept[c]) for c, e in changes.items()})
    return df


def too_new(df: DataFrame, supported: int, schema: str = "Frame", strict: bool = False) -> DataFrame:
    """Rows whose version this reader does not support."""
    newer = df.filter(row_version() > supported)
    if strict:
        found = newer.agg(F.max(row_version())).first()[0]
        if found is not None:
            raise VersionFault("rows are too new", schema=schema, found=found, supported=supported)
    return newer


def schema_differences(actual: T.StructType, expected: T.StructType = FRAME) -> list[tuple[str, str]]:
    """(column, problem) for every expected column that is missing or has another type.

    Pass the file's own schema: a read with a fixed schema turns a missing column into nulls.
    """
    types = {f.name: f.dataType for f in actual.fields}
    problems = []
    for field in expected.fields:
        if field.name not in types:
            problems.append((field.name, "missing"))
        elif types[field.name] != field.dataType:
            found = types[field.name].simpleString()
            problems.append((field.name, f"{found}, not {field.dataType.simpleString()}"))
    return sorted(problems)


def file_differences(
    footers: DataFrame, expected: T.StructType = FRAME, partitions: tuple[str, ...] = ("source_shard",)
) -> DataFrame:
    """(shard_id, path, column, problem) for every file of ``footers`` (see ``sources.footers``) that
    lacks an expected column, holds it with another type, or cannot be read. Partition columns live
    in folder names, not in files, and are not looked for there."""
    wanted = [f for f in expected.fields if f.name not in partitions]
    spark = footers.sparkSession
    types = spark.createDataFrame(
        [(f.name, f.dataType.simpleString()) for f in wanted], "column string, expected string"
    )
    files = footers.select("path", "shard_id").distinct()
    names = F.array(*[F.lit(f.name) for f in wanted])
    asked = files.select("path", "shard_id", F.explode(names).alias("column"))
    found = footers.filter(F.col("problem").isNull())
    missing = asked.join(found.select("path", "column"), ["path", "column"], "left_anti").withColumn(
        "problem", F.lit("missing")
    )
    retyped = found.join(F.broadcast(types), "column").filter(F.col("type") != F.col("expected"))
    retyped = retyped.select(
        "path", "shard_id", "column", F.concat("type", F.lit(", not "), "expected").alias("problem")
    )
    unreadable = footers.filter(F.col("problem").isNotNull()).select("path", "shard_id", "column", "problem")
    # A file that cannot be read also lacks every column; the one row of its own says why.
    missing = missing.join(unreadable.select("path"), "path", "left_anti")
    columns = ["shard_id", "path", "column", "problem"]
    return missing.select(*columns).unionByName(retyped.select(*columns)).unionByName(unreadable.select(*columns))


def observed_checks(df: DataFrame, name: str = "frame checks") -> tuple[DataFrame, Observation]:
    """``df`` with the version and null-media checks of :func:`guard` observed while another job
    reads it, so that checking costs no pass of its own; judge them with :func:`judge_observed`."""
    seen = Observation(name)
    measures = [F.max("schema_version").alias("max_version")]
    measures += [F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in MEDIA_COLUMNS]
    return df.observe(seen, *measures), seen


def judge_observed(seen: Observation, source: str = "<table>", supported: int = FRAME_VERSION) -> None:
    """Raise as :func:`guard` would for what ``seen`` counted; call it after a job has read the rows."""
    found = seen.get
    if found.get("max_version") is not None and found["max_version"] > supported:
        raise VersionFault("rows are too new", source=source, found=found["max_version"], supported=supported)
    for name in MEDIA_COLUMNS:
        if found.get(f"null_{name}"):
            raise GuardFault(f"{found[f'null_{name}']} null(s) in {name}", source=source)


def guard_files(footers: DataFrame, shards: DataFrame | None = None, source: str = "<files>", shown: int = 20) -> None:
    """Raise if any file (of ``shards``' ``shard_id`` where given) lacks or retypes an expected column."""
    differences = file_differences(footers)
    if shards is not None:
        differences = differences.join(shards.select("shard_id").distinct(), "shard_id", "left_semi")
    found = differences.orderBy("shard_id", "path", "column").limit(shown).collect()
    if found:
        listed = "; ".join(f"{r['shard_id']} {r['column']}: {r['problem']}" for r in found)
        raise GuardFault(listed, source=source)


def table_checks(df: DataFrame, supported: int = FRAME_VERSION) -> DataFrame:
    """Newest version, null media and empty media of a frame table: one pass, one row a check."""
    measures = [F.coalesce(F.max("schema_version"), F.lit(0)).cast("bigint").alias("max_version")]
    for name in MEDIA_COLUMNS:
        measures.append(F.count_if(F.col(name).isNull()).alias(f"null_{name}"))
        measures.append(F.count_if(F.length(name) == 0).alias(f"empty_{name}"))
    one = df.agg(*measures)
    listed = F.array(
        *[F.struct(F.lit(c).alias("check_name"), F.col(c).alias("found")) for c in one.columns]
    )
    limit = F.when(F.col("check_name") == "max_version", supported).otherwise(0)
    return (
        one.select(F.explode(listed).alias("c"))
        .select("c.*")
        .withColumn("passed", F.col("found") <= limit)
    )


def guard_columns(schema: T.StructType, source: str = "<table>") -> None:
    """Raise for expected columns that ``schema`` lacks or holds with another type."""
    problems = schema_differences(schema)
    if problems:
        raise GuardFault("; ".join(f"{c}: {p}" for c, p in problems), source=source)


def guard(
    df: DataFrame,
    file_schema: T.StructType | None = None,
    source: str = "<table>",
    supported: int = FRAME_VERSION,
) -> DataFrame:
    """Strict check, in order: columns and types, version, media; returns ``df`` or raises.

    Empty media are left to the decoder, which names the sample.
    """
    guard_columns(file_schema or df.schema, source)
    found = {r["check_name"]: r["found"] for r in table_checks(df, supported).collect()}  # 5 rows
    if found["max_version"] > supported:
        raise VersionFault("rows are too new", source=source, found=found["max_version"], supported=supported)
    for name in MEDIA_COLUMNS:
        if found[f"null_{name}"]:
            raise GuardFault(f"{found[f'null_{name}']} null(s) in {name}", source=source)
    return df


def separate(df: DataFrame, rules: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """(rows that keep every rule, broken rows with a ``violations`` array)."""
    checked = df.withColumn("violations", broken_rules(rules))
    valid = checked.filter(F.size("violations") == 0).drop("violations")
    return valid, checked.filter(F.size("violations") > 0)
