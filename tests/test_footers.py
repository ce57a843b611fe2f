"""Files' own schemas: footers read by executors, differences, and the guard of an ingest run."""

import pytest
from pyspark.sql import functions as F
from test_frames import frames
from test_manifest import append

from shardloom.errors import GuardFault, VersionFault
from shardloom.operators import guard as g
from shardloom.operators import manifest as m
from shardloom.plans.incremental import ingest
from shardloom.sources import shards
from shardloom.sources.footers import footers


def written(spark, tmp_path):
    """shard_0 whole, shard_1 without fingerprints, shard_2 with text labels, plus a broken file."""
    root = str(tmp_path / "shards")
    rows = shards.build_frames(frames(spark, 10, 20))
    shard = F.col("source_shard")
    rows = rows.withColumn("source_shard", F.concat(F.lit("shard_"), (F.col("label") % 3).cast("string")))
    shards.write_shards(rows.filter(shard == "shard_0"), root)
    shards.write_shards(rows.filter(shard == "shard_1").drop("fingerprint_bytes"), root)
    shards.write_shards(rows.filter(shard == "shard_2").withColumn("label", F.col("label").cast("string")), root)
    (tmp_path / "shards" / "source_shard=shard_3").mkdir()
    (tmp_path / "shards" / "source_shard=shard_3" / "torn.parquet").write_bytes(b"PAR1 not a footer")
    return root


def test_footers_and_differences(spark, tmp_path):
    root = written(spark, tmp_path)
    read = footers(spark, root)
    whole = read.filter("shard_id = 'shard_0'").select("column", "type").distinct().collect()
    assert {(r.column, r.type) for r in whole} == {
        (f.name, f.dataType.simpleString()) for f in shards.FRAME.fields if f.name != "source_shard"
    }
    found = {(r.shard_id, r.column, r.problem.split(":")[0]) for r in g.file_differences(read).collect()}
    assert found == {
        ("shard_1", "fingerprint_bytes", "missing"),
        ("shard_2", "label", "string, not bigint"),
        ("shard_3", None, "unreadable"),
    }
    # A read with the fixed schema hides the missing column as nulls: only the footers tell.
    assert spark.read.schema(shards.FRAME).parquet(root + "/source_shard=shard_1").filter("fingerprint_bytes IS NULL").count() > 0


def test_guard_files_names_only_planned_shards(spark, tmp_path):
    read = footers(spark, written(spark, tmp_path))
    g.guard_files(read, spark.createDataFrame([("shard_0",)], "shard_id string"))
    with pytest.raises(GuardFault, match="shard_1 fingerprint_bytes: missing"):
        g.guard_files(read, spark.createDataFrame([("shard_1",), ("shard_0",)], "shard_id string"))
    with pytest.raises(GuardFault, match="unreadable"):
        g.guard_files(read)


def test_ingest_raises_for_the_files_it_plans(spark, tmp_path):
    root = written(spark, tmp_path)
    read = footers(spark, root)
    log = append(spark, m.empty_log(spark), ("shard_0", "ADD"), ("shard_1", "ADD"))
    df = spark.read.schema(shards.FRAME).parquet(root)
    with pytest.raises(GuardFault, match="shard_1"):
        ingest(log, df, footers=read)
    clean = append(spark, m.empty_log(spark), ("shard_0", "ADD"))
    run = ingest(clean, df, footers=read)
    assert run.frames.count() == df.filter("source_shard = 'shard_0'").count()


def test_checks_ride_on_the_split(spark):
    log = append(spark, m.empty_log(spark), ("shard_0", "ADD"))
    df = frames(spark, 10, 20)
    rows, seen = g.observed_checks(df)
    rows.count()
    assert seen.get == {"max_version": 1, "null_iris_bytes": 0, "null_fingerprint_bytes": 0}
    with pytest.raises(VersionFault):
        ingest(log, df.withColumn("schema_version", F.lit(7)))
    with pytest.raises(GuardFault, match="fingerprint_bytes"):
        ingest(log, df.withColumn("fingerprint_bytes", F.lit(None).cast("binary")))
