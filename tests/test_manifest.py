import datetime
import random

import pytest
from pyspark.sql import functions as F

from shardloom.errors import LogFault
from shardloom.operators import manifest as m
from shardloom.schemas import RECORD
from shardloom.sources.log import parse_record, read_log, readable, record_json, write_log
from shardloom.streaming import changes, manifest as stream_manifest

COLUMNS = "shard_id string, operation string, path string, byte_size bigint, num_rows bigint"


def batch(spark, *rows):
    """(shard, operation) pairs as unnumbered records."""
    data = [(i, s, op, f"p/{s}", 10 * i, i) for i, (s, op) in enumerate(rows)]
    df = spark.createDataFrame(data, "seq int, " + COLUMNS)
    return df.withColumns(
        {
            "schema_version": F.lit(1),
            "record_checksum": F.lit(""),
            "content_checksum": F.lit(None).cast("string"),
            "timestamp": F.lit("2024-05-01 10:00:00.123456").cast("timestamp"),
        }
    )


def append(spark, log, *rows):
    added = m.append_records(log, batch(spark, *rows), ["seq"]).select(*RECORD.names)
    return log.unionByName(added)


def ids(df):
    return [r.shard_id for r in df.collect()]


def test_incremental_plan_returns_only_new_shards(spark):
    log = append(spark, m.empty_log(spark), *[(f"shard_{i}", "ADD") for i in range(5)])
    planned = m.plan(m.fold(log))
    assert ids(planned) == [f"shard_{i}" for i in range(5)]
    done = m.commit_records(planned.limit(3), F.current_timestamp()).withColumn("seq", F.col("shard_id"))
    log = log.unionByName(m.append_records(log, done, ["seq"]).select(*RECORD.names))
    assert ids(m.plan(m.fold(log))) == ["shard_3", "shard_4"]
    assert ids(m.plan(m.fold(log), m.FULL_SCAN)) == [f"shard_{i}" for i in range(5)]


def test_full_scan_after_everything_is_ingested(spark):
    log = append(spark, m.empty_log(spark), *[(f"s{i}", "ADD") for i in range(3)])
    manifest = m.mark_ingested(m.fold(log), m.fold(log), F.lit("2024-01-01").cast("timestamp"))
    assert ids(m.plan(manifest, m.FULL_SCAN)) == ["s0", "s1", "s2"]
    assert ids(m.plan(manifest)) == []


def test_offsets_agree_and_continue(spark):
    log = append(spark, m.empty_log(spark), *[(f"s{i}", "ADD") for i in range(4)])
    log = append(spark, log, ("s0", "REMOVE"), ("s1", "UPDATE"), ("s9", "ADD"))
    assert m.log_offset(log).first().asDict() == {"records": 7, "last_offset": 7}
    assert sorted(r.offset for r in log.collect()) == list(range(1, 8))
    assert m.log_offset(m.empty_log(spark)).first().asDict() == {"records": 0, "last_offset": 0}


def test_update_resets_remove_deletes_unknown_commit_is_ignored(spark):
    log = append(
        spark, m.empty_log(spark),
        ("a", "ADD"), ("b", "ADD"), ("c", "ADD"), ("a", "COMMIT"), ("b", "COMMIT"), ("ghost", "COMMIT"),
        ("b", "UPDATE"), ("c", "REMOVE"), ("c", "COMMIT"),
    )
    found = {r.shard_id: r for r in m.fold(log).collect()}
    assert set(found) == {"a", "b"}
    assert found["a"].ingested and found["a"].ingested_at == datetime.datetime(2024, 5, 1, 10, 0, 0, 123456)
    assert not found["b"].ingested and found["b"].ingested_at is None and found["b"].byte_size == 60
    assert {r.shard_id for r in m.fold(log, as_of=3).collect()} == {"a", "b", "c"}


def test_removed_and_added_again(spark):
    log = append(spark, m.empty_log(spark), ("a", "ADD"), ("a", "COMMIT"), ("a", "REMOVE"), ("a", "ADD"))
    row = m.fold(log).first()
    assert (row.shard_id, row.ingested, row.last_offset) == ("a", False, 4)


def _by_hand(records):
    """Apply records one by one, as a keyed table would."""
    table = {}
    for offset, shard, operation in sorted(records):
        if operation == "REMOVE":
            table.pop(shard, None)
        elif operation == "COMMIT":
            if shard in table:
                table[shard] = (table[shard][0], True)
        else:
            table[shard] = (offset, False)
    return table


def test_fold_and_merge_equal_record_by_record_application(spark):
    rng = random.Random(5)
    operations = ["ADD", "UPDATE", "REMOVE", "COMMIT", "COMMIT"]
    records = [(i + 1, rng.choice("abcdefgh"), rng.choice(operations)) for i in range(200)]
    df = spark.createDataFrame(records, "offset bigint, shard_id string, operation string").withColumns(
        {
            "path": F.col("shard_id"), "byte_size": F.col("offset"), "num_rows": F.col("offset"),
            "timestamp": F.lit("2024-01-01").cast("timestamp"),
        }
    )
    expected = _by_hand(records)

    def seen(manifest):
        return {r.shard_id: (r.last_offset, r.ingested) for r in manifest.collect()}

    assert seen(m.fold(df)) == expected
    # In two parts, the later records first, and the first part twice.
    odd, even = df.filter("offset % 2 = 1"), df.filter("offset % 2 = 0")
    state = m.merge_state(m.merge_state(m.fold_state(even), odd), even)
    assert seen(m.manifest_of(state)) == expected


def test_replay(spark):
    log = append(spark, m.empty_log(spark), *[(f"s{i}", "ADD") for i in range(6)])
    assert [r.shard_id for r in m.replay(log, 3, strict=True).collect()] == ["s3", "s4", "s5"]
    bad = log.withColumn(
        "record_checksum", F.when(F.col("offset") == 3, "feedface" * 8).otherwise(F.col("record_checksum"))
    )
    with pytest.raises(LogFault) as caught:
        m.replay(bad, strict=True)
    assert caught.value.offset == 3
    assert m.replay(bad, 3, strict=True).count() == 3  # the damage lies before
    assert [r.offset for r in m.replay(bad).collect()] == [1, 2, 4, 5, 6]
    assert [r.offset for r in m.corrupt_records(bad).collect()] == [3]


def test_filled_checksum_is_the_identity_digest(spark):
    import hashlib

    row = append(spark, m.empty_log(spark), ("s0", "ADD")).first()
    assert row.record_checksum == hashlib.sha256(b"s0:ADD:p/s0").hexdigest()
    kept = batch(spark, ("s0", "ADD")).withColumn("record_checksum", F.lit("given"))
    assert m.fill_checksum(kept).first().record_checksum == "given"


def test_ndjson_log(spark, tmp_path):
    path = str(tmp_path / "log")
    first = append(spark, m.empty_log(spark), ("a", "ADD"), ("b", "ADD"))
    write_log(first, path)
    reopened = readable(read_log(spark, path))
    write_log(m.append_records(reopened, batch(spark, ("c", "ADD")), ["seq"]), path)
    (tmp_path / "log" / "extra.json").write_text(
        '\n{"schema_version":99,"offset":9,"shard_id":"new"}\n\n{"offset":8,"shard_id":"old","x":1}\n{"offset":7,"sha'
    )
    raw = read_log(spark, path).cache()
    assert raw.count() == 6
    assert [r.offset for r in readable(raw).orderBy("offset").collect()] == [1, 2, 3, 8]
    assert raw.filter("_corrupt_record is not null").count() == 1
    row = readable(raw).filter("offset = 1").first()
    assert row.timestamp == datetime.datetime(2024, 5, 1, 10, 0, 0, 123456)
    assert readable(raw).filter("offset = 8").first().schema_version == 1


def test_record_json_round_trip(spark):
    log = append(spark, m.empty_log(spark), ("a", "ADD"))
    parsed = log.select(record_json().alias("j")).select(parse_record(F.col("j")).alias("r")).select("r.*")
    assert parsed.collect() == log.collect()


def test_planned_rows_and_the_empty_plan(spark):
    frames = spark.createDataFrame([("a", 1), ("b", 2)], "source_shard string, x int")
    plan = m.plan(m.fold(append(spark, m.empty_log(spark), ("b", "ADD"))))
    assert [r.x for r in m.planned_rows(frames, plan).collect()] == [2]
    nothing = plan.limit(0)
    assert m.planned_rows(frames, nothing).count() == 0
    assert m.planned_rows(frames, nothing, on_empty="all").count() == 2


def test_stream_restart_neither_loses_nor_doubles(spark, tmp_path):
    source, out, check = (str(tmp_path / n) for n in ("in", "out", "check"))
    log = append(spark, m.empty_log(spark), ("a", "ADD"), ("b", "ADD"), ("a", "COMMIT"))
    log.coalesce(1).write.parquet(source)

    def run():
        records = changes.read_files(spark, source, RECORD, files_per_batch=1)
        stream_manifest.maintain(records, out, check, once=True).awaitTermination()

    run()
    more = append(spark, log, ("b", "REMOVE"), ("c", "ADD")).filter("offset > 3")
    more.coalesce(1).write.mode("append").parquet(source)
    run()
    run()
    found = {(r.shard_id, r.ingested) for r in stream_manifest.snapshot(spark, out).collect()}
    assert found == {("a", True), ("c", False)}
    assert {r.shard_id for r in stream_manifest.snapshot(spark, out, 0).collect()} == {"a", "b"}


def test_stream_state_touches_only_its_buckets(spark, tmp_path):
    """A batch rewrites only the buckets of its shards; a new checkpoint over an old folder goes on
    from the stored state; compaction keeps the newest versions of each bucket."""
    source, out = (str(tmp_path / n) for n in ("in", "out"))
    log = append(spark, m.empty_log(spark), *[(f"s{k}", "ADD") for k in range(40)])
    log.coalesce(1).write.parquet(source)

    def run(check):
        records = changes.read_files(spark, source, RECORD, files_per_batch=1)
        stream_manifest.maintain(records, out, str(tmp_path / check), once=True, buckets=16, keep=1).awaitTermination()

    run("check")
    first = {(r.bucket, r.v) for r in stream_manifest.commits(spark, out).collect()}
    one = append(spark, log, ("s3", "COMMIT")).filter("offset > 40")
    one.coalesce(1).write.mode("append").parquet(source)
    run("check")
    second = {(r.bucket, r.v) for r in stream_manifest.commits(spark, out).filter("v = 1").collect()}
    assert len(second) == 1 and len(first) > 1
    # A new checkpoint reads every file again: the state goes on, nothing doubles or comes back.
    removed = append(spark, log.union(one), ("s5", "REMOVE")).filter("offset > 41")
    removed.coalesce(1).write.mode("append").parquet(source)
    run("fresh")
    found = {r.shard_id: r.ingested for r in stream_manifest.snapshot(spark, out).collect()}
    assert found == {f"s{k}": k == 3 for k in range(40) if k != 5}
    assert stream_manifest.snapshot(spark, out).count() == 39
    assert stream_manifest.compact(spark, out, keep=1) == 0  # already compacted after each version
