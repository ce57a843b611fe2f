"""Rows without a time, hot or not; lines that must not be folded; late events."""

import datetime

import pytest
from pyspark.sql import functions as F

from shardloom.errors import LogFault
from shardloom.functions.intervals import micros_of
from shardloom.operators import changes, manifest, metrics
from shardloom.operators import ordering as o
from shardloom.sources.log import read_log, rejects, trusted, write_log
from shardloom.streaming import changes as stream


def at(seconds):
    return None if seconds is None else datetime.datetime(2024, 1, 1) + datetime.timedelta(seconds=seconds)


def events(spark):
    times = [0, 1, 1, 700, 1300, None, None, 1300, 5000]
    rows = [(k, key, at(s)) for key in ("a", None) for k, s in enumerate(times)]
    return spark.createDataFrame([(i, k, p, t) for i, (k, p, t) in enumerate(rows)], "event_id int, k int, path string, ts timestamp")


@pytest.mark.parametrize("following", [True, False])
def test_hot_keys_change_nothing(spark, following):
    def run(hot_rows):
        out = o.neighbour(
            events(spark), ["path"], "ts", "event_id", F.col("event_id"), o.time_bucket("ts", "10 minutes"), "_n",
            following=following, hot_rows=hot_rows, sample=1.0,
        )
        return sorted((r.event_id, r._n) for r in out.collect())

    assert run(2) == run(1000) and len(run(2)) == 18


def test_debounce_with_null_times(spark):
    few, many = (
        sorted(r.event_id for r in changes.debounce(events(spark), "5 seconds", hot_rows=h).collect()) for h in (2, 10**6)
    )
    assert few == many and few


def test_counter_rate_with_null_times(spark):
    rates = metrics.counter_rate(events(spark), ["path"], "ts", "event_id", "event_id", "10 minutes").collect()
    assert sum(r.increase for r in rates) > 0


def test_lengths_of_intervals():
    assert micros_of("250 milliseconds") == 250_000
    assert metrics.seconds_of("1 hour 30 minutes") == 5400
    with pytest.raises(ValueError):
        micros_of("soon")


def test_a_log_with_bad_lines_is_not_trusted(spark, tmp_path):
    path = tmp_path / "log"
    batch = spark.createDataFrame([(1, "s0", "ADD", "p", 1, 1, None, "", None, 1)],
        "schema_version int, shard_id string, operation string, path string, byte_size long, num_rows long,"
        " content_checksum string, record_checksum string, timestamp timestamp, seq int")  # fmt: skip
    write_log(manifest.append_records(manifest.empty_log(spark), batch, ["seq"]), str(path))
    assert trusted(read_log(spark, str(path))).count() == 1
    (path / "more.json").write_text('{"schema_version":99,"offset":9}\n{"offset":8,"shard_id":"x"}\n{"offset":7,"sh\n')
    log = read_log(spark, str(path)).cache()
    assert sorted(r.reason for r in rejects(log).collect()) == ["newer", "tampered", "torn"]
    with pytest.raises(LogFault) as caught:
        trusted(log)
    assert caught.value.cause == "tampered" and caught.value.offset == 8


def test_late_events_are_found(spark):
    raw = events(spark).filter("ts is not null and path is not null")
    announced = changes.debounce(raw.filter("event_id <> 4"), "5 seconds")
    late = stream.missed(raw, announced, "5 seconds")
    assert {r.event_id for r in late.collect()} <= {r.event_id for r in changes.debounce(raw, "5 seconds").collect()}
    assert stream.missed(raw, changes.debounce(raw, "5 seconds"), "5 seconds").count() == 0
