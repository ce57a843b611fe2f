import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from shardloom.operators import changes as ch
from shardloom.operators import metrics as mt
from shardloom.streaming import changes as sc
from shardloom.streaming import lags as sl

START = dt.datetime(2024, 3, 1)


def at(seconds):
    return START + dt.timedelta(seconds=seconds)


def readings(spark, n=600, seed=0):
    rng = random.Random(seed)
    rows = [
        (i, at(rng.random() * 1200), rng.choice(["hot"] * 5 + ["b"]), rng.expovariate(3), rng.randrange(50))
        for i in range(n)
    ]
    return rows, spark.createDataFrame(rows, "i int, ts timestamp, k string, lag double, c long")


def test_histogram_is_cumulative(spark):
    rows, df = readings(spark)
    found = {(x.k, x.le): x.n for x in mt.histogram(df, ["k"], "lag").collect()}
    for bound in mt.LAG_BUCKETS:
        assert found["hot", str(bound)] == sum(r[2] == "hot" and r[3] <= bound for r in rows)
    assert found["b", "+Inf"] == sum(r[2] == "b" for r in rows)


def _quantile(values, q):
    bounds = [0.0, *mt.LAG_BUCKETS]
    counts = [0] + [sum(v <= b for v in values) for b in bounds[1:]]
    rank = q * len(values)
    for i in range(1, len(bounds)):
        if counts[i] >= rank:
            return bounds[i - 1] + (bounds[i] - bounds[i - 1]) * (rank - counts[i - 1]) / (counts[i] - counts[i - 1])
    return bounds[-1]


def test_quantiles_interpolate_inside_the_bucket(spark):
    rows, df = readings(spark)
    found = {(x.k, x.window_start): x for x in mt.lag_quantiles(df, ["k"], "ts", "lag", "1 minute").collect()}
    groups = {}
    for r in rows:
        groups.setdefault((r[2], r[1].replace(second=0, microsecond=0)), []).append(r[3])
    assert set(found) == set(groups)
    for key, values in groups.items():
        assert found[key].n == len(values)
        assert found[key].p50 == pytest.approx(_quantile(values, 0.5))
        assert found[key].p99 == pytest.approx(_quantile(values, 0.99))
    slow = {(x.k, x.window_start) for x in mt.breaches(mt.lag_quantiles(df, ["k"], "ts", "lag", "1 minute")).collect()}
    assert slow == {k for k, v in groups.items() if _quantile(v, 0.99) > 0.5}


def test_lags_beyond_the_last_bound(spark):
    df = spark.createDataFrame([(at(0), 100.0)], "ts timestamp, lag double")
    assert mt.lag_quantiles(df, [], "ts", "lag").first().p99 == 5.0


def test_recorded_lags(spark):
    df = spark.createDataFrame([(0.0005,), (0.001,), (0.5,), (1.0,), (1.5,)], "lag double")
    assert [(x.lag, x.slow) for x in mt.recorded_lags(df, "lag").collect()] == [(0.5, False), (1.0, False), (1.5, True)]


def test_sliding_rate_by_hand(spark):
    rows, df = readings(spark, 200)
    found = {(x.k, x.window_start): (x.n, x.total) for x in mt.sliding_rate(df, ["k"], "ts", "lag").collect()}
    starts = {k[1] for k in found}
    for start in list(starts)[:40]:
        inside = [r for r in rows if r[2] == "hot" and start <= r[1] < start + dt.timedelta(minutes=1)]
        if inside:
            assert found["hot", start][0] == len(inside)
            assert found["hot", start][1] == pytest.approx(sum(r[3] for r in inside))
    assert sum(n for n, _ in found.values()) == 6 * len(rows)


def test_counter_rate_with_restarts(spark):
    rows, df = readings(spark)
    found = {(x.k, x.window_start): x.increase for x in mt.counter_rate(df, ["k"], "ts", "i", "c").collect()}
    expected = {}
    for key in ("hot", "b"):
        own = sorted((r for r in rows if r[2] == key), key=lambda r: (r[1], r[0]))
        for before, now in zip([None, *own], own, strict=False):
            gain = 0 if before is None else now[4] - before[4] if now[4] >= before[4] else now[4]
            slot = (key, now[1].replace(second=0, microsecond=0))
            expected[slot] = expected.get(slot, 0) + gain
    assert found == expected


def test_gauge_and_timing(spark):
    _, df = readings(spark, 50)
    devices = spark.createDataFrame([("hot",), ("none",)], "k string")
    last = {x.k: x.last_value for x in mt.gauge_last(df, "k", "lag", "ts", "i", devices).collect()}
    newest = df.filter("k = 'hot'").orderBy(F.desc("ts")).first().lag
    assert last == {"hot": newest, "none": 0.0}
    timing = spark.createDataFrame(
        [("x", 1.0, 3.0, 4.0), ("x", 0.2, 0.8, 1.0), ("y", 4.0, 6.0, 10.0), ("z", 0.0, 0.0, 0.0)],
        "run string, load double, compute double, wall double",
    )
    rows = {x.run: x for x in mt.run_timing(timing, "run", "load", "compute", "wall").collect()}
    assert rows["x"].load_fraction == pytest.approx(0.24) and not rows["x"].bottleneck
    assert rows["x"].steps_per_s == pytest.approx(0.4) and rows["x"].ms_per_step == pytest.approx(2500)
    assert rows["y"].bottleneck and rows["z"].steps_per_s == pytest.approx(1e6)


# --- change feed ----------------------------------------------------------------------------------


def file_events(spark, n=300, seed=3):
    rng = random.Random(seed)
    rows = [(f"d/s{rng.choice([0] * 6 + [1, 2])}.parquet", at(rng.randrange(0, 40000, 50) / 1000), i, f"body {i}") for i in range(n)]
    return rows, spark.createDataFrame(rows, "path string, ts timestamp, event_id long, content string")


def settled_by_hand(rows, gap=0.25):
    out = set()
    for path in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == path), key=lambda r: (r[1], r[2]))
        for now, after in zip(own, [*own[1:], None], strict=True):
            if after is None or (after[1] - now[1]).total_seconds() > gap:
                out.add(now[2])
    return out


def test_debounce(spark):
    rows, df = file_events(spark)
    expected = settled_by_hand(rows)
    assert 20 < len(expected) < 200
    for bucket, hot in (("1 second", 1), ("10 minutes", 1), ("10 minutes", 10**6)):
        assert {x.event_id for x in ch.debounce(df, bucket=bucket, hot_rows=hot).collect()} == expected
    listing = spark.createDataFrame([("d/s1.parquet",)], "path string")
    kept = ch.still_there(ch.debounce(df), listing)
    assert {x.path for x in kept.collect()} == {"d/s1.parquet"}


def test_change_record(spark):
    import hashlib

    df = spark.createDataFrame([("d/s1.parquet", at(0), 1, "bödy")], "path string, ts timestamp, event_id long, content string")
    row = ch.change_records(df).first()
    assert (row.shard_id, row.operation, row.num_rows, row.byte_size) == ("s1", "ADD", 0, 5)
    assert row.content_checksum == hashlib.sha256("bödy".encode()).hexdigest()
    assert row.record_checksum == hashlib.sha256(b"s1:ADD:d/s1.parquet").hexdigest()


def test_debounce_stream_equals_batch_over_many_micro_batches(spark, tmp_path):
    rows, df = file_events(spark)
    source, flush = str(tmp_path / "in"), str(tmp_path / "flush")
    df.repartitionByRange(5, "ts").write.parquet(source)
    far = df.limit(1).withColumns({"path": F.lit("end"), "ts": F.lit("2100-01-01").cast("timestamp")})
    far.limit(0).write.parquet(flush)
    stream = sc.read_files(spark, source, df.schema, files_per_batch=1)
    stream = stream.unionByName(sc.read_files(spark, flush, df.schema))
    sc.drain(sc.settled(stream), far, flush, str(tmp_path / "out"), str(tmp_path / "check"))
    found = spark.read.parquet(str(tmp_path / "out")).filter("path <> 'end'")
    assert {x.event_id for x in found.collect()} == settled_by_hand(rows)
    assert found.count() == len(settled_by_hand(rows))


def test_rate_stream_drops_only_rows_behind_the_watermark(spark, tmp_path):
    def rows(*seconds):
        return spark.createDataFrame([("k", at(s), 1.0) for s in seconds], "k string, ts timestamp, v double")

    source, out, check = (str(tmp_path / n) for n in ("in", "out", "check"))

    def run(*seconds):
        rows(*seconds).coalesce(1).write.mode("append").parquet(source)
        stream = sc.read_files(spark, source, rows(0).schema)
        rates = sl.sliding_rate(stream, ["k"], "ts", "v", "10 seconds", "10 seconds", "1 minute")
        sc.to_table(rates, out, check, once=True).awaitTermination()

    run(0, 5, 12, 100)  # watermark reaches 40: the first two windows close
    run(41, 1)  # 41 is late but inside the watermark; 1 is behind it
    run(1000)
    found = {x.window_start: x.n for x in spark.read.parquet(out).collect()}
    assert found == {at(0): 2, at(10): 1, at(40): 1, at(100): 1}


def test_seconds_of():
    assert [mt.seconds_of(x) for x in ("1 minute", "10 seconds", "2 hours", "1 day")] == [60, 10, 7200, 86400]
    assert np.isclose(mt.LOAD_BOUND_FRACTION, 0.3)
