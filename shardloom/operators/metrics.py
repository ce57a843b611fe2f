"""Metric series: histograms, quantiles, rates, gauges, sliding windows, run timing."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shardloom.functions.intervals import micros_of
from shardloom.operators.ordering import neighbour, time_bucket

# The upper bounds of the loader-lag histogram in seconds (``+Inf`` follows), the lag
# that is recorded at all, the one that counts as slow, the p99 objective, the share of loading time
# that marks a run as bound, and the dashboard's rate window and refresh.
LAG_BUCKETS = (0.001, 0.005, 0.01, 0.05, 0.1, 0.25, 0.5, 1.0, 2.5, 5.0)
RECORDED_LAG = 0.001
SLOW_FETCH = 1.0
P99_OBJECTIVE = 0.5
LOAD_BOUND_FRACTION = 0.3
RATE_WINDOW, REFRESH = "1 minute", "10 seconds"


def recorded_lags(df: DataFrame, lag: str) -> DataFrame:
    """Lags above the recording threshold, with ``slow`` for those over a second."""
    return df.filter(F.col(lag) > RECORDED_LAG).withColumn("slow", F.col(lag) > SLOW_FETCH)


def _bucket_counts(lag: str) -> list[Column]:
    bounded = [F.count_if(F.col(lag) <= b).alias(f"_b{i}") for i, b in enumerate(LAG_BUCKETS)]
    return [*bounded, F.count(lag).alias(f"_b{len(LAG_BUCKETS)}")]


def histogram(df: DataFrame, by: Sequence[str], lag: str) -> DataFrame:
    """(by, le, n): cumulative counts per upper bound, ``+Inf`` last. One pass, one row per group
    until the bounds are spread out."""
    counted = df.groupBy(*by).agg(*_bucket_counts(lag))
    names = [str(b) for b in LAG_BUCKETS] + ["+Inf"]
    rows = F.array(
        *[F.struct(F.lit(le).alias("le"), F.col(f"_b{i}").alias("n")) for i, le in enumerate(names)]
    )
    return counted.select(*by, F.explode(rows).alias("b")).select(*by, "b.le", "b.n")


def _quantile(q: float) -> Column:
    """Linear interpolation inside the bucket the rank falls into; the last bound beyond all."""
    last = len(LAG_BUCKETS)
    rank = F.col(f"_b{last}") * F.lit(q)

    def inside(i: int) -> Column:
        below = F.col(f"_b{i - 1}") if i else F.lit(0)
        start = LAG_BUCKETS[i - 1] if i else 0.0
        share = (rank - below) / (F.col(f"_b{i}") - below)
        return F.lit(start) + F.lit(LAG_BUCKETS[i] - start) * share

    chain = F
    for i in range(last):
        chain = chain.when(F.col(f"_b{i}") >= rank, inside(i))
    return chain.otherwise(F.lit(LAG_BUCKETS[-1]))


def lag_quantiles(
    df: DataFrame, by: Sequence[str], time: str, lag: str, window: str = RATE_WINDOW
) -> DataFrame:
    """(by, window_start, n, p50, p99) of the histogram increments of each window."""
    counted = df.groupBy(*by, F.window(time, window).alias("w")).agg(*_bucket_counts(lag))
    return counted.select(
        *by,
        F.col("w.start").alias("window_start"),
        F.col(f"_b{len(LAG_BUCKETS)}").alias("n"),
        _quantile(0.50).alias("p50"),
        _quantile(0.99).alias("p99"),
    )


def breaches(quantiles: DataFrame, objective: float = P99_OBJECTIVE) -> DataFrame:
    return quantiles.filter(F.col("p99") > objective)


def seconds_of(interval: str) -> float:
    """Length of an interval such as ``"1 minute"`` in seconds."""
    return micros_of(interval) / 1_000_000


def sliding_rate(
    df: DataFrame,
    by: Sequence[str],
    time: str,
    value: str,
    window: str = RATE_WINDOW,
    slide: str = REFRESH,
) -> DataFrame:
    """(by, window_start, n, total, per_second) over sliding windows.

    Rows are first summed into tumbling panes of one slide; only panes are copied into the windows
    that cover them. ``window`` must be a multiple of ``slide``.
    """
    panes = (
        df.groupBy(*by, F.window(time, slide).alias("pane"))
        .agg(F.count("*").alias("n"), F.sum(value).alias("total"))
        .select(*by, F.col("pane.start").alias("_at"), "n", "total")
    )
    covered = panes.groupBy(*by, F.window("_at", window, slide).alias("w")).agg(
        F.sum("n").alias("n"), F.sum("total").alias("total")
    )
    return covered.select(
        *by,
        F.col("w.start").alias("window_start"),
        "n",
        "total",
        (F.col("n") / F.lit(seconds_of(window))).alias("per_second"),
    )


def counter_rate(
    df: DataFrame,
    series: Sequence[str],
    time: str,
    tie: str,
    counter: str,
    window: str = RATE_WINDOW,
) -> DataFrame:
    """(series, window_start, increase, per_second) of a growing counter.

    A drop is a restart from zero, so the new value is the increment; a series' first reading has no
    predecessor and adds nothing. A hot series is compared window by window, and only one reading
    per window crosses over.
    """
    bucket = time_bucket(time, window)
    seen = neighbour(df, series, time, tie, F.col(counter), bucket, "_before")
    now, before = F.col(counter), F.col("_before")
    increment = F.when(now >= before, now - before).when(now < before, now).otherwise(0)
    summed = seen.groupBy(*series, F.window(time, window).alias("w")).agg(
        F.sum(increment).alias("increase")
    )
    return summed.select(
        *series,
        F.col("w.start").alias("window_start"),
        "increase",
        (F.col("increase") / F.lit(seconds_of(window))).alias("per_second"),
    )


def gauge_last(df: DataFrame, key: str, value: str, time: str, tie: str, devices: DataFrame) -> DataFrame:
    """(key, last_value): latest reading of each known device, 0 where there is none."""
    latest = df.groupBy(key).agg(F.max_by(value, F.struct(time, tie)).alias("last_value"))
    return devices.select(key).join(latest, key, "left").withColumn(
        "last_value", F.coalesce("last_value", F.lit(0.0))
    )


def run_timing(df: DataFrame, run: str, load: str, compute: str, wall: str) -> DataFrame:
    """Per run: steps, load and compute seconds, their shares, throughput, and the bound flag."""
    summed = df.groupBy(run).agg(
        F.count("*").alias("steps"),
        F.sum(load).alias("load_s"),
        F.sum(compute).alias("compute_s"),
        F.sum(wall).alias("wall_s"),
    )
    floor = F.greatest(F.col("wall_s"), F.lit(1e-6))
    fraction = F.col("load_s") / floor
    return summed.withColumns(
        {
            "load_fraction": fraction,
            "compute_fraction": F.col("compute_s") / floor,
            "steps_per_s": F.col("steps") / floor,
            "ms_per_step": F.col("wall_s") * 1000.0 / F.col("steps"),
            "bottleneck": fraction > LOAD_BOUND_FRACTION,
        }
    )


def promotion_gate(metrics: DataFrame, thresholds: dict[str, float], run: str) -> DataFrame:
    """(run, passed): every threshold met, higher is better; a missing metric fails.

    ``metrics`` is (run, metric, value).
    """
    met = [
        F.max(F.when(F.col("metric") == name, F.col("value") >= least))
        for name, least in thresholds.items()
    ]
    passed = reduce(lambda a, b: a & b, [F.coalesce(m, F.lit(False)) for m in met], F.lit(True))
    return metrics.groupBy(run).agg(passed.alias("passed"))
