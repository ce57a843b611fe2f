"""Rolling metrics on a stream."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shardloom.operators.metrics import RATE_WINDOW, REFRESH, seconds_of
from shardloom.streaming.changes import LATENESS


def sliding_rate(
    stream: DataFrame,
    by: Sequence[str],
    time: str,
    value: str,
    window: str = RATE_WINDOW,
    slide: str = REFRESH,
    lateness: str = LATENESS,
) -> DataFrame:
    """(by, window_start, n, total, per_second); rows later than ``lateness`` are left out.

    State is one row per group and open window, since sums combine before the shuffle.
    """
    summed = (
        stream.withWatermark(time, lateness)
        .groupBy(*by, F.window(time, window, slide).alias("w"))
        .agg(F.count("*").alias("n"), F.sum(value).alias("total"))
    )
    return summed.select(
        *by,
        F.col("w.start").alias("window_start"),
        "n",
        "total",
        (F.col("n") / F.lit(seconds_of(window))).alias("per_second"),
    )
