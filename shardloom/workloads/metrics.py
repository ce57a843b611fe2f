"""Metric series over events: lag, rates, gauges, run timing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shardloom.operators import metrics as mt
from shardloom.operators import sampling as sp
from shardloom.operators.ordering import positions
from shardloom.workloads import tables as t

# The stand-in events are minutes apart, so rates are taken over an hour.
WINDOW, SLIDE = "1 hour", "10 minutes"
CHECKPOINT_EVERY = 20


def _series(spark: SparkSession, folder: str) -> DataFrame:
    """Events as readings: a lag in seconds, a counter, a duration."""
    counter = F.regexp_extract("props", "([0-9]+)", 1).cast("bigint")
    return t.table(spark, folder, "events").select(
        "event_id", "ts", "user_id", "event_type", "value",
        (F.col("value") / 100).alias("lag"), counter.alias("counter"),
        (counter / 10).alias("compute"),
    )


def lag_histogram(spark: SparkSession, folder: str) -> DataFrame:
    return mt.histogram(mt.recorded_lags(_series(spark, folder), "lag"), ["event_type"], "lag")


def slow_fetches(spark: SparkSession, folder: str) -> DataFrame:
    """Recorded lags with the slow ones marked."""
    return mt.recorded_lags(_series(spark, folder), "lag").select("event_id", "lag", "slow")


def _quantiles(spark: SparkSession, folder: str) -> DataFrame:
    return mt.lag_quantiles(_series(spark, folder), ["event_type"], "ts", "lag", WINDOW)


def lag_quantiles(spark: SparkSession, folder: str) -> DataFrame:
    return _quantiles(spark, folder).withColumns(t.rounded("p50", "p99"))


def slo_breaches(spark: SparkSession, folder: str) -> DataFrame:
    return mt.breaches(_quantiles(spark, folder)).select("event_type", "window_start", "n")


def lag_sliding(spark: SparkSession, folder: str) -> DataFrame:
    rates = mt.sliding_rate(_series(spark, folder), ["event_type"], "ts", "lag", WINDOW, SLIDE)
    return rates.withColumns(t.rounded("total", "per_second"))


def counter_rate(spark: SparkSession, folder: str) -> DataFrame:
    rates = mt.counter_rate(
        _series(spark, folder), ["event_type"], "ts", "event_id", "counter", WINDOW
    )
    return rates.withColumns(t.rounded("per_second"))


def gauge_last(spark: SparkSession, folder: str) -> DataFrame:
    devices = t.table(spark, folder, "customer").select(F.col("c_custkey").alias("user_id"))
    return mt.gauge_last(_series(spark, folder), "user_id", "value", "ts", "event_id", devices)


def bottleneck_report(spark: SparkSession, folder: str) -> DataFrame:
    timed = _series(spark, folder).withColumn("wall", F.col("lag") + F.col("compute"))
    report = mt.run_timing(timed, "user_id", "lag", "compute", "wall")
    return report.withColumns(
        t.rounded(
            "load_s", "compute_s", "wall_s", "load_fraction", "compute_fraction", "steps_per_s", "ms_per_step"
        )
    )


def step_sampling(spark: SparkSession, folder: str) -> DataFrame:
    """A user's events as the steps of a run."""
    steps = t.table(spark, folder, "events").select("user_id", "event_id")
    steps = positions(steps, ["event_id"], ["user_id"])
    return sp.sample_steps(steps, "user_id", "pos", checkpoint_every=CHECKPOINT_EVERY)


QUERIES = {
    fn.__name__: fn
    for fn in (
        lag_histogram, slow_fetches, lag_quantiles, slo_breaches, lag_sliding, counter_rate,
        gauge_last, bottleneck_report, step_sampling,
    )
}

_SERIES_SQL = """
series AS (
  SELECT event_id, ts, user_id, event_type, value, value / 100 AS lag,
         CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS counter,
         CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) / 10.0::DOUBLE AS compute
  FROM events
)"""

_BOUNDS_SQL = """
bounds(upper, le, lower) AS (
  VALUES {rows}
)""".format(
    rows=", ".join(
        f"(CAST({b} AS DOUBLE), '{b}', CAST({a} AS DOUBLE))"
        for a, b in zip((0.0, *mt.LAG_BUCKETS), mt.LAG_BUCKETS, strict=False)
    )
    + f", (CAST('Infinity' AS DOUBLE), '+Inf', CAST({mt.LAG_BUCKETS[-1]} AS DOUBLE))"
)

_QUANTILE_SQL = """
cumulative AS (
  SELECT event_type, date_trunc('hour', ts) AS window_start, upper, lower,
         count(*) FILTER (lag <= upper) AS n, count(*) AS total
  FROM series, bounds GROUP BY ALL
),
stepped AS (
  SELECT *, coalesce(lag(n) OVER (PARTITION BY event_type, window_start ORDER BY upper), 0) AS below
  FROM cumulative
),
quantiles AS (
  SELECT event_type, window_start, max(total) AS n,
         {p50} AS p50, {p99} AS p99
  FROM stepped GROUP BY event_type, window_start
)"""


def _quantile_sql(q: float) -> str:
    inside = (
        f"CASE WHEN upper = CAST('Infinity' AS DOUBLE) THEN lower"
        f" ELSE lower + (upper - lower) * ((total * CAST({q} AS DOUBLE) - below) / (n - below)) END"
    )
    hit = f"n >= total * CAST({q} AS DOUBLE)"
    return f"min_by({inside}, upper) FILTER ({hit})"


_QUANTILES = (
    _SERIES_SQL,
    _BOUNDS_SQL,
    _QUANTILE_SQL.format(p50=_quantile_sql(0.50), p99=_quantile_sql(0.99)),
)

SQL = {
    "lag_histogram": t.with_ctes(
        _SERIES_SQL,
        _BOUNDS_SQL,
        body="""
SELECT event_type, le, count(*) FILTER (lag <= upper) AS n FROM series, bounds
WHERE lag > CAST(0.001 AS DOUBLE) GROUP BY event_type, le""",
    ),
    "slow_fetches": t.with_ctes(
        _SERIES_SQL,
        body=" SELECT event_id, lag, lag > 1 AS slow FROM series WHERE lag > CAST(0.001 AS DOUBLE)",
    ),
    "lag_quantiles": t.with_ctes(
        *_QUANTILES,
        body="""
SELECT event_type, window_start, n, round(p50, 6) AS p50, round(p99, 6) AS p99 FROM quantiles""",
    ),
    "slo_breaches": t.with_ctes(
        *_QUANTILES,
        body=" SELECT event_type, window_start, n FROM quantiles WHERE p99 > CAST(0.5 AS DOUBLE)",
    ),
    "lag_sliding": t.with_ctes(
        _SERIES_SQL,
        """
copies AS (
  SELECT event_type, lag, time_bucket(INTERVAL 10 MINUTE, ts) - i * INTERVAL 10 MINUTE AS window_start
  FROM series, range(6) AS r(i)
)""",
        body="""
SELECT event_type, window_start, count(*) AS n, round(sum(lag), 6) AS total,
       round(count(*) / CAST(3600 AS DOUBLE), 6) AS per_second
FROM copies GROUP BY event_type, window_start""",
    ),
    "counter_rate": t.with_ctes(
        _SERIES_SQL,
        """
steps AS (
  SELECT event_type, ts, counter,
         lag(counter) OVER (PARTITION BY event_type ORDER BY ts, event_id) AS earlier FROM series
)""",
        body="""
SELECT event_type, date_trunc('hour', ts) AS window_start,
       CAST(sum(CASE WHEN counter >= earlier THEN counter - earlier
                     WHEN counter < earlier THEN counter ELSE 0 END) AS BIGINT) AS increase,
       round(sum(CASE WHEN counter >= earlier THEN counter - earlier
                      WHEN counter < earlier THEN counter ELSE 0 END) / CAST(3600 AS DOUBLE), 6)
         AS per_second
FROM steps GROUP BY event_type, date_trunc('hour', ts)""",
    ),
    "gauge_last": """
SELECT c_custkey AS user_id, coalesce(last_value, 0.0) AS last_value
FROM customer LEFT JOIN
  (SELECT user_id, arg_max(value, ts) AS last_value FROM events GROUP BY user_id) e
  ON e.user_id = c_custkey""",
    "bottleneck_report": t.with_ctes(
        _SERIES_SQL,
        """
summed AS (
  SELECT user_id, count(*) AS steps, sum(lag) AS load_s, sum(compute) AS compute_s,
         sum(lag + compute) AS wall_s FROM series GROUP BY user_id
)""",
        body="""
SELECT user_id, steps, round(load_s, 6) AS load_s, round(compute_s, 6) AS compute_s,
       round(wall_s, 6) AS wall_s, round(load_s / greatest(wall_s, 1e-6), 6) AS load_fraction,
       round(compute_s / greatest(wall_s, 1e-6), 6) AS compute_fraction,
       round(steps / greatest(wall_s, 1e-6), 6) AS steps_per_s,
       round(wall_s * 1000.0::DOUBLE / steps, 6) AS ms_per_step,
       load_s / greatest(wall_s, 1e-6) > CAST(0.3 AS DOUBLE) AS bottleneck
FROM summed""",
    ),
    "step_sampling": """
WITH steps AS (
  SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS step FROM events
)
SELECT user_id, step, 'log' AS kind FROM steps WHERE step % 10 = 0
UNION ALL SELECT user_id, step, 'checkpoint' FROM steps WHERE step > 0 AND step % 20 = 0
UNION ALL SELECT user_id, max(step), 'final' FROM steps GROUP BY user_id""",
}
