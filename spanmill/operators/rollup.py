"""Rollups of metric rows into mergeable states, and their merge to coarser windows.

A state keeps count, sum, minimum, maximum, the average as (sum, count) and a KLL sketch of the
values. Sums of states are states: compaction, coarser grains and late rows are all one merge. Both
aggregations combine on the map side before their only shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanmill.schema import DIMENSIONS

#: Windows by name.
WINDOWS = {"1m": "1 minute", "5m": "5 minutes", "15m": "15 minutes", "1h": "1 hour", "1d": "1 day"}
SECONDS = {"1m": 60, "5m": 300, "15m": 900, "1h": 3600, "1d": 86400}


def bucket(ts: str | Column, window: str) -> Column:
    """The start of the window that ts lies in."""
    if window in ("1m", "1h", "1d"):
        return F.date_trunc({"1m": "minute", "1h": "hour", "1d": "day"}[window], ts)
    return F.timestamp_seconds(F.floor(F.unix_seconds(F.col(ts) if isinstance(ts, str) else ts) / SECONDS[window]) * SECONDS[window])


def _grouped(rows: DataFrame, by: list[str] | None, states: list[Column]) -> DataFrame:
    """States by dimensions and bucket. The bucket is the first key, since sorts compare by that at little cost and dimensions have few values."""
    dimensions = DIMENSIONS if by is None else by
    own = rows.groupBy("bucket", *dimensions).agg(*states)
    return own.select(*dimensions, "bucket", *[c for c in own.columns if c != "bucket" and c not in dimensions])


def base_rollup(rows: DataFrame, window: str = "1m", sketch: bool = True, by: list[str] | None = None) -> DataFrame:
    """States per nine dimensions, or some of them, and bucket of metric rows."""
    states = [
        F.count("*").alias("count"), F.sum("value").alias("sum_value"), F.min("value").alias("min_value"), F.max("value").alias("max_value"),
        F.sum(F.col("confidence").cast("double")).alias("sum_confidence"), F.count("confidence").alias("n_confidence"),
    ]
    if sketch:
        states.append(F.kll_sketch_agg_double("value").alias("quantiles"))
    return _grouped(rows.withColumn("bucket", bucket("ts", window)), by, states)


def merge(states: DataFrame, window: str | None = None, by: list[str] | None = None) -> DataFrame:
    """States merged over equal keys; window coarsens the bucket, by replaces the dimensions."""
    own = states.withColumn("bucket", bucket("bucket", window)) if window else states
    merged = [
        F.sum("count").alias("count"), F.sum("sum_value").alias("sum_value"), F.min("min_value").alias("min_value"), F.max("max_value").alias("max_value"),
        F.sum("sum_confidence").alias("sum_confidence"), F.sum("n_confidence").alias("n_confidence"),
    ]
    if "quantiles" in states.columns:
        merged.append(F.kll_merge_agg_double("quantiles").alias("quantiles"))
    return _grouped(own, by, merged)


def average() -> Column:
    return F.col("sum_value") / F.col("count")


def quantile(rank: float, column: str = "quantiles") -> Column:
    return F.kll_sketch_get_quantile_double(column, F.lit(rank).cast("double"))


def read_window(states: DataFrame, since, until=None) -> DataFrame:
    """States of buckets from since, and before until; both are given, so that results repeat."""
    own = states.where(F.col("bucket") >= F.lit(since))
    return own if until is None else own.where(F.col("bucket") < F.lit(until))


def total_by(rows: DataFrame, metric: str, *keys: str) -> DataFrame:
    """Additive roll-up of leaves: only rows with a component, which no other row repeats."""
    return rows.where((F.col("metric") == metric) & (F.col("component_id") != "")).groupBy(*keys).agg(F.sum("value").alias("total"), F.count("*").alias("n"))


def deduplicated(rows: DataFrame) -> DataFrame:
    """One row per (span_id, metric, scope), for inputs that were delivered twice."""
    return rows.dropDuplicates(["span_id", "metric", "scope"])


def expired(rows: DataFrame, ts: str, as_of, days: int) -> DataFrame:
    """Rows within a retention of days; partitions older than that can be dropped whole."""
    return rows.where(F.col(ts) >= F.lit(as_of).cast("timestamp") - F.make_interval(days=F.lit(days)))
