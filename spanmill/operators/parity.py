"""Comparison of two derivations of the same metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def within_tolerance(produced: DataFrame, expected: DataFrame, tolerance: dict[str, float]) -> DataFrame:
    """Per metric: rows compared, how many lie within its tolerance, the largest difference."""
    keys = ["span_id", "scope", "metric"]
    both = produced.select(*keys, F.col("value").alias("_got")).join(expected.select(*keys, "value"), keys)
    both = both.where(F.col("metric").isin(*tolerance)).withColumn("_d", F.abs(F.col("_got") - F.col("value")))
    limit = F.element_at(F.create_map(*[F.lit(x) for kv in tolerance.items() for x in kv]), F.col("metric"))
    return both.groupBy("metric").agg(
        F.count("*").alias("compared"), F.sum(F.when(F.col("_d") <= limit, 1).otherwise(0)).alias("within"), F.round(F.max("_d"), 6).alias("max_diff")
    )


def missing_metrics(expected: DataFrame, produced: DataFrame) -> DataFrame:
    """Metrics in expected that produced has no row of."""
    return expected.select("metric").distinct().join(produced.select("metric").distinct(), "metric", "left_anti")
