"""Metrics that need a judge: a scorer turns spans into values, and these become metric rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanmill.operators.derive import path_columns, scopes
from spanmill.plans.registry import SCORED

#: spans -> rows (span_id, metric, value, confidence); metrics are those of registry.SCORED.
Scorer = Callable[[DataFrame], DataFrame]


def scored_rows(spans: DataFrame, lens: str, scorer: Scorer) -> DataFrame:
    """Metric rows of a scorer's values, in the derived layout; metrics of other lenses are left out."""
    values = scorer(spans).where(F.col("metric").isin(SCORED[lens])).select("span_id", "metric", F.col("value").cast("double"), F.col("confidence").cast("float"))
    path = path_columns()
    spread = spans.withColumn("_scope", F.explode(scopes()))
    own = spread.select(
        "span_id", F.coalesce("trace_id", F.lit("")).alias("trace_id"), F.coalesce("parent_span_id", F.lit("")).alias("parent_span_id"), F.col("_scope").alias("scope"),
        F.coalesce("solution_id", F.lit("")).alias("solution_id"), F.coalesce("endpoint", F.lit("")).alias("endpoint"), *[c.alias(n) for n, c in path.items()],
        F.coalesce("environment", F.lit("")).alias("environment"), F.col("ended_at").alias("ts"), F.col("started_at").alias("start_ts"), F.col("ended_at").alias("end_ts"),
    )
    return own.join(values, "span_id").withColumn("metric_meta", F.lit(None).cast("string"))
