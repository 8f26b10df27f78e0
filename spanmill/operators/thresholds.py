"""Thresholds against current values, and the paths of configuration rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanmill.operators.quantiles import exact_quantiles
from spanmill.operators.rollup import bucket
from spanmill.plans.registry import every_metric

PATH = ["solution_id", "endpoint_id", "workflow_id", "agent_id", "component_id"]
#: Thresholds are broadcast below this many rows, else joined by shuffle.
BROADCAST_ROWS = 200_000


def deepest(columns: list[str] = PATH) -> Column:
    """The level of a path's deepest id that isn't null or empty."""
    level = F.lit(None).cast("string")
    for c in columns:
        level = F.when(F.coalesce(F.col(c), F.lit("")) != "", F.lit(c.removesuffix("_id"))).otherwise(level)
    return level


def with_business_keys(rows: DataFrame, registry: dict[str, DataFrame]) -> DataFrame:
    """Surrogate ids of a path replaced by business keys. registry: level -> (id, <level>_id), broadcast up to BROADCAST_ROWS rows; ids that it doesn't have become null."""
    for c in PATH:
        level = c.removesuffix("_id")
        own = _checked(registry[level].select(F.col("id").alias("_id"), F.col(c).alias("_key")))
        rows = rows.join(own, rows[c] == F.col("_id"), "left").drop(c, "_id").withColumnRenamed("_key", c)
    return rows


def _checked(table: DataFrame) -> DataFrame:
    return F.broadcast(table) if table.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else table


def reduced(rows: DataFrame, window: str, by: list[str]) -> DataFrame:
    """metric, by, bucket, value, count: each metric by its own statistic, as the registry names it, per window.

    p95 is exact, by exact_quantiles(), which runs jobs of its own.
    """
    kinds = {m.name: m.reducer for m in every_metric()}
    kind = F.element_at(F.create_map(*[F.lit(x) for kv in kinds.items() for x in kv]), F.col("metric"))
    keys = ["metric", *by, "bucket"]
    own = rows.where(F.col("metric").isin(*kinds)).select("metric", *by, bucket("ts", window).alias("bucket"), "value")
    ranked = exact_quantiles(own.where(kind == "p95"), keys, "value", [0.95], names=["value"]).select(*keys, "value", "count")
    sums = own.where(kind != "p95").groupBy(*keys).agg(F.count("*").alias("count"), F.sum("value").alias("_sum"), F.max("value").alias("_max"))
    value = F.when(kind == "avg", F.col("_sum") / F.col("count")).when(kind == "max", F.col("_max")).otherwise(F.col("_sum"))
    return sums.select(*keys, value.alias("value"), "count").unionAll(ranked)


def judged(values: DataFrame, thresholds: DataFrame) -> DataFrame:
    """values (metric, scope, time_window, the path, value) that a threshold bears on, with operator, its values and status.

    ok, warning or critical. gt: too high is bad; lt: too low is bad. A threshold bears on its scope's values
    of its solution and of its own id there; a level above that it leaves null or empty takes any value. Of several, the
    one that names the deepest level counts, and of these the one that names the next, and so on; of equal
    ones the tighter one. Thresholds that aren't active are left out, as are values without one.

    Only thresholds are grouped, by what they must equal: a value meets one row, whatever the wildcards are.
    """
    filled = lambda c: F.coalesce(F.col(c), F.lit(""))
    rules = thresholds.where(F.coalesce("is_active", F.lit(True))) if "is_active" in thresholds.columns else thresholds
    own_id = lambda path: F.coalesce(*[F.when(F.col("scope") == c.removesuffix("_id"), path(c)) for c in PATH], F.lit(""))
    # deeper levels first; the sign of values puts the tighter one first
    tight = F.when(F.col("operator") == "gt", F.col("critical_value")).otherwise(-F.col("critical_value"))
    rule = F.struct(*[(filled(c) == "").alias(f"any_{c}") for c in reversed(PATH)], tight.alias("tight"), "operator", "warning_value", "critical_value", *[filled(c).alias(c) for c in PATH])
    keys = ["metric", "scope", "time_window", "_solution", "_own"]
    grouped = rules.select(F.col("metric_name").alias("metric"), "scope", "time_window", filled("solution_id").alias("_solution"), own_id(filled).alias("_own"), rule.alias("_rule"))
    grouped = _checked(grouped.groupBy(*keys).agg(F.array_sort(F.collect_list("_rule")).alias("_rules")))
    left = values.select(*[c for c in values.columns if c not in PATH], *[filled(c).alias(c) for c in PATH])
    met = left.withColumns({"_solution": F.col("solution_id"), "_own": own_id(F.col)}).join(grouped, keys)
    fits = lambda r: reduce(lambda x, y: x & y, [(r[c] == "") | (r[c] == F.col(c)) for c in PATH])
    met = met.withColumn("_rule", F.get(F.filter("_rules", fits), F.lit(0))).where("_rule is not null")
    joined = met.select(*left.columns, "_rule.operator", "_rule.warning_value", "_rule.critical_value")
    beyond = lambda c: F.when(F.col("operator") == "gt", F.col("value") > F.col(c)).otherwise(F.col("value") < F.col(c))
    return joined.withColumn("status", F.when(beyond("critical_value"), "critical").when(beyond("warning_value"), "warning").otherwise("ok"))
