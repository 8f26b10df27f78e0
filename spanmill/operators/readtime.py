"""Metrics computed when read: rates, gauges and ratios over merged states or spans."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from spanmill.operators.rollup import SECONDS, bucket
from spanmill.sources.ledger import kept

LEVEL = ["scope", "solution_id", "workflow_id"]


def throughput(rows: DataFrame, window: str = "5m") -> DataFrame:
    """Spans per second of levels, from the rows of latency, which every span has."""
    own = rows.where((F.col("metric") == "latency") & F.col("scope").isin("solution", "endpoint", "workflow", "agent"))
    counted = own.groupBy("scope", "solution_id", "endpoint", "workflow_id", "agent_id", bucket("ts", window).alias("bucket")).agg(F.count("*").alias("n"))
    return counted.withColumn("value", F.col("n") / F.lit(float(SECONDS[window])))


#: A window of more instants than this is cut into slices, by a sketch of them; and at most so many windows are.
SLICE, HOT_WINDOWS = 100_000, 10_000
#: Windows of a key that are scanned together before sums are carried from block to block.
BLOCK = 4096


def _met(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """left joined with right on keys of which nulls are equal; the columns of left and what else right has."""
    named = right.withColumnsRenamed({c: f"_r{c}" for c in keys})
    on = [left[c].eqNullSafe(named[f"_r{c}"]) for c in keys]
    return left.join(named, on, how).drop(*[f"_r{c}" for c in keys])


def _carried(parts: DataFrame, by: list[str], order: list[str], net: str) -> DataFrame:
    """parts with carry, the sum of net over the key's parts before: sums within blocks of windows, then over a key's blocks."""
    blocked = parts.withColumn("_block", F.floor(F.col("_w") / BLOCK))
    before = lambda keys, by_order: Window.partitionBy(*keys).orderBy(*by_order).rowsBetween(Window.unboundedPreceding, -1)
    sums = blocked.groupBy(*by, "_block").agg(F.sum(net).alias("_sum"))
    starts = sums.select(*by, "_block", F.coalesce(F.sum("_sum").over(before(by, ["_block"])), F.lit(0)).alias("_start"))
    own = blocked.withColumn("_within", F.coalesce(F.sum(net).over(before([*by, "_block"], order)), F.lit(0)))
    return _met(own, starts, [*by, "_block"]).select(*parts.columns, (F.col("_within") + F.col("_start")).alias("carry"))


def _followed(windows: DataFrame, by: list[str]) -> DataFrame:
    """windows with _next, the key's next window that has a row: within a block of windows, else the next block's first."""
    blocked = windows.withColumn("_block", F.floor(F.col("_w") / BLOCK))
    firsts = blocked.groupBy(*by, "_block").agg(F.min("_w").alias("_first"))
    firsts = firsts.select(*by, "_block", F.lead("_first").over(Window.partitionBy(*by).orderBy("_block")).alias("_after"))
    own = blocked.withColumn("_lead", F.lead("_w").over(Window.partitionBy(*by, "_block").orderBy("_w")))
    return _met(own, firsts, [*by, "_block"]).select(*windows.columns, F.coalesce("_lead", "_after").alias("_next"))


def _sliced(changes: DataFrame, by: list[str], most: int) -> DataFrame:
    """changes with _slice, by which windows of more than most instants are parted: up to 256 slices by quantiles of their times."""
    grid = F.kll_sketch_get_quantile_bigint(F.kll_sketch_agg_bigint("t", F.lit(1024)), F.array(*[F.lit(k / 256) for k in range(1, 256)]))
    cuts = changes.groupBy(*by, "_w").agg(F.count("*").alias("_n"), grid.alias("_grid")).where(F.col("_n") > most)
    # every so many-th quantile, for slices of about most instants
    stride = F.greatest(F.lit(1), F.floor(F.lit(256) / F.ceil(F.col("_n") / most))).cast("int")
    cuts = cuts.select(*by, "_w", F.filter("_grid", lambda x, k: (k + 1) % stride == 0).alias("_cuts"))
    own = _met(changes, F.broadcast(cuts), [*by, "_w"], "left")
    return own.select(*changes.columns, F.coalesce(F.size(F.filter("_cuts", lambda x: x <= F.col("t"))), F.lit(0)).alias("_slice"))


def concurrency(spans: DataFrame, window: str = "1h", by: tuple[str, ...] = ("solution_id",), slice_rows: int = SLICE) -> DataFrame:
    """The most spans open at once, per key and window in which any is open.

    A span opens at started_at and closes at ended_at; at the same instant closing comes first. A span is two
    changes, however long it is: changes of one instant are added up, each slice of a window is scanned for its
    net change and its peak, and these are carried over slices, windows and blocks of windows. Windows without a
    change take the number open before them. Windows with many instants are cut into slices, of which at
    most HOT_WINDOWS have a say, so that their boundaries can be broadcast (some 20 MB). Slices, a row each, are
    written to the session's shared folder, as three scans read them.

    Cases: spans without a time, or that end no later than they begin, are never open; null keys are a key; no spans give no rows.
    """
    by, step = list(by), SECONDS[window] * 1_000_000
    ok = spans.where("ended_at > started_at")
    most = max(slice_rows, 2 * ok.count() // HOT_WINDOWS)
    edges = F.explode(F.array(F.struct(F.unix_micros("started_at").alias("t"), F.lit(1).alias("d")), F.struct(F.unix_micros("ended_at").alias("t"), F.lit(-1).alias("d")))).alias("e")
    changes = ok.select(*by, edges).groupBy(*by, F.col("e.t").alias("t")).agg(F.sum("e.d").alias("d")).withColumn("_w", F.floor(F.col("t") / step))
    running = F.sum("d").over(Window.partitionBy(*by, "_w", "_slice").orderBy("t").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    slices = _sliced(changes, by, most).withColumn("_open", running).groupBy(*by, "_w", "_slice").agg(F.sum("d").alias("_net"), F.max("_open").alias("_peak"), F.min("t").alias("_first"))
    carried = _carried(kept(slices, "slices"), by, ["_w", "_slice"], "_net")
    # what is open before the first change counts, but not if that change is at the window's very start
    highest = F.greatest(F.col("carry") + F.col("_peak"), F.when(F.col("_first") > F.col("_w") * step, F.col("carry")))
    windows = carried.groupBy(*by, "_w").agg(F.max(highest).alias("_value"), F.max_by(F.col("carry") + F.col("_net"), "_slice").alias("_left"))
    row = lambda w, value: F.struct(w.alias("w"), value.cast("long").alias("value"))
    gap = F.when((F.col("_left") > 0) & (F.col("_next") > F.col("_w") + 1), F.transform(F.sequence(F.col("_w") + 1, F.col("_next") - 1), lambda w: row(w, F.col("_left"))))
    filled = _followed(windows, by).select(*by, F.explode(F.concat(F.array(row(F.col("_w"), F.col("_value"))), F.coalesce(gap, F.expr("cast(array() as array<struct<w:bigint,value:bigint>>)")))).alias("r"))
    return filled.where("r.value > 0").select(*by, F.timestamp_seconds(F.col("r.w") * SECONDS[window]).alias("bucket"), F.col("r.value").alias("value"))


def burn_rate(rows: DataFrame, hours: float, by: tuple[str, ...] = ("solution_id",)) -> DataFrame:
    """Cost per hour over a window of so many hours that rows already lie in."""
    return rows.where((F.col("metric") == "cost") & (F.col("component_id") != "")).groupBy(*by).agg((F.sum("value") / F.lit(float(hours))).alias("value"))


def projected_cost(rows: DataFrame, hours: float, horizon_hours: float, by: tuple[str, ...] = ("solution_id",)) -> DataFrame:
    return burn_rate(rows, hours, by).withColumn("value", F.col("value") * F.lit(float(horizon_hours)))


def cost_per(rows: DataFrame, counts: DataFrame, by: tuple[str, ...] = ("solution_id",)) -> DataFrame:
    """Cost over a count per key: records or outcomes, given as counts (by, n). No count, no row."""
    cost = rows.where((F.col("metric") == "cost") & (F.col("component_id") != "")).groupBy(*by).agg(F.sum("value").alias("_cost"))
    return cost.join(counts.where("n > 0"), list(by)).select(*by, (F.col("_cost") / F.col("n")).alias("value"))


def gauge(samples: DataFrame, window: str = "5m", by: tuple[str, ...] = ("solution_id",)) -> DataFrame:
    """A gauge sampled elsewhere, such as messages in flight: the highest sample (ts, value) per window."""
    return samples.groupBy(*by, bucket("ts", window).alias("bucket")).agg(F.max("value").alias("value"))


def allocated(costs: DataFrame, shares: DataFrame, by: tuple[str, ...] = ("solution_id",)) -> DataFrame:
    """Infrastructure cost (amount, in one row or more) dealt out by shares (by, share)."""
    whole = shares.agg(F.sum("share").alias("_shares")).crossJoin(costs.agg(F.sum("amount").alias("_amount")))  # one row
    return shares.crossJoin(F.broadcast(whole)).select(*by, (F.col("share") * F.col("_amount") / F.col("_shares")).alias("value"))


def budget_utilization(rows: DataFrame, budgets: DataFrame, by: tuple[str, ...] = ("solution_id",)) -> DataFrame:
    """Cost over budget per key, budgets given as (by, budget)."""
    return cost_per(rows, budgets.withColumnRenamed("budget", "n"), by)
