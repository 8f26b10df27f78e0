"""Read-time metrics as data, compiled into one aggregation.

A read-time metric is a value over statistics; a statistic counts, adds up or takes the maximum of one metric's rows, either
those emitted at the level itself (own) or those of the leaves below it. Its predicate in the registry names the levels
that it has values for. compile_metrics() takes any number of them: each row of a metric that is asked for goes to its levels
once, all statistics are conditional aggregates of a single grouping by level, path and window, and the
values come out in rows. Concurrency is no statistic of rows; it is scanned for the same levels and windows.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanmill.operators.readtime import concurrency
from spanmill.operators.rollup import SECONDS, bucket
from spanmill.plans.registry import every_metric
from spanmill.sources.ledger import kept

#: The columns of a level's path, by level.
PATHS = {"solution": ("solution_id",), "endpoint": ("solution_id", "endpoint"), "workflow": ("solution_id", "workflow_id"), "agent": ("solution_id", "workflow_id", "agent_id")}
IDS = ("solution_id", "endpoint", "workflow_id", "agent_id")
#: The levels that a read-time predicate stands for.
LEVELS = {"levels": tuple(PATHS), "sol_wf": ("solution", "workflow"), "solution_only": ("solution",)}


@dataclass(frozen=True)
class Stat:
    metric: str
    how: str
    own: bool = False

    @property
    def name(self) -> str:
        return f"{self.how}_{self.metric}_{'own' if self.own else 'leaves'}"


@dataclass(frozen=True)
class Terms:
    """What values may use besides statistics: hours of the window, hours of a projection."""

    hours: float
    horizon: float


def _over(top: Column, bottom: Column) -> Column:
    return F.when(bottom > 0, top / bottom)


COST, SPANS = Stat("cost", "sum"), Stat("latency", "count", True)
#: name -> (statistics, value of them in order and of the terms). Rows of outcomes, records, budgets, infrastructure and messages are the caller's.
FORMULAS: dict[str, tuple[tuple[Stat, ...], Callable[..., Column]]] = {
    "throughput": ((SPANS,), lambda t, n: n / (t.hours * 3600)),
    "messages_in_flight": ((Stat("messages_in_flight", "max", True),), lambda t, m: m),
    "infrastructure_cost": ((Stat("infrastructure_cost", "sum", True),), lambda t, c: c),
    "burn_rate": ((COST,), lambda t, c: c / t.hours),
    "projected_cost": ((COST,), lambda t, c: c / t.hours * t.horizon),
    "cost_per_record": ((COST, Stat("records_processed", "sum", True)), lambda t, c, n: _over(c, n)),
    "cost_per_outcome": ((COST, Stat("goal_achieved", "sum", True)), lambda t, c, n: _over(c, n)),
    "budget_utilization": ((COST, Stat("budget", "max", True)), lambda t, c, b: _over(c, b)),
}


def levels_of(name: str) -> tuple[str, ...]:
    metric = next((m for m in every_metric() if m.name == name and not m.per_span), None)
    if metric is None or metric.applies not in LEVELS:
        raise ValueError(f"no such read-time metric: {name}")
    return LEVELS[metric.applies]


def _at_levels(rows: DataFrame, levels: list[str]) -> DataFrame:
    """rows with _level and the level's path in place of their ids, once for each level that they belong to: their own, or those above a leaf."""
    leaf = F.coalesce("component_id", F.lit("")) != ""
    named = lambda level: [F.coalesce(F.col(c), F.lit("")) != "" for c in PATHS[level]]

    def belongs(level: str) -> Column:
        own = (F.col("scope") == level) & ~leaf
        below = leaf
        for known in named(level):
            below = below & known
        return own | below

    place = lambda level: F.struct(F.lit(level).alias("level"), *[(F.coalesce(F.col(c), F.lit("")) if c in PATHS[level] else F.lit("")).alias(c) for c in IDS])
    spread = F.explode(F.filter(F.array(*[F.when(belongs(level), place(level)) for level in levels]), lambda x: x.isNotNull())).alias("_at")
    return rows.select(spread, leaf.alias("_leaf"), "metric", "value", "ts", "start_ts", "end_ts")


def compile_metrics(rows: DataFrame, names: list[str], window: str = "1d", horizon_hours: float = 720.0) -> DataFrame:
    """(metric, scope, solution_id, endpoint, workflow_id, agent_id, bucket, value) of read-time metrics from metric rows.

    One shuffle for all but concurrency. A metric whose statistics a group doesn't have in full gives no row there.
    With concurrency, whose scan reads them again, the rows that are asked for are written to the shared folder.
    """
    terms = Terms(SECONDS[window] / 3600, float(horizon_hours))
    plain = [n for n in names if n != "concurrency"]
    of = {n: levels_of(n) for n in names}
    out, stats = None, list(dict.fromkeys(s for n in plain for s in FORMULAS[n][0]))
    if "concurrency" in names and plain:
        asked = {s.metric for s in stats} | {"latency"}
        rows = kept(rows.where(F.col("metric").isin(*asked)).select("metric", "scope", *IDS, "component_id", "value", "ts", "start_ts", "end_ts"), "metric-rows")
    if plain:
        wanted = [level for level in PATHS if any(level in of[n] for n in plain)]
        spread = _at_levels(rows.where(F.col("metric").isin(*{s.metric for s in stats})), wanted)
        reduce = {"count": F.count, "sum": F.sum, "max": F.max}
        held = lambda s: (F.col("metric") == s.metric) & (F.col("_leaf") != F.lit(s.own))
        whole = spread.groupBy("_at", bucket("ts", window).alias("bucket")).agg(*[reduce[s.how](F.when(held(s), F.col("value"))).alias(s.name) for s in stats])
        # a count of nothing is no value
        column = lambda s: F.when(F.col(s.name) > 0, F.col(s.name)) if s.how == "count" else F.col(s.name)
        values = [F.when(F.col("_at.level").isin(*of[n]), FORMULAS[n][1](terms, *[column(s) for s in FORMULAS[n][0]])).cast("double") for n in plain]
        long = whole.select("_at", "bucket", F.stack(F.lit(len(plain)), *[x for n, v in zip(plain, values) for x in (F.lit(n), v)]).alias("metric", "value")).where("value is not null")
        out = long.select("metric", F.col("_at.level").alias("scope"), *[f"_at.{c}" for c in IDS], "bucket", "value")
    if "concurrency" in names:
        own = _at_levels(rows.where("metric = 'latency'"), list(of["concurrency"])).where("not _leaf").select("_at", F.col("start_ts").alias("started_at"), F.col("end_ts").alias("ended_at"))
        most = concurrency(own.select("_at.*", "started_at", "ended_at"), window, ("level", *IDS))
        found = most.select(F.lit("concurrency").alias("metric"), F.col("level").alias("scope"), *IDS, "bucket", F.col("value").cast("double").alias("value"))
        out = found if out is None else out.unionAll(found)
    if out is None:
        raise ValueError("no metrics are named")
    return out
