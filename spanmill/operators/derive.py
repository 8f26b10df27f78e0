"""Spans to metric rows: filter, intermediates once per span, scope fan-out, wide to long.

The plan is one projection after another over the scan, with a broadcast join for prices: no shuffle,
and the metadata JSON is parsed once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanmill.functions import patterns as P
from spanmill.functions.predicates import predicate
from spanmill.operators.pii import analyze
from spanmill.plans.registry import INTERMEDIATES, LENSES, SPAN_TYPES
from spanmill.sources.pricing import RATES

#: What an emission scope blanks of the path. The endpoint is never blanked.
_BLANKED = {
    "workflow_id": ("solution", "endpoint"),
    "agent_id": ("solution", "endpoint", "workflow"),
    "component_id": ("solution", "endpoint", "workflow", "agent"),
    "component_type": ("solution", "endpoint", "workflow", "agent"),
}
#: Prices are broadcast below this many rows, else joined by shuffle.
BROADCAST_ROWS = 100_000


def path_columns(scope: str = "_scope") -> dict[str, Column]:
    """The entity path at an emission scope: ids deeper than the scope are empty."""
    return {c: F.when(F.col(scope).isin(*scopes), "").otherwise(F.coalesce(c, F.lit(""))) for c, scopes in _BLANKED.items()}


def scopes() -> Column:
    """Scopes a span is emitted at: its own, or its type without one; a solution span with an endpoint also there."""
    level = F.when(F.coalesce("scope", F.lit("")) != "", F.col("scope")).otherwise(F.col("span_type"))
    twice = (level == "solution") & (F.coalesce("endpoint", F.lit("")) != "")
    return F.when(twice, F.array(F.lit("solution"), F.lit("endpoint"))).otherwise(F.array(level))


def _tokens(path: str) -> Column:
    return F.coalesce(P.number(path), F.lit(0.0))


def _performance(spans: DataFrame) -> DataFrame:
    return spans.withColumn("_latency_ms", P.latency_ms()).withColumn("_output_tokens", P.number("usage.output_tokens"))


def _cost(spans: DataFrame, pricing: DataFrame) -> DataFrame:
    prices = pricing.dropDuplicates(["component_id"]).select(F.col("component_id").alias("_priced"), *[F.col(r).alias(f"_{r}") for r in RATES])
    if pricing.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        prices = F.broadcast(prices)
    own = spans.join(prices, F.col("component_id") == F.col("_priced"), "left").withColumns({f"_{r}": F.coalesce(f"_{r}", F.lit(0.0)) for r in RATES})
    own = own.withColumns({
        "_input_tokens": _tokens("usage.input_tokens"), "_output_tokens": _tokens("usage.output_tokens"), "_cached_tokens": _tokens("usage.cached_tokens"),
        "_reasoning_tokens": _tokens("usage.reasoning_tokens"), "_embedding_tokens": _tokens("embedding_tokens"), "_search_units": _tokens("search_units"),
        "_retries": _tokens("retry_count"),
    })
    own = own.withColumns({
        "_raw_input": (F.col("_input_tokens") - F.col("_cached_tokens")) / 1000.0 * F.col("_input_per_1k") + F.col("_cached_tokens") / 1000.0 * F.col("_cached_input_per_1k"),
        "_raw_output": F.col("_output_tokens") / 1000.0 * F.col("_output_per_1k"),
        "_raw_embedding": F.col("_embedding_tokens") / 1000.0 * F.col("_input_per_1k"),
        "_total_tokens": F.col("_input_tokens") + F.col("_output_tokens"),
    })
    kind = F.col("span_type")
    own = own.withColumn(
        "_raw_cost",
        F.when(kind == "model_call", F.col("_raw_input") + F.col("_raw_output")).when(kind == "embedding", F.col("_raw_embedding"))
        .when(kind == "tool_call", F.col("_per_call")).when(kind == "retrieval", F.col("_per_query")).otherwise(0.0),
    )
    failed = F.lower(F.coalesce("span_status", F.lit(""))).isin("error", "timeout")
    return own.withColumns({
        "_cost": P.money(F.col("_raw_cost")), "_input_cost": P.money(F.col("_raw_input")), "_output_cost": P.money(F.col("_raw_output")),
        "_embedding_cost": P.money(F.col("_raw_embedding")), "_tool_api_cost": P.money(F.col("_per_call")),
        "_wasted_cost": F.when(failed, P.money(F.col("_raw_cost"))).otherwise(0.0),
        "_retry_cost": P.money(F.col("_raw_cost") * F.col("_retries")),
        "_cost_per_token": F.when(F.col("_total_tokens") != 0, P.money(F.col("_raw_cost") / F.col("_total_tokens"), 10)),
        "_cache_savings": P.money(F.col("_cached_tokens") / 1000.0 * F.greatest(F.lit(0.0), F.col("_input_per_1k") - F.col("_cached_input_per_1k"))),
    })


def _safety(spans: DataFrame, policy, results=None) -> DataFrame:
    """Counts of detections in input and output. Each text is analysed once per row, next to it; with a store of
    results (operators/results.py) once for all batches, which runs jobs of its own."""
    own = spans.withColumns({"_in_text": F.coalesce(P.text("input"), F.lit("")), "_out_text": F.coalesce(P.text("output"), F.lit(""))})
    if results is None:
        own = own.withColumns({"_in": analyze(F.col("_in_text"), policy), "_out": analyze(F.col("_out_text"), policy)})
    else:
        own = results.analysed(own, {"_in": "_in_text", "_out": "_out_text"})
    own = own.withColumn("_n_in", F.col("_in.entity_count")).withColumn("_n_out", F.col("_out.entity_count"))
    types = F.array_sort(F.array_distinct(F.concat(F.map_keys("_in.entities"), F.map_keys("_out.entities"))))
    own = own.withColumn("_types", types).withColumn("_total", F.col("_n_in") + F.col("_n_out"))
    location = F.when((F.col("_n_in") > 0) & (F.col("_n_out") > 0), "both").when(F.col("_n_in") > 0, "input").otherwise("output")
    return own.withColumns({
        "_pii_count": F.col("_total").cast("double"),
        "_pii_detected": F.when(F.col("_total") > 0, 1.0).otherwise(0.0),
        "_pii_distinct_types": F.size("_types").cast("double"),
        "_pii_meta": F.when(F.size("_types") > 0, F.to_json(F.struct(F.col("_types").alias("types"), location.alias("location")))),
    })


def derive(spans: DataFrame, lens: str, pricing: DataFrame | None = None, policy=None, metrics: set[str] | None = None, results=None) -> DataFrame:
    """The lens's per-span metric rows, in the derived layout. Works alike on batch and streaming spans.

    metrics limits the output to some of the lens's own. results is a store of analyses for the safety lens,
    under the policy of its own; spans must be a batch then.
    """
    kinds = SPAN_TYPES[lens]
    own = spans.where(F.col("span_type").isin(*kinds)) if kinds else spans
    own = own.withColumn(P.META, P.parsed_metadata())
    built_in = {"performance": lambda s: _performance(s), "cost": lambda s: _cost(s, pricing), "safety": lambda s: _safety(s, policy, results)}
    own = built_in[lens](own) if lens in built_in else INTERMEDIATES[lens](own, pricing, policy) if lens in INTERMEDIATES else own
    specs = [m for m in LENSES[lens] if m.per_span and (metrics is None or m.name in metrics)]
    none = F.lit(None).cast("string")
    wide = own.select(
        "span_id", F.coalesce("trace_id", F.lit("")).alias("trace_id"), F.coalesce("parent_span_id", F.lit("")).alias("parent_span_id"),
        "scope", "span_type", F.coalesce("solution_id", F.lit("")).alias("solution_id"), "endpoint", "workflow_id", "agent_id", "component_id", "component_type",
        F.coalesce("environment", F.lit("")).alias("environment"), "started_at", "ended_at",
        *[F.when(predicate(m.applies), m.value()).cast("double").alias(f"v_{m.name}") for m in specs],
        *[F.when(predicate(m.applies), m.meta()).alias(f"m_{m.name}") for m in specs if m.meta],
    )
    spread = wide.withColumn("_scope", F.explode(scopes()))
    parts = [x for m in specs for x in (F.lit(m.name), F.col(f"v_{m.name}"), F.col(f"m_{m.name}") if m.meta else none)]
    path = path_columns()
    long = spread.select(
        "span_id", "trace_id", "parent_span_id", F.col("_scope").alias("scope"), "solution_id", F.coalesce("endpoint", F.lit("")).alias("endpoint"),
        *[path[c].alias(c) for c in _BLANKED], "environment", F.col("ended_at").alias("ts"), F.col("started_at").alias("start_ts"), F.col("ended_at").alias("end_ts"),
        F.stack(F.lit(len(specs)), *parts).alias("metric", "value", "metric_meta"),
    ).where(F.col("value").isNotNull())
    return long.select(
        "span_id", "trace_id", "parent_span_id", "scope", "solution_id", "endpoint", "workflow_id", "agent_id", "component_id", "component_type", "environment",
        "ts", "metric", "value", F.lit(None).cast("float").alias("confidence"), "metric_meta", "start_ts", "end_ts",
    )
