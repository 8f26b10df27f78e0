"""The declarative registry of metrics.

A metric names a lens, a predicate, a pattern (for the catalogue), a value over the lens's
intermediates, a unit, a window and whether a threshold may bear on it. Read-time metrics have no
value per span. reducer is the statistic that thresholds compare, a choice of this library: p95 for
times, avg for ratios, sum for money and counts; gauges take max.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spanmill.functions import patterns as P


@dataclass(frozen=True)
class Metric:
    lens: str
    name: str
    applies: str
    pattern: str
    unit: str
    window: str
    threshold: bool = False
    value: Callable[[], Column] | None = None
    meta: Callable[[], Column] | None = None

    @property
    def per_span(self) -> bool:
        return self.value is not None

    @property
    def reducer(self) -> str:
        if self.unit == "ms":
            return "p95"
        if self.unit in ("ratio", "0-1", "tok/sec", "USD/token", "ops/sec", "USD/hr"):
            return "avg"
        return "max" if self.unit == "gauge" else "sum"

    @property
    def additive(self) -> bool:
        """Whether sums over leaves give the value of the levels above."""
        return self.unit in ("USD", "count") and self.per_span


def _meta(lens: str, name: str, applies: str, path: str, unit: str, window: str, threshold: bool = False) -> Metric:
    return Metric(lens, name, applies, "metadata_numeric", unit, window, threshold, lambda: P.number(path))


def _own(lens: str, name: str, applies: str, unit: str, window: str, threshold: bool = False, meta=None) -> Metric:
    return Metric(lens, name, applies, "ctx_value", unit, window, threshold, lambda: F.col(f"_{name}"), meta)


def _read(lens: str, name: str, applies: str, unit: str, window: str, threshold: bool = False) -> Metric:
    return Metric(lens, name, applies, "aggregation_derived", unit, window, threshold)


PERFORMANCE = [
    Metric("performance", "latency", "any_span", "column_latency", "ms", "5m", True, lambda: F.round("_latency_ms", 3)),
    Metric("performance", "error_rate", "any_span", "status_flag", "ratio", "5m", True, lambda: P.status_flag("error", "timeout")),
    Metric("performance", "timeout_count", "any_span", "status_flag", "count", "5m", False, lambda: P.status_flag("timeout")),
    _meta("performance", "time_to_first_token", "llm_call", "ttft_ms", "ms", "5m", True),
    _meta("performance", "inter_token_latency", "llm_call", "inter_token_latency_ms", "ms", "5m"),
    _meta("performance", "queue_wait_time", "queued_op", "queue_wait_ms", "ms", "5m"),
    _meta("performance", "scheduling_delay", "orchestrated", "scheduling_delay_ms", "ms", "5m"),
    _meta("performance", "retry_count", "retryable", "retry_count", "count", "15m", True),
    _meta("performance", "retry_delay", "retryable", "retry_delay_ms", "ms", "15m"),
    Metric("performance", "rate_limit_hit", "rate_limited", "metadata_bool", "ratio", "5m", False, lambda: P.metadata_bool("rate_limit_hit")),
    _meta("performance", "rate_limit_wait", "rate_limited", "rate_limit_wait_ms", "ms", "5m"),
    _meta("performance", "records_processed", "batch_op", "records_processed", "count", "5m"),
    _meta("performance", "batch_size", "batch_op", "batch_size", "count", "5m"),
    Metric("performance", "token_throughput", "llm_call", "ratio", "tok/sec", "5m", False, lambda: P.ratio(F.col("_output_tokens"), F.col("_latency_ms") / 1000.0)),
    _read("performance", "throughput", "levels", "ops/sec", "5m", True),
    _read("performance", "concurrency", "levels", "gauge", "5m"),
    _read("performance", "messages_in_flight", "sol_wf", "gauge", "5m"),
]
COST = [
    _own("cost", "input_tokens", "llm_call", "count", "1h"),
    _own("cost", "output_tokens", "llm_call", "count", "1h"),
    _own("cost", "total_tokens", "llm_call", "count", "1h", True),
    _own("cost", "cached_tokens", "llm_call", "count", "1h"),
    _own("cost", "reasoning_tokens", "llm_call", "count", "1h"),
    _own("cost", "embedding_tokens", "cost_embedding", "count", "1h"),
    _own("cost", "search_units", "cost_kb", "count", "1h"),
    _own("cost", "cost", "billable", "USD", "1d", True),
    _own("cost", "input_cost", "llm_call", "USD", "1d"),
    _own("cost", "output_cost", "llm_call", "USD", "1d"),
    _own("cost", "tool_api_cost", "cost_tool", "USD", "1d"),
    _own("cost", "embedding_cost", "cost_embedding", "USD", "1d"),
    _read("cost", "infrastructure_cost", "sol_wf", "USD", "1d"),
    _read("cost", "cost_per_outcome", "sol_wf", "USD", "1d", True),
    _own("cost", "wasted_cost", "billable", "USD", "1d"),
    _own("cost", "retry_cost", "billable", "USD", "1d"),
    _own("cost", "cost_per_token", "llm_call", "USD/token", "1h"),
    _own("cost", "cache_savings", "llm_call", "USD", "1d"),
    _read("cost", "cost_per_record", "sol_wf", "USD", "1d"),
    _read("cost", "budget_utilization", "solution_only", "0-1", "1h", True),
    _read("cost", "burn_rate", "sol_wf", "USD/hr", "1h", True),
    _read("cost", "projected_cost", "solution_only", "USD", "1d"),
]
SAFETY = [
    _own("safety", "pii_count", "llm_call", "count", "1h", True, lambda: F.col("_pii_meta")),
    _own("safety", "pii_detected", "llm_call", "ratio", "1h", True),
    _own("safety", "pii_distinct_types", "llm_call", "count", "1h"),
]
LENSES: dict[str, list[Metric]] = {"performance": PERFORMANCE, "cost": COST, "safety": SAFETY}
#: Span types that a lens reads at all; None is every type.
SPAN_TYPES: dict[str, tuple[str, ...] | None] = {
    "performance": None,
    "cost": ("model_call", "embedding", "tool_call", "retrieval"),
    "safety": ("model_call",),
}
#: Metrics that have thresholds but no formula; they take a scorer's rows (see operators.scorers).
SCORED = {
    "quality": ["chunk_utilization", "coherence", "completeness", "constraint_satisfaction", "context_precision", "context_recall", "context_relevance", "data_accuracy", "data_completeness", "drift_score", "faithfulness", "format_correctness", "schema_conformance", "tool_call_validity"],
    "safety": ["jailbreak_attempt", "prompt_injection_detected", "sensitive_data_exposure", "toxicity_score"],
    "outcomes": ["goal_achieved", "human_override", "sla_met", "task_automation_rate"],
}


#: Lenses of the caller's own: what adds a lens's intermediate columns to spans, of (spans, pricing, policy).
INTERMEDIATES: dict[str, Callable] = {}


def register_lens(lens: str, metrics: list[Metric], span_types: tuple[str, ...] | None = None, intermediates: Callable[[DataFrame, DataFrame | None, object], DataFrame] | None = None) -> None:
    """A lens with metrics of its own. intermediates adds the columns that its values read, once per batch of
    spans, so it may run a UDF over them; without one, values read the span and its metadata alone."""
    if lens in LENSES:
        raise ValueError(f"lens exists: {lens}")
    for m in metrics:
        if m.lens != lens:
            raise ValueError(f"{m.name} belongs to lens {m.lens}")
    LENSES[lens], SPAN_TYPES[lens] = list(metrics), span_types
    if intermediates is not None:
        INTERMEDIATES[lens] = intermediates


def register_metric(metric: Metric) -> None:
    """A further metric of a lens that exists; a name that the lens has is an error."""
    if metric.name in owned(metric.lens):
        raise ValueError(f"metric exists: {metric.name}")
    LENSES[metric.lens].append(metric)


def every_metric() -> list[Metric]:
    return [m for specs in LENSES.values() for m in specs]


def owned(lens: str) -> set[str]:
    return {m.name for m in LENSES[lens]}


def catalogue(spark: SparkSession) -> DataFrame:
    rows = [(m.lens, m.name, m.applies, m.pattern, m.unit, m.window, m.threshold, m.per_span) for m in every_metric()]
    return spark.createDataFrame(rows, "lens string, metric string, applies string, pattern string, unit string, window string, threshold boolean, per_span boolean")
