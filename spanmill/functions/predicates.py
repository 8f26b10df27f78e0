"""Which spans a metric applies to, as boolean columns over span_type and scope."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def of_type(*span_types: str) -> Column:
    return F.coalesce(F.col("span_type").isin(*span_types), F.lit(False))


def of_level(scopes: tuple[str, ...], span_types: tuple[str, ...]) -> Column:
    return F.coalesce(F.col("scope").isin(*scopes), F.lit(False)) | of_type(*span_types)



# The predicates' names, span types and scopes.
_PREDICATES: dict[str, Callable[[], Column]] = {
    "any_span": lambda: F.lit(True),
    "llm_call": lambda: of_type("model_call"),
    "queued_op": lambda: of_type("agent", "workflow"),
    "orchestrated": lambda: of_type("workflow"),
    "retryable": lambda: of_type("model_call", "tool_call", "retrieval", "embedding", "validation", "agent"),
    "rate_limited": lambda: of_type("model_call", "tool_call"),
    "batch_op": lambda: of_type("validation", "skill_exec"),
    "levels": lambda: of_level(("solution", "endpoint", "workflow", "agent"), ("solution", "workflow", "agent")),
    "sol_wf": lambda: of_type("solution", "workflow"),
    "billable": lambda: of_type("model_call", "embedding", "tool_call", "retrieval"),
    "cost_embedding": lambda: of_type("embedding"),
    "cost_tool": lambda: of_type("tool_call"),
    "cost_kb": lambda: of_type("retrieval"),
    "solution_only": lambda: of_type("solution"),
}


def register_predicate(name: str, build: Callable[[], Column]) -> None:
    """A predicate of the caller's own; a name that is taken is an error."""
    if name in _PREDICATES:
        raise ValueError(f"predicate exists: {name}")
    _PREDICATES[name] = build


def predicate(name: str) -> Column:
    """A named predicate. Columns are built on demand, since they need a running session."""
    return _PREDICATES[name]()
