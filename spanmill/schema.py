"""Column layouts of spans, derived metrics, rollups and configuration tables."""

from __future__ import annotations

from pyspark.sql import types as T


#: The columns of a raw span, in order.
RAW_SPAN_DDL = (
    "trace_id string, span_id string, parent_span_id string, correlation_id string, session_id string, "
    "span_type string, span_name string, span_status string, scope string, solution_id string, endpoint string, "
    "workflow_id string, agent_id string, component_id string, component_type string, "
    "started_at timestamp, ended_at timestamp, pipeline_stage string, stage_order short, entity_type string, "
    "service string, environment string, region string, metadata string, recorded_at timestamp"
)
#: The columns of a derived metric row, in order.
DERIVED_DDL = (
    "span_id string, trace_id string, parent_span_id string, scope string, solution_id string, endpoint string, "
    "workflow_id string, agent_id string, component_id string, component_type string, environment string, "
    "ts timestamp, metric string, value double, confidence float, metric_meta string, start_ts timestamp, end_ts timestamp"
)
#: The nine dimensions of a rollup besides its bucket.
DIMENSIONS = ["scope", "solution_id", "endpoint", "workflow_id", "agent_id", "component_id", "component_type", "environment", "metric"]


def raw_span() -> T.StructType:
    return T.StructType.fromDDL(RAW_SPAN_DDL)


def derived() -> T.StructType:
    return T.StructType.fromDDL(DERIVED_DDL)
