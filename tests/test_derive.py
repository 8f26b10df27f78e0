"""Metric derivation on hand-written spans: every edge of metadata, status, scope and prices."""

import json
from datetime import datetime, timedelta

import pytest

from spanmill.operators import rollup, thresholds
from spanmill.operators.derive import derive
from spanmill.plans.registry import LENSES, SCORED, catalogue, every_metric, owned
from spanmill.schema import derived, raw_span
from spanmill.sources import config
from spanmill.sources.pricing import pricing_from_components, static_pricing

T0 = datetime(2024, 1, 1, 12, 0, 0)


def spans_of(spark, *rows):
    base = dict.fromkeys(raw_span().fieldNames(), "")
    base |= {"span_id": "s", "trace_id": "t", "span_type": "model_call", "span_status": "ok", "scope": "component", "solution_id": "sol", "started_at": T0,
             "ended_at": T0 + timedelta(milliseconds=1500), "stage_order": None, "recorded_at": T0, "environment": "prod", "metadata": None}
    return spark.createDataFrame([tuple((base | r)[c] for c in raw_span().fieldNames()) for r in rows], raw_span())


def values(rows, **where):
    return {(r["span_id"], r["scope"], r["metric"]): r["value"] for r in rows.collect() if all(r[k] == v for k, v in where.items())}


def test_catalogue(spark):
    assert [len(LENSES[k]) for k in ("performance", "cost", "safety")] == [17, 22, 3]
    assert catalogue(spark).count() == 42 and len({m.name for m in every_metric()}) == 42
    assert sum(not m.per_span for m in every_metric()) == 9
    assert owned("safety") == {"pii_count", "pii_detected", "pii_distinct_types"}
    assert [len(v) for v in SCORED.values()] == [14, 4, 4]


def test_layout(spark):
    rows = derive(spans_of(spark, {}), "performance")
    assert [(f.name, f.dataType) for f in rows.schema] == [(f.name, f.dataType) for f in derived()]


@pytest.mark.parametrize("metadata", [None, "", "{}", "\\N", "{bad", "[1]", "3", '"x"'])
def test_metadata_that_is_no_object(spark, metadata):
    got = values(derive(spans_of(spark, {"metadata": metadata}), "performance"))
    assert {m for _, _, m in got} == {"latency", "error_rate", "timeout_count"}
    cost = values(derive(spans_of(spark, {"metadata": metadata, "component_id": "model_gpt4o"}), "cost", static_pricing(spark)))
    assert cost["s", "component", "cost"] == 0.0 and cost["s", "component", "input_tokens"] == 0.0 and ("s", "component", "cost_per_token") not in cost


def test_numbers_in_metadata(spark):
    cases = {"a": {"ttft_ms": "12.5"}, "b": {"ttft_ms": True}, "c": {"ttft_ms": None}, "d": {"ttft_ms": "x"}, "e": {"ttft_ms": 0}}
    got = values(derive(spans_of(spark, *[{"span_id": k, "metadata": json.dumps(v)} for k, v in cases.items()]), "performance", metrics={"time_to_first_token"}))
    assert {k[0]: v for k, v in got.items()} == {"a": 12.5, "b": 1.0, "e": 0.0}


def test_booleans_in_metadata(spark):
    cases = {"a": True, "b": 1, "c": "1", "d": "true", "e": "True", "f": False, "g": 0, "h": "yes", "i": None, "j": 2}
    got = values(derive(spans_of(spark, *[{"span_id": k, "metadata": json.dumps({"rate_limit_hit": v})} for k, v in cases.items()]), "performance", metrics={"rate_limit_hit"}))
    assert {k[0]: v for k, v in got.items()} == {"a": 1.0, "b": 1.0, "c": 1.0, "d": 1.0, "e": 1.0, "f": 0.0, "g": 0.0, "h": 0.0, "j": 0.0}


def test_status_latency_and_throughput(spark):
    usage = json.dumps({"usage": {"output_tokens": 30}})
    got = values(derive(spans_of(
        spark, {"span_id": "u", "span_status": "ERROR"}, {"span_id": "n", "span_status": None}, {"span_id": "t", "span_status": "Timeout"},
        {"span_id": "z", "ended_at": T0, "metadata": usage}, {"span_id": "m", "ended_at": T0 - timedelta(milliseconds=5)}, {"span_id": "p", "metadata": usage},
    ), "performance"))
    assert [got[k, "component", "error_rate"] for k in "unt"] == [1.0, 0.0, 1.0] and got["t", "component", "timeout_count"] == 1.0
    assert got["m", "component", "latency"] == -5.0 and got["p", "component", "token_throughput"] == 20.0
    assert ("z", "component", "token_throughput") not in got


def test_scopes_and_paths(spark):
    full = {"workflow_id": "w", "agent_id": "a", "component_id": "c", "component_type": "model", "endpoint": "e"}
    rows = derive(spans_of(
        spark, {"span_id": "1", "span_type": "solution", "scope": "solution", **full}, {"span_id": "2", "span_type": "solution", "scope": "solution"},
        {"span_id": "3", "span_type": "workflow", "scope": "workflow", **full}, {"span_id": "4", "span_type": "agent", "scope": "agent", **full}, {"span_id": "5", "scope": "", **full},
        {"span_id": "6", "scope": None, **full},
    ), "performance", metrics={"latency"}).collect()
    got = {(r["span_id"], r["scope"]): (r["endpoint"], r["workflow_id"], r["agent_id"], r["component_id"], r["component_type"]) for r in rows}
    assert got == {
        ("1", "solution"): ("e", "", "", "", ""), ("1", "endpoint"): ("e", "", "", "", ""), ("2", "solution"): ("", "", "", "", ""), ("3", "workflow"): ("e", "w", "", "", ""),
        ("4", "agent"): ("e", "w", "a", "", ""), ("5", "model_call"): ("e", "w", "a", "c", "model"), ("6", "model_call"): ("e", "w", "a", "c", "model"),
    }


def test_money(spark):
    usage = lambda **k: json.dumps({"usage": k, "retry_count": 2})
    got = values(derive(spans_of(
        spark, {"span_id": "a", "component_id": "model_gpt4o", "span_status": "error", "metadata": usage(input_tokens=1000, output_tokens=500, cached_tokens=400)},
        {"span_id": "b", "component_id": "model_gpt4o", "metadata": usage(input_tokens=100, cached_tokens=400)}, {"span_id": "c", "component_id": "unknown", "metadata": usage(input_tokens=100)},
        {"span_id": "d", "span_type": "tool_call", "component_id": "tool_websearch"}, {"span_id": "e", "span_type": "agent"},
    ), "cost", static_pricing(spark)))
    at = lambda k, m: got[k, "component", m]
    assert at("a", "input_cost") == 0.004 and at("a", "output_cost") == 0.0075 and at("a", "cost") == 0.0115
    assert at("a", "wasted_cost") == 0.0115 and at("a", "retry_cost") == 0.023 and at("a", "cache_savings") == 0.001
    assert at("b", "input_cost") == -0.0005 and at("b", "wasted_cost") == 0.0
    assert at("c", "cost") == 0.0 and at("c", "cost_per_token") == 0.0
    assert at("d", "cost") == 0.005 and at("d", "tool_api_cost") == 0.005 and not any(k[0] == "e" for k in got)


def test_pricing_json(spark):
    own = spark.createDataFrame([("m", "model", '{"input_per_1k": 0.5}', True), ("n", "model", None, True), ("o", "model", "{}", False)], "component_id string, component_type string, pricing string, is_active boolean")
    assert {r["component_id"]: r["input_per_1k"] for r in pricing_from_components(own).collect()} == {"m": 0.5, "n": None}


def test_safety(spark):
    meta = lambda i, o: json.dumps({"input": i, "output": o})
    rows = derive(spans_of(spark, {"span_id": "a", "metadata": meta("mail ann@example.org", "ip 10.0.0.1 and 10.0.0.2")}, {"span_id": "b", "metadata": meta("", None)}, {"span_id": "c", "metadata": meta(None, "ann@example.org")}), "safety").collect()
    got = {(r["span_id"], r["metric"]): (r["value"], r["metric_meta"]) for r in rows}
    assert got["a", "pii_count"] == (3.0, '{"types":["EMAIL_ADDRESS","IP_ADDRESS"],"location":"both"}') and got["a", "pii_distinct_types"][0] == 2.0
    assert got["b", "pii_count"] == (0.0, None) and got["b", "pii_detected"][0] == 0.0
    assert got["c", "pii_count"] == (1.0, '{"types":["EMAIL_ADDRESS"],"location":"output"}') and got["c", "pii_detected"] == (1.0, None)


def test_rollup_of_rollup_is_the_direct_rollup(spark):
    spans = spans_of(spark, *[{"span_id": str(k), "ended_at": T0 + timedelta(seconds=17 * k)} for k in range(300)])
    rows = derive(spans, "performance", metrics={"latency"})
    twice, once = rollup.merge(rollup.base_rollup(rows), "1h"), rollup.base_rollup(rows, "1h")
    pick = lambda d: sorted((str(r["bucket"]), r["count"], r["sum_value"], r["min_value"], r["max_value"]) for r in d.collect())
    assert pick(twice) == pick(once) and sum(r[1] for r in pick(once)) == 300
    p95 = twice.orderBy("bucket").select(rollup.quantile(0.5)).first()[0]
    assert abs(p95 - 17000 * 105) < 17000 * 20


def test_thresholds(spark):
    values_ = spark.createDataFrame([("latency", "solution", "5m", "s1", "", "", "", "", v) for v in (1.0, 3.0, 9.0)], "metric string, scope string, time_window string, solution_id string, endpoint_id string, workflow_id string, agent_id string, component_id string, value double")
    rules = [("performance", "latency", "solution", "5m", "gt", 2.0, 5.0)]
    got = thresholds.judged(values_, config.thresholds_by_rule(spark, rules, ["s1", "s2"])).collect()
    assert sorted((r["value"], r["status"]) for r in got) == [(1.0, "ok"), (3.0, "warning"), (9.0, "critical")]
    low = [("performance", "latency", "solution", "5m", "lt", 5.0, 2.0)]
    assert sorted(r["status"] for r in thresholds.judged(values_, config.thresholds_by_rule(spark, low, ["s1"])).collect()) == ["critical", "ok", "warning"]


def test_business_keys(spark):
    registry = {k: spark.createDataFrame([(f"uuid-{k}", f"{k}-1")], f"id string, {k}_id string") for k in ("solution", "endpoint", "workflow", "agent", "component")}
    rows = spark.createDataFrame([("uuid-solution", "uuid-endpoint", None, None, "uuid-component")], config.BINDING_SCHEMA)
    got = thresholds.with_business_keys(rows, registry).withColumn("level", thresholds.deepest()).first()
    assert (got["solution_id"], got["endpoint_id"], got["workflow_id"], got["component_id"], got["level"]) == ("solution-1", "endpoint-1", None, "component-1", "component")
