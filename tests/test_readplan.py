"""Read-time metrics compiled together against each by itself, and their levels."""

import pytest

from spanmill.operators.derive import derive
from spanmill.plans.readplan import FORMULAS, compile_metrics, levels_of
from spanmill.sources.pricing import static_pricing
from spanmill.testbed import event_spans


def listed(frame):
    return sorted(tuple(str(v) for v in r) for r in frame.collect())


def test_together_equals_apart_and_levels_are_honoured(spark, sf_dir):
    spans = event_spans(spark, sf_dir).limit(300)
    rows = derive(spans, "performance", metrics={"latency"}).unionByName(derive(spans, "cost", static_pricing(spark), metrics={"cost"}))
    names = ["throughput", "burn_rate", "projected_cost", "concurrency"]
    whole = compile_metrics(rows, names, "1h", 100.0)
    assert listed(whole) == sorted(x for n in names for x in listed(compile_metrics(rows, [n], "1h", 100.0)))
    scopes = {n: {r["scope"] for r in whole.where(whole.metric == n).select("scope").distinct().collect()} for n in names}
    assert scopes["projected_cost"] == {"solution"} and scopes["burn_rate"] == {"solution", "workflow"} and scopes["throughput"] >= {"solution", "endpoint", "workflow"}
    by = {(r["metric"], r["scope"], r["solution_id"], r["workflow_id"], r["bucket"]): r["value"] for r in whole.collect() if r["metric"] != "throughput"}
    assert all(abs(v - 100 * by["burn_rate", *k[1:]]) < 1e-12 for k, v in by.items() if k[0] == "projected_cost")


def test_names_and_levels(spark):
    assert levels_of("burn_rate") == ("solution", "workflow") and levels_of("budget_utilization") == ("solution",) and len(FORMULAS) == 8
    for name in ("latency", "no_such"):
        with pytest.raises(ValueError):
            levels_of(name)
