"""Thresholds by path against a loop over all of them."""

import random

from spanmill.operators import thresholds
from spanmill.sources import config

LEVELS = ["solution", "endpoint", "workflow", "agent", "component"]


def brute(value, rules):
    """The rule that bears on a value: (scope, path, value)."""
    scope, path, _ = value
    fits = []
    for _, _, s, _, op, warn, crit, *own, active in rules:
        if active is not False and s == scope and own[0] == path[0] and own[LEVELS.index(s)] == path[LEVELS.index(s)] and all(not a or a == b for a, b in zip(own, path)):
            fits.append(([not x for x in reversed(own)], crit if op == "gt" else -crit, op, warn, crit))
    return min(fits)[2:] if fits else None


def test_the_deepest_path_counts(spark):
    rng = random.Random(5)
    ids = [["s1", "s2"], ["e1", "e2", ""], ["w1", "w2", ""], ["a1", ""], ["c1", "c2", ""]]
    rules = []
    for _ in range(120):
        scope = rng.choice(LEVELS)
        k = LEVELS.index(scope)
        path = [rng.choice([*own, None, ""]) if 0 < i < k else rng.choice([x for x in own if x]) if i in (0, k) else None for i, own in enumerate(ids)]
        rules.append(("performance", "latency", scope, "5m", rng.choice(["gt", "lt"]), float(rng.randint(0, 9)), float(rng.randint(0, 9)), *path, rng.choice([True, True, None, False])))
    values = [(scope, [rng.choice(own) for own in ids], float(rng.randint(0, 9))) for scope in LEVELS for _ in range(60)]
    frame = spark.createDataFrame([(n, "latency", s, "5m", *p, v) for n, (s, p, v) in enumerate(values)], "n long, metric string, scope string, time_window string, " + ", ".join(f"{c} string" for c in thresholds.PATH) + ", value double")
    got = {r["n"]: (r["operator"], r["warning_value"], r["critical_value"], r["status"]) for r in thresholds.judged(frame, spark.createDataFrame(rules, config.THRESHOLD_SCHEMA)).collect()}
    want = {}
    for n, v in enumerate(values):
        rule = brute(v, rules)
        if rule:
            op, warn, crit = rule
            beyond = lambda x: v[2] > x if op == "gt" else v[2] < x
            want[n] = (op, warn, crit, "critical" if beyond(crit) else "warning" if beyond(warn) else "ok")
    assert got == want and len(want) > 100


def test_tables_without_activity_are_active(spark):
    values = spark.createDataFrame([("latency", "workflow", "5m", "s", "e", "w", "", "", 3.0)], "metric string, scope string, time_window string, " + ", ".join(f"{c} string" for c in thresholds.PATH) + ", value double")
    rule = spark.createDataFrame([("performance", "latency", "workflow", "5m", "gt", 1.0, 2.0, "s", None, "w", None, None, None)], config.THRESHOLD_SCHEMA)
    assert thresholds.judged(values, rule.drop("is_active")).first()["status"] == "critical"
