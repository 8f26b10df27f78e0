"""Concurrency against a plain sweep."""

import random
from collections import defaultdict
from datetime import datetime, timedelta, timezone

import pytest

from spanmill.operators import readtime

START = datetime(2024, 1, 1, tzinfo=timezone.utc)
SCHEMA = "solution_id string, started_at timestamp, ended_at timestamp"


def brute(rows, step_s):
    """(key, window) -> most open at once; all in whole seconds."""
    by = defaultdict(lambda: defaultdict(lambda: [0, 0]))
    for k, a, b in rows:
        if a is not None and b is not None and b > a:
            by[k][a][1] += 1
            by[k][b][0] -= 1
    out = {}
    for k, changes in by.items():
        times, n = sorted(changes), 0
        for t, after in zip(times, [*times[1:], None]):
            n += sum(changes[t])
            if n > 0:
                for w in range(t // step_s, (after - 1) // step_s + 1):
                    out[k, w] = max(out.get((k, w), 0), n)
    return out


def run(spark, rows, window, **kwargs):
    at = lambda s: None if s is None else START + timedelta(seconds=s)
    frame = spark.createDataFrame([(k, at(a), at(b)) for k, a, b in rows], SCHEMA).repartition(3)
    found = readtime.concurrency(frame, window, **kwargs).collect()
    base = int(START.timestamp()) // readtime.SECONDS[window]
    out = {(r["solution_id"], int(r["bucket"].replace(tzinfo=None if r["bucket"].tzinfo else timezone.utc).timestamp()) // readtime.SECONDS[window] - base): r["value"] for r in found}
    assert len(out) == len(found)
    return out


@pytest.mark.parametrize("seed", range(2))
@pytest.mark.parametrize("most", [3, 100_000])
def test_most_open_at_once_equals_a_sweep(spark, seed, most, monkeypatch):
    monkeypatch.setattr(readtime, "BLOCK", 4)
    monkeypatch.setattr(readtime, "HOT_WINDOWS", 10**9)
    rng = random.Random(seed)
    rows = []
    for _ in range(500):
        a = rng.choice([rng.randint(0, 9000), rng.randint(0, 9000) // 300 * 300, 4000 + rng.randint(0, 20)])
        rows.append((rng.choice(["a", "a", "a", "b", None]), a, a + rng.choice([-5, 0, 1, 10, 300, 600, rng.randint(1, 5000)])))
    rows += [("a", None, 5), ("a", 5, None), ("c", 0, 300), ("c", 300, 600), ("c", 1500, 1501), rows[0]]
    assert run(spark, rows, "5m", slice_rows=most) == brute(rows, 300)


def test_a_span_of_a_year(spark):
    rows = [("a", 0, 365 * 86_400), ("a", 100, 200), ("b", 5, 6)]
    got = run(spark, rows, "1h")
    assert got == brute(rows, 3600) and len(got) == 365 * 24 + 1


def test_no_spans(spark):
    assert run(spark, [], "1h") == {} and run(spark, [("a", 5, 5)], "1h") == {}
