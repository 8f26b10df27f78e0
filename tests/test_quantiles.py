"""Exact quantiles against numpy's, with brackets so small that many rounds are needed."""

import math
import random

import numpy as np
import pytest

from spanmill.operators.quantiles import exact_quantiles

RANKS = [0.0, 0.01, 0.5, 0.95, 1.0]


def brute(rows):
    by = {}
    for k, v in rows:
        by.setdefault(k, [])
        if v is not None:
            by[k].append(v)
    return {k: (len(v), *[float(np.quantile(v, q)) if v else None for q in RANKS]) for k, v in by.items()}


def close(a, b):
    return a == b or (a is not None and b is not None and (math.isclose(a, b, rel_tol=1e-12, abs_tol=1e-12) or (math.isnan(a) and math.isnan(b))))


def run(spark, rows, tmp_path, most=40, ranks=RANKS):
    data = spark.createDataFrame(rows, "k string, v double").repartition(5)
    return {r["k"]: tuple(r)[1:] for r in exact_quantiles(data, ["k"], "v", ranks, str(tmp_path), most=most).collect()}


@pytest.mark.parametrize("seed", range(2))
def test_quantiles_equal_sorting(spark, tmp_path, seed):
    rng = random.Random(seed)
    draw = {"flat": rng.random, "ties": lambda: float(rng.randint(0, 3)), "two": lambda: float(rng.random() < 0.5), "tail": lambda: math.exp(rng.gauss(0, 6)), "mixed": lambda: 7.0 if rng.random() < 0.7 else rng.gauss(0, 1), "neg": lambda: -rng.random() * 10 ** rng.randint(0, 9)}
    rows = [(k, f()) for k, f in draw.items() for _ in range(3000)] + [("few", 1.0), ("few", 2.5), ("one", 3.0), ("none", None), (None, 4.0), (None, 8.0), ("flat", None), ("same", 5.0)] + [("same", 5.0)] * 500
    got, want = run(spark, rows, tmp_path), brute(rows)
    assert set(got) == set(want)
    for k in want:
        assert all(close(a, b) for a, b in zip(got[k], want[k])), (k, got[k], want[k])


def test_nan_counts_as_greatest_and_no_rows_give_no_keys(spark, tmp_path):
    rows = [("a", float(k)) for k in range(300)] + [("a", math.nan)] * 10
    got = run(spark, rows, tmp_path, ranks=[0.5, 1.0])["a"]
    assert got[0] == 310 and got[1] == 154.5 and math.isnan(got[2])
    assert run(spark, [], tmp_path) == {}
    whole = exact_quantiles(spark.createDataFrame([], "k string, v double"), [], "v", [0.5], str(tmp_path)).collect()
    assert whole == []


def test_no_list_is_longer_than_told(spark, tmp_path, monkeypatch):
    """What is sorted is bounded, whatever the key holds."""
    from pyspark.sql import functions as F

    from spanmill.operators import quantiles

    longest = []
    real = quantiles.kept

    def kept(frame, label, store):
        out = real(frame, label, store)
        if "low" in out.columns and "s" not in out.columns:
            longest.append(out.where(~F.col("low").eqNullSafe(F.col("high"))).agg(F.max("n")).first()[0])
        return out

    monkeypatch.setattr(quantiles, "kept", kept)
    rows = [("a", random.Random(k).random()) for k in range(5000)]
    got = run(spark, rows, tmp_path, most=25)
    assert longest and max(longest) <= 25 and all(close(a, b) for a, b in zip(got["a"], brute(rows)["a"]))


def test_ranks_are_checked(spark, tmp_path):
    with pytest.raises(ValueError):
        run(spark, [], tmp_path, ranks=[1.5])
