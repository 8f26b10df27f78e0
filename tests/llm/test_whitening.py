"""LOBPCG and whitening against dense eigenvectors."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from spanmill.llm import whitening

SCHEMA = "vec_id long, embedding array<float>"


class Dense:
    def __init__(self, a):
        self.a, self.passes = a, 0

    def __matmul__(self, block):
        self.passes += 1
        return self.a @ block


def matrix(spectrum, seed=0):
    q, _ = np.linalg.qr(np.random.default_rng(seed).standard_normal((len(spectrum),) * 2))
    a = (q * spectrum) @ q.T
    return (a + a.T) / 2


@pytest.mark.parametrize("spectrum", [np.linspace(1, 2, 64), 2.0 ** -np.arange(64), 1 + np.arange(120) * 1e-4, np.array([5.0, 4, 3] + [0] * 37), np.arange(1.0, 6), np.array([2.0]), 10.0 ** np.linspace(0, 9, 90)])
def test_eigenvectors_equal_dense_ones(spectrum):
    a = matrix(np.asarray(spectrum))
    values, found, certified = whitening.lobpcg(Dense(a), len(spectrum), 8)
    exact, vectors = np.linalg.eigh(a)
    exact, vectors = exact[::-1][:8], vectors[:, ::-1][:, :8]
    assert np.abs(values - exact).max() <= 1e-13 * exact[0] and certified.max() <= 1e-12 * exact[0]
    for k in np.flatnonzero(exact > 1e-9 * exact[0]):
        assert abs(abs(found[:, k] @ vectors[:, k]) - 1) < 1e-9
    assert np.abs(found.T @ found - np.eye(found.shape[1])).max() < 1e-13


def test_equal_eigenvalues_span_their_space():
    a = matrix(np.repeat([4.0, 3, 2, 1], 5), 3)
    values, found, _ = whitening.lobpcg(Dense(a), 20, 8)
    space = np.linalg.eigh(a)[1][:, ::-1][:, :5]
    assert np.allclose(values, [4] * 5 + [3] * 3) and np.allclose(space @ (space.T @ found[:, :5]), found[:, :5])


def test_what_does_not_converge_is_an_error():
    with pytest.raises(RuntimeError):
        whitening.lobpcg(Dense(matrix(np.linspace(1, 2, 200))), 200, 8, most_rounds=3)


def exact(rows, components=8):
    """(n, deviations, covariance's eigenvalues, whitened values) by dense algebra."""
    x = np.array([[math.floor(1024 * float(np.float32(c))) + 100_000 for c in v] for v in rows], dtype=object)
    n, s = len(x), x.sum(axis=0)
    d = n * x - s
    c = d.astype(float) / n
    values, vectors = np.linalg.eigh(c.T @ c / n)
    values, vectors = values[::-1][:components], vectors[:, ::-1][:, :components]
    kept = values > 1e-12 * np.trace(c.T @ c / n)
    return n, (d**2).sum(axis=1), values, c @ vectors[:, kept] / np.sqrt(values[kept])


def odd_vectors(n=300, width=40, seed=2):
    rng = np.random.default_rng(seed)
    rows = rng.standard_normal((n, width)) @ np.diag(np.linspace(0.1, 2, width)) + rng.standard_normal(width)
    rows[n // 3 : 2 * n // 3] = rows[0]  # a third are copies
    return rows.tolist()


def test_whitened_values_equal_dense_ones(spark):
    good = odd_vectors()
    rows = [(k, v) for k, v in enumerate(good)] + [(7, good[7]), (None, good[8]), (900, None), (901, []), (902, [1.0] * 39), (903, [None] * 40), (904, [float("nan")] * 40), (905, [float("inf")] + [0.0] * 39)]
    data = spark.createDataFrame(rows, SCHEMA).withColumns({"x": F.lit("clash"), "n": F.lit(None), "whitened": F.lit(1)})
    out = whitening.whiten(data.repartition(6)).orderBy("vec_id").collect()
    n, deviations, values, white = exact([*good, good[7], good[8]])
    assert len(out) == n == 302 and {r["n"] for r in out} == {n} and max(r["identity_error"] for r in out) < 1e-9
    want = sorted((int(d), tuple(np.round(np.abs(w), 6))) for d, w in zip(deviations, white))
    assert sorted((int(r["deviation"]), tuple(np.round(np.abs(r["whitened"]), 6))) for r in out) == want
    assert np.allclose(out[0]["explained"], values / (np.sum(deviations.astype(float)) / n**3), rtol=1e-9)
    signs = np.sign([r["whitened"] for r in out if r["vec_id"] == 3][0]) * np.sign(white[3])
    assert all(np.allclose(np.array(r["whitened"]) * signs, white[r["vec_id"]], atol=1e-9) for r in out if r["vec_id"] is not None)


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [])], [(1, [1.0, 2.0])], [(1, [1.0]), (2, [1.0])]])
def test_no_variance_gives_no_rows(spark, rows):
    assert whitening.whiten(spark.createDataFrame(rows, SCHEMA)).collect() == []


def test_components_without_variance_are_left_out(spark):
    rng = random.Random(1)
    rows = [(k, [a := rng.random(), 2 * a, 0.5, rng.random()]) for k in range(50)]
    rows = [(k, [float(math.floor(c * 64)) / 64 for c in v]) for k, v in rows]
    rows = [(k, [v[0], 2 * v[0], v[2], v[3]]) for k, v in rows]
    out = whitening.whiten(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {len(r["whitened"]) for r in out} == {2} and max(r["identity_error"] for r in out) < 1e-9


def test_deviations_beyond_64_bits_are_exact_and_sums_beyond_them_an_error(spark):
    rows = [(k, [1e9 * (-1) ** k, float(k)]) for k in range(9)]
    out = {r["vec_id"]: int(r["deviation"]) for r in whitening.whiten(spark.createDataFrame(rows, SCHEMA)).collect()}
    want = exact([v for _, v in rows])[1]
    assert out == {k: int(want[k]) for k in range(9)} and max(out.values()) > 2**63
    with pytest.raises(ValueError):
        whitening.whiten(spark.createDataFrame([(k, [1e18 * (k + 1)]) for k in range(9)], SCHEMA))


def test_query(spark, sf_dir):
    out = whitening.op12_lobpcg_whitening(spark, sf_dir).toPandas()
    data = spark.read.parquet(f"{sf_dir}/embeddings.parquet").toPandas()
    n, deviations, values, white = exact(data["embedding"])
    assert len(out) == 8 * n and set(out["n"]) == {n} and out["identity_error"].max() < 1e-9 and out["residual"].max() < 1e-12
    got = out.pivot(index="vec_id", columns="component", values="whitened").loc[data["vec_id"]].to_numpy()
    signs = np.sign((got * white).sum(axis=0))
    assert np.allclose(got * signs, white, atol=1e-9)
    assert (out[out["component"] == 1].set_index("vec_id")["deviation"].loc[data["vec_id"]].to_numpy() == deviations.astype(np.int64)).all()
