"""Whitening of vectors by their leading principal components, found by LOBPCG.

Entries become integers, so that the mean is removed exactly: n * x - S, with S the sums per dimension.
The covariance is never formed. Each round multiplies it with a block of directions in one pass
over the centred rows (a partial block per task, added up by dimension in a shuffle), and a Rayleigh-Ritz step on
the iterate, the residual and the previous directions, kept orthonormal, gives the next iterate. The block is some
directions wider than the components asked for. When residuals no longer fall, the products of the
iterate are computed afresh and certify each component: |V x - e x| <= tolerance * e1, or an error.
The driver holds blocks of dimensions x directions, never rows.

Cases: vectors that are null or empty or hold null or non-finite entries are left out; so are those whose length is
not the most frequent one (of two equally frequent ones the longer stays); null ids and repeated rows are
rows of their own; components without variance (below 1e-12 of the trace) are left out, so equal vectors
or a single one give an empty result, as an empty table does; entries so large that n * x leaves 64
bits are an error; extra columns are ignored. Eigenvectors of equal eigenvalues are any basis of their space.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialize, read

#: Entries of centred rows that a task holds at a time.
CHUNK = 1 << 20


def _rows(batch, width: int) -> Iterator[np.ndarray]:
    """The vectors of a column of lists as integer matrices of bounded size."""
    column = batch.column("x")
    whole = column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width)
    step = max(1, CHUNK // width)
    for k in range(0, len(whole), step):
        yield whole[k : k + step]


def _added(table: DataFrame, part, columns: int) -> np.ndarray:
    """The sum over tasks of their partial matrices: part maps a task's batches to one matrix of so many columns."""
    import pyarrow as pa

    names = [f"c{k}" for k in range(columns)]

    def run(batches):
        own = part(batches)
        if own is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(own), dtype=np.int32)), *[pa.array(own[:, k]) for k in range(columns)]], ["i", *names])

    kind = "long" if part.whole else "double"
    found = table.mapInArrow(run, "i int, " + ", ".join(f"{c} {kind}" for c in names)).groupBy("i").agg(*[F.sum(c).alias(c) for c in names]).orderBy("i").collect()
    return np.array([list(r)[1:] for r in found], dtype=np.int64 if part.whole else np.float64)


def sums_of(table: DataFrame, width: int) -> np.ndarray:
    def part(batches):
        out = None
        for batch in batches:
            for x in _rows(batch, width):
                own = x.sum(axis=0, dtype=np.int64)
                out = own if out is None else out + own
        return None if out is None else out[:, None]

    part.whole = True
    return _added(table.select("x"), part, 1)[:, 0]


class Covariance:
    """Products of the covariance of a table of integer vectors x with blocks of directions."""

    def __init__(self, table: DataFrame, n: int, sums: np.ndarray):
        self.table, self.n, self.sums, self.width, self.passes = table.select("x"), n, sums, len(sums), 0
        self.trace = float(self._pass(np.zeros((self.width, 0)))[:, 0].sum()) / n

    def _pass(self, block: np.ndarray) -> np.ndarray:
        """Sums of squares per dimension, beside the product: both times n."""
        n, sums, width = self.n, self.sums, self.width
        self.passes += 1

        def part(batches):
            out = None
            for batch in batches:
                for x in _rows(batch, width):
                    own = (n * x - sums) / n
                    both = np.concatenate([(own * own).sum(axis=0)[:, None], own.T @ (own @ block)], axis=1)
                    out = both if out is None else out + both
            return out

        part.whole = False
        return _added(self.table, part, 1 + block.shape[1])

    def __matmul__(self, block: np.ndarray) -> np.ndarray:
        return self._pass(block)[:, 1:] / self.n


def _orthonormal(block: np.ndarray, against: np.ndarray | None = None, least: float = 1e-9) -> np.ndarray:
    """An orthonormal basis of block's columns, beside those of an orthonormal basis; directions that are as good as in it are dropped."""
    norms = np.linalg.norm(block, axis=0)
    out = block[:, norms > 0] / norms[norms > 0]
    for _ in range(2):
        if against is not None:
            out = out - against @ (against.T @ out)
        u, s, _v = np.linalg.svd(out, full_matrices=False)
        out = u[:, s > least]
    return out


def lobpcg(operator, width: int, components: int, *, guard: int = 8, tolerance: float = 1e-12, most_rounds: int = 500, seed: int = 12) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(eigenvalues, eigenvectors as columns, residuals) of the components largest eigenvalues of a symmetric operator, falling.

    operator @ block is the only use of it. An error if a residual stays above tolerance times the largest eigenvalue.
    """
    k, m = min(components, width), min(components + guard, width)
    x = _orthonormal(np.random.default_rng(seed).standard_normal((width, m)))
    ax, p, ap = operator @ x, np.zeros((width, 0)), np.zeros((width, 0))
    best, since, rounds = np.inf, 0, 0
    while True:
        values, turn = np.linalg.eigh((x.T @ ax + ax.T @ x) / 2)
        order = np.argsort(-values)
        values, x, ax = values[order], x @ turn[:, order], ax @ turn[:, order]
        residual = ax - x * values
        top = max(abs(values[0]), np.finfo(float).tiny)
        worst = np.linalg.norm(residual[:, :k], axis=0).max() / top
        best, since = (worst, 0) if worst < best / 2 else (best, since + 1)
        w = _orthonormal(residual, np.concatenate([x, p], axis=1)) if worst > 2e-15 else x[:, :0]
        if worst <= 1e-14 or w.shape[1] == 0 or (since >= 6 and worst <= tolerance):
            x = _orthonormal(x)
            ax = operator @ x
            values, turn = np.linalg.eigh((x.T @ ax + ax.T @ x) / 2)
            order = np.argsort(-values)
            values, x, ax = values[order], x @ turn[:, order], ax @ turn[:, order]
            certified = np.linalg.norm((ax - x * values)[:, :k], axis=0)
            if certified.max() <= tolerance * max(abs(values[0]), np.finfo(float).tiny):
                return values[:k], x[:, :k], certified
            p, ap, best, since = p[:, :0], ap[:, :0], np.inf, 0
            w = _orthonormal(ax - x * values, x)
        rounds += 1
        if rounds > most_rounds:
            raise RuntimeError(f"residual {worst:.1e} of the largest eigenvalue after {most_rounds} rounds")
        aw = operator @ w
        basis, images = np.concatenate([x, w, p], axis=1), np.concatenate([ax, aw, ap], axis=1)
        small = basis.T @ images
        inner, turn = np.linalg.eigh((small + small.T) / 2)
        chosen = turn[:, np.argsort(-inner)[:m]]
        step = chosen.copy()
        step[:m] = 0  # the new directions: the change without the old iterate's share
        step = _orthonormal(step, chosen)
        x, ax, p, ap = basis @ chosen, images @ chosen, basis @ step, images @ step


def integers(vectors: DataFrame, id_col: str, vector_col: str, scale: int, shift: int) -> tuple[DataFrame, int, int]:
    """(id_col, x) of the vectors that take part, as a table; how many they are, and their length."""
    v = F.col(vector_col)
    sound = v.isNotNull() & (F.size(v) > 0) & ~F.exists(v, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    own = vectors.select(F.col(id_col), v).where(sound)
    often = own.groupBy(F.size(v).alias("width")).agg(F.count("*").alias("n"), F.max(F.array_max(F.transform(v, lambda c: F.abs(c.cast("double"))))).alias("most")).orderBy(F.desc("n"), F.desc("width")).first()
    if often is None:
        return own.select(id_col, F.expr("cast(array() as array<long>)").alias("x")), 0, 0
    if often["n"] * (scale * often["most"] + abs(shift) + 1) >= 2.0**62:
        raise ValueError("entries are too large for exact sums in 64 bits")
    x = F.transform(v, lambda c: F.floor(c.cast("double") * scale) + shift)
    return materialize(own.where(F.size(v) == often["width"]).select(id_col, x.alias("x")), "whitening-integers"), often["n"], often["width"]


def whiten(
    vectors: DataFrame, components: int = 8, *, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 1024, shift: int = 100_000, guard: int = 8, tolerance: float = 1e-12, seed: int = 12
) -> DataFrame:
    """(id_col, n, deviation, whitened, explained, residuals, identity_error) per vector; whitened has a value per component.

    deviation is the exact sum of (n * x - S)^2, as decimal; explained is each component's share of the
    variance, residuals its certificate relative to the largest eigenvalue, identity_error the largest
    absolute entry of the whitened values' covariance minus the identity.
    """
    table, n, width = integers(vectors, id_col, vector_col, scale, shift)
    whitened_type = "n long, deviation decimal(38,0), whitened array<double>"
    none = table.select(id_col, F.lit(0).cast("long").alias("n"), F.lit(0).cast("decimal(38,0)").alias("deviation"), *[F.expr(f"cast(array() as array<double>) as {c}") for c in ("whitened", "explained", "residuals")], F.lit(0.0).alias("identity_error")).where("false")
    if not n:
        return none
    covariance = Covariance(table, n, sums := sums_of(table, width))
    if covariance.trace == 0:
        return none
    values, found, certified = lobpcg(covariance, width, components, guard=guard, tolerance=tolerance, seed=seed)
    kept = values > 1e-12 * covariance.trace
    values, certified = values[kept], certified[kept]
    turn = found[:, kept] / np.sqrt(values)

    def moments(batches):
        out = None
        for batch in batches:
            for x in _rows(batch, width):
                own = ((n * x - sums) / n) @ turn
                both = np.concatenate([own.sum(axis=0)[:, None], own.T @ own], axis=1)
                out = both if out is None else out + both
        return out

    moments.whole = False
    second = _added(table.select("x"), moments, 1 + len(values)) / n
    error = float(np.abs(second[:, 1:] - np.outer(second[:, 0], second[:, 0]) - np.eye(len(values))).max())

    def project(batches):
        import pyarrow as pa

        for batch in batches:
            at = 0
            for x in _rows(batch, width):
                own = n * x - sums
                if float(np.abs(own).max(initial=0)) ** 2 * width < 2.0**62:
                    squares = pa.array((own * own).sum(axis=1)).cast(pa.decimal128(38, 0))
                else:
                    squares = pa.array((own.astype(object) ** 2).sum(axis=1).tolist(), pa.decimal128(38, 0))
                white = (own / n) @ turn
                offsets = pa.array(np.arange(0, white.size + 1, white.shape[1], dtype=np.int32))
                lists = pa.ListArray.from_arrays(offsets, pa.array(white.reshape(-1)))
                yield pa.RecordBatch.from_arrays([batch.column(id_col).slice(at, len(x)), pa.array(np.full(len(x), n)), squares, lists], [id_col, "n", "deviation", "whitened"])
                at += len(x)

    id_type = table.schema[id_col].dataType.simpleString()
    out = table.mapInArrow(project, f"`{id_col}` {id_type}, {whitened_type}")
    fixed = lambda values: F.array(*[F.lit(float(v)) for v in values])
    return out.select("*", fixed(values / covariance.trace).alias("explained"), fixed(certified / values[0]).alias("residuals"), F.lit(error).alias("identity_error"))


def op12_lobpcg_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = whiten(read(spark, sf_dir, "embeddings"), 8).withColumn("deviation", F.col("deviation").cast("long"))
    each = own.select("vec_id", "n", "deviation", "identity_error", F.posexplode(F.arrays_zip("whitened", "explained", "residuals")).alias("_k", "_v"))
    return each.select("vec_id", (F.col("_k") + 1).cast("int").alias("component"), "n", "deviation", F.col("_v.whitened").alias("whitened"), F.col("_v.explained").alias("explained"), "identity_error", F.col("_v.residuals").alias("residual"))
