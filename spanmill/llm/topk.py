"""Exact top-k inner products in three phases with a uniform threshold.

The components are dealt to n_lists lists; a row's local score in a list is its partial inner
product there.
1. Every task gathers, per query and list, the k rows of highest local score, and looks up their
   other local scores. The k-th best complete score of a query, over all tasks, bounds its result
   from below.
2. That bound is the cutoff, and is broadcast. A row whose total reaches it must reach
   cutoff / n_lists in some list, so each task collects just the entries that do, list by list. A
   local score that is no entry lies below its share: so the known scores of a row, and the share
   for each unknown one, bound its total from above, and rows whose bound falls short are dropped.
3. The unknown local scores of the rows left are looked up, one by one, and what reaches the cutoff
   is ranked; a task hands on its k best per query, which is enough for the k best of all.
No total is ever computed for a pair that is neither in a local list nor an entry. In a list, rows
whose norm is too small to reach any query's share there are passed over before any product.

Queries go in blocks of block_queries on average (dealt by a hash of the id, so that sizes vary
little), each of which passes over all rows: what is broadcast is one block, whatever the input, and
it is dropped when the block's results are written. Within a task, a block is worked off in tiles of
bounded size. All arithmetic is on integers: in single precision where norms prove every partial sum
below 2^24, in double precision below 2^53, else in 64-bit integers.

Cases: vectors that are null, empty, or hold null or non-finite components take no part; vectors
of another length than the query's block are not compared (each length is searched by itself);
ties go to the smaller id; a repeated query id is asked once, with its smallest vector, and rows
that bear the query's id are its own and no candidates; other repeated rows are candidates each on
its own; rows without an id take no part; vectors so long that a score could leave 64 bits are an error;
empty tables give an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import materialize, read, table_path

_FOUND = "query_id long, vec_id long, score long"
#: Local scores that are held at a time.
TILE = 4_000_000
_NONE = -(2.0**62)


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """The rows of a list column as 64-bit integers; all have the given width."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, width)


def best(queries: np.ndarray, ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The k best (score down, id up) of each query, given parallel arrays."""
    order = np.lexsort((ids, -scores, queries))
    q = queries[order]
    rank = np.arange(len(q)) - np.searchsorted(q, q, "left")
    order = order[rank < k]
    return queries[order], ids[order], scores[order]


class Lists:
    """Queries and rows as n_lists lists of local scores."""

    def __init__(self, queries: np.ndarray, rows: np.ndarray, n_lists: int):
        width = queries.shape[1]
        cuts = np.linspace(0, width, min(n_lists, width) + 1).astype(int)
        norm = lambda x: np.sqrt((x.astype(np.float64) ** 2).sum(axis=1))
        most = norm(queries).max(initial=0.0) * norm(rows).max(initial=0.0)
        kind = np.float32 if most < 2**24 else np.float64 if most < 2**53 else np.int64
        self.queries = [np.ascontiguousarray(queries[:, a:b]).astype(kind) for a, b in zip(cuts, cuts[1:])]
        self.rows = [np.ascontiguousarray(rows[:, a:b]).astype(kind) for a, b in zip(cuts, cuts[1:])]
        self.q_norms, self.r_norms = [norm(x) for x in self.queries], [norm(x) for x in self.rows]
        self.looked_up = 0

    def __len__(self) -> int:
        return len(self.queries)

    def scores(self, j: int, at: np.ndarray | slice = slice(None)) -> np.ndarray:
        """Local scores in list j of all queries with the rows at."""
        return self.queries[j] @ self.rows[j][at].T

    def look_up(self, j: int, qs: np.ndarray, rs: np.ndarray) -> np.ndarray:
        """Single local scores in list j, of pairs of a query and a row."""
        self.looked_up += len(qs)
        kind, out = self.queries[j].dtype, np.empty(len(qs), np.int64)
        for a in range(0, len(qs), 200_000):
            q, r = qs[a : a + 200_000], rs[a : a + 200_000]
            out[a : a + 200_000] = np.einsum("ij,ij->i", self.queries[j][q], self.rows[j][r], dtype=kind)
        return out

    def totals(self, qs: np.ndarray, rs: np.ndarray) -> np.ndarray:
        return sum((self.look_up(j, qs, rs) for j in range(len(self))), np.zeros(len(qs), np.int64))


def local_lists(lists: Lists, own: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Phase 1: (query, row) of the k highest local scores of each query in any list, without those marked own."""
    n = own.shape[1]
    found = []
    for j in range(len(lists)):
        part = lists.scores(j).astype(np.float64)
        part[own] = -np.inf
        at = np.argpartition(-part, min(k, n) - 1, axis=1)[:, : min(k, n)]
        found.append((np.repeat(np.arange(len(part)), at.shape[1]) * n + at.ravel()))
    pairs = np.unique(np.concatenate(found))
    qs, rs = pairs // n, pairs % n
    fair = ~own[qs, rs]
    return qs[fair], rs[fair]


def entries(lists: Lists, own: np.ndarray, cutoffs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Phases 2 and 3: (query, row, total) of all pairs that reach their query's cutoff, or fall short by rounding only."""
    n, m = own.shape[1], len(lists)
    cutoffs = cutoffs - 1e-9 * np.abs(cutoffs) - 1e-6  # a lower cutoff is as safe, and rounding can't raise it
    share = cutoffs / m
    known: list[tuple[np.ndarray, np.ndarray]] = []
    for j in range(m):
        # |q| |r| bounds the local score: a row below every query's share / |q| can't be an entry here.
        least = np.where(share <= 0, -np.inf, share / np.maximum(lists.q_norms[j], 1e-9)).min() * (1 - 1e-6)
        rows = np.flatnonzero(lists.r_norms[j] >= least)
        part = lists.scores(j, rows if len(rows) < n else slice(None))
        qs, at = np.nonzero(part >= share[:, None])
        fair = ~own[qs, rows[at]]
        qs, at = qs[fair], at[fair]
        known.append((qs * n + rows[at], part[qs, at].astype(np.int64)))
    pairs = np.unique(np.concatenate([p for p, _ in known]))
    qs, rs = pairs // n, pairs % n
    score, bound, seen = np.zeros(len(pairs), np.int64), np.zeros(len(pairs)), np.zeros((m, len(pairs)), bool)
    for j, (p, s) in enumerate(known):
        at = np.searchsorted(pairs, p)
        score[at] += s
        seen[j, at] = True
        bound += np.where(seen[j], 0.0, share[qs])
    left = np.flatnonzero(score + bound >= cutoffs[qs])
    qs, rs, score, seen = qs[left], rs[left], score[left], seen[:, left]
    for j in range(m):
        at = np.flatnonzero(~seen[j])
        score[at] += lists.look_up(j, qs[at], rs[at])
    fine = score >= cutoffs[qs]
    return qs[fine], rs[fine], score[fine]


def _phase(shared, n_lists: int, k: int):
    """Phase 1 if the block has no cutoffs, else phases 2 and 3, over one partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        q_ids, queries, cutoffs = shared.value
        kept = [np.zeros(0, np.int64)] * 3
        tile = min(len(q_ids), 4096)
        for batch in batches:
            all_ids = batch.column("vec_id").to_numpy(zero_copy_only=False)
            all_x = _matrix(batch.column("v"), queries.shape[1])
            step = max(1, TILE // tile)
            for a in range(0, len(all_ids), step):
                ids, x, new = all_ids[a : a + step], all_x[a : a + step], [kept]
                for b in range(0, len(q_ids), tile):
                    here, lists = q_ids[b : b + tile], Lists(queries[b : b + tile], x, n_lists)
                    own = here[:, None] == ids[None, :]
                    if cutoffs is None:
                        qs, rs = local_lists(lists, own, k)
                        scores = lists.totals(qs, rs)
                    else:
                        qs, rs, scores = entries(lists, own, cutoffs[b : b + tile])
                    new.append([here[qs], ids[rs], scores])
                kept = list(best(*(np.concatenate(z) for z in zip(*new)), k))
        if len(kept[0]):
            yield pa.RecordBatch.from_arrays([pa.array(z.astype(np.int64)) for z in kept], names=["query_id", "vec_id", "score"])

    return run


def quantized(vectors: DataFrame, id_col: str, vec_col: str, scale: int) -> DataFrame:
    """(vec_id, v): floor(scale * x) of each component as long, of the vectors that take part."""
    clean = F.col(vec_col).isNotNull() & F.col(id_col).isNotNull() & (F.size(vec_col) > 0) & F.forall(
        vec_col, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    )
    return vectors.where(clean).select(
        F.col(id_col).cast("long").alias("vec_id"), F.transform(vec_col, lambda x: F.floor(x.cast("double") * F.lit(float(scale)))).alias("v")
    )


def top_k(
    vectors: DataFrame, *, k: int = 5, every: int = 50, scale: int = 256, n_lists: int = 2, block_queries: int = 32_768,
    id_col: str = "vec_id", vec_col: str = "embedding",
) -> DataFrame:
    """query_id, rank, vec_id, score: for each row whose id is divisible by every, its k best others."""
    spark = vectors.sparkSession
    rows = materialize(quantized(vectors, id_col, vec_col, scale).withColumn("width", F.size("v")), "topk-vectors")
    asked = materialize(
        rows.where(F.col("vec_id") % every == 0).groupBy("vec_id").agg(F.min("v").alias("v")).withColumn("width", F.size("v")), "topk-queries"
    )
    # the two longest vectors bound every score of two rows
    squares = F.aggregate("v", F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double"))
    longest = [r[0] for r in rows.select(squares.alias("s")).orderBy(F.desc("s")).limit(2).collect()]
    if len(longest) == 2 and (longest[0] ** 0.5) * (longest[1] ** 0.5) >= 0.999999 * 2.0**63:
        raise ValueError("scores could leave 64 bits: vectors are too long")
    path = table_path(spark, "topk-found")
    rows.limit(0).select(F.col("vec_id").alias("query_id"), "vec_id", F.lit(0).cast("long").alias("score")).write.parquet(path)
    for width, n in sorted(asked.groupBy("width").count().collect()):
        there, n_blocks = rows.where(F.col("width") == width).select("vec_id", "v"), -(-n // block_queries)
        for b in range(n_blocks):
            got = asked.where((F.col("width") == width) & (F.pmod(F.xxhash64("vec_id"), F.lit(n_blocks)) == b)).select("vec_id", "v").orderBy("vec_id").toArrow()
            if not got.num_rows:
                continue
            q_ids = got.column("vec_id").to_numpy().astype(np.int64)
            queries = _matrix(got.column("v").combine_chunks(), width)
            block = spark.sparkContext.broadcast((q_ids, queries, None))
            ranked = there.mapInArrow(_phase(block, n_lists, k), _FOUND).withColumn("n", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")))
            cut = dict(ranked.where(F.col("n") == k).select("query_id", "score").collect())
            block.destroy()
            cutoffs = np.array([cut.get(int(q), _NONE) for q in q_ids], dtype=np.float64)
            block = spark.sparkContext.broadcast((q_ids, queries, cutoffs))
            there.mapInArrow(_phase(block, n_lists, k), _FOUND).write.mode("append").parquet(path)
            block.destroy()
    found = spark.read.schema(_FOUND).parquet(path)
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank.cast("int")).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op10_uniform_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(read(spark, sf_dir, "embeddings"))


OP10_SQL = """
WITH clean AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM clean q JOIN clean c ON q.vec_id <> c.vec_id
  WHERE q.vec_id % 50 = 0
), ranked AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""
