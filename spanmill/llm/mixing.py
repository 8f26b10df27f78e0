"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

Every source is a stream of words, its documents in an order fixed by a hash, cut into blocks of equal
length. A source's target in words gives its exact quota of blocks: whole passes over the stream, and
for the rest a draw. In every pass the blocks are permuted anew; the first quota blocks in that order
are taken, so which words the mix takes is drawn block by block. A binary tree over the output shards
splits the vector of quotas by multivariate hypergeometric draws, as a uniform shuffle of all blocks
would, and gives each shard a stretch of every source's draw order, disjoint from the others'. Each
shard is then shuffled locally, by a hash of what was drawn.

The last block drawn is cut so that a source's words meet its target to the word. Windows run within
buckets of the hash order, which hold all sources in proportion; a source's buckets are summed first.

Cases: null text has size 0; null source is a source of its own, the last; a source without words
has target 0; repeated rows are rows of their own; rows with equal hash order by id and size; rows
equal in id and text share a bucket, null ids don't; empty tables give an empty result; extra columns
are kept by mixed_documents, whatever their names, and ignored by plan_mix and mix.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import WORD, materialize, read, unnested

#: A document is taken at most so many times.
MOST_REPEATS = 3


def targets(sizes: list[int], weights: list[float], most: float = MOST_REPEATS) -> list[float]:
    """Share sum(sizes) by weight; what lies above most times a size is shared anew by weight."""
    out, free, rest = [0.0] * len(sizes), {k for k, s in enumerate(sizes) if s > 0}, float(sum(sizes))
    while free:
        unit = rest / sum(weights[k] for k in free)
        above = {k for k in free if unit * weights[k] > most * sizes[k]}
        for k in above or free:
            out[k] = float(most * sizes[k]) if above else unit * weights[k]
        rest -= sum(out[k] for k in above)
        free = free - above if above else set()
    return out


def split_quotas(quotas: list[int], n_shards: int, seed: int) -> np.ndarray:
    """Blocks of each source for each shard: an array (n_shards, sources) whose columns sum to quotas.

    Node (low, high) of the tree splits its quotas between its halves; each node has a generator of
    its own, so a rerun gives the same draws.
    """
    out = np.zeros((n_shards, len(quotas)), dtype=np.int64)
    todo = [(0, n_shards, np.array(quotas, dtype=np.int64))]
    while todo:
        low, high, own = todo.pop()
        if high - low == 1:
            out[low] = own
            continue
        middle = (low + high) // 2
        n = int(own.sum()) * (middle - low) // (high - low)
        left = np.random.Generator(np.random.PCG64([seed, low, high])).multivariate_hypergeometric(own, n, method="marginals") if len(own) else own
        todo += [(low, middle, left), (middle, high, own - left)]
    return out


def _stride(n: int, seed: int, epoch: int) -> tuple[int, int]:
    """(a, b) such that k -> (a * k + b) mod n permutes 0..n-1."""
    rng = np.random.Generator(np.random.PCG64([seed, n, epoch]))
    a = int(rng.integers(1, max(2, n)))
    while math.gcd(a, n) != 1:
        a += 1
    return a, int(rng.integers(0, max(1, n)))


def draw(size: int, words: int, block: int, strides: list[tuple[int, int]]) -> tuple[int, int, int]:
    """(blocks a pass, blocks taken, words of the last one taken) for a source of size words that gives words of them.

    The one short block of a pass, its last, counts where its permuted place comes.
    """
    n = -(-size // block)
    if not words:
        return n, 0, 0
    passes, rest = divmod(words, size)
    if not rest:
        return n, passes * n, block
    a, b = strides[passes]
    short, place = block - (size - (n - 1) * block), (a * (n - 1) + b) % n
    taken = -(-rest // block)
    if place < taken:
        taken = -(-(rest + short) // block)
    before = (taken - 1) * block - (short if place < taken - 1 else 0)
    return n, passes * n + taken, rest - before


PIECES = "array<struct<shard:int,epoch:int,block:bigint,start:bigint,length:bigint>>"


def _planned(
    docs: DataFrame,
    keep: list[str],
    weights: tuple[float, ...] = (1.0, 2.0, 3.0),
    *,
    n_shards: int = 8,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    block_words: int = 4096,
    least_block: int = 64,
    blocks_per_shard: int = 64,
    bucket_rows: int = 2000,
    max_sources: int = 100_000,
    max_blocks: int = 300_000_000,
    seed: int = 11,
) -> DataFrame:
    """_row (the columns keep of docs), size, source_size, target, pieces: one row per document.

    The sources, in order of code points with null last, weigh as weights says, repeated as needed. A
    source's blocks are block_words long, or shorter where it has less than blocks_per_shard of them
    per shard, and longer where all sources would have over max_blocks. The driver holds a row per
    source (an error above max_sources).
    """
    spark = docs.sparkSession
    col = lambda c: F.col(f"`{c}`")
    size = F.coalesce(F.regexp_count(col(text_col), F.lit(WORD)), F.lit(0)).cast("long")
    sized = materialize(docs.select(
        F.struct(*[col(c) for c in keep]).alias("_row"), col(source_col).alias("_source"), col(id_col).alias("_id"), size.alias("size"), F.xxhash64(col(id_col), col(text_col), F.lit(seed)).alias("_order")
    ), "mix-sizes")
    found = sized.groupBy("_source").agg(F.sum("size"), F.count("*")).orderBy(F.col("_source").asc_nulls_last()).limit(max_sources + 1).collect()
    if len(found) > max_sources:
        raise ValueError(f"over {max_sources} sources")
    sizes = [int(r[1]) for r in found]
    goal = targets(sizes, [weights[k % len(weights)] for k in range(len(found))])
    longest = max(block_words, -(-MOST_REPEATS * sum(sizes) // max_blocks))
    meta, quotas = [], []
    for k, r in enumerate(found):
        block = max(least_block, min(longest, sizes[k] // (blocks_per_shard * n_shards)), -(-MOST_REPEATS * sum(sizes) // max_blocks))
        n = -(-sizes[k] // block)
        strides = [_stride(n, seed + k, e) for e in range(MOST_REPEATS)]
        n, quota, last = draw(sizes[k], min(MOST_REPEATS * sizes[k], math.floor(goal[k] + 0.5)), block, strides)
        quotas.append(quota)
        meta.append([r[0], k, sizes[k], float(goal[k]), block, n, quota, last, [a for a, _ in strides], [b for _, b in strides]])
    shards = np.cumsum(split_quotas(quotas, n_shards, seed), axis=0)
    kind = sized.schema["_source"].dataType.simpleString()
    sources = spark.createDataFrame(
        [(*m, [int(x) for x in shards[:, k]]) for k, m in enumerate(meta)],
        f"_name {kind}, _sid int, source_size long, target double, _len long, _n long, _quota long, _last long, _a array<long>, _b array<long>, _ends array<long>",
    )
    buckets = max(1, -(-sum(int(r[2]) for r in found) // bucket_rows))
    dealt = sized.join(F.broadcast(sources.select("_name", "_sid")), F.col("_source").eqNullSafe(F.col("_name"))).withColumn("_bucket", F.pmod("_order", F.lit(buckets)))
    sums = dealt.groupBy("_sid", "_bucket").agg(F.sum("size").alias("_in"))
    before = sums.select("_sid", "_bucket", (F.sum("_in").over(Window.partitionBy("_sid").orderBy("_bucket")) - F.col("_in")).alias("_before"))
    in_bucket = Window.partitionBy("_bucket", "_sid").orderBy("_order", "_id", "size").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    by_bucket = before.groupBy("_bucket").agg(F.map_from_entries(F.collect_list(F.struct("_sid", "_before"))).alias("_befores"))
    at = (
        dealt.repartition("_bucket").withColumn("_end", F.sum("size").over(in_bucket))
        .join(by_bucket, "_bucket")
        .withColumn("_at", F.element_at("_befores", F.col("_sid")) + F.col("_end") - F.col("size"))
        .drop("_befores")
        .join(F.broadcast(sources.drop("_name")), "_sid")
    )
    # Blocks of each pass that the document lies in, with their place in the draw order; those within the quota are taken.
    pieces = F.expr(f"""
        if(size = 0, cast(array() as {PIECES}), filter(transform(
            filter(flatten(transform(sequence(0, {MOST_REPEATS - 1}), e -> transform(sequence(_at div _len, (_at + size - 1) div _len), k ->
                named_struct('e', e, 'k', k, 'place', e * _n + pmod(_a[e] * k + _b[e], _n))))), x -> x.place < _quota),
            x -> named_struct('shard', cast(size(filter(_ends, y -> y <= x.place)) as int), 'epoch', x.e, 'block', x.k,
                'start', greatest(x.k * _len, _at) - _at,
                'length', least(x.k * _len + if(x.place = _quota - 1, _last, _len), _at + size) - greatest(x.k * _len, _at))), p -> p.length > 0))
    """)
    return at.withColumn("pieces", pieces).select("_row", "size", "source_size", "target", "pieces")


def plan_mix(docs: DataFrame, weights: tuple[float, ...] = (1.0, 2.0, 3.0), *, id_col: str = "doc_id", source_col: str = "source", **options) -> DataFrame:
    """One row per document: id_col, source_col, size, source_size, target, and pieces, an array of
    (shard, epoch, block, start, length): which words of the document each shard draws, in which pass."""
    plan = _planned(docs, [id_col, source_col], weights, id_col=id_col, source_col=source_col, **options)
    return plan.select(f"_row.`{id_col}`", f"_row.`{source_col}`", "size", "source_size", "target", "pieces")


def _shuffle_key(seed: int, *more: str):
    return F.xxhash64(F.lit(seed), *more)


def mix(docs: DataFrame, *, seed: int = 11, id_col: str = "doc_id", **options) -> DataFrame:
    """The mix itself: one row per piece, with shard, epoch, block, start, length, and shuffle_key,
    by which each shard is sorted when it is written (see write_mix)."""
    plan = plan_mix(docs, seed=seed, id_col=id_col, **options)
    out = plan.select(*[f"`{c}`" for c in plan.columns if c != "pieces"], F.explode("pieces").alias("_p")).select("*", "_p.*").drop("_p")
    return out.withColumn("shuffle_key", _shuffle_key(seed, "shard", "epoch", "block", f"`{id_col}`", "start"))


def write_mix(mixed: DataFrame, path: str, files_per_shard: int = 16) -> None:
    """Write the pieces by shard, each file in shuffled order; hot shards spread over files_per_shard tasks."""
    salted = mixed.withColumn("_file", F.pmod("shuffle_key", F.lit(files_per_shard)))
    salted.repartition("shard", "_file").sortWithinPartitions("shard", "_file", "shuffle_key").drop("_file").write.partitionBy("shard").parquet(path)


def mixed_documents(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", chars_col: str = "n_chars", seed: int = 11, **options) -> DataFrame:
    """docs as the mix draws them, with the columns of docs: a row for each piece of a document.

    A document that lies within one block stays whole, once for each pass that draws it. One that
    blocks cut has a row for each drawn part, its words with the white space after each. Rows stand
    by shard and within it in shuffled order, in every partition, which holds all sources in proportion.
    """
    plan = _planned(docs, docs.columns, id_col=id_col, text_col=text_col, seed=seed, **options)
    rows = plan.select("_row", "size", F.explode_outer("pieces").alias("_p")).where("_p is not null")  # explode would evaluate pieces twice
    text = F.col(f"_row.`{text_col}`")
    words = F.regexp_extract_all(text, F.lit(WORD + r"[\x20\x09-\x0D]*"), F.lit(0))
    cut = F.array_join(F.slice(words, (F.col("_p.start") + 1).cast("int"), F.col("_p.length").cast("int")), "")
    partly = F.col("_p.length") < F.col("size")
    own = rows.withColumn("_text", F.when(partly, cut).otherwise(text))
    own = own.sortWithinPartitions("_p.shard", _shuffle_key(seed, "_p.epoch", "_p.block", f"_row.`{id_col}`", "_p.start"))
    changed = {text_col: F.col("_text")}
    if chars_col in docs.columns:
        changed[chars_col] = F.when(partly, F.length("_text").cast(docs.schema[chars_col].dataType)).otherwise(F.col(f"_row.`{chars_col}`"))
    return unnested(own, **changed)


def op5_hypergeometric_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = plan_mix(read(spark, sf_dir, "documents"))
    taken = F.aggregate("pieces", F.lit(0).cast("long"), lambda total, p: total + p["length"])
    drawn = F.array_join(F.transform("pieces", lambda p: F.concat_ws(":", p["shard"], p["epoch"], p["block"], p["start"], p["length"])), ",")
    return plan.select("doc_id", "size", "source_size", "target", taken.alias("taken"), drawn.alias("drawn"))
