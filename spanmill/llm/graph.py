"""Connected components of links between keys, by alternating large-star and small-star rounds.

Cases: links with a null end link nothing and are left out; a key linked to itself only is left out;
repeated links count once; keys may be of any type that can be ordered; an empty table of links gives
an empty result; extra columns are ignored. Rounds that don't suffice are an error.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize


def _stars(pairs: DataFrame, larger_only: bool) -> DataFrame:
    """Each neighbour v of u linked to the least of u and its neighbours. pairs: (u, v)."""
    least = pairs.groupBy("u").agg(F.min("v").alias("_m")).select("u", F.least("u", "_m").alias("_m"))
    joined = pairs.join(least, "u")
    if larger_only:
        return joined.where(F.col("v") > F.col("u")).select(F.col("v").alias("a"), F.col("_m").alias("b"))
    near = joined.select(F.col("v").alias("a"), F.col("_m").alias("b"))
    return near.unionAll(least.select(F.col("u").alias("a"), F.col("_m").alias("b")))


#: Below so many links a round runs in one task, without a shuffle; that is some 30 MB.
SMALL_LINKS = 500_000


def components(links: DataFrame, most_rounds: int = 30) -> DataFrame:
    """(key, root) for every key in a link (a, b); root is the least key of its component. An error if most_rounds don't suffice."""
    edges = materialize(links.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    small, state = edges.count() <= SMALL_LINKS, None
    for _ in range(most_rounds):
        edges = edges.coalesce(1) if small else edges
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionAll(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
        large = _stars(both, True).where(F.col("a") != F.col("b")).distinct()
        near = _stars(large.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")), False)
        edges = materialize(near.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "stars")
        now = edges.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.lit(0))).first()
        if now == state:
            break
        state = now
    else:
        raise RuntimeError(f"components have not converged after {most_rounds} rounds")
    return edges.select(F.col("a").alias("key"), F.col("b").alias("root")).unionAll(edges.select(F.col("b").alias("key"), F.col("b").alias("root")).distinct())
