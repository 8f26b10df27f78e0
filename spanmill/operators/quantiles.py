"""Exact quantiles per key in constant memory: bracket, count, refine.

A sketch of a key's values gives a bracket that should hold the value at the wanted rank. One pass counts what lies
below the bracket and in it, so it is known whether it does; where not, the next bracket is taken on the side where
the rank lies, so counts decide and the sketch only guides. Brackets shrink by some ten times a round, and from the
first round on only the values in brackets are read again, until a bracket holds MOST values or one
value alone. Then its values are sorted, and the next greater value, which interpolation may need, is
known from the count. No buffer holds more than MOST values of a key, however many are different.

Results equal quantile_cont of SQL: between the values at the ranks below and above (n - 1) * q.

Cases: null values are left out, and keys with no other value get nulls; NaN counts as greater than all else;
null keys are a key; ties cost no more than other values; no rows give no keys, even where by is empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanmill.sources.ledger import kept

#: A bracket of so many values is sorted.
MOST = 32_768
#: Brackets are broadcast below this many, else joined by shuffle, where AQE splits keys with many rows.
BROADCAST_ROWS = 100_000
#: Steps of the grid of quantiles that a sketch gives, and half the width of a bracket in steps: some three times the sketch's error.
STEPS, SLACK = 100, 4


def exact_quantiles(rows: DataFrame, by: list[str], value: str | Column, ranks: list[float], store: str | None = None, *, most: int = MOST, names: list[str] | None = None) -> DataFrame:
    """(by, count, a column per rank) for each key.

    store is a folder that all executors share, by default the session's: brackets, and the values in them, are
    written there, so that no round repeats those before. names are those of the rank columns, q0, q1, ... by default.
    """
    if not all(0 <= q <= 1 for q in ranks):
        raise ValueError("ranks lie between 0 and 1")
    names = names or [f"q{k}" for k in range(len(ranks))]
    keep = lambda frame: kept(frame, "quantiles", store)
    key = F.struct(*[F.col(c) for c in by]) if by else F.struct(F.lit(1))
    data = rows.select(*by, F.sha2(F.to_json(key, {"ignoreNullFields": "false"}), 256).alias("_k") if by else F.lit("").alias("_k"), (F.col(value) if isinstance(value, str) else value).cast("double").alias("_v"))
    totals = keep(data.groupBy(*by, "_k").agg(F.count("_v").alias("_n"), F.min("_v").alias("_low"), F.max("_v").alias("_high"), _grid(F.col("_v")).alias("_s")))
    # a target: the rank r (from 0) of key _k; low and high enclose its value; below lie so many values, in the bracket n
    wanted = F.explode(F.array(*[F.struct(F.lit(k).alias("q"), F.floor((F.col("_n") - 1) * F.lit(float(q))).alias("r")) for k, q in enumerate(ranks)]))
    whole = totals.where("_n > 0").select("_k", "_n", "_low", "_high", "_s", wanted.alias("_w")).select(
        "_k", F.col("_w.q").alias("q"), F.col("_w.r").alias("r"), F.col("_low").alias("low"), F.col("_high").alias("high"), F.lit(0).cast("long").alias("below"), F.col("_n").alias("n"), F.lit(None).cast("double").alias("above"), F.col("_s").alias("s")
    )
    done, state, live = None, keep(whole), data.where("_v is not null").select("_k", "_v")
    for _ in range(60):
        settled = (F.col("n") <= most) | F.col("low").eqNullSafe(F.col("high"))
        ready = state.where(settled).drop("s")
        done = ready if done is None else done.unionAll(ready)
        state = state.where(~settled)
        if state.isEmpty():
            break
        state = keep(_narrowed(live, state))
        live = keep(_within(live, state))
    else:
        raise RuntimeError("brackets do not shrink")
    return _picked(by, data, totals, keep(done), ranks, names)


def _checked(targets: DataFrame) -> DataFrame:
    return F.broadcast(targets) if targets.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else targets


def _grid(value: Column) -> Column:
    """Quantiles of a column by a sketch, in equal steps; null where it has no value."""
    steps = F.array(*[F.lit(k / STEPS) for k in range(STEPS + 1)])
    return F.when(F.count(F.when(value.isNotNull() & ~F.isnan(value), 1)) > 0, F.kll_sketch_get_quantile_double(F.kll_sketch_agg_double(value, F.lit(400)), steps))


def _narrowed(values: DataFrame, state: DataFrame) -> DataFrame:
    """state with narrower brackets: one pass over values, those outside of the brackets included or not."""
    share = (F.col("r") - F.col("below") + 0.5) / F.col("n")
    at = lambda step: F.get("s", F.floor(share * STEPS).cast("int") + step)
    a, b = F.coalesce(F.greatest("low", at(-SLACK)), "low"), F.coalesce(F.least("high", at(SLACK + 1)), "high")
    inner = state.select("*", a.alias("a"), b.alias("b"), F.coalesce(at(0), "low").alias("m"))
    stuck = (F.col("a") <= F.col("low")) & (F.col("b") >= F.col("high"))  # few different values: one of them alone, so that the bracket shrinks
    inner = inner.withColumns({"a": F.when(stuck, F.col("m")).otherwise(F.col("a")), "b": F.when(stuck, F.col("m")).otherwise(F.col("b"))}).drop("s", "m")
    v = F.col("_v")
    met = values.join(_checked(inner.select("_k", "q", "low", "high", "a", "b")), "_k").where((v >= F.col("low")) & (v <= F.col("high")))
    under, over, inside = v < F.col("a"), v > F.col("b"), (v >= F.col("a")) & (v <= F.col("b"))
    side = lambda cond, name: [
        F.count(F.when(cond, 1)).alias(f"{name}_n"), F.min(F.when(cond, v)).alias(f"{name}_low"), F.max(F.when(cond, v)).alias(f"{name}_high"), _grid(F.when(cond, v)).alias(f"{name}_s")
    ]
    counts = met.groupBy("_k", "q").agg(*side(under, "u"), *side(inside, "i"), *side(over, "o"))
    own = inner.select("_k", "q", "r", "below", "above").join(counts, ["_k", "q"])
    r = F.col("r") - F.col("below")
    where = F.when(r < F.col("u_n"), 0).when(r < F.col("u_n") + F.col("i_n"), 1).otherwise(2)
    pick = lambda c: F.when(F.col("w") == 0, F.col(f"u_{c}")).when(F.col("w") == 1, F.col(f"i_{c}")).otherwise(F.col(f"o_{c}"))
    less = F.when(F.col("w") == 0, 0).when(F.col("w") == 1, F.col("u_n")).otherwise(F.col("u_n") + F.col("i_n"))
    # the least value beyond the bracket
    next_up = F.when(F.col("w") == 0, F.coalesce("i_low", "o_low", "above")).when(F.col("w") == 1, F.coalesce("o_low", "above")).otherwise(F.col("above"))
    return own.withColumn("w", where).select("_k", "q", "r", pick("low").alias("low"), pick("high").alias("high"), (F.col("below") + less).cast("long").alias("below"), pick("n").alias("n"), next_up.alias("above"), pick("s").alias("s"))


def _within(values: DataFrame, state: DataFrame) -> DataFrame:
    """Values that a bracket of their key holds, once for each of the key's brackets that are apart."""
    spans = state.groupBy("_k").agg(F.min("low").alias("low"), F.max("high").alias("high"), F.collect_set(F.struct("low", "high")).alias("all"))
    met = values.join(_checked(spans), "_k").where((F.col("_v") >= F.col("low")) & (F.col("_v") <= F.col("high")))
    return met.where(F.exists("all", lambda x: (F.col("_v") >= x["low"]) & (F.col("_v") <= x["high"]))).select("_k", "_v")


def _picked(by: list[str], data: DataFrame, totals: DataFrame, done: DataFrame, ranks: list[float], names: list[str]) -> DataFrame:
    """The values at the ranks of settled brackets, and from them the quantiles."""
    single, v = F.col("low").eqNullSafe(F.col("high")), F.col("_v")
    many = done.where(~single)
    bounds = _checked(many.select("_k", "q", "low", "high"))
    lists = data.select("_k", "_v").join(bounds, "_k").where((v >= F.col("low")) & (v <= F.col("high"))).groupBy("_k", "q").agg(F.array_sort(F.collect_list("_v")).alias("l"))
    place = (F.col("r") - F.col("below")).cast("int")
    sorted_ = many.join(lists, ["_k", "q"]).select("_k", "q", F.get("l", place).alias("v0"), F.coalesce(F.get("l", place + 1), "above").alias("v1"))
    tied = done.where(single).select("_k", "q", F.col("low").alias("v0"), F.when(place + 1 < F.col("n"), F.col("low")).otherwise(F.col("above")).alias("v1"))
    found = sorted_.unionAll(tied).groupBy("_k").agg(*[F.max(F.when(F.col("q") == k, F.col(c))).alias(f"{c}_{k}") for k in range(len(ranks)) for c in ("v0", "v1")])
    out = totals.select(*by, "_k", F.col("_n").alias("count")).join(found, "_k", "left")

    def between(k: int, q: float) -> Column:
        position = (F.col("count") - 1) * F.lit(float(q))
        part, a, b = position - F.floor(position), F.col(f"v0_{k}"), F.col(f"v1_{k}")
        return F.when((part == 0) | (a == b), a).otherwise(a + (b - a) * part)

    return out.select(*by, "count", *[between(k, q).alias(n) for k, (q, n) in enumerate(zip(ranks, names))])
