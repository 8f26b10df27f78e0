"""Coarser states kept beside the base ones, brought up to date by the hours that changed.

A tier is a ledger per window and lens, a part per day. refresh() looks at the base's parts that came since
its last call (late batches and replays among them; merging parts makes none new), takes the hours that they
touch, and merges only those hours anew; the other hours of a day are copied. Its one commit names the new
parts and how far the base was read, so a refresh that stops anywhere is repeated and counts nothing twice.

The base may be dropped earlier than the tier (worker.retain): for hours that the base no longer holds in
full, new states are merged with the tier's own instead. A replay of a batch of such an hour is then counted
twice, so the base must be kept for as long as batches may be replayed.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanmill.operators.rollup import SECONDS, bucket, merge
from spanmill.sources.ledger import Part, Version
from spanmill.streaming.worker import ledger, lenses_of, schema_of


def tier_name(window: str) -> str:
    return f"tier-{window}"


def _news(base: Version, seen: int) -> list[Part]:
    return [p for p in base.parts if p.facts["since"] > seen]


def _changed(spark: SparkSession, out: str, lens: str, window: str, base: Version, tier: Version) -> tuple[DataFrame, list[Part]] | None:
    """(bucket, whole) for each bucket of the tier that the base's new parts touch, whole telling whether the base still holds all of it; and these parts."""
    seen = tier.facts.get("base", 0)
    news = _news(base, seen)
    if not news:
        return None
    touched = ledger(spark, out, "states", lens).read(schema_of(base), parts=news).select(bucket("bucket", window).alias("bucket"))
    replaced = [p.facts["replaced"] for p in news if p.facts["replaced"]]
    if replaced and tier.number:  # hours of earlier attempts, which the new ones may not touch
        near = [p for p in tier.parts if p.path and any(p.facts["extent"][0] <= b and a - SECONDS[window] < p.facts["extent"][1] for a, b in replaced)]
        at = F.unix_seconds("bucket")
        inside = F.lit(False)
        for a, b in replaced:
            inside = inside | ((at > a - SECONDS[window]) & (at <= b))
        touched = touched.unionAll(ledger(spark, out, tier_name(window), lens).read(schema_of(tier), parts=near).where(inside).select("bucket"))
    complete = F.unix_seconds("bucket") >= F.lit(base.facts.get("complete_from", -(2**60)))
    return touched.distinct().withColumn("whole", complete), news


def _merged(spark: SparkSession, out: str, lens: str, window: str, base: Version, tier: Version, changed: DataFrame, news: list[Part]) -> DataFrame:
    """States of the changed buckets."""
    states, own = ledger(spark, out, "states", lens), ledger(spark, out, tier_name(window), lens)
    schema = schema_of(base)
    at = bucket("bucket", window)
    of = lambda rows, whole: rows.withColumn("bucket", at).join(changed.where("whole" if whole else "not whole").select("bucket"), "bucket", "left_semi").select(*schema.names)
    parts = of(states.read(schema, base), True).unionAll(of(states.read(schema, parts=news), False))
    if tier.number and "complete_from" in base.facts:
        parts = parts.unionAll(of(own.read(schema, tier), False))
    return merge(parts)


def refresh(spark: SparkSession, out: str, lens: str, window: str = "1h") -> int:
    """Bring a lens's tier up to date; how many of its buckets were merged anew."""
    states, own = ledger(spark, out, "states", lens), ledger(spark, out, tier_name(window), lens)
    base, tier = states.current(), own.current()
    found = _changed(spark, out, lens, window, base, tier) if base.number else None
    if found is None:
        return 0
    schema = schema_of(base)
    changed = own.frame(own.stage(found[0]), found[0].schema)  # read more than once
    day = F.date_format("bucket", "yyyy-MM-dd")
    days = {r[0] for r in changed.select(day).distinct().collect()}  # a value per day of history
    kept = own.read(schema, parts=[p for p in tier.parts if p.key.removeprefix("day=") in days]).join(changed.select("bucket"), "bucket", "left_anti").select(*schema.names)
    anew = _merged(spark, out, lens, window, base, tier, changed, found[1]).select(*schema.names)
    path = own.stage(anew.unionAll(kept).withColumn("day", day).repartition("day"), partition_by="day")
    per_day = own.spark.read.parquet(f"{own.root}/{path}").groupBy(F.col("day").cast("string").alias("day")).agg(F.unix_seconds(F.min("bucket")).alias("a"), F.unix_seconds(F.max("bucket")).alias("b")).collect()
    fresh = [Part(f"day={r['day']}", f"{path}/day={r['day']}", {"extent": [r["a"], r["b"]], "batches": [[-1, -1]], "replaced": None, "since": tier.number + 1}) for r in per_day]
    count = changed.count()

    def change(now: Version):
        if now.number != tier.number:
            return None
        return (*[p for p in now.parts if p.key.removeprefix("day=") not in days], *fresh), now.facts | {"base": base.number, "schema": json.loads(schema.json())}

    done = own.commit(change)
    if done.facts.get("base") != base.number:
        raise RuntimeError("another refresh of the tier came first")
    return count


def read_tier(spark: SparkSession, out: str, lens: str, window: str = "1h") -> DataFrame:
    """States of a lens at the tier's window: the tier's, and those of buckets that changed since its last refresh merged from the base."""
    states, own = ledger(spark, out, "states", lens), ledger(spark, out, tier_name(window), lens)
    base, tier = states.current(), own.current()
    schema = schema_of(base if base.number else tier)
    found = _changed(spark, out, lens, window, base, tier) if base.number else None
    if found is None:
        return own.read(schema, tier)
    changed, news = found
    kept = own.read(schema, tier).join(changed.select("bucket"), "bucket", "left_anti").select(*schema.names)
    return _merged(spark, out, lens, window, base, tier, changed, news).select(*schema.names).unionAll(kept)


def refresh_all(spark: SparkSession, out: str, window: str = "1h") -> dict[str, int]:
    return {lens: refresh(spark, out, lens, window) for lens in lenses_of(spark, out, "states")}
