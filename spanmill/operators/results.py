"""Analyses of texts kept by content, so that a text is analysed once however many batches hold it.

A store is a ledger per policy (another policy or pattern gives another folder, never a stale result): parts of
results by the SHA-256 of their text, one per batch that brought new texts, and parts of touches, the
digests that a batch met again. For a batch, texts become one row per digest before anything is shuffled by
it, the store's digests are taken away, and what is left is analysed and committed. Rows get their results by
their digests: those of texts that a batch holds very often, of which there are at most HOT_TEXTS, are
broadcast, and rows that have theirs are spread over all tasks for the join of the others.

A batch that stops before its commit leaves nothing behind; one that is repeated finds its own results. Two writers may
both analyse a text that is new to both: results are equal, and either is taken. evict() keeps a bounded number of texts,
those met last.

Cases: null and empty texts have no detections and aren't stored; repeated rows stay rows; an empty batch commits nothing.
"""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spanmill.operators.pii import CONTEXT, PATTERNS, SCORED, STRICT, Policy, Recognizer, analyze
from spanmill.sources.ledger import Ledger, Part, Version

#: At most so many texts of a batch count as very frequent; rows of one are at least so many.
HOT_TEXTS = 10_000
HOT_ROWS = 10_000
RESULT = "entity_count int, entities map<string,int>"
_RESULTS = f"digest string, {RESULT}, tick long"
_TOUCHES = "digest string, tick long"


def digest(text: str) -> Column:
    """The key of a text; null for a null or empty one."""
    return F.when(F.col(text) != "", F.sha2(F.col(text), 256))


class ResultStore:
    """Results of pii.analyze() under one policy. recognizer needs a name of its own, since its code can't be compared."""

    def __init__(self, spark: SparkSession, path: str, policy: Policy | None = None, recognizer: Recognizer | None = None, recognizer_name: str = "", hot_rows: int = HOT_ROWS):
        if recognizer is not None and not recognizer_name:
            raise ValueError("a recognizer needs a name")
        self.spark, self.policy, self.recognizer, self.hot_rows = spark, policy or STRICT, recognizer, hot_rows
        own = self.policy
        said = json.dumps([own.score_threshold, sorted(own.disabled), sorted(own.thresholds.items()), PATTERNS, SCORED, sorted(CONTEXT.items()), recognizer_name])
        self.ledger = Ledger(spark, f"{path.rstrip('/')}/{hashlib.sha256(said.encode()).hexdigest()[:16]}")

    def _parts(self, version: Version, kind: str) -> list[Part]:
        return [p for p in version.parts if p.facts["kind"] == kind]

    def results(self, version: Version | None = None) -> DataFrame:
        """(digest, entity_count, entities, tick): tick is the batch that brought the text."""
        own = version or self.ledger.current()
        return self.ledger.read(_RESULTS, own, self._parts(own, "results"))

    def touches(self, version: Version | None = None) -> DataFrame:
        """(digest, tick) of texts that later batches met again."""
        own = version or self.ledger.current()
        return self.ledger.read(_TOUCHES, own, self._parts(own, "touches"))

    def learn(self, rows: DataFrame, columns: list[str]) -> DataFrame:
        """Analyse those texts of the columns that the store doesn't hold, as a batch of their own; (digest, n) of all of them, n counting rows."""
        before = self.ledger.current()
        tick = before.facts.get("tick", 0) + 1
        texts = rows.select(F.explode(F.array(*[F.struct(digest(c).alias("digest"), F.col(c).alias("text")) for c in columns])).alias("t")).select("t.*").where("digest is not null")
        counted = texts.groupBy("digest").agg(F.count("*").alias("n"))
        met = self.ledger.frame(self.ledger.stage(counted), counted.schema)  # digests alone, read more than once
        held = self.results(before).select("digest")
        fresh = texts.groupBy("digest").agg(F.first("text").alias("text")).join(held, "digest", "left_anti")
        found = fresh.select("digest", analyze(F.col("text"), self.policy, self.recognizer).alias("a")).select("digest", "a.entity_count", "a.entities", F.lit(tick).cast("long").alias("tick"))
        path = self.ledger.stage(found)
        again = self.ledger.stage(met.join(held, "digest", "left_semi").select("digest", F.lit(tick).cast("long").alias("tick")))
        staged = [(kind, p) for kind, p, schema in (("results", path, _RESULTS), ("touches", again, _TOUCHES)) if not self.ledger.frame(p, schema).isEmpty()]
        if staged:
            self.ledger.commit(lambda old: ((*old.parts, *[Part(f"{kind}={p}", p, {"kind": kind}) for kind, p in staged]), {"tick": max(tick, old.facts.get("tick", 0))}))
        return met

    def analysed(self, rows: DataFrame, columns: dict[str, str]) -> DataFrame:
        """rows with a struct (entity_count, entities) for each text column: columns maps names of results to text columns."""
        met = self.learn(rows, list(columns.values()))
        total = met.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
        often = met.where(F.col("n") >= max(self.hot_rows, total // HOT_TEXTS)).select("digest")
        # of this batch's texts, one row each, whoever analysed them
        own = self.results().join(met.select("digest"), "digest", "left_semi").groupBy("digest").agg(F.first(F.struct("entity_count", "entities")).alias("_result"))
        known = self.ledger.frame(self.ledger.stage(own), own.schema)
        hot, cold = known.join(often, "digest", "left_semi"), known.join(often, "digest", "left_anti")
        nothing = F.expr("named_struct('entity_count', 0, 'entities', cast(map() as map<string,int>))")
        out = rows
        for name, text in columns.items():
            key, spread = F.col("_digest"), F.concat(F.lit("-"), F.pmod(F.monotonically_increasing_id(), F.lit(4096)).cast("string"))
            keyed = out.withColumn("_digest", digest(text)).join(F.broadcast(hot.select(F.col("digest").alias("_digest"), F.col("_result").alias("_hot"))), "_digest", "left")
            keyed = keyed.withColumn("_key", F.when(F.col("_hot").isNull() & key.isNotNull(), key).otherwise(spread))  # no result has such a key
            met_cold = keyed.join(cold.select(F.col("digest").alias("_key"), F.col("_result").alias("_cold")), "_key", "left")
            out = met_cold.withColumn(name, F.coalesce("_hot", "_cold", nothing)).drop("_digest", "_key", "_hot", "_cold")
        return out

    def evict(self, most: int) -> int:
        """Keep at most so many texts: those that a batch met last, of one batch's texts whole prefixes of the digest; how many were kept.

        The parts become one. The driver holds a count per batch, and per prefix of four digits.
        """
        version = self.ledger.current()
        results = self.results(version)
        last = results.select("digest", "tick").unionAll(self.touches(version)).groupBy("digest").agg(F.max("tick").alias("tick"))
        last = self.ledger.frame(self.ledger.stage(last), last.schema)
        room = most
        for tick, n in last.groupBy("tick").count().orderBy(F.desc("tick")).collect():
            if n > room:
                cut = "g"  # behind all digests
                for prefix, k in last.where(F.col("tick") == tick).groupBy(F.substring("digest", 1, 4).alias("p")).count().orderBy("p").collect():
                    if k > room:
                        cut = prefix
                        break
                    room -= k
                kept = (F.col("tick") > tick) | ((F.col("tick") == tick) & (F.col("digest") < cut))
                break
            room -= n
        else:
            kept = F.lit(True)
        chosen = last.where(kept)
        one = results.groupBy("digest").agg(F.first("entity_count").alias("entity_count"), F.first("entities").alias("entities")).join(chosen, "digest").select("digest", "entity_count", "entities", "tick")
        path = self.ledger.stage(one)
        gone = {p.key for p in version.parts}
        self.ledger.commit(lambda old: ((*[p for p in old.parts if p.key not in gone], Part(f"results={path}", path, {"kind": "results"})), old.facts))
        return self.ledger.frame(path, _RESULTS).count()
