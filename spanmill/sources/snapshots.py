"""Configuration tables as versioned snapshots: loaded at most once per time to live, the last good one when the source fails.

A snapshot is a part of a ledger, so that all jobs of a cluster share it and a batch can name the one it used;
at() reads any that is still kept. A load whose rows equal the newest snapshot's makes no new one. A source
that fails is asked again only after retry seconds, so that it isn't hammered; the first load has
nothing to fall back to, so its error is raised.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spanmill.sources.ledger import Ledger, Part, Version


@dataclass(frozen=True)
class Snapshot:
    name: str
    table: DataFrame
    loaded_at: float
    stale: bool = False
    error: str | None = None


class Snapshots:
    """load reads the source; ttl and retry are seconds; kept is how many snapshots stay readable."""

    def __init__(self, spark: SparkSession, path: str, load: Callable[[SparkSession], DataFrame], ttl: float = 300.0, retry: float = 10.0, kept: int = 100, clock: Callable[[], float] = time.time):
        self.ledger, self.load, self.ttl, self.retry, self.kept, self.clock = Ledger(spark, path), load, ttl, retry, kept, clock

    def _at(self, part: Part, stale: bool = False, error: str | None = None) -> Snapshot:
        schema = T.StructType.fromJson(part.facts["schema"])
        return Snapshot(part.key, self.ledger.frame(part.path, schema), part.facts["loaded_at"], stale, error)

    def current(self, force: bool = False) -> Snapshot:
        """The newest snapshot, loaded anew if it is older than ttl; if that fails the last good one, marked stale, with the error."""
        version, now = self.ledger.current(), self.clock()
        newest = version.parts[-1] if version.parts else None
        if newest is not None and not force:
            if now - version.facts["checked_at"] <= self.ttl:
                return self._at(newest)
            if now - version.facts.get("failed_at", -self.retry - 1) <= self.retry and version.facts["failed_at"] > version.facts["checked_at"]:
                return self._at(newest, True, version.facts["error"])
        try:
            part = self._load(version, now)
        except Exception as error:
            if newest is None:
                raise
            said = f"{type(error).__name__}: {error}"[:500]
            self.ledger.commit(lambda old: (old.parts, old.facts | {"failed_at": now, "error": said}))
            return self._at(newest, True, said)

        def change(old: Version):
            known = [p for p in old.parts if p.facts["digest"] == part.facts["digest"]]
            if known and known[-1] is old.parts[-1]:
                return old.parts, old.facts | {"checked_at": max(now, old.facts["checked_at"])}
            return (*old.parts, Part(f"snapshot-{old.number + 1}", part.path, part.facts))[-self.kept :], old.facts | {"checked_at": now}

        return self._at(self.ledger.commit(change).parts[-1])

    def _load(self, version: Version, now: float) -> Part:
        frame = self.load(self.ledger.spark)
        path = self.ledger.stage(frame)
        written = self.ledger.frame(path, frame.schema)
        rows, mixed = written.agg(F.count("*"), F.sum(F.xxhash64(*written.columns).cast("decimal(38,0)"))).first()
        return Part("", path, {"schema": json.loads(frame.schema.json()), "loaded_at": now, "digest": f"{rows}:{mixed}"})

    def at(self, name: str) -> DataFrame:
        part = self.ledger.current().part(name)
        if part is None:
            raise KeyError(name)
        return self._at(part).table
