"""Lenses as streaming queries: spans in, metric rows and partial rollup states out.

Rows and states of a lens are ledgers (sources/ledger.py). Every micro-batch commits its rows and its states
under its own batch id, in place of what an earlier attempt of the same batch left, so a replay counts
nothing twice, even after its states were merged with others: a merged part names the batches in it.
Late rows are states like any other: no watermark drops them. Each lens has its own checkpoint, and its
first run takes in all history. compact() merges states and retain() drops old ones, each by one commit;
streaming/tiers.py keeps coarser states beside the base.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from spanmill.operators.derive import derive
from spanmill.operators.rollup import base_rollup, merge
from spanmill.plans.registry import LENSES
from spanmill.schema import derived, raw_span
from spanmill.sources.ledger import Ledger, Part, Version
from spanmill.sources.snapshots import Snapshots


def read_stream(spark: SparkSession, path: str, files_per_batch: int = 100, file_format: str = "parquet") -> DataFrame:
    return spark.readStream.schema(raw_span()).format(file_format).option("maxFilesPerTrigger", files_per_batch).load(path)


def ledger(spark: SparkSession, out: str, kind: str, lens: str) -> Ledger:
    """kind: rows, states, or a tier's name."""
    return Ledger(spark, f"{out.rstrip('/')}/{kind}/lens={lens}")


def lenses_of(spark: SparkSession, out: str, kind: str) -> list[str]:
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{out.rstrip('/')}/{kind}")
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in fs.listStatus(path)] if fs.exists(path) else []
    return sorted(n.removeprefix("lens=") for n in names if n.startswith("lens="))


def schema_of(version: Version) -> T.StructType:
    """The columns of a lens's ledger, as its last writer named them."""
    return T.StructType.fromJson(version.facts["schema"])


def _holds(part: Part, batch_id: int) -> bool:
    return any(a <= batch_id <= b for a, b in part.facts["batches"])


def _extent(rows: DataFrame, ts: str) -> list[int] | None:
    """The first and last time of rows, in seconds; None for no rows."""
    first, last = rows.agg(F.unix_seconds(F.min(ts)), F.unix_seconds(F.max(ts))).first()
    return None if first is None else [first, last]


def _joined(*extents: list[int] | None) -> list[int] | None:
    own = [e for e in extents if e]
    return [min(e[0] for e in own), max(e[1] for e in own)] if own else None


def _add(to: Ledger, batch_id: int, path: str, extent: list[int] | None, schema: T.StructType, more: dict | None = None) -> None:
    """A batch's part, with more facts if given. since is the version that brought it; replaced, the times that an earlier attempt held."""

    def change(old: Version):
        before = old.part(f"batch={batch_id}")
        facts = {"batches": [[batch_id, batch_id]], "extent": extent, "since": old.number + 1, "replaced": _joined(before.facts["extent"], before.facts["replaced"]) if before else None} | (more or {})
        kept = [p for p in old.parts if p.key != f"batch={batch_id}"]
        return (*kept, Part(f"batch={batch_id}", path, facts)), old.facts | {"schema": json.loads(schema.json())}

    to.commit(change)


class Worker:
    """One lens. pricing is a function that reads the price table anew for each batch, or snapshots of it, whose
    name the batch's rows then bear; results, a store of analyses that batches share."""

    def __init__(self, lens: str, out: str, checkpoint: str, pricing=None, policy=None, window: str = "1m", results=None):
        if lens not in LENSES:
            raise ValueError(f"no such lens: {lens}")
        self.lens, self.out, self.checkpoint, self.pricing, self.policy, self.window, self.results = lens, out.rstrip("/"), checkpoint.rstrip("/"), pricing, policy, window, results

    def on_batch(self, spans: DataFrame, batch_id: int) -> None:
        """Commit the batch's rows and states. A batch whose states are merged already is left as it is."""
        spark = spans.sparkSession
        rows_to, states_to = ledger(spark, self.out, "rows", self.lens), ledger(spark, self.out, "states", self.lens)
        if any(_holds(p, batch_id) and p.key != f"batch={batch_id}" for p in states_to.current().parts):
            return
        # one snapshot for the whole batch, however long it takes
        snapshot = self.pricing.current() if isinstance(self.pricing, Snapshots) else None
        prices = snapshot.table if snapshot else self.pricing(spark) if self.pricing else None
        # dealt to all tasks: a file has as few as it has row groups, and a stretch of a cursor one
        rows = derive(spans.repartition("trace_id", "span_id"), self.lens, prices, self.policy, results=self.results)
        written = rows_to.stage(rows)
        own = rows_to.frame(written, rows.schema)
        states = base_rollup(own, self.window)
        merged = states_to.stage(states)
        _add(rows_to, batch_id, written, _extent(own, "ts"), rows.schema, {"prices": snapshot.name, "stale": snapshot.stale} if snapshot else {})
        _add(states_to, batch_id, merged, _extent(states_to.frame(merged, states.schema), "bucket"), states.schema)

    def start(self, spans: DataFrame, seconds: float = 2.0, once: bool = False) -> StreamingQuery:
        """once drains what is there and stops; else a batch begins every so many seconds."""
        trigger = {"availableNow": True} if once else {"processingTime": f"{seconds} seconds"}
        writer = spans.writeStream.queryName(f"lens_{self.lens}").foreachBatch(self.on_batch)
        return writer.option("checkpointLocation", f"{self.checkpoint}/{self.lens}").trigger(**trigger).start()

    def on_message(self, spark: SparkSession, spans: list[dict], batch_id: int) -> None:
        """Spans pushed by a caller, as one batch under an id of the caller's."""
        self.on_batch(spark.createDataFrame([tuple(s.get(c) for c in raw_span().fieldNames()) for s in spans], raw_span()), batch_id)


def _all(spark: SparkSession, out: str, kind: str) -> DataFrame | None:
    found = None
    for lens in lenses_of(spark, out, kind):
        own = ledger(spark, out, kind, lens)
        version = own.current()
        if version.number:
            part = own.read(schema_of(version), version)
            found = part if found is None else found.unionByName(part)
    return found


def rows_of(spark: SparkSession, out: str) -> DataFrame:
    found = _all(spark, out, "rows")
    return spark.createDataFrame([], derived()) if found is None else found


def partials_of(spark: SparkSession, out: str) -> DataFrame:
    """The partial states of all batches as they are, several of a key. Sums over coarser keys need no merge before."""
    found = _all(spark, out, "states")
    return base_rollup(spark.createDataFrame([], derived())) if found is None else found


def states_of(spark: SparkSession, out: str) -> DataFrame:
    """The partial states of all batches, merged."""
    return merge(partials_of(spark, out))


def compact(spark: SparkSession, out: str, lens: str, before_batch: int, window: str | None = None) -> None:
    """Merge a lens's states of batches below before_batch into one part, at a coarser window if given.

    The merged part takes the place of its parts by one commit; until then, and if the job stops anywhere,
    readers see the parts. What no version names goes with Ledger.vacuum(). A batch that is replayed
    afterwards isn't counted again. Of two compactions of the same parts the second does nothing.
    """
    own = ledger(spark, out, "states", lens)
    version = own.current()
    old = [p for p in version.parts if max(b for _, b in p.facts["batches"]) < before_batch]
    if len(old) < 2 and not (old and window):
        return
    merged = merge(own.read(schema_of(version), parts=old), window)
    path = own.stage(merged)
    gone = {(p.key, p.path) for p in old}
    extent = _extent(own.frame(path, merged.schema), "bucket")

    def change(now: Version):
        if not gone <= {(p.key, p.path) for p in now.parts}:
            return None
        facts = {"batches": ranges([x for p in old for x in p.facts["batches"]]), "extent": extent, "since": max(p.facts["since"] for p in old), "replaced": _joined(*[p.facts["replaced"] for p in old])}
        return (*[p for p in now.parts if (p.key, p.path) not in gone], Part(f"merged={path}", path, facts)), now.facts

    own.commit(change)


def ranges(found: list[list[int]]) -> list[list[int]]:
    """Ranges of batch ids, those that touch as one."""
    out: list[list[int]] = []
    for a, b in sorted(found):
        if out and a <= out[-1][1] + 1:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return out


def retain(spark: SparkSession, out: str, kind: str, lens: str, as_of, days: int) -> None:
    """Drop what is older than days, counted from the start of as_of's day: whole parts by the commit alone, others rewritten.

    kind: rows, states or a tier's name. The version remembers from where on it is complete. A part that
    another writer replaced meanwhile keeps its old rows until the next call.
    """
    own = ledger(spark, out, kind, lens)
    version = own.current()
    if not version.number:
        return
    day = F.date_trunc("day", F.lit(as_of).cast("timestamp"))
    cut = spark.range(1).select(F.unix_seconds(day - F.make_interval(days=F.lit(days)))).first()[0]
    ts, schema = "ts" if kind == "rows" else "bucket", schema_of(version)
    rewritten: dict[str, tuple[str, list[int] | None]] = {}
    for p in version.parts:
        if p.path and p.facts["extent"] and p.facts["extent"][0] < cut <= p.facts["extent"][1]:
            path = own.stage(own.frame(p.path, schema).where(F.col(ts) >= F.timestamp_seconds(F.lit(cut))))
            rewritten[p.path] = path, _extent(own.frame(path, schema), ts)
    lost = {p.path for p in version.parts if p.path and p.facts["extent"] and p.facts["extent"][1] < cut}

    def change(now: Version):
        kept = []
        for p in now.parts:
            if p.path in rewritten:
                path, extent = rewritten[p.path]
                p = Part(p.key, path, p.facts | {"extent": extent})
            # a part without rows keeps its place, so that a replay of its batches is known
            kept.append(Part(p.key, "", p.facts | {"extent": None}) if p.path in lost else p)
        return tuple(kept), now.facts | {"complete_from": max(cut, now.facts.get("complete_from", cut))}

    own.commit(change)


def start_all(spans: DataFrame, workers: list[Worker], once: bool = False) -> list[StreamingQuery]:
    return [w.start(spans, once=once) for w in workers]


def stop_all(queries: list[StreamingQuery]) -> None:
    for q in queries:
        q.stop()


def recent(states: DataFrame, as_of, minutes: int) -> DataFrame:
    return states.where(F.col("bucket") >= F.lit(as_of).cast("timestamp") - F.make_interval(mins=F.lit(minutes)))
