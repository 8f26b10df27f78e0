"""Evaluation of detections against annotated tokens: BIO tags to spans, greedy matching, precision and recall.

Spans are rows. Annotated documents become spans by running sums over their tokens, and are matched by a sweep
over each document's spans of one type, in a task that sees its documents one after another: linear in tokens
and, but for places where very many different spans overlap, in spans.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import deque
from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from spanmill.operators.quantiles import exact_quantiles
from spanmill.sources.ledger import kept

# Annotation labels and the entity types they stand for.
LABELS = {"NAME_STUDENT": "PERSON", "EMAIL": "EMAIL_ADDRESS", "PHONE_NUM": "PHONE_NUMBER", "URL_PERSONAL": "URL", "USERNAME": "NRP", "STREET_ADDRESS": "LOCATION"}
_SPANS = "array<struct<start:int,end:int,entity_type:string>>"


def gold_rows(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(id_col, place, start, end, entity_type) from docs (id_col, tokens, labels, trailing_whitespace), in characters. id_col must tell documents apart.

    B opens a span, I extends the open one whatever its label, all else closes it; a B with an
    unknown label opens none. So tokens form stretches that begin at each token that isn't I; a stretch is a
    span if a B with a known label begins it.
    """
    return gold_of(placed(docs.withColumn("_marked", F.transform("labels", lambda x: x != "O")), "_marked", id_col), id_col)


def gold_of(own: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """gold_rows() from the tokens (id_col, place, start, end, label) of documents whose label isn't O."""
    kind = F.create_map(*[F.lit(x) for kv in LABELS.items() for x in kv])
    # marked tokens alone are shuffled; where one isn't next to the last one, an unmarked one closed the span
    so_far = Window.partitionBy(id_col).orderBy("place")
    apart = F.coalesce(F.lag("place").over(so_far) + 1 != F.col("place"), F.lit(True))
    begins = own.withColumn("_b", ~F.col("label").startswith("I-") | apart)
    stretches = begins.withColumn("_k", F.count(F.when(F.col("_b"), 1)).over(so_far)).groupBy(id_col, "_k")
    spans = stretches.agg(F.min_by("label", "place").alias("_l"), F.min("place").alias("place"), F.min("start").alias("start"), F.max("end").alias("end"))
    entity = F.when(F.col("_l").startswith("B-"), F.try_element_at(kind, F.substring("_l", F.lit(3), F.length("_l"))))
    return spans.select(id_col, "place", "start", "end", entity.alias("entity_type")).where("entity_type is not null")


def placed(docs: DataFrame, marked: str, id_col: str = "doc_id") -> DataFrame:
    """(id_col, place, start, end, token, label) of the tokens that the array of booleans marked names, from docs (id_col, tokens, labels, trailing_whitespace).

    A sum over a document's tokens, in its own row: no token is shuffled.
    """
    import pyarrow as pa

    types = (pa.int32(), pa.int32(), pa.int32(), pa.string(), pa.string())

    def run(batches):
        for batch in batches:
            at, columns = [], [[], [], [], [], []]
            for n, (tokens, labels, spaces, chosen) in enumerate(zip(*(batch.column(k).to_pylist() for k in range(1, 5)))):
                start = 0
                for place, (token, label, space, wanted) in enumerate(zip(tokens or (), labels or (), spaces or (), chosen or ())):
                    end = start + len(token)
                    if wanted:
                        at.append(n)
                        for column, value in zip(columns, (place, start, end, token, label)):
                            column.append(value)
                    start = end + bool(space)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at, pa.int32())), *[pa.array(c, t) for c, t in zip(columns, types)]], [id_col, "place", "start", "end", "token", "label"])

    id_type = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, "tokens", "labels", "trailing_whitespace", marked).mapInArrow(run, f"`{id_col}` {id_type}, place int, start int, end int, token string, label string")


def gold_spans(docs: DataFrame) -> DataFrame:
    """docs with gold, the spans of gold_rows() as an array in their order. Documents are numbered in a table of the shared folder."""
    own = kept(docs.withColumn("_doc", F.monotonically_increasing_id()), "annotated")
    each = gold_rows(own.select("_doc", "tokens", "labels", "trailing_whitespace"), "_doc").groupBy("_doc").agg(F.array_sort(F.collect_list(F.struct("start", "end", "entity_type"))).alias("gold"))
    return own.join(each, "_doc", "left").select(*docs.columns, F.coalesce("gold", F.expr(f"cast(array() as {_SPANS})")).alias("gold"))


def greedy(golds: Iterable[tuple[int, int]], predictions: Iterable[tuple[int, int]], min_iou: float) -> int:
    """How many predictions find a gold span: each, in order, takes the first of those that it overlaps enough and that are free.

    Equal gold spans are one entry. Entries by start carry the greatest end so far, which tells where the
    search for overlaps may stop.
    """
    places: dict[tuple[int, int], deque[int]] = {}
    for k, span in enumerate(golds):
        places.setdefault(span, deque()).append(k)
    entries = sorted(places)
    starts, tops, top = [a for a, _ in entries], [], 0
    for _, b in entries:
        top = max(top, b)
        tops.append(top)
    hits = 0
    for a, b in predictions:
        k, best = bisect_left(starts, b), None
        while k and tops[k - 1] > a:
            k -= 1
            c, d = entries[k]
            both = min(b, d) - max(a, c)
            if both > 0 and places[c, d] and both / (max(b, d) - min(a, c)) >= min_iou and (best is None or places[c, d][0] < places[best][0]):
                best = c, d
        if best is not None:
            places[best].popleft()
            hits += 1
    return hits


def matched(spans: DataFrame, id_col: str = "doc_id", min_iou: float = 0.5) -> DataFrame:
    """(entity_type, tp, fp, fn) from spans (id_col, gold: boolean, place, start, end, entity_type); place is a span's order within its document.

    A document's spans of one type are one task's work; a task holds those of one at a time.
    """
    import pyarrow as pa

    def sweep(batches):
        key, golds, found, kinds = None, [], [], {}

        def close():
            if key is not None:
                hits = greedy(golds, found, min_iou)
                own = kinds.setdefault(key[1], [0, 0, 0])
                for k, n in enumerate((hits, len(found) - hits, len(golds) - hits)):
                    own[k] += n
                golds.clear()
                found.clear()

        for batch in batches:
            for doc, entity, gold, start, end in zip(*(batch.column(k).to_pylist() for k in range(5))):
                if (doc, entity) != key:
                    close()
                    key = doc, entity
                (golds if gold else found).append((start, end))
        close()
        yield pa.RecordBatch.from_arrays([pa.array(list(kinds), pa.string()), *[pa.array([v[k] for v in kinds.values()], pa.int64()) for k in range(3)]], ["entity_type", "tp", "fp", "fn"])

    own = spans.select(F.col(id_col).alias("_doc"), "entity_type", "gold", "start", "end", "place").repartition("_doc", "entity_type").sortWithinPartitions("_doc", "entity_type", "place")
    return own.drop("place").mapInArrow(sweep, "entity_type string, tp long, fp long, fn long").groupBy("entity_type").agg(*[F.sum(c).alias(c) for c in ("tp", "fp", "fn")])


def match_counts(docs: DataFrame, min_iou: float = 0.5) -> DataFrame:
    """(entity_type, tp, fp, fn) from docs (predicted, gold), each an array<(start, end, entity_type)>: matched() in the arrays' order."""
    spans = lambda c, gold: F.coalesce(
        F.transform(c, lambda s, k: F.struct(F.lit(gold).alias("gold"), k.alias("place"), s["start"].alias("start"), s["end"].alias("end"), s["entity_type"].alias("entity_type"))),
        F.expr("cast(array() as array<struct<gold:boolean,place:int,start:int,end:int,entity_type:string>>)"),
    )
    numbered = docs.select(F.monotonically_increasing_id().alias("_id"), F.concat(spans("predicted", False), spans("gold", True)).alias("_s"))
    return matched(numbered.select("_id", F.explode("_s").alias("_s")).select("_id", "_s.*"), "_id", min_iou)


def scores(counts: DataFrame) -> DataFrame:
    """Precision, recall and F1 per type with a hit or a miss, and OVERALL over all types."""
    every = counts.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("tp", "fp", "fn")]).select(F.lit("OVERALL").alias("entity_type"), "tp", "fp", "fn")
    rows = counts.where("tp + fn > 0").unionAll(every)
    share = lambda n, d: F.when(d > 0, n / d).otherwise(0.0)
    p, r = share(F.col("tp"), F.col("tp") + F.col("fp")), share(F.col("tp"), F.col("tp") + F.col("fn"))
    return rows.select("entity_type", "tp", "fp", "fn", F.round(p, 6).alias("precision"), F.round(r, 6).alias("recall"), F.round(share(2 * p * r, p + r), 6).alias("f1"))


def latency_stats(runs: DataFrame, column: str = "latency_ms", *by: str) -> DataFrame:
    """Count, mean, deviation, extremes and quantiles of how long runs took, per key."""
    own = [F.count(column).alias("n"), F.round(F.avg(column), 4).alias("mean"), F.round(F.stddev_pop(column), 4).alias("deviation"), F.min(column).alias("least"), F.max(column).alias("most")]
    names = ["p50", "p95", "p99"]
    ranks = exact_quantiles(runs, list(by), column, [0.5, 0.95, 0.99], names=names)
    same = [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in by] or [F.lit(True)]
    both = runs.groupBy(*by).agg(*own).alias("a").join(ranks.alias("b"), same, "left")
    return both.select(*[f"a.{c}" for c in by], "n", "mean", "deviation", "least", "most", *[F.round(f"b.{c}", 4).alias(c) for c in names])
