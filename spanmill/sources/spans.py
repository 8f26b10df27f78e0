"""Sources and sinks of spans and metric rows, in batch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanmill.schema import derived, raw_span
from spanmill.sources.ledger import Ledger, Version, kept

#: The null marker of CSV files, and where an unset cursor stands.
NULL, EPOCH = "\\N", "1970-01-01 00:00:00.000"


def read_spans_csv(spark: SparkSession, path: str, span_types: tuple[str, ...] | None = None) -> DataFrame:
    own = spark.read.schema(raw_span()).option("header", True).option("nullValue", NULL).option("escape", '"').option("timestampFormat", "yyyy-MM-dd HH:mm:ss[.SSS]").csv(path)
    return own.where(F.col("span_type").isin(*span_types)) if span_types else own


def read_derived_csv(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(derived()).option("header", True).option("nullValue", NULL).option("escape", '"').option("timestampFormat", "yyyy-MM-dd HH:mm:ss[.SSS]").csv(path)


def write_csv(rows: DataFrame, path: str, mode: str = "error") -> None:
    rows.write.mode(mode).option("header", True).option("nullValue", NULL).option("escape", '"').option("timestampFormat", "yyyy-MM-dd HH:mm:ss.SSS").csv(path)


def write_spans(spans: DataFrame, path: str, mode: str = "append") -> None:
    """Monthly partitions, sorted so that row groups can be skipped by solution and span type."""
    own = spans.withColumn("month", F.date_format("started_at", "yyyyMM"))
    own.sortWithinPartitions("month", "solution_id", "span_type", "started_at").write.mode(mode).partitionBy("month").parquet(path)


def append_rows(rows: DataFrame, path: str) -> None:
    """Append metric rows in daily partitions, sorted for reads by solution, scope and metric."""
    own = rows.withColumn("day", F.date_format("ts", "yyyyMMdd"))
    own.sortWithinPartitions("day", "solution_id", "scope", "metric", "ts").write.mode("append").partitionBy("day").parquet(path)


def next_batch(spans: DataFrame, since: str, limit: int, span_types: tuple[str, ...] | None = None, after_span: str | None = None) -> DataFrame:
    """The next spans by (recorded_at, span_id). Rows that tie with the cursor's time are not lost if after_span is given."""
    at = F.lit(since).cast("timestamp")
    later = F.col("recorded_at") > at
    if after_span is not None:
        later = later | ((F.col("recorded_at") == at) & (F.col("span_id") > after_span))
    own = spans.where(later)
    if span_types:
        own = own.where(F.col("span_type").isin(*span_types))
    return own.orderBy("recorded_at", "span_id").limit(limit)


class Cursors:
    """A cursor per lens for batch jobs, as facts of a ledger in a folder that all jobs share.

    recorded_at is text of one form (ISO, UTC), so that text order is time order. A cursor never goes back, and a
    lost write leaves it where it was; few versions are kept.
    """

    def __init__(self, spark: SparkSession, path: str, kept: int = 5):
        self.spark, self.ledger, self.kept = spark, Ledger(spark, path), kept

    def _state(self, lens: str) -> list:
        return self.ledger.current().facts.get(lens, [EPOCH, "", 0])

    def load(self, lens: str) -> tuple[str, str]:
        """(recorded_at, span_id) of the last span done."""
        return tuple(self._state(lens)[:2])

    def batch(self, lens: str) -> int:
        """The number of the batch that comes next: how often the cursor moved."""
        return self._state(lens)[2]

    def save(self, lens: str, recorded_at: str, span_id: str) -> None:
        def change(old: Version):
            now = old.facts.get(lens, [EPOCH, "", 0])
            return None if [recorded_at, span_id] <= now[:2] else (old.parts, old.facts | {lens: [recorded_at, span_id, now[2] + 1]})

        if self.ledger.commit(change).number > self.kept:
            self.ledger.vacuum(self.kept)


def poll(spans: DataFrame, cursors: Cursors, lens: str, limit: int, handle: Callable[[DataFrame, int], None], span_types: tuple[str, ...] | None = None, most_batches: int | None = None) -> int:
    """Hand the spans behind a lens's cursor to handle(batch, number), at most limit rows at a time by (recorded_at, span_id), until none is left; how many batches.

    Spans that tie with the cursor's time aren't lost. The cursor moves when handle returns: a batch that stops is repeated
    under its number, which a Worker's on_batch() counts once. Only the cursor's place comes to the driver.
    """
    done = 0
    while most_batches is None or done < most_batches:
        at, last = cursors.load(lens)
        own = kept(next_batch(spans, at, limit, span_types, after_span=last), "poll")
        end = own.agg(F.max(F.struct(F.date_format("recorded_at", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("at"), "span_id"))).first()[0]
        if end is None:
            break
        handle(own, cursors.batch(lens))
        cursors.save(lens, end["at"], end["span_id"])
        done += 1
    return done


def read_text_files(spark: SparkSession, path: str) -> DataFrame:
    """One document per file: doc_id is the file's name."""
    own = spark.read.text(path, wholetext=True).select(F.col("value").alias("text"), "_metadata.file_name")
    return own.select(F.col("file_name").alias("doc_id"), "text")


def read_annotated_csv(spark: SparkSession, path: str, limit: int | None = None) -> DataFrame:
    """Annotated documents: list columns are written as literals of lists, here read as JSON."""
    own = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    lists = {"tokens": "array<string>", "labels": "array<string>", "trailing_whitespace": "array<boolean>"}
    as_json = lambda c: F.regexp_replace(F.regexp_replace(c, r"\bTrue\b", "true"), r"\bFalse\b", "false")
    own = own.withColumns({c: F.from_json(as_json(F.col(c)), t, {"allowSingleQuotes": "true"}) for c, t in lists.items()})
    return own if limit is None else own.limit(limit)


def append_audit(audit, path: str) -> None:
    audit.write.mode("append").json(path)
