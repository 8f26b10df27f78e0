"""CSV round trips, cursors, and streaming workers: replay, late rows, several lenses."""

from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from spanmill.operators import pii, rollup
from spanmill.operators.derive import derive
from spanmill.sources import spans as io
from spanmill.sources.pricing import static_pricing
from spanmill.streaming.worker import Worker, ledger, read_stream, rows_of, start_all, states_of
from spanmill.testbed import event_spans
from tests.test_derive import T0, spans_of


def test_csv_round_trip(spark, tmp_path):
    own = spans_of(spark, {"span_id": "1", "metadata": '{"a": "x, \\"y\\""}'}, {"span_id": "2", "metadata": None, "span_type": "agent"})
    io.write_csv(own, str(tmp_path / "c"))
    back = io.read_spans_csv(spark, str(tmp_path / "c"))
    pick = lambda d: sorted((r["span_id"], r["metadata"], r["started_at"], r["stage_order"]) for r in d.collect())
    assert pick(back) == pick(own)
    assert io.read_spans_csv(spark, str(tmp_path / "c"), ("agent",)).count() == 1


def test_batches_miss_no_ties(spark):
    own = spans_of(spark, *[{"span_id": f"{k:02d}", "recorded_at": T0 + timedelta(seconds=k // 4)} for k in range(12)])
    seen, at, last = [], "1970-01-01 00:00:00", ""
    while rows := io.next_batch(own, at, 3, after_span=last).collect():
        seen += [r["span_id"] for r in rows]
        at, last = str(rows[-1]["recorded_at"]), rows[-1]["span_id"]
    assert seen == [f"{k:02d}" for k in range(12)]


def test_cursor(spark, tmp_path):
    own = io.Cursors(spark, str(tmp_path))
    assert own.load("cost") == (io.EPOCH, "")
    own.save("cost", "2024-01-01 00:00:00.000", "a")
    own.save("cost", "2024-01-02 00:00:00.000", "b")
    assert own.load("cost") == ("2024-01-02 00:00:00.000", "b") and own.load("safety") == (io.EPOCH, "")


def test_text_files(spark, tmp_path):
    (tmp_path / "a.txt").write_text("one\ntwo")
    assert [tuple(r) for r in io.read_text_files(spark, str(tmp_path)).collect()] == [("a.txt", "one\ntwo")]


def test_annotated_csv(spark, tmp_path):
    (tmp_path / "a.csv").write_text('document,text,tokens,labels,trailing_whitespace\n1,Ann,"[\'Ann\']","[\'B-NAME_STUDENT\']","[True]"\n')
    row = io.read_annotated_csv(spark, str(tmp_path / "a.csv")).first()
    assert row["tokens"] == ["Ann"] and row["labels"] == ["B-NAME_STUDENT"] and row["trailing_whitespace"] == [True]


def totals(states):
    return {r["metric"]: (r["n"], round(r["s"], 3)) for r in states.groupBy("metric").agg(F.sum("count").alias("n"), F.sum("sum_value").alias("s")).collect()}


def test_stream_equals_batch_and_replay_adds_nothing(spark, sf_dir, tmp_path):
    own = event_spans(spark, sf_dir)
    own.where("cast(span_id as int) < 500").coalesce(2).write.parquet(str(tmp_path / "in"))
    worker = Worker("performance", str(tmp_path / "out"), str(tmp_path / "check"))
    worker.start(read_stream(spark, str(tmp_path / "in"), 1), once=True).awaitTermination()
    own.where("cast(span_id as int) >= 500").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    worker.start(read_stream(spark, str(tmp_path / "in"), 1), once=True).awaitTermination()
    expected = totals(rollup.base_rollup(derive(own, "performance")))
    assert totals(states_of(spark, str(tmp_path / "out"))) == expected
    last = max(int(p.key.removeprefix("batch=")) for p in ledger(spark, str(tmp_path / "out"), "rows", "performance").current().parts)
    worker.on_batch(spark.read.schema(own.schema).parquet(str(tmp_path / "in")).where("cast(span_id as int) >= 500"), last)
    assert totals(states_of(spark, str(tmp_path / "out"))) == expected
    assert rows_of(spark, str(tmp_path / "out")).count() == derive(own, "performance").count()


def test_lenses_run_apart(spark, sf_dir, tmp_path):
    own = event_spans(spark, sf_dir).coalesce(1)
    own.write.parquet(str(tmp_path / "in"))
    workers = [Worker(k, str(tmp_path / "out"), str(tmp_path / "check"), static_pricing) for k in ("performance", "cost")]
    for q in start_all(read_stream(spark, str(tmp_path / "in")), workers, once=True):
        q.awaitTermination()
    expected = totals(rollup.base_rollup(derive(own, "performance"))) | totals(rollup.base_rollup(derive(own, "cost", static_pricing(spark))))
    assert totals(states_of(spark, str(tmp_path / "out"))) == expected


def test_rows_append_in_daily_partitions(spark, sf_dir, tmp_path):
    rows = derive(event_spans(spark, sf_dir).limit(30), "performance")
    for _ in range(2):
        io.append_rows(rows, str(tmp_path / "rows"))
    back = spark.read.parquet(str(tmp_path / "rows"))
    assert back.count() == 2 * rows.count() and {r[0] for r in back.select("day").distinct().collect()} == {int(r[0]) for r in rows.select(F.date_format("ts", "yyyyMMdd")).distinct().collect()}


def test_audits_append_without_texts(spark, tmp_path):
    done = pii.anonymize(spark.createDataFrame([(1, "ip 10.20.30.40")], "doc_id long, text string"))
    for _ in range(2):
        io.append_audit(pii.audit_rows(done), str(tmp_path / "audit"))
    back = spark.read.json(str(tmp_path / "audit"))
    assert back.count() == 2 and "text" not in back.columns and {r["entity_type"] for r in back.collect()} == {"IP_ADDRESS"}


def test_policies_from_files(tmp_path):
    yaml = pytest.importorskip("yaml")
    (tmp_path / "p.yaml").write_text(yaml.safe_dump({"default_strategy": "mask", "score_threshold": 0.5, "entities": {"AGE": {"enabled": False}, "URL": {"strategy": "replace", "score_threshold": 0.9}}}))
    own = pii.Policy.from_yaml(str(tmp_path / "p.yaml"))
    assert own.strategy("EMAIL_ADDRESS") == "mask" and own.strategy("URL") == "replace" and not own.allows("AGE", 1.0) and not own.allows("URL", 0.85) and own.allows("ZIP_CODE", 0.5)


def test_spans_load_and_roll_up_once(spark, sf_dir, tmp_path):
    """A bulk load, its rows and their stored hourly states, from which days merge."""
    spans = event_spans(spark, sf_dir)
    io.write_spans(spans, str(tmp_path / "spans"))
    rows = derive(spark.read.parquet(str(tmp_path / "spans")).drop("month"), "performance")
    rollup.base_rollup(rows, "1h").write.parquet(str(tmp_path / "hours"))
    days = rollup.merge(spark.read.parquet(str(tmp_path / "hours")), "1d", by=["metric"]).groupBy("metric").agg(F.sum("count").alias("n"))
    assert {r["metric"]: r["n"] for r in days.collect()} == {r["metric"]: r["n"] for r in rows.groupBy("metric").agg(F.count("*").alias("n")).collect()}
