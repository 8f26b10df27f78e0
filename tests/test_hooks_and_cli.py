"""Context scores, label maps, the caller's own lenses, the command line, and upkeep of stored states."""

import json

import pytest
from pyspark.sql import functions as F

from spanmill import cli
from spanmill.functions import predicates
from spanmill.operators import evaluate, pii, readtime, rollup, thresholds
from spanmill.operators.derive import derive
from spanmill.operators.pii import STRICT, Policy
from spanmill.plans import registry
from spanmill.plans.registry import Metric
from spanmill.sources import config
from spanmill.sources import spans as io
from spanmill.streaming import worker
from spanmill.testbed import event_spans


@pytest.mark.parametrize(("text", "expected"), [
    ("savings account of mine 12345678", {("US_BANK_NUMBER", 0.76)}),
    ("routing 123456789", {("US_BANK_NUMBER", 0.76), ("US_BANK_NUMBER", 0.75)}),
    ("hospital stay was MGH-884721", {("MEDICAL_RECORD_NUMBER", 0.9)}),
    ("my website johndoe.com", {("URL", 0.85)}),
    ("the birthday is 01/02/1980", {("DATE_OF_BIRTH", 0.75)}),
    ("account one two three four five 12345678", set()),
    ("nothing near 12345678 but later account", set()),
    ("plain johndoe.com", set()),
])
def test_context_lifts_scores(text, expected):
    assert {(d[0], d[4]) for d in pii.detect_text(text, STRICT) if d[0] != "US_BANK_NUMBER" or "account" in text or "routing" in text} >= expected
    if not expected:
        assert pii.detect_text(text, STRICT) == []


def test_labels_of_models_are_mapped():
    found = pii.mapped(lambda texts: [[("B-PER", 0, 3, 0.9), ("GPE", 4, 6, 0.8), ("WEIRD", 0, 1, 0.9)] for _ in texts])(["Ann NY"])
    assert found == [[("PERSON", 0, 3, 0.9), ("LOCATION", 4, 6, 0.8)]]
    assert set(pii.MODEL_LABELS.values()) <= set(pii.ENTITY_TYPES)


def test_stand_ins_keep_the_shape():
    own = pii.stand_in("Ann-Lee 415 é")
    assert own == pii.stand_in("Ann-Lee 415 é") != pii.stand_in("Ann-Lee 415 é", "salt") and len(own) == 13 and own[3] == "-" and own[8:11].isdigit() and own[0].isupper()
    assert pii.replacement("PERSON", "Bo", "stand_in") == pii.stand_in("Bo") and pii.stand_in("") == ""


def test_audit_has_times(spark):
    done = pii.anonymize(spark.createDataFrame([(1, "ip 10.20.30.40"), (2, None)], "doc_id long, text string"))
    at = F.lit("2024-01-02 03:04:05").cast("timestamp")
    assert [str(r["timestamp"]) for r in pii.audit_rows(done, at=at).collect()] == ["2024-01-02 03:04:05"]
    assert sorted((r["document_id"], r["entities_found"]) for r in pii.audit_records(done).collect()) == [(1, 1), (2, 0)]


def test_matching_is_greedy(spark):
    span = "array<struct<start:int,end:int,entity_type:string>>"
    rows = [([(0, 4, "A"), (0, 4, "A"), (9, 9, "A")], [(0, 4, "A"), (0, 5, "A"), (0, 4, "B")]), ([], [(1, 2, "B")]), ([], [])]
    got = {r[0]: tuple(r)[1:] for r in evaluate.match_counts(spark.createDataFrame(rows, f"predicted {span}, gold {span}")).collect()}
    assert got == {"A": (2, 1, 0), "B": (0, 0, 2)}


@pytest.fixture
def own_lens():
    predicates.register_predicate("leafy", lambda: F.col("component_id") != "")
    metric = Metric("depth", "name_length", "leafy", "ctx_value", "count", "5m", False, lambda: F.col("_n"))
    registry.register_lens("depth", [metric], intermediates=lambda spans, pricing, policy: spans.withColumn("_n", F.length("span_name")))
    yield "depth"
    del registry.LENSES["depth"], registry.SPAN_TYPES["depth"], registry.INTERMEDIATES["depth"], predicates._PREDICATES["leafy"]


def test_a_lens_of_the_callers_own(spark, sf_dir, own_lens):
    rows = derive(event_spans(spark, sf_dir), own_lens)
    assert {r["value"] for r in rows.select("value").distinct().collect()} <= {4.0, 5.0, 6.0, 8.0} and rows.select("metric").distinct().count() == 1
    with pytest.raises(ValueError):
        registry.register_lens("depth", [])
    with pytest.raises(ValueError):
        predicates.register_predicate("leafy", lambda: F.lit(True))
    registry.register_metric(Metric("depth", "twice", "leafy", "ctx_value", "count", "5m", False, lambda: F.col("_n") * 2))
    assert derive(event_spans(spark, sf_dir), own_lens).select("metric").distinct().count() == 2


def test_reducers_differ_by_metric(spark):
    rows = spark.createDataFrame([("latency", "s", float(v), "2024-01-01 00:00:01") for v in range(101)] + [("timeout_count", "s", 1.0, "2024-01-01 00:00:02")] * 3 + [("error_rate", "s", v, "2024-01-01 00:00:02") for v in (0.0, 1.0)], "metric string, solution_id string, value double, ts string").withColumn("ts", F.col("ts").cast("timestamp"))
    assert {r["metric"]: r["value"] for r in thresholds.reduced(rows, "1d", ["solution_id"]).collect()} == {"latency": 95.0, "timeout_count": 3.0, "error_rate": 0.5}


def test_span_shapes_that_events_lack(spark):
    """Orchestrated and batch operations, and the metrics that only they have."""
    meta = json.dumps({"scheduling_delay_ms": 5, "records_processed": 7, "batch_size": 3, "inter_token_latency_ms": 2.5, "retry_delay_ms": 4, "rate_limit_wait_ms": 6})
    base = event_spans(spark, "/root/testdata/sf0.001").limit(1)
    rows = [base.withColumn("span_type", F.lit(t)).withColumn("scope", F.lit(t)).withColumn("metadata", F.lit(meta)) for t in ("workflow", "validation", "model_call")]
    got = {(r["scope"], r["metric"]): r["value"] for r in derive(rows[0].unionAll(rows[1]).unionAll(rows[2]), "performance").collect()}
    assert got["workflow", "scheduling_delay"] == 5.0 and got["validation", "records_processed"] == 7.0 and got["validation", "batch_size"] == 3.0 and got["validation", "retry_delay"] == 4.0
    assert got["model_call", "inter_token_latency"] == 2.5 and got["model_call", "rate_limit_wait"] == 6.0 and ("workflow", "records_processed") not in got


def test_gauges_and_shares(spark):
    samples = spark.createDataFrame([("s", "2024-01-01 00:00:01", 3.0), ("s", "2024-01-01 00:01:01", 9.0)], "solution_id string, ts string, value double").withColumn("ts", F.col("ts").cast("timestamp"))
    assert [r["value"] for r in readtime.gauge(samples).collect()] == [9.0]
    shares, costs = spark.createDataFrame([("a", 1.0), ("b", 3.0)], "solution_id string, share double"), spark.createDataFrame([(10.0,), (30.0,)], "amount double")
    assert {r[0]: r[1] for r in readtime.allocated(costs, shares).collect()} == {"a": 10.0, "b": 30.0}
    rows = spark.createDataFrame([("s", "cost", "c", 5.0)], "solution_id string, metric string, component_id string, value double")
    assert readtime.budget_utilization(rows, spark.createDataFrame([("s", 20.0)], "solution_id string, budget double")).first()["value"] == 0.25


def test_retention_and_recent(spark):
    rows = spark.createDataFrame([("2024-01-01 00:00:00",), ("2024-01-09 00:00:00",)], "t string").select(F.col("t").cast("timestamp").alias("bucket"))
    assert rollup.expired(rows, "bucket", "2024-01-10 00:00:00", 3).count() == 1 and worker.recent(rows, "2024-01-09 00:10:00", 30).count() == 1


def test_text_command(tmp_path, capsys):
    file = tmp_path / "note.txt"
    file.write_text("mail ann@example.org, age: 42")
    assert cli.main(["deidentify", str(file), "--audit", str(tmp_path / "audit.jsonl")]) == 0
    assert capsys.readouterr().out.strip() == "mail [EMAIL_ADDRESS], <AGE>"
    record = json.loads((tmp_path / "audit.jsonl").read_text())
    assert record["entities_found"] == 2 and record["document_id"] == "note.txt" and "ann@" not in json.dumps(record)
    assert cli.main(["deidentify", str(file), "--strategy", "mask", "--score-threshold", "0.9", "--format", "json", "--output", str(tmp_path / "out.json")]) == 0
    assert json.loads((tmp_path / "out.json").read_text())["deidentified_text"] == "mail ***************, age: 42"
    assert cli.main(["deidentify", str(tmp_path / "absent")]) == 1


def test_worker_command(spark, sf_dir, tmp_path):
    spans = event_spans(spark, sf_dir).limit(50)
    io.write_csv(spans, str(tmp_path / "spans"))
    assert cli.main(["worker", "--lens", "performance", "--csv", str(tmp_path / "spans"), "--out", str(tmp_path / "out")]) == 0
    assert io.read_derived_csv(spark, str(tmp_path / "out/performance")).count() == derive(spans, "performance").count()
    assert cli.main(["worker", "--lens", "cost", "--stream", "x", "--out", "y"]) == 2


def test_messages_states_and_compaction(spark, sf_dir, tmp_path):
    own = worker.Worker("performance", str(tmp_path / "out"), str(tmp_path / "check"))
    spans = [r.asDict() for r in event_spans(spark, sf_dir).limit(40).collect()]
    for batch in range(4):
        own.on_message(spark, spans[10 * batch : 10 * batch + 10], batch)
    own.on_message(spark, spans[30:], 3)  # a replay counts once
    states = lambda: sorted((tuple(str(r[c]) for c in ("metric", "scope", "solution_id", "component_id", "endpoint", "bucket", "environment", "workflow_id")), r["count"], round(r["sum_value"], 6)) for r in worker.states_of(spark, str(tmp_path / "out")).collect())
    before = states()
    worker.compact(spark, str(tmp_path / "out"), "performance", 3)
    assert len(worker.ledger(spark, str(tmp_path / "out"), "states", "performance").current().parts) == 2 and states() == before
    assert worker.rows_of(spark, str(tmp_path / "out")).count() == derive(spark.createDataFrame([tuple(s.values()) for s in spans], event_spans(spark, sf_dir).schema), "performance").count()


def test_stop(spark, sf_dir, tmp_path):
    event_spans(spark, sf_dir).limit(5).write.parquet(str(tmp_path / "in"))
    running = worker.start_all(worker.read_stream(spark, str(tmp_path / "in")), [worker.Worker("performance", str(tmp_path / "out"), str(tmp_path / "check"))])
    worker.stop_all(running)
    assert not running[0].isActive


def test_scripts_of_inserts_as_sources(spark, tmp_path):
    (tmp_path / "seed.sql").write_text("""BEGIN; -- a (comment), with 'quotes'
INSERT INTO solutions (id, solution_id, note) VALUES ('s1', 'sol_a', 'it''s (one); of two'), ('s2', 'sol_b', NULL);
INSERT INTO endpoints (id, endpoint_id, solution_id, spec) VALUES ('e1', 'ep_a', 's1', '{"a":1}'::jsonb);
INSERT INTO bindings (id, solution_id, endpoint_id, workflow_id, agent_id, component_id) VALUES
 -- [1] a path
 ('b1', 's1', 'e1', NULL, NULL, 'c1'), ('b2', 's2', 'e1', NULL, NULL, NULL);
INSERT INTO components (id, component_id) VALUES ('c1', 'model_x');
INSERT INTO thresholds (category, metric_name, scope, time_window, operator, warning_value, critical_value, solution_id) VALUES ('cost','cost','solution','1h','gt',0.5,-2,'s1');
INSERT INTO thresholds (metric_name, category, scope, time_window, operator, warning_value, critical_value, solution_id) VALUES ('latency','performance','solution','5m','gt',1,2,'s2');
COMMIT;""")
    tables = config.read_inserts(spark, str(tmp_path / "seed.sql"))
    assert [tuple(r) for r in tables["solutions"].orderBy("id").collect()] == [("s1", "sol_a", "it's (one); of two"), ("s2", "sol_b", None)]
    empty = {level: spark.createDataFrame([], f"id string, {level}_id string") for level in ("workflow", "agent")}
    registry_ = {"solution": tables["solutions"], "endpoint": tables["endpoints"], "component": tables["components"], **empty}
    paths = thresholds.with_business_keys(tables["bindings"], registry_).withColumn("level", thresholds.deepest())
    assert {(r["solution_id"], r["endpoint_id"], r["component_id"], r["level"]) for r in paths.collect()} == {("sol_a", "ep_a", "model_x", "component"), ("sol_b", "ep_a", None, "endpoint")}
    own = config.thresholds_of(tables)
    assert {(r["category"], r["metric_name"], r["warning_value"], r["critical_value"], r["solution_id"], r["agent_id"]) for r in own.collect()} == {("cost", "cost", 0.5, -2.0, "s1", None), ("performance", "latency", 1.0, 2.0, "s2", None)}


def test_cursors_collect_one_row(spark, tmp_path):
    own = io.Cursors(spark, str(tmp_path))
    assert own.load("cost") == (io.EPOCH, "")
    for k in range(3):
        own.save("cost", f"2024-01-0{k + 1} 00:00:00.000", f"s{k}")
    assert own.load("cost") == ("2024-01-03 00:00:00.000", "s2")


def test_policy_thresholds_reach_lifted_scores():
    assert pii.detect_text("zip is 94105", Policy(score_threshold=0.8)) == [] and [d[0] for d in pii.detect_text("zip is 94105", Policy(score_threshold=0.75))] == ["ZIP_CODE"]
