"""The store of analyses: each text once, whatever batches, policies, copies, stops and evictions there are."""

import pytest
from pyspark.sql import functions as F

from spanmill.operators.derive import derive
from spanmill.operators.pii import Policy, detect_text, resolve
from spanmill.operators.results import ResultStore
from spanmill.sources.ledger import Ledger
from spanmill.streaming.worker import Worker, rows_of
from spanmill.testbed import document_pairs

SCHEMA = "k long, a string, b string"


def brute(text, policy=None):
    return len(resolve(detect_text(text or "", policy or Policy()), within_type=True))


def test_each_text_is_analysed_once_over_many_batches(spark, tmp_path):
    store, seen = ResultStore(spark, str(tmp_path)), []
    for batch in range(6):
        rows = [(0, "mail a@b.org now", f"only in {batch}, call 415-555-2671"), (1, "", None), (2, "mail a@b.org now", "mail a@b.org now")]
        out = {r["k"]: r for r in store.analysed(spark.createDataFrame(rows, SCHEMA), {"x": "a", "y": "b"}).collect()}
        assert {k: (r["x"]["entity_count"], r["y"]["entity_count"]) for k, r in out.items()} == {k: (brute(a), brute(b)) for k, a, b in rows}
        seen.append(store.results().count())
    assert seen == list(range(2, 8))
    ticks = {(r["entity_count"], r["tick"]) for r in store.results().where(F.col("digest") == F.sha2(F.lit("mail a@b.org now"), 256)).collect()}
    assert ticks == {(1, 1)} and store.touches().count() == 5


def test_very_frequent_texts_are_met_by_broadcast_and_rows_stay(spark, tmp_path):
    store = ResultStore(spark, str(tmp_path), hot_rows=50)
    rows = [(k, "ip 10.1.2.3 of all" if k % 2 else f"text {k} x{k}@y.org", "" if k % 3 else None) for k in range(600)]
    frame = spark.createDataFrame(rows, SCHEMA).withColumns({"digest": F.lit("own"), "n": F.lit(1)}).repartition(4)
    for _ in range(2):
        out = store.analysed(frame, {"x": "a", "y": "b"}).collect()
        assert sorted((r["k"], r["x"]["entity_count"], r["y"]["entity_count"], r["digest"]) for r in out) == [(k, brute(a), 0, "own") for k, a, _ in rows]
    assert store.results().count() == 301


def test_policies_share_nothing(spark, tmp_path):
    rows = spark.createDataFrame([(1, "a@b.org and 10.1.2.3", "")], SCHEMA)
    for policy in (Policy(), Policy(disabled=frozenset({"IP_ADDRESS"})), Policy()):
        got = ResultStore(spark, str(tmp_path), policy).analysed(rows, {"x": "a"}).first()["x"]["entity_count"]
        assert got == brute("a@b.org and 10.1.2.3", policy)
    with pytest.raises(ValueError):
        ResultStore(spark, str(tmp_path), recognizer=lambda texts: [[] for _ in texts])


def test_an_empty_batch_and_one_that_stops_leave_nothing(spark, tmp_path, monkeypatch):
    store = ResultStore(spark, str(tmp_path))
    assert store.analysed(spark.createDataFrame([], SCHEMA), {"x": "a"}).collect() == [] and store.ledger.current().number == 0
    rows = spark.createDataFrame([(1, "a@b.org", "a@b.org")], SCHEMA)

    def stop(*args):
        raise RuntimeError("stopped")

    with monkeypatch.context() as m:
        m.setattr(Ledger, "_publish", stop)
        with pytest.raises(RuntimeError):
            store.learn(rows, ["a"])
    assert store.results().count() == 0
    assert store.analysed(rows, {"x": "a"}).first()["x"]["entities"] == {"EMAIL_ADDRESS": 1} and store.results().count() == 1


def test_two_writers_of_one_text_give_rows_once(spark, tmp_path, monkeypatch):
    one, other = ResultStore(spark, str(tmp_path)), ResultStore(spark, str(tmp_path))
    rows = spark.createDataFrame([(1, "a@b.org", ""), (2, "c@d.org", "")], SCHEMA)
    real = one.ledger.commit

    def late(change):
        other.learn(rows, ["a"])
        return real(change)

    monkeypatch.setattr(one.ledger, "commit", late)
    assert one.analysed(rows, {"x": "a"}).count() == 2 and one.results().count() == 4
    assert one.evict(10) == 2


def test_eviction_keeps_what_was_met_last(spark, tmp_path):
    store = ResultStore(spark, str(tmp_path))
    batch = lambda texts: store.learn(spark.createDataFrame([(k, t, None) for k, t in enumerate(texts)], SCHEMA), ["a"])
    batch([f"old {k}" for k in range(30)])
    batch([f"new {k}" for k in range(10)])
    batch(["old 3", "old 4"])
    held = lambda: {r["digest"] for r in store.results().collect()}
    sha = lambda texts: {r[0] for r in spark.createDataFrame([(t,) for t in texts], "t string").select(F.sha2("t", 256)).collect()}
    assert store.evict(100) == 40
    assert 12 <= store.evict(20) <= 20
    assert held() >= sha(["old 3", "old 4", *[f"new {k}" for k in range(10)]])
    assert store.evict(12) == 12 and held() == sha(["old 3", "old 4", *[f"new {k}" for k in range(10)]])
    batch(["old 7", "old 3"])
    assert store.results().count() == 13
    assert store.evict(1) <= 1 and store.ledger.vacuum(1, 0) > 0 and store.evict(0) == 0


def test_safety_metrics_through_a_store_equal_those_without(spark, sf_dir, tmp_path):
    spans = document_pairs(spark, sf_dir)
    listed = lambda rows: sorted((r["span_id"], r["metric"], r["value"], r["metric_meta"]) for r in rows.collect())
    want = listed(derive(spans, "safety"))
    store = ResultStore(spark, str(tmp_path / "store"), hot_rows=3)
    own = Worker("safety", str(tmp_path / "out"), str(tmp_path / "check"), results=store)
    for k in range(3):
        own.on_batch(spans.where(F.col("span_id").cast("long") % 3 == k), k)
    assert listed(rows_of(spark, str(tmp_path / "out"))) == want
    texts = spark.read.parquet(f"{sf_dir}/documents.parquet").where("text <> ''").select("text").distinct().count()
    assert store.results().count() == texts
    own.on_batch(spans, 3)
    assert store.results().count() == texts
