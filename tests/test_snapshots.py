"""Snapshots of configuration: time to live, failing sources, and batches that name what they used."""

import pytest
from pyspark.sql import functions as F

from spanmill.sources.pricing import static_pricing
from spanmill.sources.snapshots import Snapshots
from spanmill.streaming import worker
from spanmill.testbed import event_spans


class Source:
    """A price table whose prices, errors and reads the test decides."""

    def __init__(self):
        self.factor, self.fails, self.reads = 1.0, False, 0

    def __call__(self, spark):
        self.reads += 1
        if self.fails:
            raise ConnectionError("no database")
        return static_pricing(spark).withColumn("per_call", F.col("per_call") * self.factor)


@pytest.fixture
def own(spark, tmp_path):
    source, at = Source(), [1000.0]
    return source, at, Snapshots(spark, str(tmp_path / "prices"), source, ttl=300, retry=10, kept=3, clock=lambda: at[0])


def call(snapshot):
    return snapshot.table.where("per_call is not null").first()["per_call"]


def test_loads_once_per_time_to_live(own):
    source, at, snapshots = own
    first = snapshots.current()
    at[0] += 299
    assert snapshots.current().name == first.name and source.reads == 1
    at[0] += 2
    assert snapshots.current().name == first.name and source.reads == 2  # the same prices
    source.factor = 2.0
    assert snapshots.current().name == first.name and source.reads == 2
    at[0] += 301
    second = snapshots.current()
    assert second.name != first.name and call(second) == 2 * call(first) and source.reads == 3
    assert snapshots.at(first.name).count() == 5
    for k in range(3, 8):
        source.factor = float(k)
        snapshots.current(force=True)
    with pytest.raises(KeyError):
        snapshots.at(first.name)


def test_the_last_good_one_serves_while_the_source_fails(own):
    source, at, snapshots = own
    source.fails = True
    with pytest.raises(ConnectionError):
        snapshots.current()
    source.fails = False
    first = snapshots.current()
    source.fails, source.factor = True, 3.0
    at[0] += 400
    late = snapshots.current()
    assert late.name == first.name and late.stale and "no database" in late.error and call(late) == call(first)
    reads = source.reads
    assert snapshots.current().stale and source.reads == reads  # not asked again at once
    at[0] += 11
    assert snapshots.current().stale and source.reads == reads + 1
    source.fails = False
    at[0] += 11
    fresh = snapshots.current()
    assert not fresh.stale and fresh.name != first.name and call(fresh) == 3 * call(first)


def test_a_batch_names_its_snapshot_and_outlives_a_failing_source(spark, sf_dir, own, tmp_path):
    source, at, snapshots = own
    lens = worker.Worker("cost", str(tmp_path / "out"), str(tmp_path / "check"), pricing=snapshots)
    spans = event_spans(spark, sf_dir)
    lens.on_batch(spans.limit(50), 0)
    at[0] += 400
    source.fails = True
    lens.on_batch(spans.limit(60), 1)
    at[0] += 400
    source.fails, source.factor = False, 2.0
    lens.on_batch(spans.limit(70), 2)
    facts = [p.facts for p in worker.ledger(spark, str(tmp_path / "out"), "rows", "cost").current().parts]
    assert [f["stale"] for f in facts] == [False, True, False] and facts[0]["prices"] == facts[1]["prices"] != facts[2]["prices"]
    assert {f["prices"] for f in facts} == {p.key for p in snapshots.ledger.current().parts}
