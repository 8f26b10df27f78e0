"""Ledgers, compaction, retention and tiers: whatever stops where, nothing is lost or counted twice."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from spanmill.operators.derive import derive
from spanmill.operators.rollup import base_rollup, merge
from spanmill.sources.ledger import Ledger, Part
from spanmill.streaming import tiers, worker
from spanmill.testbed import event_spans


class Stop(Exception):
    pass


@pytest.fixture
def batches(spark, sf_dir):
    """Batches of spans of all hours, so that every batch has late ones."""
    spans = event_spans(spark, sf_dir).where("cast(span_id as long) < 600").coalesce(2).cache()
    return [spans.where(F.pmod(F.xxhash64("span_id"), F.lit(6)) == k) for k in range(6)]


def counted(states):
    keys = ("metric", "scope", "solution_id", "component_id", "endpoint", "environment", "workflow_id", "bucket")
    return {tuple(str(r[c]) for c in keys): (r["count"], round(r["sum_value"], 5), r["min_value"], r["max_value"]) for r in states.collect()}


def expected(frames, window=None):
    rows = derive(frames[0], "performance")
    for f in frames[1:]:
        rows = rows.unionAll(derive(f, "performance"))
    states = base_rollup(rows)
    return counted(merge(states, window) if window else states)


def test_of_two_commits_one_reads_anew(spark, tmp_path):
    own, other = Ledger(spark, str(tmp_path)), Ledger(spark, str(tmp_path))
    numbers = spark.range(3)
    own.put("a", own.stage(numbers))
    late = own.stage(numbers)
    seen = []

    def change(old):
        seen.append(old.number)
        if len(seen) == 1:
            other.put("b", other.stage(spark.range(5)))
        return (*old.parts, Part("c", late)), old.facts

    assert own.commit(change).number == 3 and seen == [1, 2]
    assert [p.key for p in own.current().parts] == ["a", "b", "c"] and own.read(numbers.schema).count() == 11
    before = own.current()
    own.put("b", own.stage(spark.range(1)))
    assert own.read(numbers.schema, before).count() == 11 and own.read(numbers.schema).count() == 7
    assert own.vacuum(keep=1, grace_ms=0) == 1 and own.read(numbers.schema).count() == 7
    assert Ledger(spark, str(tmp_path / "none")).read(numbers.schema).count() == 0


STEPS = [("stage", 1), ("stage", 2), ("_publish", 1), ("_publish", 2), ("vacuum", 0)]


@pytest.mark.parametrize("where", [(s, k, after) for s, k in STEPS for after in (False, True) if after or s != "vacuum"])
def test_a_stop_after_any_step_loses_and_doubles_nothing(spark, batches, tmp_path, monkeypatch, where):
    """A worker, a replay, a compaction, and a vacuum, with a stop before or after the k-th call of a step of theirs; then all is done again."""
    step, at, after = where
    out, calls = str(tmp_path), Counter()
    own = worker.Worker("performance", out, str(tmp_path / "check"))
    for k, b in enumerate(batches[:3]):
        own.on_batch(b, k)
    real = getattr(Ledger, step)

    def stopping(self, *args, **kwargs):
        calls[step] += 1
        if calls[step] == at + 1 and not after:
            raise Stop
        result = real(self, *args, **kwargs)
        if calls[step] == at + 1:
            raise Stop
        return result

    jobs = [lambda: own.on_batch(batches[2], 2), lambda: worker.compact(spark, out, "performance", 2), lambda: worker.ledger(spark, out, "states", "performance").vacuum(1, 0), lambda: own.on_batch(batches[0], 0)]
    want = expected(batches[:3])
    monkeypatch.setattr(Ledger, step, stopping)
    for job in jobs:
        try:
            job()
        except Stop:
            monkeypatch.setattr(Ledger, step, real)
            assert counted(worker.states_of(spark, out)) == want
            job()
    monkeypatch.setattr(Ledger, step, real)
    assert counted(worker.states_of(spark, out)) == want
    assert len(worker.ledger(spark, out, "states", "performance").current().parts) == 2
    assert worker.rows_of(spark, out).count() == sum(derive(b, "performance").count() for b in batches[:3])


def test_a_tier_equals_the_full_merge_after_late_and_replayed_batches(spark, batches, tmp_path):
    out = str(tmp_path)
    own = worker.Worker("performance", out, str(tmp_path / "check"))
    same = lambda frames: counted(tiers.read_tier(spark, out, "performance")) == expected(frames, "1h")
    stored = lambda: counted(worker.ledger(spark, out, "tier-1h", "performance").read(worker.schema_of(worker.ledger(spark, out, "states", "performance").current())))
    own.on_batch(batches[0], 0)
    assert same(batches[:1])  # no tier yet
    assert tiers.refresh(spark, out, "performance") > 0 and tiers.refresh(spark, out, "performance") == 0
    assert stored() == expected(batches[:1], "1h")
    own.on_batch(batches[1], 1)  # late rows in most hours
    assert same(batches[:2]) and stored() == expected(batches[:1], "1h")
    tiers.refresh(spark, out, "performance")
    own.on_batch(batches[1], 1)  # a replay
    own.on_batch(batches[2], 2)
    worker.compact(spark, out, "performance", 2)
    assert same(batches[:3])
    tiers.refresh(spark, out, "performance")
    assert stored() == expected(batches[:3], "1h")
    own.on_batch(batches[0], 0)  # a replay of what is merged
    worker.compact(spark, out, "performance", 9)
    assert tiers.refresh(spark, out, "performance") == 0 and same(batches[:3])


def test_late_rows_renew_only_their_hours_and_a_replay_without_them_takes_them_back(spark, batches, tmp_path):
    out = str(tmp_path)
    own = worker.Worker("performance", out, str(tmp_path / "check"))
    for k, b in enumerate(batches[:3]):
        own.on_batch(b, k)
    tiers.refresh(spark, out, "performance")
    one = batches[3].limit(1).cache()
    own.on_batch(one, 3)
    assert tiers.refresh(spark, out, "performance") == 1
    assert counted(tiers.read_tier(spark, out, "performance")) == expected([*batches[:3], one], "1h")
    own.on_batch(one.where("false"), 3)  # another attempt that holds other rows
    assert tiers.refresh(spark, out, "performance") >= 1
    assert counted(worker.ledger(spark, out, "tier-1h", "performance").read(worker.schema_of(worker.ledger(spark, out, "states", "performance").current()))) == expected(batches[:3], "1h")


def test_a_refresh_that_stops_is_repeated(spark, batches, tmp_path, monkeypatch):
    out = str(tmp_path)
    own = worker.Worker("performance", out, str(tmp_path / "check"))
    own.on_batch(batches[0], 0)
    tiers.refresh(spark, out, "performance")
    own.on_batch(batches[1], 1)
    for step in ("stage", "_publish"):
        def stop(self, *args, **kwargs):
            raise Stop
        real = getattr(Ledger, step)
        monkeypatch.setattr(Ledger, step, stop)
        with pytest.raises(Stop):
            tiers.refresh(spark, out, "performance")
        monkeypatch.setattr(Ledger, step, real)
        assert counted(tiers.read_tier(spark, out, "performance")) == expected(batches[:2], "1h")
    tiers.refresh(spark, out, "performance")
    assert counted(tiers.read_tier(spark, out, "performance")) == expected(batches[:2], "1h")


def test_retention_drops_old_rows_once_and_the_tier_keeps_its_own(spark, batches, tmp_path):
    out = str(tmp_path)
    own = worker.Worker("performance", out, str(tmp_path / "check"))
    own.on_batch(batches[0], 0)
    own.on_batch(batches[1], 1)
    tiers.refresh(spark, out, "performance")
    last = worker.rows_of(spark, out).agg(F.max("ts")).first()[0]
    whole = expected(batches[:2])
    days = 5
    cut = spark.range(1).select(F.date_trunc("day", F.lit(last)) - F.make_interval(days=F.lit(days))).first()[0]
    for kind in ("states", "rows"):
        worker.retain(spark, out, kind, "performance", last, days)
    kept = counted(worker.states_of(spark, out))
    assert kept == {k: v for k, v in whole.items() if k[-1] >= str(cut)} and 0 < len(kept) < len(whole)
    assert worker.rows_of(spark, out).agg(F.min("ts")).first()[0] >= cut
    assert tiers.refresh(spark, out, "performance") == 0 and counted(tiers.read_tier(spark, out, "performance")) == expected(batches[:2], "1h")
    own.on_batch(batches[2], 2)  # late rows of hours that the base doesn't hold any more
    want = expected(batches[:3], "1h")
    assert counted(tiers.read_tier(spark, out, "performance")) == want
    tiers.refresh(spark, out, "performance")
    assert counted(tiers.read_tier(spark, out, "performance")) == want
    worker.retain(spark, out, "states", "performance", last, days)
    worker.compact(spark, out, "performance", 9)
    own.on_batch(batches[0], 0)  # a batch that was dropped isn't taken in again
    assert counted(worker.states_of(spark, out)) == {k: v for k, v in expected(batches[:3]).items() if k[-1] >= str(cut)}


def test_ranges_of_batches():
    rng = random.Random(2)
    ids = rng.sample(range(60), 40)
    out = worker.ranges([[k, k] for k in ids])
    assert sorted(ids) == [x for a, b in out for x in range(a, b + 1)] and all(a[1] + 1 < b[0] for a, b in zip(out, out[1:]))


def test_polling_resumes_at_ties_and_counts_a_stopped_batch_once(spark, sf_dir, tmp_path):
    from spanmill.sources import spans as io

    spans = event_spans(spark, sf_dir).limit(60).withColumn("recorded_at", F.timestamp_seconds(F.lit(1_700_000_000) + F.floor(F.col("span_id").cast("long") / 20))).cache()
    cursors, lens, sizes = io.Cursors(spark, str(tmp_path / "cursors"), kept=2), worker.Worker("performance", str(tmp_path / "out"), str(tmp_path / "check")), []

    def handle(batch, number):
        sizes.append((number, batch.count()))
        lens.on_batch(batch, number)
        if len(sizes) == 2:
            raise Stop  # after its rows were committed, before the cursor moved

    with pytest.raises(Stop):
        io.poll(spans, cursors, "performance", 25, handle)
    assert io.poll(spans, cursors, "performance", 25, handle) == 2
    assert sizes == [(0, 25), (1, 25), (1, 25), (2, 10)] and io.poll(spans, cursors, "performance", 25, handle) == 0
    assert counted(worker.states_of(spark, str(tmp_path / "out"))) == expected([spans])
    cursors.save("performance", "2001-01-01 00:00:00.000000", "z")
    assert cursors.load("performance")[0] > "2023" and cursors.batch("performance") == 3
    assert len(cursors.ledger._names("versions")) <= 3
