"""Batches out of one file or row group reach all tasks, and their states are summed without a merge by all keys."""

import pytest
from pyspark.sql import functions as F

from spanmill.operators.rollup import base_rollup, merge
from spanmill.plans.queries import QUERIES
from spanmill.schema import DIMENSIONS
from spanmill.streaming import worker
from spanmill.testbed import event_spans


@pytest.fixture
def uncoalesced(spark):
    """Shuffles of small tables keep their partitions."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_a_batch_of_one_task_is_dealt_to_all(spark, sf_dir, tmp_path, uncoalesced):
    one = event_spans(spark, sf_dir).limit(400).coalesce(1)
    worker.Worker("performance", str(tmp_path), str(tmp_path / "check")).on_batch(one, 0)
    assert worker.rows_of(spark, str(tmp_path)).select(F.input_file_name()).distinct().count() == int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_spans_of_a_table_of_one_row_group_are_dealt(spark, sf_dir, uncoalesced):
    per_task = lambda dealt: event_spans(spark, sf_dir, dealt=dealt).groupBy(F.spark_partition_id()).count().count()
    assert per_task(False) == 1 and per_task(True) == int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_batches_of_the_tier_are_made_in_all_tasks(spark, sf_dir, monkeypatch, uncoalesced):
    class Stop(Exception):
        pass

    seen = []

    def first(self, spans, batch_id):
        seen.append(spans.groupBy(F.spark_partition_id()).count().count())
        raise Stop

    monkeypatch.setattr(worker.Worker, "on_batch", first)
    with pytest.raises(Stop):
        QUERIES["stream_tier"](spark, sf_dir)
    assert seen == [int(spark.conf.get("spark.sql.shuffle.partitions"))]


def test_partial_states_sum_to_the_merged_ones(spark, sf_dir, tmp_path):
    own, spans = worker.Worker("performance", str(tmp_path), str(tmp_path / "check")), event_spans(spark, sf_dir)
    for k in range(2):  # of the same minutes and dimensions
        own.on_batch(spans.where(f"cast(span_id as long) < {300 + k}"), k)
    total = lambda states: sorted((r["metric"], r["n"], round(r["s"], 4)) for r in states.groupBy("metric").agg(F.sum("count").alias("n"), F.sum("sum_value").alias("s")).collect())
    partials, states = worker.partials_of(spark, str(tmp_path)), worker.states_of(spark, str(tmp_path))
    assert partials.count() > states.count() and total(partials) == total(states)
    assert worker.partials_of(spark, str(tmp_path / "none")).count() == 0


def test_the_sums_of_a_stream_are_grouped_once(spark, sf_dir):
    plan = QUERIES["stream_rollup"](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate [") == 1


def test_states_are_grouped_by_bucket_first_and_keep_their_columns(spark, sf_dir):
    rows = worker.derive(event_spans(spark, sf_dir), "performance")
    for states in (base_rollup(rows), merge(base_rollup(rows), "1h")):
        assert states.columns == [*DIMENSIONS, "bucket", "count", "sum_value", "min_value", "max_value", "sum_confidence", "n_confidence", "quantiles"]
        plan = states._jdf.queryExecution().optimizedPlan().toString()
        assert plan.split("Aggregate [", 1)[1].startswith(("bucket#", "_groupingexpression#"))
    assert merge(base_rollup(rows), by=["metric"]).columns[:3] == ["metric", "bucket", "count"]
