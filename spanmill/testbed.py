"""Spans out of the general test tables, one per event, by a rule that other engines can state too."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spans_from_events(events: DataFrame) -> DataFrame:
    """A span per event; its metadata JSON is built from value and the integer k of props."""
    k = F.get_json_object("props", "$.k").cast("long")
    ts = F.date_trunc("millisecond", F.col("ts").cast("timestamp"))
    own = events.select("event_id", "user_id", "event_type", "value", ts.alias("started_at"), k.alias("k"), F.floor(F.col("value") * 10).alias("n"))
    kind = (
        F.when(F.col("event_type") == "purchase", "model_call").when(F.col("event_type") == "click", "tool_call").when(F.col("event_type") == "view", "retrieval")
        .when(F.col("event_type") == "error", "embedding").when(F.col("event_id") % 2 == 0, "solution").otherwise("workflow")
    )
    own = own.withColumn("span_type", kind).withColumn("leaf", ~F.col("span_type").isin("solution", "workflow"))
    component = (
        F.when(F.col("span_type") == "model_call", F.when(F.col("k") % 2 == 0, "model_gpt4o").otherwise("model_claude")).when(F.col("span_type") == "tool_call", "tool_websearch")
        .when(F.col("span_type") == "retrieval", "kb_product_docs").when(F.col("span_type") == "embedding", "model_embed").otherwise("")
    )
    model = F.col("span_type") == "model_call"
    only = lambda cond, value: F.when(cond, value)
    usage = F.struct(F.col("n").alias("input_tokens"), (F.col("k") * 3).alias("output_tokens"), F.floor(F.col("n") / 4).alias("cached_tokens"), F.col("k").alias("reasoning_tokens"))
    hit = F.when(F.col("k") % 5 == 0, F.lit("true")).when(F.col("k") % 5 == 1, "0").when(F.col("k") % 5 == 2, '"True"').when(F.col("k") % 5 == 4, "false")
    plain = F.to_json(F.struct(
        only(model, usage).alias("usage"), only(F.col("span_type") == "embedding", F.col("n")).alias("embedding_tokens"), only(F.col("span_type") == "retrieval", F.col("k")).alias("search_units"),
        (F.col("k") % 3).alias("retry_count"), only(model & (F.col("k") % 4 != 0), F.col("k") * 1.5).alias("ttft_ms"), only(F.col("span_type") == "workflow", F.col("k").cast("string")).alias("queue_wait_ms"),
    ))
    metadata = F.when(hit.isNotNull(), F.concat(F.substring(plain, F.lit(1), F.length(plain) - 1), F.lit(',"rate_limit_hit":'), hit, F.lit("}"))).otherwise(plain)
    status = F.when(F.col("event_type") == "error", "error").when(F.col("k") % 10 == 0, "Timeout").otherwise("ok")
    own = own.withColumn("component_id", component)
    ended = F.expr("timestampadd(MILLISECOND, cast(floor(value * 1000) as int), started_at)")
    empty = F.lit("")
    eid = F.col("event_id").cast("string")
    return own.select(
        eid.alias("trace_id"), eid.alias("span_id"), empty.alias("parent_span_id"), empty.alias("correlation_id"), F.col("user_id").cast("string").alias("session_id"),
        "span_type", F.col("event_type").alias("span_name"), status.alias("span_status"), F.when(F.col("leaf"), "component").otherwise(F.col("span_type")).alias("scope"),
        F.when(F.col("user_id") % 2 == 0, "sol_docprocess").otherwise("sol_support").alias("solution_id"), F.when(F.col("event_id") % 3 == 0, "").otherwise("ep_ticket").alias("endpoint"),
        F.when(F.col("span_type") == "solution", "").otherwise("wf_triage").alias("workflow_id"), F.when(F.col("leaf"), "agt_triage").otherwise("").alias("agent_id"), "component_id",
        F.when(F.col("component_id").startswith("model"), "model").when(F.col("component_id") == "tool_websearch", "tool").when(F.col("component_id") == "kb_product_docs", "knowledgebase").otherwise("").alias("component_type"),
        "started_at", ended.alias("ended_at"), empty.alias("pipeline_stage"), F.lit(None).cast("short").alias("stage_order"), empty.alias("entity_type"), empty.alias("service"),
        F.when(F.col("k") % 7 == 0, "staging").otherwise("prod").alias("environment"), empty.alias("region"), metadata.alias("metadata"), F.col("started_at").alias("recorded_at"),
    )


def event_spans(spark: SparkSession, sf_dir: str, dealt: bool = False) -> DataFrame:
    """dealt: to all tasks, however few row groups the table has."""
    events = table(spark, sf_dir, "events")
    return spans_from_events(events.repartition("event_id") if dealt else events)


def document_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Model calls whose input is a document of even id and whose output is the next document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    pairs = docs.groupBy(F.floor(F.col("doc_id") / 2).alias("pair")).agg(
        F.max(F.when(F.col("doc_id") % 2 == 0, F.col("text"))).alias("input"), F.max(F.when(F.col("doc_id") % 2 == 1, F.col("text"))).alias("output")
    )
    at, empty = F.lit("2024-01-01").cast("timestamp"), F.lit("")
    sid = F.col("pair").cast("string")
    return pairs.select(
        sid.alias("trace_id"), sid.alias("span_id"), empty.alias("parent_span_id"), F.lit("model_call").alias("span_type"), F.lit("ok").alias("span_status"), F.lit("component").alias("scope"),
        F.lit("sol_support").alias("solution_id"), empty.alias("endpoint"), empty.alias("workflow_id"), empty.alias("agent_id"), F.lit("model_gpt4o").alias("component_id"), F.lit("model").alias("component_type"),
        at.alias("started_at"), at.alias("ended_at"), F.lit("prod").alias("environment"), F.to_json(F.struct("input", "output")).alias("metadata"),
    )
