"""The registered queries over the test tables, each with SQL for the oracle where SQL can express it."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanmill.operators import evaluate, parity, pii, readtime, rollup, thresholds
from spanmill.operators.derive import derive
from spanmill.operators.quantiles import exact_quantiles
from spanmill.operators.results import ResultStore
from spanmill.plans.readplan import compile_metrics
from spanmill.plans.registry import LENSES, catalogue, every_metric
from spanmill.sources import config
from spanmill.sources.ledger import kept, scratch
from spanmill.sources.pricing import STATIC, static_pricing
from spanmill.sources.spans import next_batch
from spanmill.testbed import document_pairs, event_spans, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

# --- The oracle's own statement of spans and metric rows, from k and value rather than from JSON ---
_PRICES = "prices(component_id, pin, pout, pcached, pcall, pquery) AS (VALUES " + ", ".join(
    f"('{c}', {i or 0.0}::DOUBLE, {o or 0.0}::DOUBLE, {h or 0.0}::DOUBLE, {a or 0.0}::DOUBLE, {q or 0.0}::DOUBLE)" for c, _, i, o, h, a, q in STATIC
) + ")"
_SPANS = """
ev AS (
  SELECT event_id, user_id, event_type, value, date_trunc('millisecond', ts) AS started_at, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, CAST(floor(value * 10) AS BIGINT) AS n,
    CASE event_type WHEN 'purchase' THEN 'model_call' WHEN 'click' THEN 'tool_call' WHEN 'view' THEN 'retrieval' WHEN 'error' THEN 'embedding'
      ELSE CASE WHEN event_id % 2 = 0 THEN 'solution' ELSE 'workflow' END END AS span_type
  FROM events
), sp AS (
  SELECT *, CAST(event_id AS VARCHAR) AS span_id, span_type NOT IN ('solution', 'workflow') AS leaf, CAST(floor(value * 1000) AS BIGINT) AS ms,
    started_at + to_milliseconds(CAST(floor(value * 1000) AS BIGINT)) AS ended_at,
    CASE WHEN event_type = 'error' THEN 'error' WHEN k % 10 = 0 THEN 'timeout' ELSE 'ok' END AS status,
    CASE WHEN user_id % 2 = 0 THEN 'sol_docprocess' ELSE 'sol_support' END AS solution_id,
    CASE WHEN event_id % 3 = 0 THEN '' ELSE 'ep_ticket' END AS endpoint,
    CASE WHEN span_type = 'solution' THEN '' ELSE 'wf_triage' END AS workflow_id,
    CASE WHEN k % 7 = 0 THEN 'staging' ELSE 'prod' END AS environment,
    CASE span_type WHEN 'model_call' THEN CASE WHEN k % 2 = 0 THEN 'model_gpt4o' ELSE 'model_claude' END WHEN 'tool_call' THEN 'tool_websearch'
      WHEN 'retrieval' THEN 'kb_product_docs' WHEN 'embedding' THEN 'model_embed' ELSE '' END AS component_id,
    CASE WHEN span_type IN ('solution', 'workflow') THEN span_type ELSE 'component' END AS own_scope
  FROM ev
), fan AS (
  SELECT *, own_scope AS scope FROM sp
  UNION ALL SELECT *, 'endpoint' AS scope FROM sp WHERE own_scope = 'solution' AND endpoint <> ''
), priced AS (
  SELECT sp.*, coalesce(pin, 0) AS pin, coalesce(pout, 0) AS pout, coalesce(pcached, 0) AS pcached, coalesce(pcall, 0) AS pcall, coalesce(pquery, 0) AS pquery,
    CASE WHEN span_type = 'model_call' THEN CAST(n AS DOUBLE) ELSE 0 END AS it, CASE WHEN span_type = 'model_call' THEN CAST(k * 3 AS DOUBLE) ELSE 0 END AS ot,
    CASE WHEN span_type = 'model_call' THEN CAST(floor(n / 4) AS DOUBLE) ELSE 0 END AS ct, CASE WHEN span_type = 'model_call' THEN CAST(k AS DOUBLE) ELSE 0 END AS rt,
    CASE WHEN span_type = 'embedding' THEN CAST(n AS DOUBLE) ELSE 0 END AS et, CAST(k % 3 AS DOUBLE) AS retries
  FROM sp LEFT JOIN prices USING (component_id)
), costed AS (
  SELECT *, (it - ct) / 1000.0::DOUBLE * pin + ct / 1000.0::DOUBLE * pcached AS raw_in, ot / 1000.0::DOUBLE * pout AS raw_out, et / 1000.0::DOUBLE * pin AS raw_emb FROM priced
), cost AS (
  SELECT *, CASE span_type WHEN 'model_call' THEN raw_in + raw_out WHEN 'embedding' THEN raw_emb WHEN 'tool_call' THEN pcall WHEN 'retrieval' THEN pquery ELSE 0 END AS raw FROM costed
)"""
_WITH = f"WITH {_PRICES}, {_SPANS}"


def _money(x: str, places: int = 8) -> str:
    return f"(floor({x} * 1e{places} + 0.5) / 1e{places})"


def _perf_rows() -> str:
    """Rows (span_id, scope, metric, value, ...) of the performance lens."""
    cols = "span_id, scope, solution_id, endpoint, component_id, environment, ended_at AS ts"
    hit = "CASE k % 5 WHEN 0 THEN 1.0 WHEN 2 THEN 1.0 ELSE 0.0 END"
    parts = [
        ("latency", "CAST(ms AS DOUBLE)", "true"), ("error_rate", "CASE WHEN status IN ('error', 'timeout') THEN 1.0 ELSE 0.0 END", "true"),
        ("timeout_count", "CASE WHEN status = 'timeout' THEN 1.0 ELSE 0.0 END", "true"), ("time_to_first_token", "k * 1.5", "span_type = 'model_call' AND k % 4 <> 0"),
        ("queue_wait_time", "CAST(k AS DOUBLE)", "span_type = 'workflow'"), ("retry_count", "CAST(k % 3 AS DOUBLE)", "leaf"),
        ("rate_limit_hit", hit, "span_type IN ('model_call', 'tool_call') AND k % 5 <> 3"),
        ("token_throughput", "round(k * 3 / (ms / 1000.0::DOUBLE), 4)", "span_type = 'model_call' AND ms <> 0"),
    ]
    return " UNION ALL ".join(f"SELECT {cols}, '{m}' AS metric, CAST({v} AS DOUBLE) AS value FROM fan WHERE {w}" for m, v, w in parts)


def _cost_rows() -> str:
    cols = "span_id, own_scope AS scope, solution_id, endpoint, component_id, environment, ended_at AS ts"
    llm = "span_type = 'model_call'"
    failed = "status IN ('error', 'timeout')"
    parts = [
        ("input_tokens", "it", llm), ("output_tokens", "ot", llm), ("total_tokens", "it + ot", llm), ("cached_tokens", "ct", llm), ("reasoning_tokens", "rt", llm),
        ("embedding_tokens", "et", "span_type = 'embedding'"), ("search_units", "CAST(k AS DOUBLE)", "span_type = 'retrieval'"), ("cost", _money("raw"), "true"),
        ("input_cost", _money("raw_in"), llm), ("output_cost", _money("raw_out"), llm), ("tool_api_cost", _money("pcall"), "span_type = 'tool_call'"),
        ("embedding_cost", _money("raw_emb"), "span_type = 'embedding'"), ("wasted_cost", f"CASE WHEN {failed} THEN {_money('raw')} ELSE 0 END", "true"),
        ("retry_cost", _money("raw * retries"), "true"), ("cost_per_token", _money("raw / (it + ot)", 10), f"{llm} AND it + ot <> 0"),
        ("cache_savings", _money("ct / 1000.0::DOUBLE * greatest(0.0::DOUBLE, pin - pcached)"), llm),
    ]
    return " UNION ALL ".join(f"SELECT {cols}, '{m}' AS metric, CAST({v} AS DOUBLE) AS value FROM cost WHERE leaf AND {w}" for m, v, w in parts)


_PERF, _COST = f"{_WITH}, rows AS ({_perf_rows()})", f"{_WITH}, rows AS ({_cost_rows()})"


def query(name: str, sql: str | None = None):
    def register(f):
        QUERIES[name] = f
        if sql is not None:
            SQL[name] = sql
        return f

    return register


def _perf(spark: SparkSession, sf_dir: str, metrics: set[str] | None = None) -> DataFrame:
    return derive(event_spans(spark, sf_dir), "performance", metrics=metrics)


def _costs(spark: SparkSession, sf_dir: str, metrics: set[str] | None = None) -> DataFrame:
    return derive(event_spans(spark, sf_dir), "cost", static_pricing(spark), metrics=metrics)


def _eav(name: str, lens: str, metrics: tuple[str, ...]) -> None:
    source, rows = (_perf, _PERF) if lens == "performance" else (_costs, _COST)
    listed = ", ".join(f"'{m}'" for m in metrics)
    query(name, f"{rows} SELECT span_id, scope, metric, value FROM rows WHERE metric IN ({listed})")(
        lambda spark, sf_dir: source(spark, sf_dir, set(metrics)).select("span_id", "scope", "metric", "value")
    )


_eav("perf_latency_eav", "performance", ("latency",))
_eav("perf_status_flags", "performance", ("error_rate", "timeout_count"))
_eav("perf_metadata_numeric", "performance", ("time_to_first_token", "queue_wait_time", "retry_count"))
_eav("perf_metadata_bool", "performance", ("rate_limit_hit",))
_eav("perf_token_throughput", "performance", ("token_throughput",))
_eav("cost_tokens_eav", "cost", ("input_tokens", "output_tokens", "total_tokens", "cached_tokens", "reasoning_tokens", "embedding_tokens", "search_units"))
_eav("cost_money_eav", "cost", ("cost", "input_cost", "output_cost", "tool_api_cost", "embedding_cost"))
_eav("cost_wasted_retry_savings", "cost", ("wasted_cost", "retry_cost", "cache_savings"))
_eav("cost_per_token", "cost", ("cost_per_token",))


@query("scope_fanout_counts", f"""{_WITH} SELECT scope, endpoint,
  CASE WHEN scope IN ('solution', 'endpoint') THEN '' ELSE workflow_id END AS workflow_id,
  CASE WHEN scope IN ('solution', 'endpoint', 'workflow') OR NOT leaf THEN '' ELSE 'agt_triage' END AS agent_id,
  CASE WHEN scope = 'component' THEN component_id ELSE '' END AS component_id, count(*) AS n FROM fan GROUP BY ALL""")
def scope_fanout_counts(spark, sf_dir):
    return _perf(spark, sf_dir, {"latency"}).groupBy("scope", "endpoint", "workflow_id", "agent_id", "component_id").agg(F.count("*").alias("n"))


# The metrics, stated apart from the registry that they are held against.
_SPEC_VALUES = """
  ('performance', 'latency', 'ms', '5m', true, true), ('performance', 'error_rate', 'ratio', '5m', true, true),
  ('performance', 'timeout_count', 'count', '5m', false, true), ('performance', 'time_to_first_token', 'ms', '5m', true, true),
  ('performance', 'inter_token_latency', 'ms', '5m', false, true), ('performance', 'queue_wait_time', 'ms', '5m', false, true),
  ('performance', 'scheduling_delay', 'ms', '5m', false, true), ('performance', 'retry_count', 'count', '15m', true, true),
  ('performance', 'retry_delay', 'ms', '15m', false, true), ('performance', 'rate_limit_hit', 'ratio', '5m', false, true),
  ('performance', 'rate_limit_wait', 'ms', '5m', false, true), ('performance', 'records_processed', 'count', '5m', false, true),
  ('performance', 'batch_size', 'count', '5m', false, true), ('performance', 'token_throughput', 'tok/sec', '5m', false, true),
  ('performance', 'throughput', 'ops/sec', '5m', true, false), ('performance', 'concurrency', 'gauge', '5m', false, false),
  ('performance', 'messages_in_flight', 'gauge', '5m', false, false), ('cost', 'input_tokens', 'count', '1h', false, true),
  ('cost', 'output_tokens', 'count', '1h', false, true), ('cost', 'total_tokens', 'count', '1h', true, true),
  ('cost', 'cached_tokens', 'count', '1h', false, true), ('cost', 'reasoning_tokens', 'count', '1h', false, true),
  ('cost', 'embedding_tokens', 'count', '1h', false, true), ('cost', 'search_units', 'count', '1h', false, true),
  ('cost', 'cost', 'USD', '1d', true, true), ('cost', 'input_cost', 'USD', '1d', false, true),
  ('cost', 'output_cost', 'USD', '1d', false, true), ('cost', 'tool_api_cost', 'USD', '1d', false, true),
  ('cost', 'embedding_cost', 'USD', '1d', false, true), ('cost', 'infrastructure_cost', 'USD', '1d', false, false),
  ('cost', 'cost_per_outcome', 'USD', '1d', true, false), ('cost', 'wasted_cost', 'USD', '1d', false, true),
  ('cost', 'retry_cost', 'USD', '1d', false, true), ('cost', 'cost_per_token', 'USD/token', '1h', false, true),
  ('cost', 'cache_savings', 'USD', '1d', false, true), ('cost', 'cost_per_record', 'USD', '1d', false, false),
  ('cost', 'budget_utilization', '0-1', '1h', true, false), ('cost', 'burn_rate', 'USD/hr', '1h', true, false),
  ('cost', 'projected_cost', 'USD', '1d', false, false), ('safety', 'pii_count', 'count', '1h', true, true),
  ('safety', 'pii_detected', 'ratio', '1h', true, true), ('safety', 'pii_distinct_types', 'count', '1h', false, true)"""


@query("spec_catalogue", f"""{_WITH}, found AS (SELECT metric, count(*) AS n FROM ({_perf_rows()} UNION ALL {_cost_rows()}) GROUP BY metric),
  pairs AS (SELECT count(DISTINCT doc_id // 2) AS n FROM documents), t(lens, metric, unit, "window", threshold, per_span) AS (VALUES {_SPEC_VALUES})
  SELECT t.*, CASE WHEN lens = 'safety' THEN (SELECT n FROM pairs) ELSE coalesce(found.n, 0) END AS found FROM t LEFT JOIN found USING (metric)""")
def spec_catalogue(spark, sf_dir):
    """Every metric of the registry, with the rows that events and pairs of documents have of it."""
    rows = [_perf(spark, sf_dir), _costs(spark, sf_dir), derive(document_pairs(spark, sf_dir), "safety")]
    counts = rows[0].select("metric").unionAll(rows[1].select("metric")).unionAll(rows[2].select("metric")).groupBy("metric").agg(F.count("*").alias("found"))
    own = catalogue(spark).select("lens", "metric", "unit", "window", "threshold", "per_span")
    return own.join(counts, "metric", "left").select(*own.columns, F.coalesce("found", F.lit(0)).alias("found"))


@query("cost_by_solution", f"{_COST} SELECT solution_id, round(sum(value), 6) AS total, count(*) AS n FROM rows WHERE metric = 'cost' AND component_id <> '' GROUP BY solution_id")
def cost_by_solution(spark, sf_dir):
    return rollup.total_by(_costs(spark, sf_dir, {"cost"}), "cost", "solution_id").withColumn("total", F.round("total", 6))


@query("cost_top_components", f"{_COST} SELECT component_id, round(sum(value), 6) AS total FROM rows WHERE metric = 'cost' GROUP BY component_id ORDER BY total DESC LIMIT 3")
def cost_top_components(spark, sf_dir):
    return rollup.total_by(_costs(spark, sf_dir, {"cost"}), "cost", "component_id").select("component_id", F.round("total", 6).alias("total")).orderBy(F.desc("total")).limit(3)


_DUCK_BUCKET = {"1m": "date_trunc('minute', ts)", "5m": "time_bucket(INTERVAL 5 MINUTE, ts)", "15m": "time_bucket(INTERVAL 15 MINUTE, ts)", "1h": "date_trunc('hour', ts)", "1d": "date_trunc('day', ts)"}


def _rolled(name: str, window: str) -> None:
    keys = "scope, solution_id, endpoint, component_id, environment, metric"
    sql = f"""{_PERF} SELECT {keys}, CAST(epoch({_DUCK_BUCKET[window]}) AS BIGINT) AS bucket_s, count(*) AS count, round(sum(value), 4) AS sum_value,
      min(value) AS min_value, max(value) AS max_value, floor(round(sum(value), 4) / count(*) * 1e4 + 0.5) / 1e4 AS avg_value FROM rows GROUP BY ALL"""

    def run(spark, sf_dir):
        keys = ["scope", "solution_id", "endpoint", "component_id", "environment", "metric"]
        out = rollup.base_rollup(_perf(spark, sf_dir), window, sketch=False, by=keys)
        return out.select(
            "scope", "solution_id", "endpoint", "component_id", "environment", "metric", F.unix_seconds("bucket").alias("bucket_s"), "count", F.round("sum_value", 4).alias("sum_value"),
            "min_value", "max_value", (F.floor(F.round("sum_value", 4) / F.col("count") * 1e4 + 0.5) / 1e4).alias("avg_value"),
        )

    query(name, sql)(run)


for _w in ("1m", "5m", "15m", "1h", "1d"):
    _rolled(f"rollup_{_w}", _w)


@query("rollup_exact_quantiles", f"""{_PERF} SELECT solution_id, scope, round(quantile_cont(value, 0.5), 4) AS p50, round(quantile_cont(value, 0.95), 4) AS p95
  FROM rows WHERE metric = 'latency' GROUP BY solution_id, scope""")
def rollup_exact_quantiles(spark, sf_dir):
    found = exact_quantiles(_perf(spark, sf_dir, {"latency"}), ["solution_id", "scope"], "value", [0.5, 0.95], names=["p50", "p95"])
    return found.select("solution_id", "scope", F.round("p50", 4).alias("p50"), F.round("p95", 4).alias("p95"))


@query("rollup_sketch_quantiles")
def rollup_sketch_quantiles(spark, sf_dir):
    states = rollup.merge(rollup.base_rollup(_perf(spark, sf_dir, {"latency"})), "1d", by=["solution_id", "scope"])
    return states.select("solution_id", "scope", "bucket", "count", rollup.average().alias("avg"), *[rollup.quantile(q).alias(f"p{round(q * 100)}") for q in (0.5, 0.95, 0.99)])


@query("metric_counts", f"{_PERF} SELECT metric, count(*) AS n FROM rows GROUP BY metric ORDER BY metric")
def metric_counts(spark, sf_dir):
    return _perf(spark, sf_dir).groupBy("metric").agg(F.count("*").alias("n")).orderBy("metric")


_COUNTED = ("events", "documents", "conversations", "lineitem")


@query("table_counts_union", " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS n FROM {t}" for t in _COUNTED))
def table_counts_union(spark, sf_dir):
    parts = [table(spark, sf_dir, t).agg(F.count("*").alias("n")).select(F.lit(t).alias("table_name"), "n") for t in _COUNTED]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionAll(p)
    return out


@query("read_throughput", f"""{_PERF} SELECT scope, solution_id, endpoint, CAST(epoch({_DUCK_BUCKET['1h']}) AS BIGINT) AS bucket_s, round(count(*) / 3600.0, 6) AS value
  FROM rows WHERE metric = 'latency' AND scope IN ('solution', 'endpoint', 'workflow', 'agent') GROUP BY ALL""")
def read_throughput(spark, sf_dir):
    own = readtime.throughput(_perf(spark, sf_dir, {"latency"}), "1h")
    return own.select("scope", "solution_id", "endpoint", F.unix_seconds("bucket").alias("bucket_s"), F.round("value", 6).alias("value"))


@query("read_concurrency", f"""{_WITH}, w AS (
    SELECT solution_id, started_at AS a, ended_at AS b, unnest(generate_series(CAST(floor(epoch_us(started_at) / 3600000000) AS BIGINT), CAST(floor((epoch_us(ended_at) - 1) / 3600000000) AS BIGINT))) AS h
    FROM sp WHERE ended_at > started_at
  ), e AS (
    SELECT solution_id, h, greatest(epoch_us(a), h * 3600000000) AS t, 1 AS d FROM w UNION ALL SELECT solution_id, h, least(epoch_us(b), (h + 1) * 3600000000) AS t, -1 AS d FROM w
  ), r AS (SELECT solution_id, h, sum(d) OVER (PARTITION BY solution_id, h ORDER BY t, d ROWS UNBOUNDED PRECEDING) AS o FROM e)
  SELECT solution_id, h * 3600 AS bucket_s, CAST(max(o) AS BIGINT) AS value FROM r GROUP BY ALL""")
def read_concurrency(spark, sf_dir):
    return readtime.concurrency(event_spans(spark, sf_dir)).select("solution_id", F.unix_seconds("bucket").alias("bucket_s"), "value")


@query("read_burn_rate", f"{_COST} SELECT solution_id, round(sum(value) / 24.0, 6) AS value FROM rows WHERE metric = 'cost' GROUP BY solution_id")
def read_burn_rate(spark, sf_dir):
    return readtime.burn_rate(_costs(spark, sf_dir, {"cost"}), 24).withColumn("value", F.round("value", 6))


@query("read_projected_cost", f"{_COST} SELECT solution_id, round(sum(value) / 24.0 * 720.0, 4) AS value FROM rows WHERE metric = 'cost' GROUP BY solution_id")
def read_projected_cost(spark, sf_dir):
    return readtime.projected_cost(_costs(spark, sf_dir, {"cost"}), 24, 720).withColumn("value", F.round("value", 4))


@query("read_cost_per_record", f"""{_COST}, c AS (SELECT solution_id, sum(value) AS cost FROM rows WHERE metric = 'cost' GROUP BY solution_id), n AS (SELECT solution_id, count(*) AS n FROM sp WHERE NOT leaf GROUP BY solution_id)
  SELECT solution_id, round(cost / n, 6) AS value FROM c JOIN n USING (solution_id)""")
def read_cost_per_record(spark, sf_dir):
    counts = event_spans(spark, sf_dir).where(F.col("span_type").isin("solution", "workflow")).groupBy("solution_id").agg(F.count("*").alias("n"))
    return readtime.cost_per(_costs(spark, sf_dir, {"cost"}), counts).withColumn("value", F.round("value", 6))


_READ = ("throughput", "concurrency", "messages_in_flight", "infrastructure_cost", "burn_rate", "projected_cost", "cost_per_record", "cost_per_outcome", "budget_utilization")


@query("read_metrics", f"""{_WITH}, q AS (SELECT *, if(scope = 'workflow', workflow_id, '') AS wf FROM fan WHERE scope IN ('solution', 'endpoint', 'workflow')), -- no span here is an agent's
  l AS (SELECT 'cost' AS metric, 'solution' AS scope, solution_id, '' AS endpoint, '' AS workflow_id, {_money('raw')} AS value, ended_at AS ts, true AS leaf FROM cost WHERE leaf
    UNION ALL SELECT 'cost', 'workflow', solution_id, '', workflow_id, {_money('raw')}, ended_at, true FROM cost WHERE leaf AND workflow_id <> ''),
  o AS (SELECT scope, solution_id, if(scope = 'endpoint', endpoint, '') AS endpoint, wf AS workflow_id, ended_at AS ts, started_at, ended_at, k, user_id, status FROM q),
  r AS (SELECT metric, scope, solution_id, endpoint, workflow_id, value, ts FROM l UNION ALL SELECT 'latency', scope, solution_id, endpoint, workflow_id, 1.0::DOUBLE, ts FROM o
    UNION ALL SELECT 'records_processed', scope, solution_id, endpoint, workflow_id, CAST(k % 3 AS DOUBLE), ts FROM o UNION ALL SELECT 'goal_achieved', scope, solution_id, endpoint, workflow_id, CASE WHEN status = 'ok' THEN 1.0::DOUBLE ELSE 0 END, ts FROM o
    UNION ALL SELECT 'messages_in_flight', scope, solution_id, endpoint, workflow_id, CAST(user_id % 7 AS DOUBLE), ts FROM o UNION ALL SELECT 'infrastructure_cost', scope, solution_id, endpoint, workflow_id, 0.25::DOUBLE, ts FROM o
    UNION ALL SELECT 'budget', scope, solution_id, endpoint, workflow_id, 40.0::DOUBLE, ts FROM o),
  g AS (SELECT scope, solution_id, endpoint, workflow_id, CAST(epoch(date_trunc('day', ts)) AS BIGINT) AS bucket_s, count(*) FILTER (metric = 'latency') AS spans, sum(value) FILTER (metric = 'cost') AS cost, sum(value) FILTER (metric = 'records_processed') AS records,
    sum(value) FILTER (metric = 'goal_achieved') AS goals, max(value) FILTER (metric = 'messages_in_flight') AS messages, sum(value) FILTER (metric = 'infrastructure_cost') AS infra, max(value) FILTER (metric = 'budget') AS budget FROM r GROUP BY ALL),
  w AS (SELECT scope, solution_id, endpoint, workflow_id, started_at AS a, ended_at AS b, unnest(generate_series(CAST(floor(epoch_us(started_at) / 86400000000) AS BIGINT), CAST(floor((epoch_us(ended_at) - 1) / 86400000000) AS BIGINT))) AS h FROM o WHERE ended_at > started_at),
  e AS (SELECT scope, solution_id, endpoint, workflow_id, h, greatest(epoch_us(a), h * 86400000000) AS t, 1 AS d FROM w UNION ALL SELECT scope, solution_id, endpoint, workflow_id, h, least(epoch_us(b), (h + 1) * 86400000000), -1 FROM w),
  c AS (SELECT *, sum(d) OVER (PARTITION BY scope, solution_id, endpoint, workflow_id, h ORDER BY t, d ROWS UNBOUNDED PRECEDING) AS n FROM e),
  v AS (SELECT 'throughput' AS metric, * EXCLUDE (spans, cost, records, goals, messages, infra, budget), spans / 86400.0::DOUBLE AS value FROM g WHERE spans > 0
    UNION ALL SELECT 'messages_in_flight', * EXCLUDE (spans, cost, records, goals, messages, infra, budget), messages FROM g WHERE scope <> 'endpoint' UNION ALL SELECT 'infrastructure_cost', * EXCLUDE (spans, cost, records, goals, messages, infra, budget), infra FROM g WHERE scope <> 'endpoint'
    UNION ALL SELECT 'burn_rate', * EXCLUDE (spans, cost, records, goals, messages, infra, budget), cost / 24 FROM g WHERE scope <> 'endpoint' UNION ALL SELECT 'projected_cost', * EXCLUDE (spans, cost, records, goals, messages, infra, budget), cost / 24 * 720 FROM g WHERE scope = 'solution'
    UNION ALL SELECT 'cost_per_record', * EXCLUDE (spans, cost, records, goals, messages, infra, budget), cost / records FROM g WHERE scope <> 'endpoint' AND records > 0 UNION ALL SELECT 'cost_per_outcome', * EXCLUDE (spans, cost, records, goals, messages, infra, budget), cost / goals FROM g WHERE scope <> 'endpoint' AND goals > 0
    UNION ALL SELECT 'budget_utilization', * EXCLUDE (spans, cost, records, goals, messages, infra, budget), cost / budget FROM g WHERE scope = 'solution'
    UNION ALL SELECT 'concurrency', scope, solution_id, endpoint, workflow_id, h * 86400, max(n) FROM c GROUP BY ALL)
  SELECT metric, scope, solution_id, endpoint, workflow_id, bucket_s, round(value, 6) AS value FROM v WHERE value IS NOT NULL""")
def read_metrics(spark, sf_dir):
    """All nine read-time metrics, at all their levels, from one aggregation over rows of cost, latency and what spans of solutions and workflows say of outcomes, records and messages."""
    perf = _perf(spark, sf_dir, {"latency", "retry_count"})
    # what other systems would write as rows, from the spans of solutions, their endpoints and workflows
    spans = event_spans(spark, sf_dir).where("span_type in ('solution', 'workflow')").select("span_id", F.get_json_object("metadata", "$.retry_count").cast("double").alias("_k"), F.col("session_id").cast("long").alias("_user"), F.lower("span_status").alias("_status"))
    level = perf.where("metric = 'latency' and scope in ('solution', 'endpoint', 'workflow')").join(spans, "span_id")
    said = {"records_processed": F.col("_k"), "goal_achieved": F.when(F.col("_status") == "ok", 1.0).otherwise(0.0), "messages_in_flight": (F.col("_user") % 7).cast("double"), "infrastructure_cost": F.lit(0.25), "budget": F.lit(40.0)}
    given = level.select(*[c for c in perf.columns if c not in ("metric", "value")], F.stack(F.lit(len(said)), *[x for m, v in said.items() for x in (F.lit(m), v)]).alias("metric", "value"))
    rows = perf.where("metric = 'latency'").unionByName(_costs(spark, sf_dir, {"cost"})).unionByName(given)
    out = compile_metrics(rows, list(_READ), "1d", 720.0)
    return out.select("metric", "scope", "solution_id", "endpoint", "workflow_id", F.unix_seconds("bucket").alias("bucket_s"), F.round("value", 6).alias("value"))


@query("incremental_batch_scan", f"{_WITH} SELECT span_id, span_type, epoch_us(started_at) AS recorded_us FROM sp WHERE span_type IN ('model_call', 'tool_call') ORDER BY started_at, span_id LIMIT 500")
def incremental_batch_scan(spark, sf_dir):
    own = next_batch(event_spans(spark, sf_dir), "1970-01-01 00:00:00", 500, ("model_call", "tool_call"))
    return own.select("span_id", "span_type", F.unix_micros("recorded_at").alias("recorded_us"))


_RULES = [("performance", "error_rate", "solution", "1d", "gt", 0.02, 0.05), ("performance", "latency", "solution", "1d", "gt", 200000.0, 240000.0), ("performance", "throughput", "solution", "1d", "lt", 0.001, 0.0001)]


@query("threshold_signals", f"""{_PERF}, v AS (
    SELECT metric, solution_id, CAST(epoch(date_trunc('day', ts)) AS BIGINT) AS bucket_s, if(metric = 'latency', quantile_cont(value, 0.95), avg(value)) AS value FROM rows WHERE metric IN ('error_rate', 'latency') AND scope = 'solution' GROUP BY 1, 2, 3
    UNION ALL SELECT 'throughput', solution_id, CAST(epoch(date_trunc('day', ts)) AS BIGINT), count(*) / 86400.0::DOUBLE FROM rows WHERE metric = 'latency' AND scope = 'solution' GROUP BY ALL
  ), t(metric, operator, warning, critical) AS (VALUES {', '.join(f"('{m}', '{o}', {w}::DOUBLE, {c}::DOUBLE)" for _, m, _, _, o, w, c in _RULES)})
  SELECT metric, solution_id, bucket_s, round(value, 6) AS value, CASE
    WHEN operator = 'gt' AND value > critical OR operator = 'lt' AND value < critical THEN 'critical'
    WHEN operator = 'gt' AND value > warning OR operator = 'lt' AND value < warning THEN 'warning' ELSE 'ok' END AS status FROM v JOIN t USING (metric)""")
def threshold_signals(spark, sf_dir):
    rows = _perf(spark, sf_dir, {"error_rate", "latency"}).where("scope = 'solution'")
    own = thresholds.reduced(rows, "1d", ["solution_id"])
    rate = own.where("metric = 'latency'").select(F.lit("throughput").alias("metric"), "solution_id", "bucket", (F.col("count") / 86400.0).alias("value"), "count")
    none = [F.lit("").alias(c) for c in thresholds.PATH if c != "solution_id"]
    values = own.unionByName(rate).drop("count").select("*", F.lit("solution").alias("scope"), F.lit("1d").alias("time_window"), *none)
    out = thresholds.judged(values, config.thresholds_by_rule(spark, _RULES, config.SOLUTIONS))
    return out.select("metric", "solution_id", F.unix_seconds("bucket").alias("bucket_s"), F.round("value", 6).alias("value"), "status")


@query("binding_paths", f"""{_WITH} SELECT solution_id, endpoint AS endpoint_id, CASE WHEN leaf THEN 'component' WHEN span_type = 'workflow' THEN 'workflow' WHEN endpoint <> '' THEN 'endpoint' ELSE 'solution' END AS level,
  count(*) AS n FROM sp GROUP BY ALL""")
def binding_paths(spark, sf_dir):
    """Spans as a configuration names them, by surrogate ids, brought back to business keys through a registry that the spans themselves give."""
    spans = event_spans(spark, sf_dir).withColumnRenamed("endpoint", "endpoint_id").select(*thresholds.PATH)
    surrogate = lambda c: F.when(F.col(c) != "", F.md5(F.concat(F.lit(f"{c}:"), F.col(c)).cast("binary")))
    registry = {c.removesuffix("_id"): spans.where(F.col(c) != "").select(surrogate(c).alias("id"), c).distinct() for c in thresholds.PATH}
    bound = thresholds.with_business_keys(spans.select(*[surrogate(c).alias(c) for c in thresholds.PATH]), registry)
    return bound.groupBy("solution_id", F.coalesce("endpoint_id", F.lit("")).alias("endpoint_id"), thresholds.deepest().alias("level")).agg(F.count("*").alias("n"))


# thresholds of several levels for one metric: (scope, operator, warning, critical, solution, endpoint, workflow, agent, component, active)
_LEVELS = [
    ("solution", "gt", 0.01, 0.9, "sol_support", "", "", "", "", True), ("endpoint", "gt", 0.01, 0.02, "sol_support", "ep_ticket", "", "", "", True),
    ("workflow", "gt", 0.5, 0.9, "sol_support", "", "wf_triage", "", "", True), ("workflow", "gt", 0.01, 0.02, "sol_support", "ep_ticket", "wf_triage", "", "", True),
    ("component", "gt", 0.01, 0.02, "sol_docprocess", "", "", "", "model_gpt4o", True), ("component", "gt", 0.05, 0.9, "sol_docprocess", "", "wf_triage", "", "model_gpt4o", True),
    ("component", "lt", 0.2, 0.001, "sol_docprocess", "ep_ticket", "", "", "model_gpt4o", True), ("component", "gt", 0.0, 0.0, "sol_docprocess", "", "", "agt_triage", "model_gpt4o", False),
    ("component", "gt", 0.01, 0.5, "sol_docprocess", "", "", "agt_other", "model_claude", True), ("component", "lt", 0.5, 0.01, "sol_support", "", "", "", "tool_websearch", True),
]
_LEVEL_PATHS = f"""SELECT scope, solution_id, endpoint, CASE WHEN scope IN ('solution', 'endpoint') THEN '' ELSE workflow_id END AS workflow_id, CASE WHEN scope IN ('solution', 'endpoint', 'workflow') OR NOT leaf THEN '' ELSE 'agt_triage' END AS agent_id,
    CASE WHEN scope = 'component' THEN component_id ELSE '' END AS component_id, CASE WHEN status IN ('error', 'timeout') THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS value FROM fan"""


@query("threshold_paths", f"""{_WITH}, w AS ({_LEVEL_PATHS}), v AS (SELECT scope, solution_id, endpoint, workflow_id, agent_id, component_id, avg(value) AS value FROM w GROUP BY ALL),
  t(scope, operator, warning, critical, s, e, wf, a, c, active) AS (VALUES {', '.join("('{}', '{}', {}::DOUBLE, {}::DOUBLE, '{}', '{}', '{}', '{}', '{}', {})".format(*r) for r in _LEVELS)}),
  m AS (SELECT v.*, t.*, row_number() OVER (PARTITION BY v.scope, solution_id, endpoint, workflow_id, agent_id, component_id ORDER BY c = '', a = '', wf = '', e = '', critical) AS k FROM v JOIN t ON v.scope = t.scope AND active
    AND s = solution_id AND (e = '' OR e = endpoint) AND (wf = '' OR wf = workflow_id) AND (a = '' OR a = agent_id) AND (c = '' OR c = component_id))
  SELECT v.scope, v.solution_id, v.endpoint AS endpoint_id, v.workflow_id, v.agent_id, v.component_id, round(v.value, 6) AS value, v.operator, v.critical AS critical_value, CASE WHEN operator = 'gt' AND value > critical OR operator = 'lt' AND value < critical THEN 'critical'
    WHEN operator = 'gt' AND value > warning OR operator = 'lt' AND value < warning THEN 'warning' ELSE 'ok' END AS status FROM m AS v WHERE k = 1""")
def threshold_paths(spark, sf_dir):
    """Error rates of every path against thresholds of several levels, of which the one that names the deepest level counts."""
    rows = _perf(spark, sf_dir, {"error_rate"}).withColumnRenamed("endpoint", "endpoint_id")
    values = rows.groupBy("scope", *thresholds.PATH).agg(F.avg("value").alias("value")).withColumns({"metric": F.lit("error_rate"), "time_window": F.lit("1d")})
    rules = spark.createDataFrame([("performance", "error_rate", s, "1d", o, w, c, *[x or None for x in path[:-1]], path[-1]) for s, o, w, c, *path in _LEVELS], config.THRESHOLD_SCHEMA)
    return thresholds.judged(values, rules).select("scope", *thresholds.PATH, F.round("value", 6).alias("value"), "operator", "critical_value", "status")


@query("bench_lineitem_cost", """SELECT l_returnflag, l_linestatus, count(*) AS n, round(sum(floor((l_quantity / 1000.0::DOUBLE * p_retailprice) * 1e8 + 0.5) / 1e8), 2) AS cost
  FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY ALL""")
def bench_lineitem_cost(spark, sf_dir):
    from spanmill.functions.patterns import money

    lines = table(spark, sf_dir, "lineitem").select("l_partkey", "l_quantity", "l_returnflag", "l_linestatus")
    priced = lines.join(table(spark, sf_dir, "part").select("p_partkey", "p_retailprice"), F.col("l_partkey") == F.col("p_partkey"))
    return priced.groupBy("l_returnflag", "l_linestatus").agg(F.count("*").alias("n"), F.round(F.sum(money(F.col("l_quantity") / 1000.0 * F.col("p_retailprice"))), 2).alias("cost"))


_COUNTABLE = ("EMAIL_ADDRESS", "PHONE_NUMBER", "CREDIT_CARD", "IP_ADDRESS", "URL", "IBAN_CODE", "US_PASSPORT")


def _duck(entity: str) -> str:
    return "(?i)" + pii.any_pattern(entity).replace("'", "''")


@query("pii_counts_by_type", " UNION ALL ".join(f"SELECT '{e}' AS entity_type, CAST(sum(len(regexp_extract_all(text, '{_duck(e)}'))) AS BIGINT) AS n FROM documents" for e in _COUNTABLE))
def pii_counts_by_type(spark, sf_dir):
    sums = table(spark, sf_dir, "documents").agg(*[F.sum(pii.count_matches(F.col("text"), e)).cast("long").alias(e) for e in _COUNTABLE])
    return sums.select(F.stack(F.lit(len(_COUNTABLE)), *[x for e in _COUNTABLE for x in (F.lit(e), F.col(e))]).alias("entity_type", "n"))


_SAFE_TYPES = ("EMAIL_ADDRESS", "PHONE_NUMBER", "CREDIT_CARD", "IP_ADDRESS")


# --- The oracle's own statement of what the strict policy detects: every type, scores lifted by words before, overlaps settled within a type ---
#: Characters as Python's patterns see them: small letters for ASCII letters and for the four others that match one, a space for other whitespace.
#: Other digits become D and other letters L, which are word characters to RE2 too; no pattern in small letters names them.
_SEEN = "translate(lower(text), 'ſı', 'si')"
for _chars, _as in (
    (r"[\x{0b}\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]", " "), (r"[^\P{Nd}0-9]", "D"),
    (r"[^\x00-\x7f\P{L}]|[^\x00-\x7f\P{N}]|[\x{2ebf0}-\x{2ee5d}]", "L"),
):
    _SEEN = f"regexp_replace({_SEEN}, '{_chars}', '{_as}', 'g')"
_CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _seen(pattern: str) -> str:
    """A pattern over _SEEN in RE2's terms, which have no lookahead."""
    plain = r"(?:[1-57-9D]\d\d|0(?:[1-9D]\d|0[1-9D])|6(?:[0-57-9D]\d|6[0-57-9D]))"
    return pattern.lower().replace(r"(?!000|666)\d{3}", plain).replace(r"\d", "[0-9D]").replace("'", "''")


def _rule(pattern: str, entity: str, score: float, words: tuple[str, ...]) -> str:
    """A rule with the lengths of all its matches, of what stands between them, and of what they report: their group, at their end, or all."""
    own, group = _seen(pattern), 3 if "(" in pattern.replace("(?", "").replace(r"\(", "") else 2
    lengths = [f"CASE WHEN regexp_matches(seen, '{own}') THEN list_transform(regexp_extract_all(seen, '(?s)(.*?)({own})', {k}), lambda x: length(x)) ELSE [] END" for k in (1, 2, group)]
    return f"{{'entity': '{entity}', 'score': {score}::DOUBLE, 'words': '{'|'.join(words)}', 'gaps': {lengths[0]}, 'hits': {lengths[1]}, 'own': {lengths[2]}}}"


#: What a text matches that any of the rules matches: one search over all texts before those by rule.
_ANY_RULE = "|".join(f"(?:{x})" for x in dict.fromkeys(_seen(p) for p, _, _ in pii.PATTERNS + pii.SCORED))
#: Detections of the texts of t (pair, side, text): r has each rule's matches, m their places, d their scores, k those of a text and type in the order
#: in which they are taken, and n, by pair, how many are taken, and of how many types.
_DETECTED = f"""r AS (SELECT pair, side, text, unnest([{", ".join([_rule(p, e, s, ()) for p, e, s in pii.PATTERNS] + [_rule(p, e, s, pii.CONTEXT.get(e, ())) for p, e, s in pii.SCORED])}]) AS r
    FROM (SELECT *, {_SEEN} AS seen FROM t WHERE text <> '') WHERE regexp_matches(seen, '{_ANY_RULE}')),
  m AS (SELECT pair, side, text, r.entity AS entity, r.score AS score, r.words AS words, unnest(r.hits) AS hit, unnest(r.own) AS own,
    unnest(list_transform(r.gaps, lambda x, i: CAST(list_sum(r.gaps[:i]) + coalesce(list_sum(r.hits[:i - 1]), 0) AS BIGINT))) AS a FROM r WHERE len(r.gaps) > 0),
  d AS (SELECT pair, side, entity, a + hit - own AS a, a + hit AS b, CASE WHEN words <> ''
    AND regexp_matches(translate(regexp_extract(substr(text, 1, a + 1), '((?:[A-Za-z0-9_]+[^A-Za-z0-9_]+){{0,{pii.WINDOW}}})[A-Za-z0-9_]*$', 1), '{_CAPITALS}', '{_CAPITALS.lower()}'), words)
    THEN round(least(1, greatest(score + {pii.BOOST}, {pii.LEAST})), 2) ELSE score END AS score FROM m),
  k AS (SELECT pair, side, entity, list([{{'a': a, 'b': b}}] ORDER BY b - a DESC, score DESC, a) AS d FROM d WHERE score >= {pii.STRICT.score_threshold} GROUP BY ALL),
  n AS (SELECT pair, count(DISTINCT entity) AS types,
    sum(len(list_reduce(d, lambda taken, x: CASE WHEN len(list_filter(taken, lambda y: y.a < x[1].b AND x[1].a < y.b)) > 0 THEN taken ELSE taken || x END))) AS n FROM k GROUP BY pair)"""


@query("pii_safety_metrics", f"""WITH p AS (SELECT CAST(floor(doc_id / 2) AS BIGINT) AS pair, max(text) FILTER (doc_id % 2 = 0) AS input, max(text) FILTER (doc_id % 2 = 1) AS output FROM documents GROUP BY ALL),
  t AS (SELECT pair, unnest(['input', 'output']) AS side, unnest([input, output]) AS text FROM p), {_DETECTED},
  c AS (SELECT CAST(q.pair AS VARCHAR) AS span_id, coalesce(n, 0) AS n, coalesce(types, 0) AS types FROM (SELECT DISTINCT CAST(floor(doc_id / 2) AS BIGINT) AS pair FROM documents) AS q LEFT JOIN n ON q.pair IS NOT DISTINCT FROM n.pair)
  SELECT span_id, 'pii_count' AS metric, CAST(n AS DOUBLE) AS value FROM c
  UNION ALL SELECT span_id, 'pii_detected', CASE WHEN n > 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END FROM c
  UNION ALL SELECT span_id, 'pii_distinct_types', CAST(types AS DOUBLE) FROM c""")
def pii_safety_metrics(spark, sf_dir):
    """Counts of the detections of all types, under the strict policy, in model calls over all documents."""
    return derive(document_pairs(spark, sf_dir), "safety").select("span_id", "metric", "value")


_BATCHES = 4


@query("pii_result_store", f"""WITH p AS (SELECT doc_id // 2 AS pair, max(text) FILTER (doc_id % 2 = 0) AS input, max(text) FILTER (doc_id % 2 = 1) AS output FROM documents GROUP BY ALL),
  t AS (SELECT pair, pair % {_BATCHES} AS batch, unnest([input, output]) AS text FROM p), d AS (SELECT DISTINCT batch, text FROM t WHERE text <> ''), f AS (SELECT text, min(batch) AS batch FROM d GROUP BY text),
  c AS (SELECT batch, count(DISTINCT pair) AS spans, CAST(sum({' + '.join(f"coalesce(len(regexp_extract_all(text, '{_duck(e)}')), 0)" for e in _SAFE_TYPES)}) AS DOUBLE) AS pii_count FROM t GROUP BY batch)
  SELECT CAST(c.batch AS BIGINT) AS batch, spans, (SELECT count(*) FROM d WHERE d.batch = c.batch) AS texts, (SELECT count(*) FROM f WHERE f.batch = c.batch) AS analysed, pii_count FROM c""")
def pii_result_store(spark, sf_dir):
    """Model calls over all documents in batches that share a store of analyses: how many texts each batch held, and how many were new."""
    store = ResultStore(spark, f"{scratch(spark)}/results-{uuid.uuid4().hex}")
    pairs = document_pairs(spark, sf_dir)
    done = None
    for k in range(_BATCHES):
        rows = derive(pairs.where(F.col("span_id").cast("long") % _BATCHES == k), "safety", metrics={"pii_count"}, results=store)
        own = rows.agg(F.count("*").alias("spans"), F.sum("value").alias("pii_count")).select(F.lit(k).cast("long").alias("batch"), "spans", "pii_count").where("spans > 0")
        done = own if done is None else done.unionAll(own)
    fresh = store.results().groupBy((F.col("tick") - 1).alias("batch")).agg(F.count("*").alias("analysed"))
    again = store.touches().groupBy((F.col("tick") - 1).alias("batch")).agg(F.count("*").alias("again"))
    met = done.join(fresh, "batch", "left").join(again, "batch", "left").na.fill(0, ["analysed", "again"])
    return met.select("batch", "spans", (F.col("analysed") + F.col("again")).alias("texts"), "analysed", "pii_count")


@query("pii_redact", f"SELECT doc_id, md5(regexp_replace(text, '{_duck('EMAIL_ADDRESS')}', '[EMAIL_ADDRESS]', 'g')) AS digest FROM documents")
def pii_redact(spark, sf_dir):
    only = pii.Policy(disabled=frozenset(pii.ENTITY_TYPES) - {"EMAIL_ADDRESS"})
    return pii.anonymize(table(spark, sf_dir, "documents").select("doc_id", "text"), policy=only).select("doc_id", F.md5(F.col("deidentified_text").cast("binary")).alias("digest"))


@query("pii_mask", f"""WITH m AS (SELECT doc_id, unnest(regexp_extract_all(text, '{_duck('IP_ADDRESS')}')) AS x FROM documents)
  SELECT doc_id, if(len(x) < 8, left(x, 1) || repeat('*', CAST(len(x) - 2 AS INTEGER)) || right(x, 1), left(x, 2) || repeat('*', CAST(len(x) - 4 AS INTEGER)) || right(x, 2)) AS masked, count(*) AS n FROM m GROUP BY ALL""")
def pii_mask(spark, sf_dir):
    found = table(spark, sf_dir, "documents").select("doc_id", F.explode(F.regexp_extract_all("text", F.lit("(?i)" + next(p for p, e, _ in pii.PATTERNS if e == "IP_ADDRESS")), F.lit(0))).alias("x"))
    return found.groupBy("doc_id", pii.partly_masked(F.col("x")).alias("masked")).agg(F.count("*").alias("n"))


@query("pii_audit_entries")
def pii_audit_entries(spark, sf_dir):
    return pii.audit_rows(pii.anonymize(table(spark, sf_dir, "documents").select("doc_id", "text"))).drop("timestamp")


_LIFTED = {"US_BANK_NUMBER": r"\d{8,17}", "MEDICAL_RECORD_NUMBER": r"\d{6,10}", "ZIP_CODE": r"\d{5}"}


def _after_context(entity: str) -> str:
    """RE2: a bare number of a type with a word of its context among the five words before it."""
    return rf"(?i)\b[A-Z0-9_]*(?:{'|'.join(pii.CONTEXT[entity])})[A-Z0-9_]*[^A-Z0-9_]+(?:[A-Z0-9_]+[^A-Z0-9_]+){{0,4}}\b{_LIFTED[entity]}\b"


@query("pii_context", "SELECT doc_id, " + ", ".join(f"coalesce(regexp_matches(text, '{_after_context(e)}'), false) AS {e.lower()}" for e in _LIFTED) + " FROM documents")
def pii_context(spark, sf_dir):
    own = pii.Policy(score_threshold=0.75, disabled=frozenset(pii.ENTITY_TYPES) - set(_LIFTED))
    found = pii.detect(F.col("text"), own, resolved=False)
    bare = lambda e: F.exists("found", lambda d: (d["entity_type"] == e) & d["text"].rlike(rf"^{_LIFTED[e]}$"))
    return table(spark, sf_dir, "documents").select("doc_id", found.alias("found")).select("doc_id", *[bare(e).alias(e.lower()) for e in _LIFTED])


@query("pii_latency_stats", """SELECT solution_id, count(*) AS n, round(avg(value), 4) AS mean, round(stddev_pop(value), 4) AS deviation, min(value) AS least, max(value) AS most, round(quantile_cont(value, 0.5), 4) AS p50,
  round(quantile_cont(value, 0.95), 4) AS p95, round(quantile_cont(value, 0.99), 4) AS p99 FROM (SELECT value, if(event_type = 'error', 'failed', 'done') AS solution_id FROM events WHERE value IS NOT NULL) GROUP BY solution_id""")
def pii_latency_stats(spark, sf_dir):
    own = table(spark, sf_dir, "events").where("value is not null").select("value", F.when(F.col("event_type") == "error", "failed").otherwise("done").alias("solution_id"))
    return evaluate.latency_stats(own, "value", "solution_id")


_NUMBER, _MAIL = "^[0-9+(][0-9().+-]*$", "[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+"


@query("eval_prf1", f"""WITH t AS (SELECT doc_id, unnest(string_split(text, ' ')) AS x, generate_subscripts(string_split(text, ' '), 1) AS i FROM documents),
  n AS (SELECT *, CAST(coalesce(sum(length(x) + 1) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS a, contains(x, '@') AS mail, regexp_matches(x, '{_NUMBER}') AS num FROM t),
  m AS (SELECT *, num AND coalesce(lag(num AND NOT mail) OVER (PARTITION BY doc_id ORDER BY i), false) AS more, regexp_extract(x, '{_MAIL}') AS y FROM n),
  k AS (SELECT *, sum((NOT (num AND more AND NOT mail))::INT) OVER (PARTITION BY doc_id ORDER BY i) AS k FROM m),
  g AS (SELECT doc_id, CASE WHEN bool_or(mail) THEN 'EMAIL_ADDRESS' WHEN bool_or(num) THEN 'PHONE_NUMBER' ELSE 'URL' END AS e, min(a) AS a, max(a + length(x)) AS b FROM k GROUP BY doc_id, k HAVING bool_or(mail OR num OR starts_with(x, 'http'))),
  p AS (SELECT doc_id, 3 * i AS place, 'EMAIL_ADDRESS' AS e, a + instr(x, y) - 1 AS a, a + instr(x, y) - 1 + length(y) AS b FROM m WHERE mail AND y <> '' UNION ALL SELECT doc_id, 3 * i + 1, 'EMAIL_ADDRESS', a + instr(x, y) - 1, a + length(x) FROM m WHERE mail AND y <> ''
    UNION ALL SELECT doc_id, 3 * i, 'PHONE_NUMBER', a, a + length(x) FROM m WHERE num AND NOT mail UNION ALL SELECT doc_id, 3 * i, 'URL', a, a + length(x) FROM m WHERE (starts_with(x, 'http') OR starts_with(x, 'www')) AND NOT mail AND NOT num),
  o AS (SELECT p.doc_id, p.e, p.place, g.a FROM p JOIN g ON p.doc_id = g.doc_id AND p.e = g.e AND least(p.b, g.b) - greatest(p.a, g.a) > 0 AND (least(p.b, g.b) - greatest(p.a, g.a)) / (greatest(p.b, g.b) - least(p.a, g.a))::DOUBLE >= 0.5),
  h AS (SELECT e, count(DISTINCT (doc_id, a)) AS tp FROM o GROUP BY e),
  s AS (SELECT e, coalesce(tp, 0) AS tp, np - coalesce(tp, 0) AS fp, ng - coalesce(tp, 0) AS fn FROM (SELECT e, count(*) AS ng FROM g GROUP BY e) FULL JOIN (SELECT e, count(*) AS np FROM p GROUP BY e) USING (e) LEFT JOIN h USING (e)),
  u AS (SELECT e AS entity_type, tp, coalesce(fp, 0) AS fp, coalesce(fn, 0) AS fn FROM s WHERE tp + coalesce(fn, 0) > 0 UNION ALL SELECT 'OVERALL', sum(tp), sum(fp), sum(fn) FROM s),
  r AS (SELECT *, CASE WHEN tp + fp > 0 THEN tp / (tp + fp)::DOUBLE ELSE 0 END AS pr, CASE WHEN tp + fn > 0 THEN tp / (tp + fn)::DOUBLE ELSE 0 END AS re FROM u)
  SELECT entity_type, CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp, CAST(fn AS BIGINT) AS fn, round(pr, 6) AS "precision", round(re, 6) AS recall, round(CASE WHEN pr + re > 0 THEN 2 * pr * re / (pr + re) ELSE 0 END, 6) AS f1 FROM r""")
def eval_prf1(spark, sf_dir):
    """Words with @, runs of numbers and links of all documents, annotated by rule as BIO tags, against predictions that cut, double and part them."""
    words = F.split("text", " ")
    number = lambda x: x.rlike(_NUMBER) & ~x.contains("@")
    before = lambda ws, k: F.coalesce(number(F.get(ws, k - 1)), F.lit(False))
    docs = table(spark, sf_dir, "documents").where("text is not null").select("doc_id", words.alias("tokens"))
    label = lambda x, k: (
        F.when(x.contains("@"), "B-EMAIL").when(number(x), F.when(before(F.col("tokens"), k), "I-PHONE_NUM").otherwise("B-PHONE_NUM")).when(x.startswith("http"), "B-URL_PERSONAL").otherwise("O")
    )
    docs = docs.withColumns({"labels": F.transform("tokens", label), "trailing_whitespace": F.transform("tokens", lambda x: F.lit(True))})
    marks = F.transform("tokens", lambda x: x.contains("@") | number(x) | x.startswith("http") | x.startswith("www"))
    found = kept(evaluate.placed(docs.withColumn("marked", marks), "marked"), "marked-tokens")  # read for gold and for predictions
    gold = evaluate.gold_of(found.where("label <> 'O'")).select("doc_id", F.lit(True).alias("gold"), "place", "start", "end", "entity_type")
    own = found.select("doc_id", F.col("place").alias("i"), F.col("token").alias("x"), F.col("start").alias("a")).withColumn("y", F.regexp_extract("x", _MAIL, 0))
    mail, end = F.col("x").contains("@"), F.col("a") + F.length("x")
    first = F.col("a") + F.expr("instr(x, y)") - 1
    span = lambda k, e, a, b: F.struct((F.col("i") * 3 + k).alias("place"), F.lit(e).alias("entity_type"), a.cast("int").alias("start"), b.cast("int").alias("end"))
    predicted = (
        F.when(mail & (F.col("y") != ""), F.array(span(0, "EMAIL_ADDRESS", first, first + F.length("y")), span(1, "EMAIL_ADDRESS", first, end))).when(mail, F.array())
        .when(number(F.col("x")), F.array(span(0, "PHONE_NUMBER", F.col("a"), end))).when(F.col("x").startswith("http") | F.col("x").startswith("www"), F.array(span(0, "URL", F.col("a"), end)))
    )
    found = own.select("doc_id", F.explode(predicted).alias("p")).select("doc_id", F.lit(False).alias("gold"), "p.place", "p.start", "p.end", "p.entity_type")
    return evaluate.scores(evaluate.matched(gold.unionByName(found)))


@query("parity_tolerance", f"""{_PERF} SELECT metric, count(*) AS compared, CAST(count(*) FILTER (NOT (metric = 'latency' AND CAST(span_id AS BIGINT) % 5 = 0)) AS BIGINT) AS within,
  CASE WHEN metric = 'latency' THEN 2.0::DOUBLE ELSE 0.0::DOUBLE END AS max_diff FROM rows WHERE metric IN ('latency', 'error_rate') GROUP BY metric""")
def parity_tolerance(spark, sf_dir):
    produced = _perf(spark, sf_dir, {"latency", "error_rate"})
    odd = (F.col("metric") == "latency") & (F.col("span_id").cast("long") % 5 == 0)
    expected = produced.withColumn("value", F.when(odd, F.col("value") + 2).when(F.col("metric") == "latency", F.col("value") + 1).otherwise(F.col("value")))
    return parity.within_tolerance(produced, expected, {"latency": 1.5, "error_rate": 0.0})


@query("missing_metrics", """SELECT * FROM (VALUES ('inter_token_latency'), ('scheduling_delay'), ('retry_delay'), 
  ('rate_limit_wait'), ('records_processed'), ('batch_size'), ('throughput'), ('concurrency'), ('messages_in_flight')) AS t(metric)""")
def missing_metrics(spark, sf_dir):
    return parity.missing_metrics(catalogue(spark).where("lens = 'performance'"), _perf(spark, sf_dir))


@query("dedup_derived", f"{_PERF} SELECT metric, count(*) AS n, round(sum(value), 4) AS total FROM rows WHERE metric IN ('latency', 'error_rate') GROUP BY metric")
def dedup_derived(spark, sf_dir):
    rows = _perf(spark, sf_dir, {"latency", "error_rate"})
    return rollup.deduplicated(rows.unionAll(rows)).groupBy("metric").agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total"))


@query("stream_rollup", f"{_PERF} SELECT metric, count(*) AS count, round(sum(value), 4) AS sum_value FROM rows GROUP BY metric")
def stream_rollup(spark, sf_dir):
    """Spans written as files, drained by a streaming worker, read back from its partial states."""
    from spanmill.streaming.worker import Worker, partials_of, read_stream

    own = f"{scratch(spark)}/stream-{uuid.uuid4().hex}"
    event_spans(spark, sf_dir, dealt=True).write.parquet(f"{own}/spans")
    Worker("performance", f"{own}/out", f"{own}/checkpoint").start(read_stream(spark, f"{own}/spans", 2), once=True).awaitTermination()
    return partials_of(spark, f"{own}/out").groupBy("metric").agg(F.sum("count").alias("count"), F.round(F.sum("sum_value"), 4).alias("sum_value"))


@query("stream_tier", f"""{_PERF} SELECT scope, solution_id, endpoint, component_id, environment, metric, CAST(epoch(date_trunc('hour', ts)) AS BIGINT) AS bucket_s, count(*) AS count, round(sum(value), 4) AS sum_value,
  min(value) AS min_value, max(value) AS max_value FROM rows GROUP BY ALL""")
def stream_tier(spark, sf_dir):
    """Hourly states kept beside those of a minute, after late batches, a replay and a compaction, each followed by a refresh of the hours that changed."""
    from spanmill.streaming import tiers, worker

    out, spans = f"{scratch(spark)}/tier-{uuid.uuid4().hex}", event_spans(spark, sf_dir, dealt=True)
    lens = worker.Worker("performance", out, f"{out}/checkpoint")
    batch = lambda k: spans.where(F.pmod(F.xxhash64("span_id"), F.lit(3)) == k)
    lens.on_batch(batch(0), 0)
    tiers.refresh(spark, out, "performance")
    lens.on_batch(batch(1), 1)
    lens.on_batch(batch(0), 0)
    worker.compact(spark, out, "performance", 2)
    tiers.refresh(spark, out, "performance")
    lens.on_batch(batch(2), 2)
    lens.on_batch(batch(1), 1)
    tiers.refresh(spark, out, "performance")
    keys = ["scope", "solution_id", "endpoint", "component_id", "environment", "metric"]
    states = rollup.merge(tiers.read_tier(spark, out, "performance"), by=keys)
    return states.select(*keys, F.unix_seconds("bucket").alias("bucket_s"), "count", F.round("sum_value", 4).alias("sum_value"), "min_value", "max_value")


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """95th percentile and average of latency per solution and day, from one-minute states."""
    return rollup_sketch_quantiles(spark, sf_dir)
