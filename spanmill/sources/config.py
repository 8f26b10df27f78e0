"""Configuration: the registry's entities and the bindings between them, and thresholds from files."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The sample registry's business ids.
SOLUTIONS = ["sol_docprocess", "sol_support"]
ENDPOINTS = ["ep_extract_v1", "ep_doc", "ep_ticket", "ep_quick"]
WORKFLOWS = ["wf_docunderstand", "wf_triage"]
AGENTS = ["agt_classify", "agt_extract", "agt_retrieve", "agt_enrich", "agt_review", "agt_triage", "agt_route", "agt_responder"]
COMPONENTS = [
    ("model_gpt4o", "model"), ("model_claude", "model"), ("model_embed", "model"), ("tool_websearch", "tool"),
    ("kb_product_docs", "knowledgebase"), ("skill_ner", "skill"), ("func_validate", "function"), ("mem_conv", "memory"),
]
BINDING_SCHEMA = "solution_id string, endpoint_id string, workflow_id string, agent_id string, component_id string"
THRESHOLD_SCHEMA = (
    "category string, metric_name string, scope string, time_window string, operator string, warning_value double, critical_value double, "
    "solution_id string, endpoint_id string, workflow_id string, agent_id string, component_id string, is_active boolean"
)


def bindings_of(solution: str, endpoint: str, workflow: str | None, agents: dict[str, list[str]]) -> list[tuple]:
    """Binding paths by rule: the workflow if there is one, each agent under it, each component of each agent."""
    rows: list[tuple] = [(solution, endpoint, workflow, None, None)] if workflow else []
    rows += [(solution, endpoint, workflow, a, None) for a in agents]
    return rows + [(solution, endpoint, workflow, a, c) for a, own in agents.items() for c in own]


def sample_bindings(spark: SparkSession) -> DataFrame:
    """Paths of the sample registry: a workflow of several agents, one of two, and an endpoint that calls a component directly."""
    rows = bindings_of("sol_support", "ep_ticket", "wf_triage", {"agt_triage": ["model_claude"], "agt_route": ["model_gpt4o"]})
    rows += [("sol_support", "ep_quick", None, None, "model_gpt4o")]
    rows += bindings_of("sol_support", "ep_quick", None, {"agt_responder": ["model_claude"]})
    return spark.createDataFrame(rows, BINDING_SCHEMA)


def read_thresholds(spark: SparkSession, path: str) -> DataFrame:
    """Thresholds from a CSV with a header; empty path columns are null, and so is is_active in files without it."""
    return spark.read.schema(THRESHOLD_SCHEMA).option("header", True).csv(path)


_TOKEN = re.compile(r"--[^\n]*|'(?P<text>(?:[^']|'')*)'|::\w+(?:\[\])?|(?P<word>[A-Za-z_][A-Za-z0-9_.]*)|(?P<number>-?[0-9]+(?:\.[0-9]+)?)|(?P<mark>[(),;])|\s+|.")


def read_inserts(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """Tables of an SQL script, from its INSERT INTO t (columns) VALUES (...), ... statements, all columns as text.

    Literals may be quoted, numbers, NULL or booleans, with casts; other statements are passed over. For
    configuration: the script is read by the driver.
    """
    script = "\n".join(r[0] for r in spark.read.text(path, wholetext=True).collect())
    tokens = [m for m in _TOKEN.finditer(script) if m.lastgroup]
    value = lambda m: m["text"].replace("''", "'") if m["text"] is not None else None if (m["word"] or "").upper() == "NULL" else m["word"] or m["number"]
    found: dict[str, tuple[list[str], list[tuple]]] = {}
    at = 0
    while at + 2 < len(tokens):
        if [(t["word"] or "").upper() for t in tokens[at : at + 2]] != ["INSERT", "INTO"]:
            at += 1
            continue
        table, lists, own = tokens[at + 2]["word"], [], None
        at += 3
        while at < len(tokens) and tokens[at]["mark"] != ";":
            mark = tokens[at]["mark"]
            if mark == "(":
                own = []
            elif mark == ")" and own is not None:
                lists.append(own)
                own = None
            elif own is not None and mark is None:
                own.append(value(tokens[at]))
            at += 1
        names, rows = found.setdefault(table, (lists[0], []))
        place = [lists[0].index(c) for c in names]
        rows += [tuple(x[k] for k in place) for x in lists[1:]]
    return {t: spark.createDataFrame(rows, ", ".join(f"{c} string" for c in names)) for t, (names, rows) in found.items()}


def thresholds_of(tables: dict[str, DataFrame]) -> DataFrame:
    """The thresholds of such a script, typed."""
    own = tables["thresholds"]
    return own.select(*[F.col(c.split()[0]).cast(c.split()[1]) if c.split()[0] in own.columns else F.lit(None).cast(c.split()[1]).alias(c.split()[0]) for c in THRESHOLD_SCHEMA.split(", ")])


def thresholds_by_rule(spark: SparkSession, rules: list[tuple], solutions: list[str]) -> DataFrame:
    """Each rule (category, metric, scope, window, operator, warning, critical) for each solution."""
    return spark.createDataFrame([(*r, s, None, None, None, None, True) for r in rules for s in solutions], THRESHOLD_SCHEMA)
