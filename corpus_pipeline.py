"""A corpus from raw documents to packed training windows, in five stages.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before kept; its result is
written as Parquet and read again as the next one's docs, and the tables that it needed are dropped
then. All but the last return the columns of docs.

Cases: null and empty texts have no words, so the first stage rejects them; a later stage that is run
by itself takes them as empty; null ids, repeated rows, empty tables and extra columns of any name are
as in each stage's operator: rows stay rows, columns stay columns.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from spanmill.llm.common import drop_tables, materialize, read, tables_since
from spanmill.llm.mixing import mixed_documents
from spanmill.llm.neardup import drop_near_duplicates
from spanmill.llm.packing import pack_documents
from spanmill.llm.pii import redact
from spanmill.llm.quality import filter_quality

#: Tables that the stage before needed for its result, which is written when the next stage begins.
_left: list[str] = []


def _stage(function: Callable[[SparkSession, DataFrame, str], DataFrame]) -> Callable[[SparkSession, DataFrame, str], DataFrame]:
    """The function, which first drops what the stage before left, unless docs still reads it."""

    @wraps(function)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        drop_tables(spark, _left, keep=docs)
        before = len(tables_since())
        out = function(spark, docs, sf_dir)
        _left[:] = tables_since(before)
        return out

    return run_stage


@_stage
def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules pass and whose posterior probability of good quality suffices."""
    return filter_quality(docs)


@_stage
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class, that of the least id."""
    return drop_near_duplicates(docs)


@_stage
def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with personal data replaced by its kind in brackets, n_chars to match."""
    return redact(docs)


@_stage
def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as the mix takes them: some not, some up to three times."""
    return mixed_documents(docs)


@_stage
def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in windows of 1024 tokens."""
    return pack_documents(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("personal_data", personal_data),
    ("mixing", mixing),
    ("packing", packing),
]

#: SQL can't express order MinHash, boosted trees or a tokenizer; tests/llm/test_queries_and_pipeline.py checks the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = read(spark, sf_dir, "documents"), len(tables_since())
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
        drop_tables(spark, tables_since(before), keep=docs)
    return STAGES[-1][1](spark, docs, sf_dir)
