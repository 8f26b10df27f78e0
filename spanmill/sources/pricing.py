"""Price tables: component_id with one column per rate."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RATES = ["input_per_1k", "output_per_1k", "cached_input_per_1k", "per_call", "per_query"]
#: The offline price table, in USD.
STATIC = [
    ("model_gpt4o", "model", 0.005, 0.015, 0.0025, None, None),
    ("model_claude", "model", 0.003, 0.015, 0.0003, None, None),
    ("model_embed", "model", 0.00002, 0.0, 0.0, None, None),
    ("tool_websearch", "tool", None, None, None, 0.005, None),
    ("kb_product_docs", "knowledgebase", None, None, None, None, 0.0001),
]
SCHEMA = "component_id string, component_type string, " + ", ".join(f"{r} double" for r in RATES)


def static_pricing(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(STATIC, SCHEMA)


def pricing_from_components(components: DataFrame) -> DataFrame:
    """Active components with their pricing JSON unpacked; absent pricing is no rates."""
    rates = F.from_json(F.coalesce(F.col("pricing"), F.lit("{}")), ", ".join(f"{r} double" for r in RATES))
    return components.where(F.coalesce("is_active", F.lit(True))).select("component_id", F.col("component_type").cast("string"), rates.alias("_r")).select("component_id", "component_type", "_r.*")


def pricing_from_jdbc(spark: SparkSession, url: str, table: str = "components", **options) -> DataFrame:
    return pricing_from_components(spark.read.format("jdbc").options(url=url, dbtable=table, **options).load())
