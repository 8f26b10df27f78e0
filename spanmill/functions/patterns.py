"""Value expressions over spans: timing, status, metadata, ratios, money. A null value is not emitted.

Metadata that isn't JSON, or isn't an object, counts as empty. A value that can't be read as a number
is null, so that one bad attribute never stops a batch.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The parsed metadata, a variant, which the engine adds once per span.
META = "_meta"


def parsed_metadata(column: str = "metadata") -> Column:
    raw = F.col(column)
    return F.when(raw.isNull() | raw.isin("", "{}", "\\N"), F.lit(None)).otherwise(F.try_parse_json(raw))


def number(path: str) -> Column:
    """A metadata value as double; numeric strings and booleans convert."""
    return F.try_variant_get(F.col(META), f"$.{path}", "double")


def text(path: str) -> Column:
    return F.try_variant_get(F.col(META), f"$.{path}", "string")


def latency_ms() -> Column:
    return F.expr("timestampdiff(MICROSECOND, started_at, ended_at) / 1000D")


def status_flag(*statuses: str) -> Column:
    return F.when(F.lower(F.coalesce("span_status", F.lit(""))).isin(*statuses), 1.0).otherwise(0.0)


def metadata_bool(path: str) -> Column:
    """1 for true, 1, "1", "true" and "True"; 0 for any other value; null where absent or null."""
    value = F.try_variant_get(F.col(META), f"$.{path}", "variant")
    is_text = F.schema_of_variant(value) == "STRING"
    yes = F.when(is_text, text(path).isin("1", "true", "True")).otherwise(F.coalesce(number(path) == 1, F.lit(False)))
    return F.when(value.isNull() | F.is_variant_null(value), None).when(yes, 1.0).otherwise(0.0)


def ratio(numerator: Column, denominator: Column, places: int = 4) -> Column:
    return F.when(denominator != 0, F.round(numerator / denominator, places))


def money(value: Column, places: int = 8) -> Column:
    """Half up by scaling, the one rounding that gives equal results in other engines too."""
    scale = float(10**places)
    return F.floor(value * scale + 0.5) / scale


def content_hash(column: str) -> Column:
    return F.substring(F.sha2(F.col(column).cast("binary"), 256), 1, 16)
