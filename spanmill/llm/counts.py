"""Token counts of sections by offset-mapped attribution.

A whole document is encoded once. Byte-level tokens cover its bytes without gaps, so their summed
lengths give each token's interval, in code points; sections are intervals too, and a sorted interval
join gives each token's sections. A token that crosses a boundary is allocated by an explicit rule:
first (the section of its first code point), last, or most (the section that holds most of its code
points, the earlier of two that hold as many). So sections add up to the document, which counts of
sections encoded apart do not.

Sections are lines, each with its line end, unless a function gives other starts. A code point that
several tokens share counts as the first code point of each.

Cases: null or empty text is one empty section without tokens; repeated rows give repeated results;
ids may be null; an empty table gives an empty result; extra columns are ignored; texts of any length
are encoded whole.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read
from .tokens import default_tokenizer, encoder

RULES = ("first", "last", "most")
ROWS = "doc_id long, section long, start long, end long, n_tokens long, doc_tokens long"


def line_starts(points: np.ndarray) -> np.ndarray:
    """Starts of lines, given the text's code points."""
    after = np.flatnonzero(points == 10) + 1
    return np.concatenate(([0], after[after < len(points)])).astype(np.int64)


def token_spans(lengths: np.ndarray, raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, end) of each token in code points; lengths and raw are in bytes."""
    ends = np.cumsum(lengths)
    starts = ends - lengths
    before = np.concatenate(([0], np.cumsum((raw & 0xC0) != 0x80)))  # code points begun before each byte
    first = before[starts] - ((raw[starts] & 0xC0) == 0x80)
    return first, np.maximum(before[ends], first + 1)


def allocate(starts: np.ndarray, ends: np.ndarray, sections: np.ndarray, rule: str) -> np.ndarray:
    """The section of each token, given the sorted starts of sections."""
    first = np.searchsorted(sections, starts, "right") - 1
    if rule == "first":
        return first
    last = np.searchsorted(sections, ends - 1, "right") - 1
    if rule == "last":
        return last
    out, cuts = first.copy(), np.append(sections, np.iinfo(np.int64).max)
    for t in np.flatnonzero(last > first):
        held = [min(ends[t], cuts[s + 1]) - max(starts[t], cuts[s]) for s in range(first[t], last[t] + 1)]
        out[t] = first[t] + int(np.argmax(held))
    return out


def section_counts(text: str, own, rule: str, sections: Callable[[np.ndarray], np.ndarray]) -> list[tuple[int, int, int]]:
    """(start, end, tokens) of each section of a text."""
    if not text:
        return [(0, 0, 0)]
    raw = np.frombuffer(text.encode(), np.uint8)
    points = np.frombuffer(text.encode("utf-32-le"), "<u4")
    starts = sections(points)
    a, b = token_spans(own.byte_lengths()[np.frombuffer(own.encode(text), "<u4")], raw)
    n = np.bincount(allocate(a, b, starts, rule), minlength=len(starts))
    return list(zip(starts.tolist(), [*starts[1:].tolist(), len(points)], n.tolist()))


def count_tokens(
    docs: DataFrame, *, rule: str = "first", sections: Callable[[np.ndarray], np.ndarray] = line_starts, tokenizer: str | None = None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per section: doc_id, section, start, end (code points), n_tokens, doc_tokens."""
    if rule not in RULES:
        raise ValueError(f"no such rule: {rule}")
    path = tokenizer or default_tokenizer()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = encoder(path)
        for frame in batches:
            rows = []
            for doc_id, text in zip(frame["doc_id"].astype("Int64").array, frame["text"].array):
                found = section_counts(text, own, rule, sections)
                total = sum(n for *_, n in found)
                rows += [(doc_id, k, a, b, n, total) for k, (a, b, n) in enumerate(found)]
            yield pd.DataFrame(rows, columns=["doc_id", "section", "start", "end", "n_tokens", "doc_tokens"]).astype({"doc_id": "Int64"})

    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return texts.mapInPandas(run, ROWS)


def op1_offset_attribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(read(spark, sf_dir, "documents"))
