"""Packing documents into windows by best-fit decreasing.

A document's ids, with one end id, are cut into full windows and a rest. Full windows stand alone.
Rests are packed longest first: a segment tree over remaining capacities, 0 to the window, counts the
open windows of each capacity and finds the tightest one that still takes the rest.

Ids never leave the task that made them: only (start, length, checksum) rows are dealt out evenly
and packed in groups of GROUP_ROWS rests, so memory is bounded and no key can be hot. Each group
leaves at most a few windows partly filled.

Cases: null or empty text is one end id; repeated rows are packed each on its own; null ids are kept;
an empty table gives an empty result; extra columns are ignored; a document of many windows
becomes many pieces and is never cut short.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read
from .tokens import default_tokenizer, encoder

#: Rests that are packed together.
GROUP_ROWS = 65_536
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


class Capacities:
    """A segment tree whose leaf c counts the open windows with remaining capacity c."""

    def __init__(self, window: int):
        self.leaves = 1
        while self.leaves <= window:
            self.leaves *= 2
        self.count = [0] * (2 * self.leaves)

    def add(self, capacity: int, by: int) -> None:
        k = self.leaves + capacity
        while k:
            self.count[k] += by
            k >>= 1

    def tightest(self, need: int) -> int:
        """The least capacity >= need with an open window, or -1."""
        count, k = self.count, self.leaves + need
        if count[k]:
            return need
        while True:
            while k & 1:  # a right child: nothing to the right under this parent
                k >>= 1
                if k <= 1:
                    return -1
            if not k:
                return -1
            k += 1
            if count[k]:
                break
        while k < self.leaves:
            k *= 2
            if not count[k]:
                k += 1
        return k - self.leaves


def best_fit_decreasing(lengths: list[int], window: int) -> list[tuple[int, int]]:
    """For each length (1 to window) its (bin, offset), bins numbered from 0. Ties keep their order."""
    tree, open_bins, out, bins = Capacities(window), [[] for _ in range(window + 1)], [(0, 0)] * len(lengths), 0
    for k in sorted(range(len(lengths)), key=lambda k: -lengths[k]):
        need = lengths[k]
        capacity = tree.tightest(need)
        if capacity < 0:
            number, capacity = bins, window
            bins += 1
        else:
            number = open_bins[capacity].pop()
            tree.add(capacity, -1)
        out[k] = (number, window - capacity)
        if capacity > need:
            open_bins[capacity - need].append(number)
            tree.add(capacity - need, 1)
    return out


def _cut(path: str, window: int, end_id: int):
    end = int(end_id).to_bytes(4, "little")

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = encoder(path).encode
        for frame in batches:
            rows = []
            for doc_id, text in zip(frame["doc_id"].array, frame["text"].array):
                ids = encode(text) + end
                n = len(ids) // 4
                for start in range(0, n, window):
                    piece = ids[4 * start : 4 * (start + window)]
                    rows.append((doc_id, start, len(piece) // 4, zlib.crc32(piece), n))
            out = pd.DataFrame(rows, columns=["doc_id", "start", "length", "ids_crc32", "doc_tokens"])
            yield out.astype({"doc_id": "Int64"})

    return cut


def _pack(window: int):
    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        first = TaskContext.get().partitionId() << 40
        used, held, n_held = 0, [], 0

        def numbered(frame: pd.DataFrame) -> pd.DataFrame:
            nonlocal used
            frame = frame.sort_values(["length", "ids_crc32", "doc_id", "start"], ascending=[False, True, True, True], kind="stable", ignore_index=True)
            places = best_fit_decreasing(frame["length"].tolist(), window)
            frame["sequence_id"] = [first + used + b for b, _ in places]
            frame["offset"] = [o for _, o in places]
            used += 1 + max(b for b, _ in places)
            return frame

        for frame in batches:
            frame["doc_id"] = frame["doc_id"].astype("Int64")
            full = frame[frame["length"] == window].copy()
            if len(full):
                full["sequence_id"] = range(first + used, first + used + len(full))
                full["offset"] = 0
                used += len(full)
                yield full
            rest = frame[frame["length"] < window]
            held.append(rest)
            n_held += len(rest)
            if n_held >= GROUP_ROWS:
                yield numbered(pd.concat(held))
                held, n_held = [], 0
        if n_held:
            yield numbered(pd.concat(held))

    return pack


def pack_documents(
    docs: DataFrame, *, window: int = 1024, end_id: int = 0, tokenizer: str | None = None, id_col: str = "doc_id", text_col: str = "text", docs_per_task: int = 16_384
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    rows = docs.count()
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    pieces = texts.mapInPandas(_cut(tokenizer or default_tokenizer(), window, end_id), PIECES)
    dealt = pieces.repartition(max(1, -(-rows // docs_per_task)))
    return dealt.mapInPandas(_pack(window), PIECES + ", sequence_id long, offset long")


def op4_best_fit_decreasing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(read(spark, sf_dir, "documents"))
