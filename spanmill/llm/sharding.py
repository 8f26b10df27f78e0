"""Size-balanced shards by sampled splitters.

A record's key is (hash of its text, id, salt), so that equal texts lie side by side; the salt, from the
record's place in the table, parts records equal in both. A size-weighted
sample of keys gives quantile boundaries; records are range-partitioned by them; ranges that turn
out overfull are sampled anew and subdivided. Exact sums per range then place every record on the
axis of cumulated bytes, which is cut into shards of equal length.

Ranges only share out the work: shard and slot follow from the exact sums, and a group of equal texts that
lies in several ranges is placed by its sums over all of them. Ranges that are overfull after
max_rounds subdivisions are an error, never left to one task; ranges of up to FEW_ROWS rows never count
as overfull, since rows are kept without their texts here.

Cases: null text counts as empty (size 1); null ids sort first; repeated rows are rows of their own;
equal texts share a shard unless
their group weighs more than GROUP_SHARE of a shard and lies across a cut; an empty table gives
an empty result; extra columns are ignored unless named in carry, and must not clash with the
result's own names.
"""

from __future__ import annotations

from itertools import accumulate

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .common import materialize, read, text_or_empty

#: A group of equal texts that weighs less than this share of a shard is never cut.
GROUP_SHARE = 0.02
#: Salts of records equal in text and id.
SALTS = 1 << 20
#: A range of so few rows is no burden to a task, whatever its texts weigh.
FEW_ROWS = 1000
_FIRST = -(2**63)


Key = tuple[int, int, int]


def splitters_of(sample: list[tuple[Key, float]], quota: float) -> list[Key]:
    """Boundaries that cut a weighted sample of keys into ranges of about quota.

    A boundary stands at the start of a hash unless that hash alone weighs more than quota, and at the
    start of an id there unless that id does.
    """
    out: list[Key] = []
    weight_of: dict[tuple, float] = {}
    for (h, i, _), w in sample:
        weight_of[h,] = weight_of.get((h,), 0.0) + w
        weight_of[h, i] = weight_of.get((h, i), 0.0) + w
    filled = 0.0
    for k, ((h, i, salt), w) in enumerate(sorted(sample)):
        if k and filled + w / 2 > quota:
            cut = (h, i if weight_of[h,] > quota else _FIRST, salt if weight_of[h, i] > quota else 0)
            if not out or cut > out[-1]:
                out.append(cut)
                filled = 0.0
        filled += w
    return out


def ranges_of(splitters: list[Key], h: np.ndarray, i: np.ndarray, salt: np.ndarray) -> np.ndarray:
    """The number of splitters at or below each key."""
    hashes, ids, salts = (np.array([x[k] for x in splitters], dtype=np.int64) for k in range(3))
    low, high = np.searchsorted(hashes, h, "left"), np.searchsorted(hashes, h, "right")
    out = low.copy()
    inside = np.flatnonzero(high > low)
    for a in np.unique(low[inside]):
        at = inside[low[inside] == a]
        known, place = np.unique(ids[a : high[at[0]]], return_inverse=True)
        pos = np.searchsorted(known, i[at], "left")
        equal = (pos < len(known)) & (known[np.minimum(pos, len(known) - 1)] == i[at])
        # (place of the id, whether it is a splitter's, salt) as one number, in order of keys
        out[at] = a + np.searchsorted((2 * place + 1) * SALTS + salts[a : high[at[0]]], (2 * pos + equal) * SALTS + np.where(equal, salt[at], 0), "right")
    return out.astype(np.int32)


def _range_udf(splitters: list[Key]):
    @F.pandas_udf(T.IntegerType())
    def range_of(h: pd.Series, i: pd.Series, salt: pd.Series) -> pd.Series:
        return pd.Series(ranges_of(splitters, h.to_numpy(np.int64), i.to_numpy(np.int64), salt.to_numpy(np.int64)))

    return range_of


def shard_by_size(
    docs: DataFrame,
    n_shards: int = 8,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    carry: tuple[str, ...] = (),
    ranges_per_shard: int = 32,
    samples_per_range: int = 64,
    rows_per_range: int = 500_000,
    max_rounds: int = 8,
    seed: int = 7,
) -> DataFrame:
    """Give each record a shard in 0..n_shards-1 with nearly equal bytes, and a gapless slot there.

    Returns id_col, the carry columns, size, text_crc32, range_id, shard, slot. The driver holds
    samples_per_range keys per range and one (bytes, rows) pair per range: with one range per
    rows_per_range rows, 60,000 ranges for 3e10 documents.
    """
    text = text_or_empty(text_col)
    keyed = materialize(
        docs.select(
            F.col(id_col).cast("long").alias(id_col), *carry, (F.octet_length(text) + 1).cast("long").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"), F.xxhash64(text).alias("_hash"),
            F.coalesce(F.col(id_col).cast("long"), F.lit(_FIRST)).alias("_id"), F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(SALTS)).alias("_salt"),
        ),
        "shard-keys",
    )
    total, rows = keyed.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count("*")).first()
    if not rows:
        return keyed.select(id_col, *carry, "size", "text_crc32", F.lit(0).alias("range_id"), F.lit(0).alias("shard"), F.lit(0).cast("long").alias("slot"))
    n_ranges = max(n_shards * ranges_per_shard, -(-rows // rows_per_range))
    quota = total / n_ranges

    def sampled(frame: DataFrame, bytes_there: float, ranges: float, again: int) -> list[tuple[Key, float]]:
        """Each key with a chance in proportion to its size, at most ranges * samples_per_range of them on average."""
        chance = F.least(F.lit(1.0), F.col("size") * (ranges * samples_per_range / bytes_there))
        uniform = F.shiftrightunsigned(F.xxhash64("_hash", "_id", "_salt", F.lit(seed + again)), 11) / float(2**53)
        return [((h, i, s), w) for h, i, s, w in frame.where(uniform < chance).select("_hash", "_id", "_salt", F.col("size") / chance).collect()]

    splitters = splitters_of(sampled(keyed, total, n_ranges, 0), quota)
    for again in range(1, max_rounds + 1):
        ranged = keyed.withColumn("range_id", _range_udf(splitters)("_hash", "_id", "_salt"))
        sums = {r[0]: (r[1], r[2], r[3]) for r in ranged.groupBy("range_id").agg(F.sum("size"), F.count("*"), F.max("size")).collect()}
        over = [k for k, (b, n, most) in sums.items() if n > FEW_ROWS and b > 2 * quota and b > 1.5 * most]
        if not over:
            break
        if again == max_rounds:
            raise RuntimeError(f"{len(over)} ranges are overfull after {max_rounds} rounds")
        there = float(sum(sums[k][0] for k in over))
        flagged = ranged.where(F.col("range_id").isin(over))
        more = splitters_of(sampled(flagged, there, 2 * there / quota, again), quota / 2)
        splitters = sorted({*splitters, *more})

    order = sorted(sums)
    starts = [0, *accumulate(sums[k][0] for k in order)]
    before = [0, *accumulate(sums[k][1] for k in order)]
    spark = docs.sparkSession
    offsets = spark.createDataFrame(
        [(k, int(b), int(n)) for k, b, n in zip(order, starts, before)], "range_id int, _bytes_before long, _rows_before long"
    )
    in_range = Window.partitionBy("range_id").orderBy("_hash", "_id", "_salt").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    in_group = Window.partitionBy("range_id", "_hash")
    placed = (
        ranged.join(F.broadcast(offsets), "range_id")
        .withColumn("_end", F.sum("size").over(in_range))
        .withColumn("_row", F.row_number().over(Window.partitionBy("range_id").orderBy("_hash", "_id", "_salt")))
        .withColumn("_group", F.sum("size").over(in_group))
        .withColumn("_group_start", F.min(F.col("_end") - F.col("size")).over(in_group))
    )
    placed = placed.withColumn("_group_start", F.col("_bytes_before") + F.col("_group_start"))
    parted = sorted({h for h, i, salt in splitters if i != _FIRST or salt})
    if parted:  # groups that a boundary cuts: one row for each such boundary at most
        over_ranges = placed.where(F.col("_hash").isin(parted)).groupBy("_hash").agg(F.sum("size").alias("_whole"), F.min("_group_start").alias("_whole_start"))
        placed = placed.join(F.broadcast(over_ranges), "_hash", "left").withColumns({"_group": F.coalesce("_whole", "_group"), "_group_start": F.coalesce("_whole_start", "_group_start")})
    whole = F.col("_group") <= GROUP_SHARE * total / n_shards
    middle = F.when(whole, F.col("_group_start") + F.col("_group") / 2).otherwise(F.col("_bytes_before") + F.col("_end") - F.col("size") / 2)
    shard = F.least(F.lit(n_shards - 1), F.floor(middle * n_shards / F.lit(float(total)))).cast("int")
    placed = materialize(
        placed.select(id_col, *carry, "size", "text_crc32", "range_id", shard.alias("shard"), (F.col("_rows_before") + F.col("_row") - 1).alias("_at")),
        "shard-places",
    )
    firsts = placed.groupBy("shard").agg(F.min("_at").alias("_first"))
    return placed.join(F.broadcast(firsts), "shard").select(
        id_col, *carry, "size", "text_crc32", "range_id", "shard", (F.col("_at") - F.col("_first")).cast("long").alias("slot")
    )


def op2_sampled_splitters(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = shard_by_size(read(spark, sf_dir, "documents"), 8)
    return out.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "range_id"
    )
