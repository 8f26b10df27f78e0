"""Near-duplicates by order MinHash over word shingles, verified by banded alignment of words.

Equal texts become one key (their MD5). A text's k-mers are its shingles of SHINGLE words, labelled by
occurrence. An order-MinHash value takes the L least labels under one hash and keeps them in text
order, so that it is sensitive to edits and to moved text; ROWS values make a band, and keys that
share one of BANDS bands are candidates. Texts of up to SHORT words, in which one edit can change
most shingles, have as many further bands over runs of SHORT_SHINGLE words.

Candidates are not expanded into pairs. In each bucket the key that shares most with others is the
hub; all members are verified against it, in chunks that hold the hub's words once, and links grow
into components. Buckets that still hold several components are cut into blocks of bounded size, in
which the members across components are aligned, so no candidate pair is left between components
unverified. A component that is the largest of many buckets meets the others of all of them at once, and
members of crowded buckets are first parted by their rarest words, an exact prefix filter. The words that
two texts share in any order bound their alignment from above. Counted in 64 hash buckets, they are 64
bytes a text: by them pairs with a hub, and members without any possible partner in a block, are ruled
out before words are dealt out. Counted in 256 in a block, they rule out most of the rest before it is aligned.

The similarity of two texts is LCS / (n + m - LCS) over their words, at least THRESHOLD: one word in
nine may be replaced. The alignment runs bit-parallel in the band that the threshold allows. Over
shingles instead, an edit would count five times: where words are replaced here and there, 0.8 here
is about 0.4 there, so that what reaches 0.8 there does so here too.

Chance of a candidate for shingle similarity s: 1 - (1 - s**(L * ROWS)) ** BANDS, 0.99 at 0.39.

Cases: null text is empty; empty texts are copies of each other; a text of fewer than SHINGLE words
is one shingle; repeated rows share a class; a class is named by its least id, null if it has none;
an empty table gives an empty result; extra columns of any name are ignored, or kept by
drop_near_duplicates.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import drop_tables, materialize, nested, read, tables_since, unnested
from .graph import components

SHINGLE, THRESHOLD = 5, 0.8
L, ROWS, BANDS = 2, 1, 32
SHORT, SHORT_SHINGLE = 100, 2
#: Members and words in a chunk of a bucket, and the bound for broadcasting keys or ids.
BLOCK_ROWS, BLOCK_WORDS, BROADCAST_ROWS = 500, 2_000_000, 200_000
#: A class of so many different texts counts as large: its keys aren't joined by their root.
LARGE_CLASS = 1000
#: Hash buckets in which a text's words are counted, a byte each. A count of 255 stands for that or any more.
BAG = 64
#: Hash buckets in which the texts that hold a word are counted, to tell rare words.
SLOTS = 2**18

_P = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_P), -1, 2**64))
_power = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_power[0]) < n:
        for k, base in enumerate((_P, _INVERSE)):
            full = np.full(2 * n, base, np.uint64)
            full[0] = 1
            _power[k] = np.multiply.accumulate(full)
    return _power[0][:n], _power[1][:n]


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(text: str) -> np.ndarray:
    """A 64-bit hash of each word, from prefix sums of a polynomial over the UTF-8 bytes."""
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    inside = (raw != 32) & ((raw < 9) | (raw > 13))
    edge = np.flatnonzero(np.diff(np.concatenate(([False], inside, [False])).view(np.int8)))
    starts, ends = edge[::2], edge[1::2]
    if not len(starts):
        return np.zeros(0, np.uint64)
    up, down = _powers(len(raw))
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * up, dtype=np.uint64)))
    return _mixed((sums[ends] - sums[starts]) * down[starts])


def shingles(words: np.ndarray, k: int = SHINGLE) -> np.ndarray:
    """Hashes of all runs of k words; of the whole where there are fewer."""
    if not len(words):
        return words
    k = min(k, len(words))
    out = np.full(len(words) - k + 1, k, np.uint64)
    for j in range(k):
        out = out * _P + words[j : len(words) - k + 1 + j]
    return _mixed(out)


def _labelled(s: np.ndarray) -> np.ndarray:
    """Shingles made distinct by the number of their occurrence."""
    order = np.argsort(s, kind="stable")
    ranked = s[order]
    new = np.concatenate(([True], ranked[1:] != ranked[:-1]))
    if new.all():
        return s
    occurrence = np.arange(len(s)) - np.maximum.accumulate(np.where(new, np.arange(len(s)), 0))
    out = s.copy()
    again = occurrence > 0  # the first occurrence keeps its hash, as in a text where nothing repeats
    out[order[again]] = _mixed(ranked[again] + occurrence[again].astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    return out


class Sketch:
    """Bands of order-MinHash values, from a seed."""

    def __init__(self, bands: int = BANDS, rows: int = ROWS, take: int = L, seed: int = 5):
        rng = np.random.Generator(np.random.PCG64(seed))
        self.bands, self.rows, self.take = bands, rows, take
        self.xor = rng.integers(0, 2**64, bands * rows, np.uint64)
        self.factor = rng.integers(0, 2**64, bands * rows, np.uint64) | np.uint64(1)

    def of(self, s: np.ndarray) -> np.ndarray:
        """One hash per band, of a non-empty sequence of shingles."""
        x = _labelled(s)
        n, take = len(x), min(self.take, len(x))
        values = np.empty(len(self.xor), np.uint64)
        step = max(1, 500_000 // n)
        for a in range(0, len(values), step):
            h = (x[None, :] ^ self.xor[a : a + step, None]) * self.factor[a : a + step, None]
            rows, at = np.arange(len(h)), []
            for j in range(take):
                at.append(h.argmin(axis=1))
                if j + 1 < take:
                    h[rows, at[-1]] = np.uint64(2**64 - 1)
            value = np.full(len(h), take, np.uint64)
            for position in np.sort(np.stack(at), axis=0):
                value = _mixed(value * _P + s[position])
            values[a : a + step] = value
        out = np.arange(1, self.bands + 1).astype(np.uint64)
        for r in range(self.rows):
            out = _mixed(out * _P + values[r :: self.rows])
        return out


def _shared(a: np.ndarray, b: np.ndarray, buckets: int = 1024) -> int:
    """Words that two sequences share in any order, at most: counted by hash bucket. No alignment is longer."""
    count = lambda x: np.bincount((x & (buckets - 1)).astype(np.int64), minlength=buckets)
    return int(np.minimum(count(a), count(b)).sum())


def aligned(a: np.ndarray, b: np.ndarray, threshold: float = THRESHOLD) -> float:
    """LCS / (n + m - LCS) if it reaches the threshold, else 0."""
    n, m = len(a), len(b)
    if not n or not m:
        return float(n == m)
    need = int(np.ceil(threshold * (n + m) / (1 + threshold) - 1e-9))
    if min(n, m) < need:
        return 0.0
    short = min(n, m)
    differ = np.flatnonzero(a[:short] != b[:short])
    head = int(differ[0]) if len(differ) else short
    rest = short - head
    differ = np.flatnonzero(a[n - rest :][::-1] != b[m - rest :][::-1])
    tail = int(differ[0]) if len(differ) else rest
    x, y = a[head : n - tail], b[head : m - tail]
    lcs = head + tail
    if len(x) and len(y):
        if lcs + _shared(x, y) < need:
            return 0.0
        places: dict[int, int] = {}
        for j, v in enumerate(y.tolist()):
            places[v] = places.get(v, 0) | 1 << j
        width = n + m - 2 * need  # more insertions and deletions than that fall short
        band, full = (1 << (2 * width + 1)) - 1, (1 << len(y)) - 1
        row = full
        for i, v in enumerate(x.tolist()):
            hit = places.get(v)
            if hit:
                hit &= (band << (i - width) if i >= width else band >> (width - i))
                step = row & hit
                row = ((row + step) | (row - step)) & full
        lcs += len(y) - row.bit_count()
    return lcs / (n + m - lcs) if lcs >= need else 0.0


def bag(words: np.ndarray) -> bytes:
    """The words' counts by hash bucket."""
    return np.minimum(np.bincount((words & (BAG - 1)).astype(np.int64), minlength=BAG), 255).astype(np.uint8).tobytes()


def _bags(raw: list[bytes]) -> np.ndarray:
    """The counts, a row for each; a full byte is more than any text has."""
    counts = np.frombuffer(b"".join(raw), np.uint8).reshape(-1, BAG).astype(np.int64)
    return np.where(counts == 255, 2**40, counts)


def _possible(n: np.ndarray, m: np.ndarray, a: np.ndarray, b: np.ndarray, threshold: float) -> np.ndarray:
    """Where texts of n and m words with counts a and b could reach the threshold; never false where they do."""
    need = np.ceil(threshold * (n + m) / (1 + threshold) - 1e-9)
    return (np.minimum(n, m) >= need) & (np.minimum(a, b).sum(axis=-1) >= need)


def _signatures(bands: int, rows: int, take: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sketch, short, seen = Sketch(bands, rows, take), Sketch(bands, rows, take, seed=6), set()
        for frame in batches:
            out = []
            for key, text in zip(frame["key"].array, frame["text"].array):
                if key in seen:
                    out.append((None, None, None, None))
                    continue
                if len(seen) < 200_000:
                    seen.add(key)
                w = word_hashes(text)
                own = [sketch.of(shingles(w))] if len(w) else []
                if 0 < len(w) <= SHORT:
                    own.append(short.of(shingles(w, SHORT_SHINGLE)))
                w = (w >> np.uint64(32)).astype("<u4")
                out.append((w.tobytes(), np.concatenate(own).view(np.int64) if own else np.zeros(0, np.int64), len(w), bag(w)))
            words, found, n, bags = zip(*out) if out else [()] * 4
            yield pd.DataFrame({"doc_id": frame["doc_id"].astype("Int64").array, "key": frame["key"], "words": list(words), "bands": list(found), "n": pd.array(list(n), "Int64"), "bag": list(bags)})

    return run


def _sequence(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, "<u4")


def _groups(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[tuple[tuple, pa.Table]]:
    """Runs of rows with equal values of names, over batches sorted by them. One run is held at a time."""
    held, last = [], None
    for batch in batches:
        keys = list(zip(*(batch.column(n).to_pylist() for n in names)))
        starts = [k for k in range(len(keys)) if k == 0 or keys[k] != keys[k - 1]]
        for a, b in zip(starts, [*starts[1:], len(keys)]):
            if held and keys[a] != last:
                yield last, pa.Table.from_batches(held)
                held = []
            last = keys[a]
            held.append(batch.slice(a, b - a))
    if held:
        yield last, pa.Table.from_batches(held)


def _linked(pairs: list[tuple[bytes, bytes]]) -> pa.RecordBatch:
    own = [(max(p), min(p)) for p in pairs]
    return pa.RecordBatch.from_arrays([pa.array([p[k] for p in own], pa.binary()) for k in (0, 1)], names=["a", "b"])


def _stars_possible(threshold: float):
    """Pairs (hub, key) that could be links, with the words of key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                n, m, a, b = (batch.column(c) for c in ("n", "_n", "bag", "_bag"))
                fit = _possible(n.to_numpy(), m.to_numpy(), _bags(a.to_pylist()), _bags(b.to_pylist()), threshold)
                yield batch.select(["hub", "key", "n"]).filter(pa.array(fit))

    return run


def _blocks_possible(threshold: float):
    """Members (place, large, key) of blocks that could have a link to a member of another component there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (place, large, i, j), table in _groups(batches, ["place", "large", "i", "j"]):
            codes: dict[bytes, int] = {}
            roots = np.array([codes.setdefault(r, len(codes)) for r in table["root"].to_pylist()])
            if len(codes) < 2:
                continue
            first, second = _sides(table, large, i, j)
            n, bags, found = table["n"].to_numpy(), _bags(table["bag"].to_pylist()), np.zeros(len(roots), bool)
            for x in np.flatnonzero(first):
                others = np.flatnonzero(second & (roots != roots[x]))
                if found[x]:  # what is left to tell is which others could
                    others = others[~found[others]]
                others = others[_possible(n[others], n[x], bags[others], bags[x], threshold)]
                found[others] = True
                found[x] |= len(others) > 0
            if found.any():
                keys = table["key"].to_pylist()
                own = [keys[x] for x in np.flatnonzero(found)]
                yield pa.RecordBatch.from_arrays([pa.array([place] * len(own), pa.binary()), pa.array([large] * len(own)), pa.array(own, pa.binary())], names=["place", "large", "key"])

    return run


def _slots(x: np.ndarray) -> np.ndarray:
    return (_mixed(x) & np.uint64(SLOTS - 1)).astype(np.int64)


def _held_by(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many texts hold a word, by slot; a word that repeats counts as others."""
    for batch in batches:
        own = [_slots(_labelled(_sequence(w).astype(np.uint64))) for w in batch.column("words").to_pylist()]
        found, n = np.unique(np.concatenate(own) if own else np.zeros(0, np.int64), return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(found, pa.int64()), pa.array(n, pa.int64())], names=["slot", "n"])


def rarest(words: np.ndarray, counts: np.ndarray, threshold: float) -> np.ndarray:
    """A text's rarest words by counts, repeated ones apart: so many that two texts that reach the threshold share one.

    Such texts share threshold * n words or more for either's n, so more than either leaves out here.
    The least of the shared words, in the one order of all texts, is therefore among those of both.
    """
    x = _labelled(words.astype(np.uint64))
    return x[np.lexsort((x, counts[_slots(x)]))[: len(x) - int(np.ceil(threshold * len(x) - 1e-9)) + 1]]


def _rare(counts: np.ndarray, threshold: float):
    """(key, token) of each text's rarest words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, raw in zip(batch.column("key").to_pylist(), batch.column("words").to_pylist()):
                own = rarest(_sequence(raw), counts, threshold)
                yield pa.RecordBatch.from_arrays([pa.array([key] * len(own), pa.binary()), pa.array([t.tobytes() for t in own], pa.binary())], names=["key", "token"])

    return run


def _sides(table: pa.Table, large: bool, i: int, j: int) -> tuple[np.ndarray, np.ndarray]:
    """Which members of a block are to be held against which."""
    chunks, major = table["chunk"].to_numpy(), np.array(table["major"].to_pylist())
    return (major, ~major) if large else (chunks == i, chunks == j)


def _with_hubs(threshold: float):
    """Links of chunks of members with their hub, whose row is marked."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (hub, _), table in _groups(batches, ["hub", "chunk"]):
            rows = list(zip(table["is_hub"].to_pylist(), table["key"].to_pylist(), table["words"].to_pylist()))
            central = next((_sequence(w) for is_hub, _, w in rows if is_hub), None)
            if central is not None and (found := [(hub, k) for is_hub, k, w in rows if not is_hub and aligned(central, _sequence(w), threshold) > 0]):
                yield _linked(found)

    return run


def across(texts: list[np.ndarray], roots: np.ndarray, first: np.ndarray, second: np.ndarray, fair, threshold: float) -> list[tuple[int, int]]:
    """Links of members marked first with members marked second in another component, each pair once.

    fair(x, others) tells which pairs belong here. Members that links found here connect aren't aligned.
    """
    sizes, roots = np.array([len(t) for t in texts]), roots.copy()
    counts = np.stack([np.bincount((t & 255).astype(np.int64), minlength=256) for t in texts]).astype(np.int32)
    same, out, at = bool((first & second).any()), [], np.arange(len(texts))
    for x in np.flatnonzero(first):
        small, large = np.minimum(sizes, sizes[x]), np.maximum(sizes, sizes[x])
        others = np.flatnonzero(second & (roots != roots[x]) & (small >= threshold * large - 1e-9) & ((at > x) | (not same)))
        if len(others):
            need = np.ceil(threshold * (sizes[others] + sizes[x]) / (1 + threshold) - 1e-9)
            others = others[np.minimum(counts[others], counts[x]).sum(axis=1) >= need]
        if len(others):
            for y in others[fair(x, others)]:
                if roots[x] != roots[y] and aligned(texts[x], texts[y], threshold) > 0:
                    out.append((int(x), int(y)))
                    roots[roots == roots[y]] = roots[x]
    return out


def _in_blocks(threshold: float):
    """Links across components within blocks of places.

    A block holds a chunk of a largest component and a chunk of the members it meets, or two chunks of
    other members of a bucket. A pair is aligned where the first band it shares belongs, so once in all.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (_, large, i, j), table in _groups(batches, ["place", "large", "i", "j"]):
            if table.num_rows < 2:
                continue
            codes: dict[bytes, int] = {}
            roots = np.array([codes.setdefault(r, len(codes)) for r in table["root"].to_pylist()])
            if len(codes) < 2:
                continue
            own = table["bands"].combine_chunks()
            own = own.chunk(0) if isinstance(own, pa.ChunkedArray) else own
            lengths = np.diff(own.offsets.to_numpy())
            bands = np.zeros((len(roots), lengths.max()), np.int64)
            bands[np.arange(bands.shape[1]) < lengths[:, None]] = own.flatten().to_numpy()

            def fair(x: int, others: np.ndarray, bands=bands, here=table["buckets"].to_pylist()) -> np.ndarray:
                shared = (bands[others] == bands[x]) & (bands[x] != 0)
                return shared.any(axis=1) & np.isin(bands[x][shared.argmax(axis=1)], here[x])

            keys = table["key"].to_pylist()
            found = across([_sequence(w) for w in table["words"].to_pylist()], roots, *_sides(table, large, i, j), fair, threshold)
            if found:
                yield _linked([(keys[x], keys[y]) for x, y in found])

    return run


def _chunks(rows, words):
    """Chunks for so many members with so many words."""
    return F.greatest(F.lit(1), F.ceil(rows / BLOCK_ROWS), F.ceil(words / BLOCK_WORDS)).cast("int")


def _rows(a, wa, b, wb):
    """Rows dealt for a members with wa words to meet b members with wb words."""
    return a * _chunks(b, wb) + b * _chunks(a, wa)


def _if_few(keys: DataFrame) -> DataFrame:
    """keys, broadcast if there are few."""
    return F.broadcast(keys) if keys.count() <= BROADCAST_ROWS else keys


def _texts(fresh: DataFrame, keys: DataFrame, *columns: str) -> DataFrame:
    """key and columns of the texts with these distinct keys, once each and dealt by key, so that a join by key deals none of it again."""
    return fresh.select("key", *columns).join(_if_few(keys), "key", "left_semi").groupBy("key").agg(*[F.first(c).alias(c) for c in columns])


def _starred(pairs: DataFrame, sizes: DataFrame, fresh: DataFrame, threshold: float) -> DataFrame:
    """Links (a, b) among pairs (hub, key). A hub's words go once to each chunk of its members."""
    of_hubs = sizes.select(F.col("key").alias("hub"), F.col("n").alias("_n"), F.col("bag").alias("_bag"))
    both = pairs.join(sizes, "key").join(of_hubs, "hub")
    pairs = materialize(both.mapInArrow(_stars_possible(threshold), "hub binary, key binary, n long"), "neardup-possible")
    per = materialize(pairs.groupBy("hub").agg(_chunks(F.count("*"), F.sum("n")).alias("_c")), "neardup-chunks")
    large = _if_few(per.where("_c > 1"))  # all members of others are in chunk 0, without a join by a hot hub
    members = pairs.join(large, "hub", "left").select("hub", F.pmod(F.xxhash64("key"), F.coalesce("_c", F.lit(1))).cast("int").alias("chunk"), "key", F.lit(False).alias("is_hub"))
    hubs = per.select("hub", F.explode(F.sequence(F.lit(0), F.col("_c") - 1)).alias("chunk"), F.col("hub").alias("key"), F.lit(True).alias("is_hub"))
    keys = materialize(pairs.select("key").unionAll(per.select("hub")).distinct(), "neardup-starred")
    own = members.unionAll(hubs).join(_texts(fresh, keys, "words"), "key").select("hub", "chunk", "key", "words", "is_hub")
    return own.repartition("hub", "chunk").sortWithinPartitions("hub", "chunk").mapInArrow(_with_hubs(threshold), "a binary, b binary")


def _places(members: DataFrame, sizes: DataFrame) -> DataFrame:
    """Where members (bucket, key, root) meet: place, large, key, root, major, n, and its buckets that belong there.

    A bucket's largest component meets the other members in a large place. Members of a component
    share most of their buckets, so that one place for all buckets in which it is the largest, with
    each member once, mostly deals far fewer rows than a place for each bucket; where it deals more,
    there is one for each. The other members meet in the bucket, if they are of several components.
    """
    sized = members.join(sizes.select("key", "n"), "key")
    each = sized.groupBy("bucket", "root").agg(F.count("*").alias("c"), F.sum("n").alias("w"))
    per = each.groupBy("bucket").agg(F.max(F.struct("c", "w", "root")).alias("_top"), F.sum("c").alias("_all"), F.sum("w").alias("_words"), F.count("*").alias("_roots"))
    per = materialize(per.select("bucket", F.col("_top.root").alias("_of"), "_roots", _rows(F.col("_top.c"), F.col("_top.w"), F.col("_all") - F.col("_top.c"), F.col("_words") - F.col("_top.w")).alias("_apart")), "neardup-largest")
    met = materialize(sized.join(_if_few(per.drop("_apart")), "bucket").withColumn("major", F.col("root") == F.col("_of")), "neardup-met")
    once = met.groupBy("_of", "key").agg(F.first("major").alias("major"), F.first("n").alias("n")).groupBy("_of").agg(
        *[f.alias(c) for c, f in (("_a", F.count_if("major")), ("_wa", F.sum(F.when(F.col("major"), F.col("n")))), ("_b", F.count_if(~F.col("major"))), ("_wb", F.sum(F.when(~F.col("major"), F.col("n")))))]
    )
    cheaper = per.groupBy("_of").agg(F.sum("_apart").alias("_apart")).join(once, "_of").where(_rows(F.col("_a"), F.col("_wa"), F.col("_b"), F.col("_wb")) <= F.col("_apart"))
    together = materialize(cheaper.select("_of", F.lit(True).alias("_once")), "neardup-once")
    bucket = F.unhex(F.lpad(F.hex("bucket"), 16, "0"))  # of another length than a root
    large = met.join(_if_few(together), "_of", "left").withColumn("place", F.when(F.col("_once"), F.col("_of")).otherwise(bucket)).withColumn("large", F.lit(True))
    small = met.where(~F.col("major") & (F.col("_roots") > 2)).withColumn("place", bucket).withColumn("large", F.lit(False))
    both = large.drop("_once").unionByName(small)
    return both.groupBy("place", "large", "key").agg(*[F.first(c).alias(c) for c in ("root", "major", "n")], F.collect_list("bucket").alias("buckets"))


def _whole():
    """The place that a part is of."""
    return F.expr("substring(place, 1, length(place) - 8)")


def _counted(places: DataFrame) -> DataFrame:
    """Members and words on both sides of each place, the rows dealt for it, and whether it has two that could be linked."""
    major, n = F.col("major"), F.col("n")
    per = places.groupBy("place", "large").agg(
        F.count_if(major).alias("_a"), F.coalesce(F.sum(F.when(major, n)), F.lit(0)).alias("_wa"), F.count_if(~major).alias("_b"), F.coalesce(F.sum(F.when(~major, n)), F.lit(0)).alias("_wb"),
        (F.min("root") != F.max("root")).alias("_several"),
    )
    b, wb = F.col("_b"), F.col("_wb")
    return per.withColumn("_dealt", F.when(F.col("large"), _rows(F.col("_a"), F.col("_wa"), b, wb)).otherwise(b * _chunks(b, wb)))


def _parted(places: DataFrame, fresh: DataFrame, threshold: float) -> tuple[DataFrame, DataFrame] | None:
    """Parts of crowded places, and the places that they stand for; None if no place is crowded.

    A place of so many chunks that its members would be dealt more often than they have rare words is
    parted: a part holds the members with one rare word. Members that could have a link share one, so
    they meet in a part, and no part is dealt where none can. A part's name is its place's and the
    word, 8 bytes. Where words are so common that this would deal more, the place stays whole.
    """
    crowded = _counted(places).where(F.col("_dealt") > (1 - threshold) * (F.col("_wa") + F.col("_wb")) + F.col("_a") + F.col("_b"))
    crowded = materialize(crowded.select("place", "large", F.col("_dealt").alias("_whole")), "neardup-crowded")
    if crowded.isEmpty():
        return None
    own = places.join(_if_few(crowded), ["place", "large"], "left_semi")
    words = materialize(_texts(fresh, own.select("key").distinct(), "words"), "neardup-crowded-words")
    counts = np.zeros(SLOTS, np.int64)
    for r in words.mapInArrow(_held_by, "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n")).collect():
        counts[r["slot"]] = r["n"]
    rare = words.mapInArrow(_rare(counts, threshold), "key binary, token binary")
    parts = materialize(own.join(rare, "key").withColumn("place", F.concat("place", "token")).drop("token"), "neardup-parts")
    met = materialize(_counted(parts).where("_several and (not large or _a > 0 and _b > 0)").select("place", "large", "_dealt"), "neardup-parts-met")
    spent = met.groupBy(_whole().alias("place"), "large").agg(F.sum("_dealt").alias("_spent"))
    stood = materialize(crowded.join(spent, ["place", "large"], "left").where(F.coalesce("_spent", F.lit(0)) < F.col("_whole")).select("place", "large"), "neardup-parted")
    of = _if_few(stood.withColumnRenamed("place", "_whole"))
    used = met.drop("_dealt").withColumn("_whole", _whole()).join(of, ["_whole", "large"], "left_semi").drop("_whole")
    return parts.join(used, ["place", "large"], "left_semi"), stood


def _dealt(places: DataFrame, texts: DataFrame) -> DataFrame:
    """The rows of places with the columns of texts, sorted by the blocks (place, large, i, j) that they take part in.

    No pairs are dealt out: a member goes to the blocks it takes part in, at most one for each chunk
    that it meets, and no two chunks of the largest component ever meet.
    """
    per = materialize(_counted(places).select("place", "large", _chunks(F.col("_a"), F.col("_wa")).alias("_a"), _chunks(F.col("_b"), F.col("_wb")).alias("_b")), "neardup-chunks")
    many = _if_few(per.where("_a > 1 or _b > 1"))  # all members of others are in chunk 0, without a join by a hot place
    one = places.join(many, ["place", "large"], "left").withColumns({c: F.coalesce(c, F.lit(1)) for c in ("_a", "_b")})
    one = one.withColumn("chunk", F.pmod(F.xxhash64("key"), F.when(F.col("major"), F.col("_a")).otherwise(F.col("_b"))).cast("int"))
    met = one.drop("n").join(texts, "key").withColumn("_block", F.explode(F.expr("""
        if(large and not major, transform(sequence(0, _a - 1), i -> named_struct('i', i, 'j', chunk)),
           transform(sequence(0, _b - 1), j -> if(large, named_struct('i', chunk, 'j', j), named_struct('i', least(chunk, j), 'j', greatest(chunk, j)))))""")))
    own = met.select("place", "large", "_block.*", "chunk", *[c for c in places.columns if c not in ("place", "large", "n")], *[c for c in texts.columns if c != "key"])
    by = ["place", "large", "i", "j"]
    return own.repartition(*by).sortWithinPartitions(*by)


def _blocked(members: DataFrame, sizes: DataFrame, fresh: DataFrame, threshold: float) -> DataFrame:
    """Links (a, b) between members (bucket, key, root) of one bucket in different components.

    The blocks are met twice: first by counts of words, which tell the members that could have a link
    there, then by the words of those. In crowded places members are parted for the first by their rare words.
    """
    possible_in = lambda rows: _dealt(rows, sizes).mapInArrow(_blocks_possible(threshold), "place binary, large boolean, key binary")
    places = materialize(_places(members, sizes), "neardup-places")
    bare = places.drop("buckets")
    if parted := _parted(bare, fresh, threshold):
        parts, stood = parted
        possible = possible_in(bare.join(_if_few(stood), ["place", "large"], "left_anti"))
        possible = possible.unionAll(possible_in(materialize(parts, "neardup-parts-used")).withColumn("place", _whole()))
    else:
        possible = possible_in(bare)
    places = materialize(places.join(possible.distinct(), ["place", "large", "key"], "left_semi"), "neardup-possible")
    keys = materialize(places.select("key").distinct(), "neardup-blocked")
    return _dealt(places, _texts(fresh, keys, "words", "bands")).mapInArrow(_in_blocks(threshold), "a binary, b binary").distinct()


def _class_of(named: DataFrame, large_from: int = LARGE_CLASS) -> DataFrame:
    """(key, class_id) from (key, _least, root): the least of _least over a root's keys.

    The classes of large_from keys or more, of which there are 10,000 at most, are broadcast; their keys are
    spread over all tasks for the join of the other classes, so that no class gathers in one task.
    """
    classes = materialize(named.groupBy("root").agg(F.min("_least").alias("class_id"), F.count("*").alias("_n")), "neardup-classes")
    from_ = max(large_from, named.count() // 10_000)
    large, others = classes.where(F.col("_n") >= from_), classes.where(F.col("_n") < from_)
    met = named.join(F.broadcast(large.select("root", F.struct("class_id").alias("_large"))), "root", "left")
    spread = F.concat("root", F.substring("key", 1, 4))  # longer than a root, so no class has it
    met = met.withColumn("_at", F.when(F.col("_large").isNull(), F.col("root")).otherwise(spread))
    met = met.join(others.select(F.col("root").alias("_at"), F.col("class_id").alias("_other")), "_at", "left")
    return met.select("key", F.when(F.col("_large").isNull(), F.col("_other")).otherwise(F.col("_large.class_id")).alias("class_id"))


def near_duplicates(docs: DataFrame, *, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text", bands: int = BANDS, rows: int = ROWS, take: int = L) -> DataFrame:
    """doc_id, key, class_id: one row per row of docs; class_id is the least doc_id of its class."""
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    texts = texts.withColumn("key", F.unhex(F.md5(F.col("text").cast("binary"))))
    signed = materialize(texts.mapInPandas(_signatures(bands, rows, take), "doc_id long, key binary, words binary, bands array<long>, n long, bag binary"), "neardup-signatures")
    fresh = signed.where("bands is not null")  # a task gives them once for each text
    placed = fresh.groupBy("key").agg(F.first("bands").alias("bands")).select("key", F.explode("bands").alias("bucket"))
    crowded = placed.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
    members = materialize(placed.join(crowded, "bucket"), "neardup-members")
    central = members.groupBy("key").agg(F.sum("n").alias("score"))
    members = materialize(members.join(central, "key").select("bucket", "key", "score"), "neardup-scored")
    sizes = materialize(_texts(fresh, members.select("key").distinct(), "n", "bag"), "neardup-sizes")
    least = signed.groupBy("key").agg(F.min("doc_id").alias("_least"))

    hubs = members.groupBy("bucket").agg(F.max(F.struct("score", "key")).alias("h")).select("bucket", F.col("h.key").alias("hub"))
    pairs = materialize(members.join(hubs, "bucket").where(F.col("key") != F.col("hub")).select("hub", "key").distinct(), "neardup-stars")
    roots = components(materialize(_starred(pairs, sizes, fresh, threshold), "neardup-hubs"))
    labelled = members.join(roots, "key", "left").select("bucket", "key", F.coalesce("root", "key").alias("root"))
    several = labelled.groupBy("bucket").agg(F.min("root").alias("_low"), F.max("root").alias("_high")).where(F.col("_low") != F.col("_high")).select("bucket")
    mixed = materialize(labelled.join(several, "bucket", "left_semi"), "neardup-mixed")
    if not mixed.isEmpty():
        linked = materialize(_blocked(mixed, sizes, fresh, threshold), "neardup-links")
        if not linked.isEmpty():  # the new links join components: a graph over their roots
            of = lambda c: F.coalesce(f"_r{c}", c).alias(c)
            over = linked.join(roots.select(F.col("key").alias("a"), F.col("root").alias("_ra")), "a", "left").join(roots.select(F.col("key").alias("b"), F.col("root").alias("_rb")), "b", "left")
            merged = components(over.select(of("a"), of("b"))).select(F.col("key").alias("root"), F.col("root").alias("_top"))
            moved = roots.join(merged, "root", "left").select("key", F.coalesce("_top", "root").alias("root"))
            roots = materialize(moved.unionAll(merged.select(F.col("root").alias("key"), F.col("_top").alias("root"))).distinct(), "neardup-roots")
    named = least.join(roots, "key", "left").withColumn("root", F.coalesce("root", "key"))
    class_of = _class_of(materialize(named, "neardup-named"))
    return signed.select("doc_id", "key").join(class_of, "key").select("doc_id", "key", "class_id")


def op7_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read(spark, sf_dir, "documents")).select("doc_id", "class_id")


def drop_near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The document with the least id of each class, with all its columns; of its repeated rows, one.

    Documents without an id stay, unless their class has one with an id or they are equal. The tables
    needed to find the classes are dropped as soon as the ids to leave out are written.
    """
    before = len(tables_since())
    found = near_duplicates(docs, id_col=id_col, text_col=text_col, **options)
    own = F.col("doc_id").eqNullSafe(F.col("class_id"))
    gone = materialize(found.where(~own).select(F.col("doc_id").alias("_gone"), F.col("key").alias("_of")).distinct(), "neardup-gone")
    repeated = found.where(own).groupBy("doc_id", "key").count().where("count > 1")
    keyed = nested(docs, _id=F.col(f"`{id_col}`").cast("long"), _key=F.unhex(F.md5(F.coalesce(F.col(f"`{text_col}`"), F.lit("")).cast("binary"))))
    small, single = gone.count() <= BROADCAST_ROWS, repeated.isEmpty()
    drop_tables(docs.sparkSession, tables_since(before), keep=gone)
    kept = keyed.join(F.broadcast(gone) if small else gone, F.col("_id").eqNullSafe(F.col("_gone")) & (F.col("_key") == F.col("_of")), "left_anti")
    return unnested(kept if single else kept.dropDuplicates(["_id", "_key"]))
