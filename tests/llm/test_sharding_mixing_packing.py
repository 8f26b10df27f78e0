"""Sharding, mixing and packing against brute force, and their edge cases."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from spanmill.llm import common, mixing, packing, sharding
from spanmill.llm.tokens import default_tokenizer, encoder

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, len(t or "")) for i, t, s in rows], SCHEMA)


def odd_rows(n=400, seed=1):
    """Nulls, empties, copies, one very long text, a hot source, repeated rows."""
    rng = random.Random(seed)
    rows = [(k, " ".join("w%d" % rng.randint(0, 50) for _ in range(rng.randint(0, 60))), rng.choice(["a", "a", "a", "b", "é", "Z"])) for k in range(n)]
    rows += [(n + k, "same text here", "a") for k in range(n // 3)]
    rows += [(2 * n, None, None), (2 * n + 1, "", "b"), (2 * n + 2, "x y" * 5000, "b"), (None, "no id", None), (7, rows[7][1], rows[7][2])]
    return rows


def test_shards_are_even_and_gapless(spark):
    rows = odd_rows()
    out = sharding.shard_by_size(docs_of(spark, rows), 4).collect()
    assert len(out) == len(rows)
    assert Counter(r["doc_id"] for r in out) == Counter(r[0] for r in rows)
    text = {r[0]: r[1] or "" for r in rows}
    load, slots = Counter(), defaultdict(list)
    for r in out:
        raw = text[r["doc_id"]].encode()
        assert r["size"] == len(raw) + 1 and r["text_crc32"] == zlib.crc32(raw)
        load[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    whole = sum(load.values())
    longest = max(r["size"] for r in out)
    assert max(load.values()) - min(load.values()) <= 2 * longest + 0.05 * whole


def test_shards_repeat(spark):
    rows = [r for r in odd_rows(100) if r[0] is not None][:-1]
    pick = lambda d: sorted((r["doc_id"], r["shard"], r["slot"]) for r in sharding.shard_by_size(d, 4).collect())
    assert pick(docs_of(spark, rows)) == pick(docs_of(spark, rows[::-1]).repartition(5))


def test_small_groups_of_copies_stay_together(spark):
    rng = random.Random(3)
    rows = [(k, f"text number {k // 3} " * rng.randint(5, 9), "a") for k in range(3000)]
    rows = [(k, rows[k - k % 3][1], "a") for k in range(3000)]
    of = defaultdict(set)
    for r in sharding.shard_by_size(docs_of(spark, rows), 8).collect():
        of[r["text_crc32"]].add(r["shard"])
    assert all(len(s) == 1 for s in of.values())


def test_splitters_cut_by_weight():
    sample = [((h, 0, 0), 1.0) for h in range(100)] + [((50, i, 0), 1.0) for i in range(1, 60)] + [((70, 7, s), 1.0) for s in range(60)]
    cuts = sharding.splitters_of(sample, 20.0)
    assert cuts == sorted(set(cuts)) and any(h == 50 and i > 0 for h, i, _ in cuts) and any(h == 70 and i == 7 and s > 0 for h, i, s in cuts)


@given(st.lists(st.tuples(st.integers(-3, 3), st.integers(-2, 2), st.integers(0, 3)), max_size=12), st.lists(st.tuples(st.integers(-4, 4), st.integers(-3, 3), st.integers(0, 3)), min_size=1, max_size=30))
@settings(deadline=None)
def test_ranges_equal_comparison_of_keys(splitters, keys):
    own = sorted(set(splitters))
    got = sharding.ranges_of(own, *(np.array([k[j] for k in keys], dtype=np.int64) for j in range(3)))
    assert got.tolist() == [sum(s <= k for s in own) for k in keys]


def test_rows_equal_in_text_and_id_are_parted(spark):
    rows = [(None, "the same words in all of them", "a")] * 900 + [(k, f"other {k}", "a") for k in range(300)]
    out = sharding.shard_by_size(docs_of(spark, rows), 4, ranges_per_shard=8).collect()
    ranges, slots = Counter(), defaultdict(list)
    for r in out:
        ranges[r["range_id"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
    assert len(out) == 1200 and max(ranges.values()) < 0.15 * sum(ranges.values()) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    load = Counter()
    for r in out:
        load[r["shard"]] += r["size"]
    assert max(load.values()) - min(load.values()) < 0.05 * sum(load.values())


def even_and_gapless(out, n_shards):
    load, slots = Counter(), defaultdict(list)
    for r in out:
        load[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    return [load[k] for k in range(n_shards)]


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_repeated_rows_of_several_files(spark, sf):
    """Equal rows at the same place of two files: nothing but the file tells them apart."""
    docs = spark.read.parquet(f"/root/testdata/{sf}/documents.parquet")
    out = sharding.shard_by_size(docs.unionAll(docs), 8).select("shard", "slot", "size").collect()
    load = even_and_gapless(out, 8)
    assert len(out) == 2 * docs.count() and max(load) - min(load) <= 4 * max(r["size"] for r in out)


def test_two_equal_rows(spark):
    one = docs_of(spark, [(1, "the same text", "a")])
    out = sharding.shard_by_size(one.unionAll(one), 8).collect()
    assert len(out) == 2
    even_and_gapless(out, 8)


def test_groups_of_copies_that_lie_in_several_ranges_stay_together(spark):
    """Groups of 1.3 % of a shard, with far more ranges than groups."""
    rows = [(k, f"copies of the text number {k % 600} " + "x" * 100, "a") for k in range(30_000)]
    of, cut = defaultdict(set), sharding.shard_by_size(docs_of(spark, rows).repartition(4), 8, ranges_per_shard=125)
    found = cut.collect()
    for r in found:
        of[r["text_crc32"]].add(r["shard"])
    assert len({r["range_id"] for r in found}) > 800 and all(len(s) == 1 for s in of.values())
    load = even_and_gapless(found, 8)
    assert max(load) - min(load) <= 0.04 * sum(load) / 8


def test_shards_of_an_empty_table(spark):
    assert sharding.shard_by_size(docs_of(spark, []), 8).count() == 0


@given(st.lists(st.tuples(st.integers(0, 1000), st.integers(1, 5)), min_size=1, max_size=12))
@settings(deadline=None)
def test_targets(pairs):
    sizes, weights = [s for s, _ in pairs], [float(w) for _, w in pairs]
    got = mixing.targets(sizes, weights)
    assert sum(got) == pytest.approx(sum(sizes)) and all(0 <= t <= 3 * s + 1e-6 for t, s in zip(got, sizes))
    free = [k for k in range(len(sizes)) if sizes[k] and got[k] < 3 * sizes[k] - 1e-6]
    assert all(got[k] / weights[k] == pytest.approx(got[free[0]] / weights[free[0]]) for k in free)


@given(st.lists(st.integers(0, 500), min_size=1, max_size=6), st.integers(1, 9))
@settings(deadline=None)
def test_split_quotas(quotas, n):
    got = mixing.split_quotas(quotas, n, 5)
    assert got.sum(axis=0).tolist() == quotas and (got >= 0).all() and (got == mixing.split_quotas(quotas, n, 5)).all()
    assert got.sum(axis=1).max() - got.sum(axis=1).min() <= max(2, n.bit_length())


def words(text):
    return common.WORD and len([w for w in (text or "").replace("\t", " ").split(" ") if w])


def test_mix(spark):
    rows = odd_rows()
    plan = mixing.plan_mix(docs_of(spark, rows), block_words=64, least_block=16, bucket_rows=50).collect()
    assert Counter(r["doc_id"] for r in plan) == Counter(r[0] for r in rows)
    size, taken, target = Counter(), Counter(), {}
    seen = set()
    for r in plan:
        size[r["source"]] += r["size"]
        got = sum(p["length"] for p in r["pieces"])
        assert got <= 3 * r["size"]
        taken[r["source"]] += got
        target[r["source"]] = r["target"]
        for p in r["pieces"]:
            assert 0 <= p["start"] and p["start"] + p["length"] <= r["size"] and p["length"] > 0 and 0 <= p["shard"] < 8
            seen.add((r["source"], p["epoch"], p["block"], p["shard"]))
    assert len({x[:3] for x in seen}) == len(seen)  # a block lies in one shard
    for source in target:
        held = Counter(h for s, _, _, h in seen if s == source)
        assert max(held.values(), default=0) - min([held[k] for k in range(8)]) <= max(24, 0.6 * sum(held.values()))
    order = sorted((s for s in size if s is not None)) + [None]
    expected = mixing.targets([size[s] for s in order], [(1.0, 2.0, 3.0)[k % 3] for k in range(len(order))])
    for s, t in zip(order, expected):
        assert target[s] == pytest.approx(t) and abs(taken[s] - t) <= 1


def test_mix_repeats_and_handles_empty(spark):
    rows = odd_rows(60)
    pick = lambda d: sorted((r["doc_id"] or -1, sum(p["length"] for p in r["pieces"])) for r in mixing.plan_mix(d).collect())
    assert pick(docs_of(spark, rows)) == pick(docs_of(spark, rows[::-1]).repartition(3))
    assert mixing.plan_mix(docs_of(spark, [])).count() == 0
    assert mixing.mix(docs_of(spark, rows)).columns[-1] == "shuffle_key"


@given(st.integers(1, 4000), st.floats(0, 3), st.integers(1, 300), st.integers(0, 99))
@settings(deadline=None)
def test_draws_meet_the_target_to_the_word(size, share, block, seed):
    words = int(share * size)
    n = -(-size // block)
    strides = [mixing._stride(n, seed, e) for e in range(3)]
    got = mixing.draw(size, words, block, strides)
    taken = 0
    for e in range(3):
        for k in range(n):
            place = e * n + (strides[e][0] * k + strides[e][1]) % n
            if place < got[1]:
                full = min(block, size - k * block)
                taken += min(full, got[2]) if place == got[1] - 1 else full
    assert got[0] == n and taken == words


def brute_mix(rows, n_shards, least, per_shard, buckets, seed=11):
    """(source, words taken) of each shard by plain loops over the streams of words."""
    from pyspark.sql import SparkSession
    from pyspark.sql import functions as F

    frame = SparkSession.active().createDataFrame([(k, i, t) for k, (i, t, _) in enumerate(rows)], "k long, i long, t string")
    order = {r["k"]: (r["o"] % buckets, r["o"]) for r in frame.select("k", F.xxhash64("i", "t", F.lit(seed)).alias("o")).collect()}
    names = sorted({r[2] for r in rows if r[2] is not None}) + [None] * any(r[2] is None for r in rows)
    streams = {s: sum(((t or "").split() for k, (_, t, _) in sorted(enumerate(rows), key=lambda x: order[x[0]]) if rows[k][2] == s), []) for s in names}
    goal = mixing.targets([len(streams[s]) for s in names], [(1.0, 2.0, 3.0)[k % 3] for k in range(len(names))])
    plans = []
    for k, s in enumerate(names):
        size = len(streams[s])
        block = max(least, min(4096, size // (per_shard * n_shards)), 1)
        strides = [mixing._stride(-(-size // block), seed + k, e) for e in range(3)]
        plans.append((s, block, strides, *mixing.draw(size, min(3 * size, int(goal[k] + 0.5)), block, strides)))
    shards = mixing.split_quotas([p[4] for p in plans], n_shards, seed)
    out = Counter()
    for (s, block, strides, n, quota, last), column in zip(plans, shards.T):
        ends = np.cumsum(column)
        for e in range(3):
            for b in range(n):
                place = e * n + (strides[e][0] * b + strides[e][1]) % n
                if place < quota:
                    part = streams[s][b * block : b * block + (last if place == quota - 1 else block)]
                    out.update((s, int((ends <= place).sum()), w) for w in part)
    return out


def test_each_shard_holds_the_words_of_its_drawn_blocks(spark):
    rng = random.Random(4)
    rows = [(k, " ".join(f"d{k}w{j}" for j in range(rng.randint(0, 40))), rng.choice(["a", "a", "b", None])) for k in range(150)]
    got = Counter()
    for r in mixing.plan_mix(docs_of(spark, rows), n_shards=4, least_block=8, blocks_per_shard=16, bucket_rows=13).collect():
        own = (dict((i, t) for i, t, _ in rows)[r["doc_id"]] or "").split()
        for p in r["pieces"]:
            got.update((r["source"], p["shard"], w) for w in own[p["start"] : p["start"] + p["length"]])
    assert got == brute_mix(rows, 4, 8, 16, -(-150 // 13))


def test_the_draw_decides_what_is_taken(spark, monkeypatch):
    """With blocks in stream order instead of permuted, other words are taken; with other seeds too."""
    docs = docs_of(spark, [(k, " ".join(f"w{j}" for j in range(30)), "ab"[k % 7 == 0]) for k in range(200)])
    pick = lambda **o: {r["doc_id"]: [tuple(p) for p in r["pieces"]] for r in mixing.plan_mix(docs, least_block=16, **o).collect()}
    taken = lambda plan: {i: sum(p[4] for p in own) for i, own in plan.items()}
    drawn = pick()
    assert taken(drawn) != taken(pick(seed=12))
    monkeypatch.setattr(mixing, "_stride", lambda n, seed, epoch: (1, 0))
    assert taken(drawn) != taken(pick())
    monkeypatch.setattr(mixing, "split_quotas", lambda quotas, n, seed: np.array([quotas] + [[0] * len(quotas)] * (n - 1)))
    assert {p[0] for own in pick().values() for p in own} == {0} != {p[0] for own in drawn.values() for p in own}


def test_shards_are_written_in_shuffled_order(spark, tmp_path):
    docs = docs_of(spark, [(k, " ".join(f"w{j}" for j in range(30)), "ab"[k % 2]) for k in range(300)])
    mixed = mixing.mix(docs, n_shards=4)
    mixing.write_mix(mixed, str(tmp_path / "mix"), files_per_shard=2)
    back = spark.read.parquet(str(tmp_path / "mix"))
    assert sorted(map(tuple, back.select(mixed.columns).collect())) == sorted(map(tuple, mixed.collect()))
    ids = [r["doc_id"] for r in mixing.mixed_documents(docs).coalesce(1).collect()]
    runs = sum(b < a for a, b in zip(ids, ids[1:]))
    assert runs > 0.3 * len(ids)


def test_mixed_documents_hold_the_words_taken(spark):
    rows = [r for r in odd_rows(80) if r[0] is not None]
    out = mixing.mixed_documents(docs_of(spark, rows))
    assert out.columns == SCHEMA.replace(" long", "").replace(" string", "").split(", ")
    got = Counter()
    for r in out.collect():
        got[r["source"]] += words(r["text"])
        assert r["n_chars"] == len(r["text"])
    plan = Counter()
    for r in mixing.plan_mix(docs_of(spark, rows)).collect():
        plan[r["source"]] += sum(p["length"] for p in r["pieces"])
    assert got == +plan


def test_mixed_documents_keep_columns_of_any_name(spark):
    names = ["size", "target", "source_size", "pieces", "_row", "_id", "_source", "_order", "_sid", "_bucket", "_p", "_text", "_len", "_at", "a.b", "Shard"]
    docs = spark.createDataFrame([(k, "a b  c\nd", "s", 8, *[f"x{k}"] * len(names)) for k in range(20)], ["doc_id", "text", "source", "n_chars", *names])
    out = mixing.mixed_documents(docs)
    rows = out.collect()
    assert out.columns == docs.columns and {r[0] for r in rows} == set(range(20)) and all(set(r[4:]) == {f"x{r[0]}"} for r in rows)
    assert {r[1] for r in rows} == {"a b  c\nd"}


def brute_best_fit(lengths, window):
    free, out = [], {}
    for k in sorted(range(len(lengths)), key=lambda k: -lengths[k]):
        fits = [(f, b) for b, f in enumerate(free) if f >= lengths[k]]
        if not fits:
            free.append(window)
            fits = [(window, len(free) - 1)]
        tight = min(f for f, _ in fits)
        b = next(b for f, b in fits if f == tight)
        out[k] = tight
        free[b] -= lengths[k]
    return out, len(free)


@given(st.lists(st.integers(1, 32), max_size=80))
@settings(deadline=None)
def test_best_fit_decreasing(lengths):
    got = packing.best_fit_decreasing(lengths, 32)
    capacities, bins = brute_best_fit(lengths, 32)
    assert all(32 - offset == capacities[k] for k, (_, offset) in enumerate(got)) and len({b for b, _ in got}) == bins
    by_bin = defaultdict(list)
    for k, (b, offset) in enumerate(got):
        by_bin[b].append((offset, lengths[k]))
    for pieces in by_bin.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 32


def test_ids_equal_the_library():
    own = encoder(default_tokenizer())
    rng = random.Random(2)
    alphabet = [chr(c) for c in [*range(1, 0x250), *range(0x2000, 0x2030), 0x3000, 0xFEFF, 0x85]] + [" "] * 150 + ["\n"] * 60 + ["'s", "<|endoftext|>", "\r\n", "日本", "😀"]
    for _ in range(3000):
        text = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 30)))
        assert np.frombuffer(own.encode(text), "<u4").tolist() == own.tokenizer.encode(text, add_special_tokens=False).ids


def test_other_tokenizer_files_go_to_the_library(tmp_path):
    import json

    from spanmill.llm import tokens

    with open(default_tokenizer(), encoding="utf-8") as file:
        whole = json.load(file)
    assert tokens.plain_byte_level(whole) and encoder(default_tokenizer()).fast is not None
    for change in ({"normalizer": {"type": "Lowercase"}}, {"pre_tokenizer": {"type": "ByteLevel", "add_prefix_space": True, "trim_offsets": True, "use_regex": True}}, {"pre_tokenizer": {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}}):
        path = tmp_path / "other.json"
        path.write_text(json.dumps({**whole, **change}))
        own = tokens.Encoder(str(path))
        assert own.fast is None
        for text in ("Hello World", " x", "", "It's 42"):
            assert np.frombuffer(own.encode(text), "<u4").tolist() == own.tokenizer.encode(text, add_special_tokens=False).ids


def test_packing(spark):
    from tokenizers import Tokenizer

    rows = odd_rows(120)
    out = packing.pack_documents(docs_of(spark, rows), window=64, docs_per_task=50).collect()
    tokenizer = Tokenizer.from_file(default_tokenizer())
    ids = {r[0]: np.array(tokenizer.encode(r[1] or "", add_special_tokens=False).ids + [0], "<u4") for r in rows}
    covered, sequences = Counter(), defaultdict(list)
    for r in out:
        own = ids[r["doc_id"]]
        assert r["doc_tokens"] == len(own)
        assert r["ids_crc32"] == zlib.crc32(own[r["start"] : r["start"] + r["length"]].tobytes())
        covered[r["doc_id"]] += r["length"]
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    times = Counter(r[0] for r in rows)
    assert covered == {i: len(own) * times[i] for i, own in ids.items()}
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 64
    assert sum(covered.values()) / (64 * len(sequences)) > 0.9
    assert packing.pack_documents(docs_of(spark, [])).count() == 0
