"""Near-duplicate classes against all pairs, aligned by a plain dynamic programme."""

import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from spanmill.llm import neardup
from spanmill.llm.graph import components

SCHEMA = "doc_id long, text string, extra int"


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b):
            keep = row[j + 1]
            row[j + 1] = last + 1 if x == y else max(row[j + 1], row[j])
            last = keep
    return row[-1]


def brute_similarity(s, t):
    n = lcs(s, t)
    return n / (len(s) + len(t) - n) if s or t else 1.0


@given(st.lists(st.integers(0, 5), max_size=40), st.lists(st.integers(0, 5), max_size=40), st.sampled_from([0.5, 0.8, 0.9]))
@settings(deadline=None, max_examples=300)
def test_alignment(a, b, threshold):
    expected = brute_similarity(a, b)
    got = neardup.aligned(np.array(a, np.uint64), np.array(b, np.uint64), threshold)
    assert got == pytest.approx(expected if expected >= threshold - 1e-9 else 0.0)


def test_edited_sequences_align():
    rng = random.Random(4)
    for _ in range(40):
        a = [rng.randint(0, 400) for _ in range(300)]
        b = [x for x in a if rng.random() > 0.04] + [rng.randint(0, 400) for _ in range(rng.randint(0, 12))]
        expected = brute_similarity(a, b)
        assert neardup.aligned(np.array(a, np.uint64), np.array(b, np.uint64)) == pytest.approx(expected if expected >= 0.8 else 0.0)


def test_words_and_shingles():
    one, two = neardup.word_hashes(" a  bb\tccc\n a é"), neardup.word_hashes("a bb ccc a é")
    assert (one == two).all() and len(one) == 5 and one[0] == one[3] and len(set(one.tolist())) == 4
    assert len(neardup.word_hashes("")) == 0 and len(neardup.word_hashes(" \t")) == 0 and len(neardup.shingles(two)) == 1
    assert len(neardup.shingles(neardup.word_hashes("a b"))) == 1


def test_sketch_feels_order():
    rng = np.random.default_rng(1)
    a = rng.integers(0, 2**63, 300).astype(np.uint64)
    own = neardup.Sketch()
    assert (own.of(a) == own.of(a)).all()
    assert (own.of(a) == own.of(a[::-1].copy())).sum() < 4
    again = np.concatenate((a, a[:3]))  # shingles that repeat don't change the labels of the others
    assert (own.of(a) == own.of(again)).sum() > 25


def family(rng, n, words, edits):
    base = [f"b{rng.randint(0, 10**6)}" for _ in range(words)]
    out = [" ".join(base)]
    for _ in range(n - 1):
        own = list(base)
        for _ in range(rng.randint(1, edits)):
            own[rng.randrange(len(own))] = f"e{rng.randint(0, 10**6)}"
        out.append(" ".join(own))
    return out


def chain(rng, n, words):
    own = [f"c{rng.randint(0, 10**6)}" for _ in range(words)]
    out = [" ".join(own)]
    for _ in range(n - 1):
        own = list(own)
        for _ in range(3):
            own[rng.randrange(len(own))] = f"d{rng.randint(0, 10**6)}"
        out.append(" ".join(own))
    return out


def classes_of(texts):
    sh = [(t or "").split() for t in texts]
    root = list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(texts)):
        for j in range(i):
            same = (texts[i] or "") == (texts[j] or "")
            near = sh[i] and sh[j] and min(len(sh[i]), len(sh[j])) >= 0.8 * max(len(sh[i]), len(sh[j])) and len(set(sh[i]) & set(sh[j])) > 0
            if same or near and brute_similarity(sh[i], sh[j]) >= 0.8:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(texts))]


@pytest.mark.parametrize("block_rows", [500, 7])
def test_classes_equal_all_pairs(spark, monkeypatch, block_rows):
    monkeypatch.setattr(neardup, "BLOCK_ROWS", block_rows)
    rng = random.Random(8)
    texts = family(rng, 30, 160, 9) + chain(rng, 12, 160) + family(rng, 5, 40, 1)
    passage = " ".join(f"p{k}" for k in range(60))
    texts += [" ".join(f"x{rng.randint(0, 10**6)}" for _ in range(rng.randint(20, 80))) + " " + passage for _ in range(25)]
    texts += [texts[0]] * 5 + [None, "", "", "one two", "one two", "one three", "a b c d e", texts[1] + " tail", "\n".join(texts[2].split(" "))]
    texts += [" ".join(f"y{k % 700}" for k in range(9000)), " ".join(f"y{k % 700}" for k in range(9000)) + " end"]
    order = list(range(len(texts)))
    rng.shuffle(order)
    docs = spark.createDataFrame([(i, texts[i], 1) for i in order], SCHEMA)
    got = {r["doc_id"]: r["class_id"] for r in neardup.near_duplicates(docs).collect()}
    expected = classes_of(texts)
    assert [got[i] for i in range(len(texts))] == expected
    kept = neardup.drop_near_duplicates(docs)
    assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.collect()) == sorted(set(expected))


def edited(rng, words, share):
    """words with a share of them replaced, removed or doubled."""
    out = []
    for w in words:
        what = rng.randrange(3) if rng.random() < share else 3
        out += [[f"n{rng.randrange(10**6)}"], [], [w, f"n{rng.randrange(10**6)}"], [w]][what]
    return out


def test_recall_of_planted_near_copies(spark):
    """Of copies with up to a tenth of the words edited, at least 0.95 are found; other texts stay alone."""
    rng = random.Random(21)
    texts, pairs = [], []
    for k in range(400):
        n, share = rng.choice([12, 40, 80, 150, 400, 1500]), rng.choice([0.01, 0.02, 0.05, 0.08])
        base = [f"v{rng.randrange(3000)}" for _ in range(n)]
        near = edited(rng, base, share)
        if brute_similarity(base, near) >= 0.8 if n < 500 else True:
            pairs.append((len(texts), len(texts) + 1))
        texts += [" ".join(base), " ".join(near)]
    got = {r["doc_id"]: r["class_id"] for r in neardup.near_duplicates(spark.createDataFrame([(k, t, 0) for k, t in enumerate(texts)], SCHEMA)).collect()}
    found = sum(got[a] == got[b] for a, b in pairs) / len(pairs)
    assert found >= 0.98, found
    assert all(c // 2 == k // 2 for k, c in got.items())


def test_dropping_keeps_columns_of_any_name(spark):
    names = ["_row", "key", "_key", "_id", "_of", "_gone", "class_id", "bands", "words", "root", "a.b"]
    docs = spark.createDataFrame([(k, f"text number {k // 2} of some words", *[k] * len(names)) for k in range(10)], ["doc_id", "text", *names])
    out = neardup.drop_near_duplicates(docs)
    assert out.columns == docs.columns and all(set(r[2:]) == {r[0]} for r in out.collect()) and out.count() < 10


def test_odd_ids_and_empty_tables(spark):
    assert neardup.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0
    long = " ".join(f"w{k}" for k in range(50))
    docs = spark.createDataFrame([(None, "only here", 1), (3, long, 1), (3, long, 1), (None, long, 2), (2, "z " + long, 3)], SCHEMA)
    got = sorted(((r["doc_id"] is None, r["doc_id"] or 0, r["class_id"]) for r in neardup.near_duplicates(docs).collect()), key=str)
    assert got == sorted([(True, 0, None), (False, 3, 2), (False, 3, 2), (True, 0, 2), (False, 2, 2)], key=str)
    assert sorted((r["doc_id"] or -1) for r in neardup.drop_near_duplicates(docs).collect()) == [-1, 2]


@given(st.lists(st.tuples(st.integers(0, 30), st.integers(0, 30)), min_size=1, max_size=25))
@settings(deadline=None, max_examples=3)
def test_components(spark, links):
    root = {x: x for e in links for x in e if e[0] != e[1]}
    for _ in range(40):
        for a, b in links:
            if a != b:
                root[a] = root[b] = min(root[a], root[b])
    got = {r["key"]: r["root"] for r in components(spark.createDataFrame(links, "a int, b int")).collect()}
    assert got == root


def test_components_that_have_not_converged_are_an_error(spark):
    links = spark.createDataFrame([(k, k + 1) for k in range(40)], "a long, b long")
    with pytest.raises(RuntimeError):
        components(links, most_rounds=1)
    assert {tuple(r) for r in components(links).collect()} == {(k, 0) for k in range(41)}


@given(st.lists(st.integers(0, 200), min_size=1, max_size=60), st.integers(1, 9), st.data())
@settings(deadline=None, max_examples=200)
def test_counts_of_words_never_rule_out_a_link(a, times, data):
    """Also where a count is full."""
    a = np.array(a * times ** 3, "<u4")
    b = np.delete(a, data.draw(st.lists(st.integers(0, len(a) - 1), max_size=max(1, len(a) // 6))))
    n, m, x, y = len(a), len(b), *neardup._bags([neardup.bag(a), neardup.bag(b)])
    assert len(b) == 0 or not neardup.aligned(a, b) > 0 or neardup._possible(np.array([n]), np.array([m]), x[None], y[None], 0.8)[0]


def test_words_are_dealt_only_where_a_link_is_possible(spark, monkeypatch):
    """Texts that share a passage and nothing else make buckets, but their words needn't be dealt by bucket."""
    rng, dealt = random.Random(3), []
    plain = neardup._texts
    monkeypatch.setattr(neardup, "_texts", lambda fresh, keys, *columns: dealt.append((columns, keys.count())) or plain(fresh, keys, *columns))
    passage = " ".join(f"p{k}" for k in range(60))
    texts = [" ".join(f"x{rng.randint(0, 10**6)}" for _ in range(200)) + " " + passage for _ in range(40)]
    base = [f"f{k}" for k in range(200)]
    texts += [" ".join(base[:k] + ["new"] + base[k + 1 :]) for k in range(0, 200, 50)]
    got = {r["doc_id"]: r["class_id"] for r in neardup.near_duplicates(spark.createDataFrame([(k, t, 0) for k, t in enumerate(texts)], SCHEMA)).collect()}
    assert [got[k] for k in range(44)] == classes_of(texts)
    assert dict(dealt)["n", "bag"] > 20 and dict(dealt)["words",] == 4 and dict(dealt).get(("words", "bands"), 0) == 0


def test_near_copies_meet_others_once_and_not_in_every_bucket(spark, monkeypatch):
    """Near copies share most of their buckets; with others there, they are dealt once and not once for each bucket."""
    rng, dealt, plain = random.Random(12), [], neardup._dealt

    def counted(*arguments):
        own = plain(*arguments)
        dealt.append((own.count(), own.select("key").distinct().count()))
        return own

    monkeypatch.setattr(neardup, "_dealt", counted)
    texts = family(rng, 60, 160, 3) + family(rng, 1, 160, 1)
    base = texts[0].split()
    texts += [" ".join(base[:100] + [f"z{rng.randint(0, 10**6)}" for _ in range(60)]) for _ in range(12)]
    got = {r["doc_id"]: r["class_id"] for r in neardup.near_duplicates(spark.createDataFrame([(k, t, 0) for k, t in enumerate(texts)], SCHEMA)).collect()}
    assert [got[k] for k in range(len(texts))] == classes_of(texts)
    rows, keys = dealt[0]
    assert keys > 60 and rows < 5 * keys, dealt


@pytest.mark.parametrize("block_rows", [500, 3])
def test_every_pair_across_components_meets_once(spark, monkeypatch, block_rows):
    monkeypatch.setattr(neardup, "BLOCK_ROWS", block_rows)
    rng = random.Random(30)
    root = {bytes([k]): bytes([k % 7 if k < 30 else k]) for k in range(48)}
    buckets = {b: rng.sample(sorted(root), rng.randint(2, 20)) for b in [-5, *range(1, 24)]}
    buckets |= {b: sorted(root)[:12] + [bytes([40 + b % 4])] for b in range(50, 56)}
    members = spark.createDataFrame([(b, k, root[k]) for b, own in buckets.items() for k in own], "bucket long, key binary, root binary")
    sizes = spark.createDataFrame([(k, 10, b"") for k in root], "key binary, n long, bag binary")
    places = neardup._places(members, sizes)
    met, kinds = {}, set()
    for r in neardup._dealt(places, sizes).collect():
        met.setdefault((bytes(r["place"]), r["large"], r["i"], r["j"]), []).append(r)
        kinds.add((r["large"], len(r["place"])))
    found = []
    for (_, large, i, j), rows in met.items():
        assert len({bytes(r["key"]) for r in rows}) == len(rows)
        for x in rows:
            for y in rows:
                sided = x["major"] and not y["major"] if large else x["chunk"] == i and y["chunk"] == j and (i != j or x["key"] < y["key"])
                shared = sorted(b for b, own in buckets.items() if {bytes(x["key"]), bytes(y["key"])} <= set(own))
                if sided and x["root"] != y["root"] and shared and shared[0] in x["buckets"]:
                    found.append(frozenset((bytes(x["key"]), bytes(y["key"]))))
    expected = {frozenset((x, y)) for own in buckets.values() for x in own for y in own if root[x] != root[y]}
    assert len(found) == len(set(found)) and set(found) == expected
    assert kinds == {(True, 1), (True, 8), (False, 8)} or block_rows == 500


@given(st.lists(st.integers(0, 60), min_size=1, max_size=60), st.integers(1, 3), st.data())
@settings(deadline=None, max_examples=200)
def test_texts_that_are_linked_share_a_rare_word(a, times, data):
    a = np.array(a * times, "<u4")
    b = np.delete(a, data.draw(st.lists(st.integers(0, len(a) - 1), max_size=max(1, len(a) // 6))))
    b = np.append(b, np.array(data.draw(st.lists(st.integers(0, 90), max_size=max(1, len(a) // 9))), "<u4"))
    counts = np.random.default_rng(data.draw(st.integers(0, 99))).integers(0, 5, neardup.SLOTS)
    if len(b) and neardup.aligned(a, b) > 0:
        assert len(np.intersect1d(neardup.rarest(a, counts, 0.8), neardup.rarest(b, counts, 0.8)))


def test_a_crowded_bucket_is_dealt_by_rare_words(spark, monkeypatch):
    """Links in a bucket of many components are all found, with rows that don't grow with the square of its members."""
    monkeypatch.setattr(neardup, "BLOCK_ROWS", 2)
    rng, dealt, plain = random.Random(14), [], neardup._dealt

    def counted(*arguments):
        own = plain(*arguments)
        dealt.append(own.count())
        return own

    monkeypatch.setattr(neardup, "_dealt", counted)
    passage, rows = list(range(25)), []
    for k in range(120):
        rows.append([rng.randrange(100, 10**6) for _ in range(25)] + passage)
        if k % 12 == 0:
            rows.append([*rows[-1][:10], 99, *rows[-1][11:]])
    texts = {f"{k:03}".encode(): np.array(w, "<u4") for k, w in enumerate(rows)}
    for roots in (1, 40):  # every text alone, or one component of 40
        own = [(7, k, b"000" if int(k) < roots else k) for k in texts]
        members = spark.createDataFrame(own, "bucket long, key binary, root binary")
        fresh = spark.createDataFrame([(k, w.tobytes(), [7], len(w), neardup.bag(w)) for k, w in texts.items()], "key binary, words binary, bands array<long>, n long, bag binary")
        sizes = fresh.select("key", "n", "bag")
        del dealt[:]
        got = {(bytes(r["a"]), bytes(r["b"])) for r in neardup._blocked(members, sizes, fresh, 0.8).collect()}
        of = {k: r for _, k, r in own}
        expected = {(y, x) for x in texts for y in texts if x < y and of[x] != of[y] and neardup.aligned(texts[x], texts[y]) > 0}
        assert got == expected and expected
        assert sum(dealt) < 10 * len(texts), dealt


@pytest.mark.parametrize("large_from", [1, 5, 10**6])
def test_large_classes_give_every_key_the_least_id_of_its_class(spark, large_from):
    rng = random.Random(large_from)
    rows = [(b"k%05d" % k + b"-" * 10, rng.choice([None, rng.randint(0, 10**6)]), rng.choice([b"hot", b"hot", b"b", b"r%d" % k]) + b"root") for k in range(2000)]
    want = {}
    for key, low, root in rows:
        want.setdefault(root, []).append(low)
    least = {root: min((x for x in lows if x is not None), default=None) for root, lows in want.items()}
    got = neardup._class_of(spark.createDataFrame(rows, "key binary, _least long, root binary").repartition(3), large_from).collect()
    assert len(got) == len(rows) and {bytes(r["key"]): r["class_id"] for r in got} == {key: least[root] for key, _, root in rows}
