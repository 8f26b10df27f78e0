"""Anagram hashing against plain enumeration of words one letter apart."""

import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

from spanmill.llm import spelling


def brute_counts(rows, one_in=199):
    found = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{low}".encode())
            if one_in and h % one_in == 0:
                low = low[: h % len(low)] + low[h % len(low) + 1 :]
            found[low] += 1
    return {w: n for w, n in found.items() if len(w) >= 6 and n >= 5}


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    long, short = (a, b) if len(a) > len(b) else (b, a)
    return len(long) == len(short) + 1 and any(long[:k] + long[k + 1 :] == short for k in range(len(long)))


def brute_forms(counts):
    """All pairs."""
    by, words = defaultdict(set), sorted(counts)
    for k, a in enumerate(words):
        for b in words[:k]:
            if abs(len(a) - len(b)) < 2 and near(a, b):
                by[a].add(b)
                by[b].add(a)
    form = {}
    for w in words:
        best = min(by[w], key=lambda x: (-counts[x], x), default=None)
        if best and counts[best] >= 5 * counts[w]:
            form[w] = best

    def root(w):
        while w in form:
            w = form[w]
        return w

    return {(w, form.get(w), root(w), counts[w], len(by[w]), counts[form[w]] if w in form else None) for w in words}


def run(spark, rows, **kwargs):
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "doc_id AS n", "text AS word", "1 AS key")
    return [tuple(r) for r in spelling.variants(docs.repartition(4), **kwargs).select("word", "form", "root", "n", "n_near", "form_n").collect()]


@pytest.mark.parametrize("seed", range(3))
def test_forms_equal_enumeration_of_pairs(spark, seed):
    """Words of few letters, so that anagrams, runs of a letter and chains of forms are common."""
    rng = random.Random(seed)
    base = ["".join(rng.choice("abcé") for _ in range(rng.randint(6, 9))) for _ in range(60)]

    def changed(w):
        k = rng.randrange(len(w))
        return rng.choice([w[:k] + w[k + 1 :], w[:k] + rng.choice("abcéÉ") + w[k:], w[:k] + rng.choice("abdÿ") + w[k + 1 :], w[:k] + w[k:][::-1]])

    words = base + [changed(w) for w in base for _ in range(4)]
    words += [changed(w) for w in words]
    pool = [w for w in words for _ in range(rng.choice([1, 5, 6, 30, 160, 900]))]
    rng.shuffle(pool)
    rows = [(rng.choice([None, k, k]), rng.choice([" ", ", ", "1", "\n"]).join(x.title() if rng.random() < 0.2 else x for x in pool[k :: 50])) for k in range(50)]
    rows += [(900, None), (901, ""), rows[3], (902, "the words here are few")]
    want = brute_forms(brute_counts(rows))
    got = run(spark, rows)
    assert len(got) == len(set(got)) and set(got) == want
    assert sum(f is not None for _, f, *_ in got) > 20 and any(r != f and f for _, f, r, *_ in got)


def test_many_anagrams_without_near_words_and_all_letters_at_one_place(spark):
    rng = random.Random(5)
    anagrams = {"".join(rng.sample("abcdefghij", 10)) for _ in range(400)}
    place = ["prefix" + c + "suffix" for c in "abcdefghijklmnopqrstuvwxyzàéÿ×÷"]
    rows = [(k, " ".join([*anagrams, *place, *place[:3] * (k % 9)])) for k in range(7)]
    assert set(run(spark, rows, one_in=0)) == brute_forms(brute_counts(rows, 0))


def test_long_words_cost_their_length(spark):
    long = "ab" * 100_000
    rows = [(k, f"{long} {long}a {long}ca" if k else (long + "c ") * 40) for k in range(6)]
    got = {w[-4:] + str(len(w)): (f and len(f), k) for w, f, _, _, k, _ in run(spark, rows, one_in=0)}
    assert got == {"abab200000": (200_001, 2), "baba200001": (200_001, 3), "abca200002": (200_001, 2), "babc200001": (None, 3)}


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, "")], [(1, "lonely lonely lonely lonely lonely")]])
def test_few_words(spark, rows):
    assert set(run(spark, rows, one_in=0)) == brute_forms(brute_counts(rows, 0))
