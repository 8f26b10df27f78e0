"""Merkle fingerprints against a plain Python tree, and the order of documents with ties, nulls and copies."""

import hashlib
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from spanmill.llm import merkle

sha = lambda x: hashlib.sha256(x.encode("utf-8", "surrogatepass")).hexdigest()


def brute_print(text):
    lines, sections = text.split("\n"), [[]]
    for k, line in enumerate(lines):
        sections[-1].append(line)
        if k + 1 < len(lines) and (line == "" or sha(line)[0] in "0123" or lines[k + 1].startswith("#")):
            sections.append([])
    whole, out = "", ""
    for s in sections:
        digest = sha("".join("," + sha(line) for line in s))
        whole += "/" + digest
        out += "/" + digest[:16]
        for line in s:
            words, piece, pieces = re.findall(r" *[^ ]+ *| +", line), "", []
            n = 0
            for w in words:
                if not w.strip(" "):
                    pieces.append(w)
                    continue
                lead = len(w) - len(w.lstrip(" "))
                if n == 0 or lead == 0:
                    piece, n = piece + w, n + 1
                if n == 16 or w.rstrip(" ")[-1] in ".!?":
                    pieces.append(piece)
                    piece, n = "", 0
            if piece:
                pieces.append(piece)
            out += "," + sha(line)[:16] + "".join("." + sha(p)[:8] for p in pieces)
    return sha(whole) + out


def brute_nodes(p):
    return set(re.findall("[/,.]?[0-9a-f]+", p))


def brute_likeness(a, b):
    x, y = brute_nodes(a), brute_nodes(b)
    return 1.0 if a[:64] == b[:64] else 2.0 * len(x & y) / (len(x) + len(y))


def brute_edited(rows):
    """rows of (id, text): the outputs, as a multiset. Nulls first; rows equal in id are ordered by whatever, so ids that tie must be equal in text too."""
    own = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is not None, r[0] or 0))
    out = Counter()
    for k, (i, t) in enumerate(own):
        after, cut = own[(k + 1) % len(own)][1], len(t) // 4
        edited = t[: len(t) - cut] + after[:cut]
        a, b, c = brute_print(t), brute_print(edited), brute_print(after)
        out[i, len(t), sha(edited), a, b, brute_likeness(a, b), brute_likeness(a, c)] += 1
    return out


def own_rows(frame):
    return Counter((r["doc_id"], r["n_chars"], r["edited_sha256"], r["fingerprint"], r["edited_fingerprint"], r["near_edited"], r["near_next"]) for r in frame.collect())


def odd_texts(n=60, seed=4):
    rng = random.Random(seed)
    word = lambda: rng.choice(["a", "bé", "cat.", "dog!", "é?", "x" * 30, "# h", "tab\there", "𝒳y", "e,"])
    line = lambda: (rng.choice(["", " ", "# ", "  "]) + " ".join(word() for _ in range(rng.randint(0, 60))) + rng.choice(["", " ", "."])) if rng.random() > 0.1 else ""
    return ["\n".join(line() for _ in range(rng.randint(1, 12))) for _ in range(n)]


def test_fingerprints_and_edits_equal_brute_force(spark):
    texts = odd_texts()
    rows = [(10 * k, t) for k, t in enumerate(texts)] + [(5, None), (7, ""), (8, "one"), (9, "." * 50), (11, "word " * 40_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"_n": F.lit(1), "fingerprint": F.lit("clash"), "_a": F.lit(2)})
    assert own_rows(merkle.edited_by_next(docs.repartition(5))) == brute_edited(rows)


def test_copies_ties_and_null_ids(spark):
    rows = [(None, "no id at all, in four rows")] * 4 + [(3, "the same text and id. " * 9)] * 300 + [(4, "other words stand here, many of them")] + [(5, "the same text and id. " * 9)] + [(2, "first of those with ids")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = own_rows(merkle.edited_by_next(docs.repartition(7)))
    assert got == brute_edited(rows) and sum(got.values()) == len(rows)


@pytest.mark.parametrize("n", [0, 1, 2])
def test_few_rows(spark, n):
    rows = [(k, f"text of number {k}") for k in range(n)]
    assert own_rows(merkle.edited_by_next(spark.createDataFrame(rows, "doc_id long, text string"))) == brute_edited(rows)


def test_ids_equal_with_different_texts_keep_every_row(spark):
    rows = [(1, f"text of number {k}") for k in range(40)]
    out = merkle.edited_by_next(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(out) == 40 and len({r["fingerprint"] for r in out}) == 40


def test_roots_test_equality_and_branches_locate_edits(spark):
    lines = [f"paragraph number {k} has these words. And more of them here." for k in range(400)]
    changed = lines[:250] + ["an inserted paragraph"] + lines[250:]
    changed[17] = "another one stands here now"
    rows = [(1, "\n".join(lines), "\n".join(changed)), (2, "same", "same"), (3, "", "x")]
    prints = spark.createDataFrame(rows, "k long, a string, b string").select("k", "b", merkle.fingerprint(F.col("a")).alias("pa"), merkle.fingerprint(F.col("b")).alias("pb"))
    found = [tuple(r) for r in merkle.edits(prints, "k", "pa", "pb").collect()]
    assert {k for k, _, _ in found} == {1, 3}
    print_b = next(r["pb"] for r in prints.collect() if r["k"] == 1)
    digests = [re.findall(",([0-9a-f]{16})", s) for s in print_b[64:].split("/")[1:]]
    assert {digests[s][p] for k, s, p in found if k == 1} == {sha(changed[17])[:16], sha(changed[250])[:16]}
    near = prints.select("k", merkle.likeness(F.col("pa"), F.col("pb")).alias("x"), merkle.changed_paragraphs(F.col("pa"), F.col("pb")).alias("n")).collect()
    by = {r["k"]: (r["x"], r["n"]) for r in near}
    assert by[2] == (1.0, 0) and 0.9 < by[1][0] < 1 and by[1][1] == 2 and by[3] == (0.0, 1)


def test_a_swap_of_paragraphs_is_near_but_not_equal(spark):
    row = spark.createDataFrame([("a b\nc d\ne f", "c d\na b\ne f")], "a string, b string").select(merkle.likeness(merkle.fingerprint(F.col("a")), merkle.fingerprint(F.col("b"))).alias("x")).first()
    assert 0 < row["x"] < 1
