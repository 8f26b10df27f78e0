"""Spans from BIO tags and greedy matching against plain loops, and their cost on long documents."""

import random
import time
from collections import Counter

import pytest

from spanmill.operators import evaluate

LABELS = ["O", "O", "B-EMAIL", "I-EMAIL", "B-NAME_STUDENT", "I-PHONE_NUM", "B-WEIRD", "I-WEIRD", "B-", "I-"]
SPAN = "array<struct<start:int,end:int,entity_type:string>>"


def brute_gold(tokens, labels, spaces):
    out, at, now = [], 0, None
    for token, label, space in zip(tokens, labels, spaces):
        end = at + len(token)
        if label.startswith("I-") and now:
            now = (now[0], end, now[2])
        else:
            out += [now] if now else []
            kind = evaluate.LABELS.get(label[2:]) if label.startswith("B-") else None
            now = (at, end, kind) if kind else None
        at = end + bool(space)
    return out + ([now] if now else [])


def brute_hits(golds, predictions, least):
    free, hits = [True] * len(golds), 0
    for a, b in predictions:
        for k, (c, d) in enumerate(golds):
            both = min(b, d) - max(a, c)
            if free[k] and both > 0 and both / (max(b, d) - min(a, c)) >= least:
                free[k], hits = False, hits + 1
                break
    return hits


def test_spans_of_tags_equal_a_loop(spark):
    rng = random.Random(1)
    rows = []
    for k in range(60):
        n = rng.randint(0, 30)
        rows.append((k, ["x" * rng.randint(0, 5) + "é" for _ in range(n)], [rng.choice(LABELS) for _ in range(n)], [rng.random() < 0.7 for _ in range(n)]))
    rows.append((99, None, None, None))
    docs = spark.createDataFrame(rows, "k long, tokens array<string>, labels array<string>, trailing_whitespace array<boolean>").repartition(3)
    got = {r["k"]: [tuple(s) for s in r["gold"]] for r in evaluate.gold_spans(docs).collect()}
    assert got == {k: brute_gold(t or [], ls or [], s or []) for k, t, ls, s in rows} and sum(map(len, got.values())) > 50


@pytest.mark.parametrize("least", [0.2, 0.5, 1.0])
def test_greedy_equals_a_loop(least):
    rng = random.Random(7)
    for _ in range(300):
        spans = lambda n: [(a := rng.randint(0, 30), a + rng.randint(0, 9)) for _ in range(rng.randint(0, n))]
        golds, predictions = spans(12), spans(12)
        assert evaluate.greedy(golds, predictions, least) == brute_hits(golds, predictions, least)


def test_counts_over_documents_equal_a_loop(spark):
    rng = random.Random(3)
    spans = lambda: [(a := rng.randint(0, 40), a + rng.randint(1, 9), rng.choice("AB")) for _ in range(rng.randint(0, 15))]
    rows = [(spans(), spans()) for _ in range(200)] + [(None, [(0, 3, "A")]), ([(0, 3, "A")], None)]
    want = Counter()
    for predicted, gold in rows:
        for e in "AB":
            p, g = [[(a, b) for a, b, x in s or [] if x == e] for s in (predicted, gold)]
            hits = brute_hits(g, p, 0.5)
            want[e, "tp"] += hits
            want[e, "fp"] += len(p) - hits
            want[e, "fn"] += len(g) - hits
    got = evaluate.match_counts(spark.createDataFrame(rows, f"predicted {SPAN}, gold {SPAN}").repartition(4)).collect()
    assert {(r["entity_type"], c): r[c] for r in got for c in ("tp", "fp", "fn")} == dict(want)


def test_long_documents_take_linear_time(spark):
    n = 100_000
    spans = [(3 * k, 3 * k + 2) for k in range(n)]
    began = time.time()
    assert evaluate.greedy(spans, spans, 0.5) == n and evaluate.greedy([(0, 5)] * n, [(0, 5)] * n, 0.5) == n
    assert time.time() - began < 5
    docs = spark.createDataFrame([(1, ["word"] * n, ["B-EMAIL", "I-EMAIL", "O", "O"] * (n // 4), [True] * n)], "doc_id long, tokens array<string>, labels array<string>, trailing_whitespace array<boolean>")
    assert evaluate.gold_rows(docs).count() == n // 4
