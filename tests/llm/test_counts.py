"""Token counts against the offsets of the tokenizers library."""

import random

import numpy as np
import pytest

from spanmill.llm import counts
from spanmill.llm.tokens import default_tokenizer, encoder

TEXTS = ["", None, "\n", "\n\n\n", "one line", "a\nb\n", "a \n\n b\r\nc", "é日本\n😀😀\nß", "x" * 3000 + "\n" + "y z " * 2000, "end<|endoftext|>\nof", "  lead\n   \n\ttail  "]


def brute(text, rule):
    if not text:
        return [(0, 0, 0)]
    starts = [0] + [k + 1 for k, c in enumerate(text) if c == "\n" and k + 1 < len(text)]
    section = [max(s for s, a in enumerate(starts) if a <= k) for k in range(len(text))]
    n = [0] * len(starts)
    for a, b in encoder(default_tokenizer()).tokenizer.encode(text, add_special_tokens=False).offsets:
        held = section[a : max(b, a + 1)]
        n[held[0] if rule == "first" else held[-1] if rule == "last" else max(sorted(set(held)), key=held.count)] += 1
    return list(zip(starts, [*starts[1:], len(text)], n))


@pytest.mark.parametrize("rule", counts.RULES)
def test_sections(rule):
    rng = random.Random(1)
    texts = TEXTS + ["".join(rng.choice(["word ", "\n", "\n\n", " ", "a", "12", ".", "the ", "nation"]) for _ in range(rng.randint(1, 40))) for _ in range(300)]
    for t in texts:
        assert counts.section_counts(t or "", encoder(default_tokenizer()), rule, counts.line_starts) == brute(t, rule), repr(t)


def test_sections_add_up(spark):
    docs = spark.createDataFrame([*enumerate(TEXTS), (None, "no id\nhere"), (4, TEXTS[4])], "doc_id long, text string")
    out = counts.count_tokens(docs).toPandas()
    for k, t in enumerate(TEXTS):
        own = out[out["doc_id"] == k]
        total = len(encoder(default_tokenizer()).tokenizer.encode(t or "", add_special_tokens=False).ids)
        assert (own["doc_tokens"] == total).all() and own["n_tokens"].sum() == total * (2 if k == 4 else 1)
    assert counts.count_tokens(docs.limit(0)).count() == 0
    with pytest.raises(ValueError):
        counts.count_tokens(docs, rule="any")


def test_boundary_rules():
    starts, ends, sections = np.array([0, 2, 5]), np.array([2, 5, 9]), np.array([0, 3, 8])
    assert counts.allocate(starts, ends, sections, "first").tolist() == [0, 0, 1]
    assert counts.allocate(starts, ends, sections, "last").tolist() == [0, 1, 2]
    assert counts.allocate(starts, ends, sections, "most").tolist() == [0, 1, 1]
