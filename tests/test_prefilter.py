"""Needs of patterns: whatever a pattern matches passes, and detections equal those of every pattern searched everywhere."""

import random
import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from spanmill.operators import pii, prefilter
from spanmill.operators.prefilter import Needs, Prefilter, needs

EVERY = [p for own in (pii.PATTERNS, pii.SCORED) for p, _, _ in own]


@pytest.mark.parametrize(("pattern", "want"), [
    ("abc", Needs(frozenset(["abc"]))), ("ab?c", Needs(frozenset(["a"]))), ("x(?:ab|cd)", Needs(frozenset(["xab", "xcd"]))), ("a*", Needs()), (r"\d{3}-?\d{4}", Needs(None, 7, 4)), (r"\d{3}\d+", Needs(None, 4, 4)),
    (r"(?:1|22)3", Needs(None, 2, 2)), (r"[0-9a]{5}", Needs()), (r"(?:ab|\d)x", Needs(frozenset(["x"]))), (r"(?=foo)\bbar", Needs(frozenset(["bar"]))), (r"(?:\d\d){2}", Needs(None, 4, 4)), ("A(?:B|)C", Needs(frozenset(["abc", "ac"]))),
])
def test_needs(pattern, want):
    found = needs(pattern)
    assert (found.digits, found.run) == (want.digits, want.run) and (found.literals or frozenset()) == (want.literals or frozenset())


@pytest.mark.parametrize("k", range(len(EVERY)))
def test_whatever_matches_is_allowed(k):
    own = Prefilter(EVERY)

    @given(st.from_regex(re.compile(EVERY[k], re.IGNORECASE)))
    @settings(max_examples=25, deadline=None, database=None, suppress_health_check=list(HealthCheck))
    def check(text):
        assert k in own.allowed(text)

    check()


def plain(text, policy):
    out, words = [], pii._Words(text)
    for pattern, entity, score, context in pii._compiled()[1]:
        if policy.allows(entity, pii.lifted(score) if context else score):
            for m in pattern.finditer(text):
                own, g = pii.lifted(score) if context and any(c in w for w in words.before(m.start()) for c in context) else score, 1 if m.lastindex else 0
                if policy.allows(entity, own):
                    out.append((entity, m.start(g), m.end(g), m[g], own, "regex"))
    return out


def test_detections_equal_those_of_every_pattern(spark, sf_dir):
    texts = [r[0] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("text").collect()]
    rng, pieces = random.Random(1), ["DOB: 1/2/1990", "zip code 94105", "MRN 1234567", "a@b.org", "www.x.io", "age 42", "ſite.com", "POLİCY", "mbı", "٣٤٥-12-3456", "K", "123-45-6789", "10.0.0.1", "Policy No. AB-CDEF", " ", "\n", "x", "account 123456789"]
    texts += ["".join(rng.choice(pieces) + rng.choice(["", " "]) for _ in range(rng.randint(1, 5))) for _ in range(2000)]
    for policy in (pii.STRICT, pii.LENIENT):
        assert all(pii.detect_text(t or "", policy) == plain(t or "", policy) for t in texts)


def test_without_the_library_results_are_the_same(monkeypatch):
    import builtins

    real = builtins.__import__

    def absent(name, *args, **kwargs):
        if name == "ahocorasick":
            raise ImportError(name)
        return real(name, *args, **kwargs)

    with monkeypatch.context() as m:
        m.setattr(builtins, "__import__", absent)
        own = prefilter.Prefilter(EVERY)
    assert own.of_all.automaton is None
    for text in ("zip code 94105, mail a@b.org", "nothing", "aged: 42"):
        assert list(own.allowed(text)) == list(Prefilter(EVERY).allowed(text))
