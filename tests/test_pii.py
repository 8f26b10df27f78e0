"""Patterns, policies, overlaps and replacements."""

import random
import re

import pytest

from spanmill.operators import pii
from spanmill.operators.pii import LENIENT, STRICT, Policy

HITS = {
    "EMAIL_ADDRESS": "write to ann.lee@example.org now", "PHONE_NUMBER": "call 415-555-0123 now", "US_SSN": "ssn 123-45-6789 end", "CREDIT_CARD": "card 4111111111111111 end",
    "IP_ADDRESS": "from 10.20.30.40 today", "URL": "see https://example.org/a?b=1 there", "IBAN_CODE": "DE89370400440532013000", "US_PASSPORT": "passport A12345678 end", "US_DRIVER_LICENSE": "driver's license no: D1234567",
    "ZIP_CODE": "zip code: 94105-1234", "MEDICAL_RECORD_NUMBER": "MRN: 1234567", "DATE_OF_BIRTH": "DOB: 01/02/1980", "AGE": "a 42-year-old man", "MEDICAL_LICENSE": "NPI: 1234567890", "US_BANK_NUMBER": "account number: 12345678901",
    "MEDICARE_ID": "MBI: 1EG4-TE5-MK73",
}


def test_patterns_are_complete():
    assert len(pii.PATTERNS) == 20 and len(pii.SCORED) == 22 and {e for _, e, _ in pii.PATTERNS + pii.SCORED} <= set(pii.ENTITY_TYPES) and len(pii.ENTITY_TYPES) == 21


def test_what_matches_need_is_in_every_match():
    """Texts that the patterns match hold what they are said to need, in any case of letters."""
    rng = random.Random(3)
    parts = [*HITS.values(), "Insurance Policy Number: BCBS-ALPHA", "my site johndoe.com", "WWW.Example.Org/x", "HTTPS://A.B/c", "A@B.CO", "K", "\u212a", "\u0131", " ", "-", ".", "@"]
    for _ in range(3000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(1, 3)))
        text = rng.choice([text, text.upper(), text.lower(), text.swapcase()])
        for own in (pii.PATTERNS, pii.SCORED):
            for p, e, _ in own:
                if re.search(p, text, re.IGNORECASE):
                    assert re.search(pii.needed(p, e), text.lower()), (p, text)


@pytest.mark.parametrize("entity", sorted(HITS))
def test_hits(entity):
    policy = Policy(score_threshold=0.3)
    assert entity in {d[0] for d in pii.detect_text(HITS[entity], policy)}


@pytest.mark.parametrize("text", ["", "plain words only", "version 1.2.3", "000-12-3456", "666-12-3456"])
def test_misses(text):
    assert pii.detect_text(text, STRICT) == []


@pytest.mark.parametrize("text", ["Insurance Policy Number: BCBS-ALPHA", "Policy No. AB-CDEF-GH on file", "medical record # XY-ZZTOP"])
def test_policy_numbers_without_digits(text):
    assert {(d[0], d[4]) for d in pii.detect_text(text, STRICT)} == {("MEDICAL_RECORD_NUMBER", 0.90)}


def test_policy_numbers_without_digits_are_audited(spark):
    docs = spark.createDataFrame([(1, "Insurance Policy Number: BCBS-ALPHA, thanks"), (2, "plain words")], "doc_id long, text string")
    done = pii.anonymize(docs)
    assert [(r["document_id"], r["entity_type"]) for r in pii.audit_rows(done).collect()] == [(1, "MEDICAL_RECORD_NUMBER")]
    assert {r["doc_id"]: r["deidentified_text"] for r in done.collect()} == {1: "[MEDICAL_RECORD_NUMBER], thanks", 2: "plain words"}


def test_group_span():
    found = pii.detect_text("zip code: 94105", STRICT)
    assert {(d[0], d[3]) for d in found} == {("ZIP_CODE", "94105")}  # by both its patterns, the bare one lifted


def test_resolution():
    a, b, c = ("X", 0, 5, "", 0.5, ""), ("Y", 2, 12, "", 0.4, ""), ("X", 3, 5, "", 0.9, "")
    assert pii.resolve([a, b, c]) == [b]
    assert pii.resolve([a, b, c], within_type=True) == [a, b]


def test_policy():
    own = Policy.from_dict({"default_strategy": "mask", "score_threshold": 0.5, "entities": {"URL": {"strategy": "replace"}, "AGE": {"enabled": False}}})
    assert own.strategy("URL") == "replace" and own.strategy("AGE") == "mask" and not own.allows("AGE", 0.9) and own.allows("URL", 0.5)
    with pytest.raises(ValueError):
        Policy.from_dict({"default_strategy": "blur"})
    assert STRICT.score_threshold == 0.7 and LENIENT.score_threshold == 0.35


def test_anonymize(spark):
    docs = spark.createDataFrame([(1, "card 4111111111111111, mail ann@example.org, aged: 42"), (2, None), (3, "")], "doc_id long, text string")
    got = {r["doc_id"]: r for r in pii.anonymize(docs).collect()}
    assert got[1]["deidentified_text"] == "card ****************, mail [EMAIL_ADDRESS], <AGE>"
    assert [(a["entity_type"], a["strategy"], a["start"], a["end"]) for a in got[1]["audit"]] == [("CREDIT_CARD", "mask", 5, 21), ("EMAIL_ADDRESS", "redact", 28, 43), ("AGE", "replace", 45, 53)]
    assert got[2]["deidentified_text"] is None and got[3]["deidentified_text"] == "" and got[2]["audit"] == []
    assert pii.audit_rows(pii.anonymize(docs)).columns == ["document_id", "entity_type", "strategy", "start", "end", "original_length", "score", "timestamp"]


def test_recognizer_plugs_in(spark):
    names = lambda texts: [[("PERSON", 0, 3, 0.9), ("ORG", 4, 7, 0.9)] for _ in texts]
    docs = spark.createDataFrame([(1, "Ann IBM")], "doc_id long, text string")
    assert pii.anonymize(docs, recognizer=names).first()["deidentified_text"] == "<PERSON> IBM"
