"""Detection and de-identification of personal data in text by scored patterns, with a policy.

Detections are (entity_type, start, end, text, score, source), offsets in code points. Patterns with a
group report the group. A bare pattern of CONTEXT's types scores low by itself; a word of its type among
the WINDOW words before it lifts the score by BOOST, to LEAST at least. resolve() settles overlaps: the longest span wins, then the highest score, then
the first start; analyze() settles them among detections of one type only, so that a text counts
once per type. Named-entity recognition plugs in as a function; none is supplied.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spanmill.operators.prefilter import Prefilter

# Fixed values: (pattern, entity type, score), matched without regard to case.
PATTERNS: list[tuple[str, str, float]] = [
    (r"\b[A-Za-z0-9._%+\-]+@[A-Za-z0-9.\-]+\.[A-Za-z]{2,}\b", "EMAIL_ADDRESS", 0.95),
    (r"\b(?:\+1[\s.\-]?)?\(?[2-9]\d{2}\)?[\s.\-]?\d{3}[\s.\-]?\d{4}\b", "PHONE_NUMBER", 0.85),
    (r"\b(?!000|666)\d{3}[-\s]\d{2}[-\s]\d{4}\b", "US_SSN", 0.95),
    (r"\b(?:4[0-9]{12}(?:[0-9]{3})?|5[1-5][0-9]{14}|3[47][0-9]{13}|3(?:0[0-5]|[68][0-9])[0-9]{11}|6(?:011|5[0-9]{2})[0-9]{12}|(?:2131|1800|35\d{3})\d{11})\b", "CREDIT_CARD", 0.90),
    (r"\b(?:(?:25[0-5]|2[0-4]\d|[01]?\d\d?)\.){3}(?:25[0-5]|2[0-4]\d|[01]?\d\d?)\b", "IP_ADDRESS", 0.92),
    (r"\bhttps?://[^\s/$.?#][^\s]*\b", "URL", 0.90),
    (r"\bwww\.[a-zA-Z0-9][a-zA-Z0-9\-\.]+\.[a-zA-Z]{2,}(?:[/?#][^\s]*)?\b", "URL", 0.85),
    (r"\b[A-Z]{2}\d{2}[A-Z0-9]{11,30}\b", "IBAN_CODE", 0.80),
    (r"\b[A-Z][0-9]{8}\b", "US_PASSPORT", 0.70),
    (r"(?:driver(?:'s)?\s+license|DL)(?:\s+(?:no\.?|number|#))?[:\s]+([A-Z]?\d{7,9})\b", "US_DRIVER_LICENSE", 0.65),
    (r"(?:zip(?:\s*code)?|postal\s+code)[:\s]+(\d{5}(?:-\d{4})?)", "ZIP_CODE", 0.90),
    (r"\b\d{5}-\d{4}\b", "ZIP_CODE", 0.90),
    (r"\b(?:MRN|Medical\s+Record(?:\s+No\.?)?|Patient\s+I(?:D|dentification))[:\s#\-]*\d{4,10}\b", "MEDICAL_RECORD_NUMBER", 0.92),
    (r"\b(?:MRN|Medical\s+Record(?:\s+No\.?)?|Patient\s+I(?:D|dentification)|Insurance\s+Policy|Policy)\s*(?:No\.?|Number|#)?[:\s#\-]+[A-Z]{2,4}-[A-Z0-9]{2,8}(?:-[A-Z0-9]{2,8})?\b", "MEDICAL_RECORD_NUMBER", 0.90),
    (r"\bMRN[-\s]?(?:[A-Z]+[-\s])?\d{6,10}\b", "MEDICAL_RECORD_NUMBER", 0.88),
    (r"(?:DOB|Date\s+of\s+Birth|Born|Birth\s+Date|Birthdate)[?:\s,]+\d{1,2}[/\-.]\d{1,2}[/\-]\d{2,4}", "DATE_OF_BIRTH", 0.92),
    (r"(?:DOB|Date\s+of\s+Birth|Born\s+on|Birth\s+Date|Birthdate)[?:\s,]+\d{4}-\d{2}-\d{2}", "DATE_OF_BIRTH", 0.92),
    (r"(?:age[d]?|years?\s+old)[:\s]+\d{1,3}\b|\b\d{1,3}\s*(?:years?|yrs?)[\s\-]+old\b", "AGE", 0.80),
    (r"(?:NPI|National\s+Provider\s+Identifier)[:\s#]+\d{10}\b", "MEDICAL_LICENSE", 0.88),
    (r"(?:account|acct|bank\s+acct?)(?:\s+(?:no\.?|number|#))?[:\s]+\d{8,17}\b", "US_BANK_NUMBER", 0.80),
]
# The patterns whose score a word before them lifts.
SCORED: list[tuple[str, str, float]] = [
    (r"(?:DOB|Date\s+of\s+Birth|Born|Birth\s+Date|Birthdate)[:\s]+\d{1,2}[/\-]\d{1,2}[/\-]\d{2,4}", "DATE_OF_BIRTH", 0.95),
    (r"(?:DOB|Date\s+of\s+Birth|Born|Birth\s+Date|Birthdate)[:\s]+\d{4}-\d{2}-\d{2}", "DATE_OF_BIRTH", 0.95),
    (r"\b\d{1,2}[/\-]\d{1,2}[/\-]\d{2,4}\b", "DATE_OF_BIRTH", 0.40),
    (r"(?:MRN|Medical\s+Record(?:\s+No\.?)?|Patient\s+I(?:D|dentification))[:\s#\-]*\d{4,10}", "MEDICAL_RECORD_NUMBER", 0.92),
    (r"(?:MRN|Medical\s+Record(?:\s+No\.?)?|Patient\s+I(?:D|dentification)|Insurance\s+Policy|Policy)\s*(?:No\.?|Number|#)?[:\s#\-]+[A-Z]{2,4}-[A-Z0-9]{2,8}(?:-[A-Z0-9]{2,8})?", "MEDICAL_RECORD_NUMBER", 0.90),
    (r"\bMRN[-\s]?\d{6,10}\b", "MEDICAL_RECORD_NUMBER", 0.88),
    (r"\b[A-Z]{2,4}-\d{4,8}\b", "MEDICAL_RECORD_NUMBER", 0.55),
    (r"\b[A-Z]{2,4}-\d{2,6}-[A-Z0-9]{2,6}\b", "MEDICAL_RECORD_NUMBER", 0.55),
    (r"\b\d{6,10}\b", "MEDICAL_RECORD_NUMBER", 0.40),
    (r"(?:age[d]?|years?\s+old)[:\s]+\d{1,3}", "AGE", 0.85),
    (r"\b\d{1,3}\s*(?:years?|yrs?)[\s\-]+old\b", "AGE", 0.85),
    (r"\b\d{1,3}-year-old\b", "AGE", 0.88),
    (r"\b\d{5}-\d{4}\b", "ZIP_CODE", 0.90),
    (r"\b\d{5}\b", "ZIP_CODE", 0.40),
    (r"(?:NPI|National\s+Provider\s+Identifier)(?:\s+#)?[:\s#]+\d{10}\b", "MEDICAL_LICENSE", 0.92),
    (r"\b\d{10}\b", "MEDICAL_LICENSE", 0.38),
    (r"\b\d{9}\b", "US_BANK_NUMBER", 0.40),
    (r"\b\d{8,17}\b", "US_BANK_NUMBER", 0.41),
    (r"(?:Medicare\s+Beneficiary\s+(?:ID|Identifier)|MBI)[:\s#]+[1-9][A-Z][A-Z0-9]{2}-[A-Z0-9]{3}-[A-Z0-9]{4}\b", "MEDICARE_ID", 0.95),
    (r"\b[1-9][A-Z][A-Z0-9]{2}-[A-Z0-9]{3}-[A-Z0-9]{4}\b", "MEDICARE_ID", 0.80),
    (r"\bwww\.[a-zA-Z0-9][a-zA-Z0-9\-\.]+\.[a-zA-Z]{2,}(?:[/?#][^\s]*)?\b", "URL", 0.85),
    (r"\b[a-zA-Z0-9][a-zA-Z0-9\-]+\.(?:com|net|org|io|co|me|info|edu|gov|mil)\b", "URL", 0.50),
]
# Parts of words that speak for a type when they stand shortly before it, and what they add to the score.
CONTEXT: dict[str, tuple[str, ...]] = {
    "DATE_OF_BIRTH": ("dob", "born", "birthdate", "birthday", "birth"),
    "MEDICAL_RECORD_NUMBER": ("mrn", "chart", "encounter", "registration", "emr", "ehr", "policy", "identification", "hospital", "record", "medical"),
    "AGE": ("age", "aged", "yrs", "yr", "pediatric", "geriatric", "neonatal", "adolescent", "child", "adult", "elderly", "infant"),
    "ZIP_CODE": ("zip", "zipcode", "postal", "city", "state", "address"),
    "MEDICAL_LICENSE": ("npi",),
    "US_BANK_NUMBER": ("account", "acct", "routing", "checking", "savings", "aba", "transit"),
    "MEDICARE_ID": ("medicare", "beneficiary", "mbi", "cms"),
    "URL": ("website", "blog", "site", "portfolio", "online", "visit", "www", "web", "url", "link", "page", "profile", "personal"),
}
BOOST, LEAST, WINDOW = 0.35, 0.4, 5
# Labels of common named-entity models, and the entity types they stand for.
MODEL_LABELS = {
    "PER": "PERSON", "PERSON": "PERSON", "NAME": "PERSON", "PATIENT": "PERSON", "DOCTOR": "PERSON", "STAFF": "PERSON", "HONORIFIC": "PERSON", "TITLE": "PERSON",
    "LOC": "LOCATION", "LOCATION": "LOCATION", "GPE": "LOCATION", "CITY": "LOCATION", "STATE": "LOCATION", "COUNTRY": "LOCATION", "STREET": "LOCATION", "HOSPITAL": "LOCATION", "HOSP": "LOCATION", "COORDINATE": "LOCATION",
    "DATE": "DATE_TIME", "TIME": "DATE_TIME", "DATE_TIME": "DATE_TIME", "PHONE": "PHONE_NUMBER", "PHONE_NUMBER": "PHONE_NUMBER", "FAX": "PHONE_NUMBER", "EMAIL": "EMAIL_ADDRESS", "EMAIL_ADDRESS": "EMAIL_ADDRESS", "URL": "URL",
    "ID": "MEDICAL_RECORD_NUMBER", "MEDICALRECORD": "MEDICAL_RECORD_NUMBER", "SSN": "US_SSN", "US_SSN": "US_SSN", "ZIP": "ZIP_CODE", "AGE": "AGE", "US_PASSPORT": "US_PASSPORT", "US_DRIVER_LICENSE": "US_DRIVER_LICENSE",
    "US_BANK_NUMBER": "US_BANK_NUMBER", "CREDIT_CARD": "CREDIT_CARD", "IBAN_CODE": "IBAN_CODE", "IP_ADDRESS": "IP_ADDRESS", "ORG": "ORG", "ORGANIZATION": "ORG", "PATORG": "ORG", "FINANCIAL": "ORG",
    "OTHERPHI": "NRP", "USERNAME": "NRP", "NRP": "NRP", "PROFESSION": "NRP", "MISC": "NRP", "MAC_ADDRESS": "NRP", "IMEI": "NRP", "PASSWORD": "NRP", "US_ITIN": "US_SSN", "US_LICENSE_PLATE": "NRP",
}
# The entity types, and the default policy's strategies that aren't redact.
ENTITY_TYPES = [
    "PERSON", "EMAIL_ADDRESS", "PHONE_NUMBER", "US_SSN", "CREDIT_CARD", "DATE_TIME", "DATE_OF_BIRTH", "LOCATION", "US_DRIVER_LICENSE", "US_PASSPORT", "IP_ADDRESS",
    "IBAN_CODE", "MEDICAL_LICENSE", "MEDICAL_RECORD_NUMBER", "URL", "US_BANK_NUMBER", "AGE", "ZIP_CODE", "NRP", "MEDICARE_ID", "ORG",
]
DEFAULT_STRATEGIES = {
    "PERSON": "replace", "CREDIT_CARD": "mask", "DATE_TIME": "replace", "LOCATION": "replace", "AGE": "replace", "ZIP_CODE": "mask", "NRP": "replace", "ORG": "replace",
}
STRATEGIES = ("redact", "mask", "replace", "stand_in")

DETECTION = "entity_type string, start int, end int, text string, score double, source string"
#: A recognizer of named entities: texts to lists of (entity_type, start, end, score).
Recognizer = Callable[[list[str]], list[list[tuple[str, int, int, float]]]]


@dataclass(frozen=True)
class Policy:
    default_strategy: str = "redact"
    score_threshold: float = 0.7
    strategies: dict[str, str] = field(default_factory=lambda: dict(DEFAULT_STRATEGIES))
    disabled: frozenset[str] = frozenset()
    #: Score thresholds of single types, where they differ from the general one.
    thresholds: dict[str, float] = field(default_factory=dict)

    @classmethod
    def from_dict(cls, data: dict) -> Policy:
        entities = {k: v for k, v in (data.get("entities") or {}).items() if isinstance(v, dict)}
        own = cls(
            data.get("default_strategy", "redact"), float(data.get("score_threshold", 0.7)),
            {k: v["strategy"] for k, v in entities.items() if "strategy" in v}, frozenset(k for k, v in entities.items() if not v.get("enabled", True)),
            {k: float(v["score_threshold"]) for k, v in entities.items() if "score_threshold" in v},
        )
        for s in (own.default_strategy, *own.strategies.values()):
            if s not in STRATEGIES:
                raise ValueError(f"no such strategy: {s}")
        return own

    @classmethod
    def from_yaml(cls, path: str) -> Policy:
        import yaml

        with open(path, encoding="utf-8") as file:
            return cls.from_dict(yaml.safe_load(file) or {})

    def strategy(self, entity_type: str) -> str:
        return self.strategies.get(entity_type, self.default_strategy)

    def allows(self, entity_type: str, score: float) -> bool:
        return entity_type not in self.disabled and score >= self.thresholds.get(entity_type, self.score_threshold)


#: The policy of the command line, and the lenient one of evaluations.
STRICT, LENIENT = Policy(), Policy(score_threshold=0.35)


#: What every match holds, as a plain pattern over the text in lower case: found fast, and mostly absent. All other patterns need a digit.
_NEEDED = {"EMAIL_ADDRESS": "@", "https?": "://", "www": r"www\.", "(?:com|net": r"\.(?:com|net|org|io|co|me|info|edu|gov|mil)", "Insurance": "mrn|medical|patient|policy"}


def needed(pattern: str, entity: str) -> str:
    """A pattern that is found in every text, in lower case, that the given pattern is found in."""
    return next((need for sign, need in _NEEDED.items() if sign == entity or sign in pattern), r"\d")


@lru_cache(maxsize=1)
def _compiled() -> tuple[Prefilter, list[tuple[re.Pattern, str, float, tuple[str, ...]]]]:
    """What tells which patterns a text needs; pattern, type, score, and context words of each."""
    every = [(p, e, s, CONTEXT.get(e, ()) if lifted else ()) for lifted, own in ((False, PATTERNS), (True, SCORED)) for p, e, s in own]
    return Prefilter(p for p, *_ in every), [(re.compile(p, re.IGNORECASE), e, s, c) for p, e, s, c in every]


def lifted(score: float) -> float:
    """A score with a word of context before it."""
    return round(min(1.0, max(score + BOOST, LEAST)), 2)


class _Words:
    """The words of a text, in lower case, by where they end. Found when first asked for."""

    def __init__(self, text: str):
        self.text, self.ends, self.words = text, None, []

    def before(self, start: int) -> list[str]:
        if self.ends is None:
            found = [(m.end(), m[0].lower()) for m in re.finditer(r"[A-Za-z0-9_]+", self.text)]
            self.ends, self.words = [e for e, _ in found], [w for _, w in found]
        k = bisect_right(self.ends, start)
        return self.words[max(0, k - WINDOW) : k]


def detect_text(text: str, policy: Policy) -> list[tuple]:
    """Every detection that the policy allows, in order of patterns, unresolved."""
    prefilter, compiled = _compiled()
    out, words = [], _Words(text)
    for k in prefilter.allowed(text):
        pattern, entity, score, context = compiled[k]
        if not policy.allows(entity, lifted(score) if context else score):
            continue
        for m in pattern.finditer(text):
            near = bool(context) and any(c in w for w in words.before(m.start()) for c in context)
            own, g = lifted(score) if near else score, 1 if m.lastindex else 0
            if policy.allows(entity, own):
                out.append((entity, m.start(g), m.end(g), m[g], own, "regex"))
    return out


def mapped(recognizer: Recognizer, labels: dict[str, str] | None = None) -> Recognizer:
    """A recognizer whose model has labels of its own, in this module's entity types. Other labels are left out, and prefixes like B- cut."""
    own = MODEL_LABELS if labels is None else labels
    plain = lambda x: x.split("-", 1)[1] if x[:2] in ("B-", "I-", "L-", "U-", "E-", "S-") else x

    def run(texts: list[str]) -> list[list[tuple[str, int, int, float]]]:
        return [[(own[plain(e)], a, b, s) for e, a, b, s in found if plain(e) in own] for found in recognizer(texts)]

    return run


def resolve(found: Iterable[tuple], within_type: bool = False) -> list[tuple]:
    """Detections without overlaps, by start. within_type looks only at detections of the same type."""
    kept: list[tuple] = []
    for d in sorted(set(found), key=lambda d: (d[1] - d[2], -d[4], d[1], d[0])):
        if not any(k[1] < d[2] and d[1] < k[2] and (not within_type or k[0] == d[0]) for k in kept):
            kept.append(d)
    return sorted(kept, key=lambda d: (d[1], d[2], d[0]))


def _all_detections(texts: pd.Series, policy: Policy, recognizer: Recognizer | None) -> list[list[tuple]]:
    own = [t or "" for t in texts]
    found = [detect_text(t, policy) for t in own]
    if recognizer is not None:
        for k, extra in enumerate(recognizer(own)):
            found[k] += [(e, a, b, own[k][a:b], s, "ner") for e, a, b, s in extra if policy.allows(e, s) and not (e == "ORG" and own[k][a:b].isupper() and b - a <= 5)]
    return found


def detect(text: Column, policy: Policy | None = None, recognizer: Recognizer | None = None, resolved: bool = True) -> Column:
    """array of detections in a text column."""
    own = policy or STRICT

    @F.pandas_udf(T.ArrayType(T.StructType.fromDDL(DETECTION)))
    def run(texts: pd.Series) -> pd.Series:
        found = _all_detections(texts, own, recognizer)
        return pd.Series([resolve(f) if resolved else f for f in found])

    return run(text)


def analyze(text: Column, policy: Policy | None = None, recognizer: Recognizer | None = None) -> Column:
    """struct(has_pii, entity_count, entities: count by type) of a text column."""
    own = policy or STRICT

    @F.pandas_udf(T.StructType.fromDDL("has_pii boolean, entity_count int, entities map<string,int>"))
    def run(texts: pd.Series) -> pd.DataFrame:
        fresh = list(dict.fromkeys(x or "" for x in texts))  # each distinct text of a batch is analysed once
        found = _all_detections(pd.Series(fresh, dtype=object), own, recognizer)
        counts = {t: dict(Counter(d[0] for d in resolve(f, within_type=True))) for t, f in zip(fresh, found)}
        each = [counts[x or ""] for x in texts]
        return pd.DataFrame({"has_pii": [bool(c) for c in each], "entity_count": [sum(c.values()) for c in each], "entities": each})

    return run(text)


def stand_in(text: str, salt: str = "") -> str:
    """A value of the same shape: other digits for digits, other letters for letters of their case, all else as it is.

    Equal texts get equal values under one salt, so that records still match.
    """
    draws = hashlib.shake_256(f"{salt}\x00{text}".encode("utf-8", "surrogatepass")).digest(len(text) or 1)
    pick = lambda c, d: chr(48 + d % 10) if c.isdigit() else chr(65 + d % 26) if c.isupper() else chr(97 + d % 26) if c.isalpha() else c
    return "".join(map(pick, text, draws))


def replacement(entity_type: str, text: str, strategy: str) -> str:
    """What stands for a detection: [TYPE], asterisks over up to 500 characters, <TYPE>, or a value of its shape."""
    if strategy == "stand_in":
        return stand_in(text)
    if strategy == "mask":
        return "*" * min(len(text), 500) + text[500:]
    return f"<{entity_type}>" if strategy == "replace" else f"[{entity_type}]"


def partly_masked(text: Column) -> Column:
    """Asterisks that leave up to two characters on each side; all are hidden up to four."""
    n, shown = F.length(text), F.least(F.lit(2), F.floor(F.length(text) / 4)).cast("int")
    middle = F.concat(F.substring(text, F.lit(1), shown), F.repeat(F.lit("*"), n - shown * 2), F.substring(text, n - shown + 1, shown))
    return F.when(n <= 4, F.repeat(F.lit("*"), n)).otherwise(middle)


def anonymize(docs: DataFrame, text_col: str = "text", policy: Policy | None = None, recognizer: Recognizer | None = None) -> DataFrame:
    """docs with deidentified_text and audit: array<(entity_type, strategy, start, end, original_length, score)>."""
    own = policy or STRICT
    schema = T.StructType.fromDDL("deidentified_text string, audit array<struct<entity_type:string,strategy:string,start:int,end:int,original_length:int,score:double>>")

    @F.pandas_udf(schema)
    def run(texts: pd.Series) -> pd.DataFrame:
        done, audits = [], []
        for text, found in zip(texts, _all_detections(texts, own, recognizer)):
            at, parts, audit = 0, [], []
            for entity, a, b, part, score, _ in resolve(found):
                strategy = own.strategy(entity)
                parts += [text[at:a], replacement(entity, part, strategy)]
                audit.append((entity, strategy, a, b, b - a, score))
                at = b
            done.append(None if text is None else "".join(parts) + text[at:])
            audits.append(audit)
        return pd.DataFrame({"deidentified_text": done, "audit": audits})

    return docs.withColumn("_done", run(F.col(text_col))).select(*docs.columns, "_done.*")


def audit_rows(anonymized: DataFrame, id_col: str = "doc_id", at: Column | None = None) -> DataFrame:
    """One row per entry of the audit, never with the text; timestamp is at, or the time of the query."""
    when = (F.current_timestamp() if at is None else at).alias("timestamp")
    return anonymized.select(F.col(id_col).alias("document_id"), F.explode("audit").alias("_e")).select("document_id", "_e.*", when)


def audit_records(anonymized: DataFrame, id_col: str = "doc_id", at: Column | None = None) -> DataFrame:
    """One row per document: document_id, entities_found, entities_processed, timestamp, entries."""
    when = (F.current_timestamp() if at is None else at).alias("timestamp")
    return anonymized.select(F.col(id_col).alias("document_id"), F.size("audit").alias("entities_found"), F.size("audit").alias("entities_processed"), when, F.col("audit").alias("entries"))


def any_pattern(entity_type: str) -> str:
    """All patterns of a type that score by themselves, as one."""
    own = [p for p, e, _ in PATTERNS if e == entity_type]
    return own[0] if len(own) == 1 else "|".join(f"(?:{p})" for p in own)


def count_matches(text: Column, entity_type: str) -> Column:
    """Matches of a type's patterns, within whole-stage code and without offsets."""
    held = F.lit(False)
    for need in {needed(p, e) for p, e, _ in PATTERNS if e == entity_type}:
        held = held | (text.contains(need) if re.fullmatch("[^\\\\\\[|(]+", need) else text.rlike("(?i)" + need))
    return F.when(text.isNull(), F.lit(None).cast("int")).when(held, F.regexp_count(text, F.lit(f"(?i){any_pattern(entity_type)}"))).otherwise(0)
