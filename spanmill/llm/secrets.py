"""Secret scans with multipart credential linking.

Strong spans stand by themselves: assignments to secret-like names, access identifiers with a fixed
prefix, long hexadecimal runs. Weak candidates are parts of a credential that prove nothing alone:
identifiers (`user = ...`), opaque strings of mixed characters, endpoints (`https://...`, `host = ...`).
A document is cut into scopes (paragraphs between blank lines). Within a scope the intervals of
identifiers are joined with those of secrets, and the links found with endpoints, wherever in the scope they
stand, or, where a reach is given, at most so many code points apart; a weak part is reported only as
part of a link of an identifier with a secret.

All identifiers join with all secrets, and each such pair with all endpoints, of a scope. Since
only the parts are reported, not the pairs, a part needs no more than the least start and the greatest
end of what it joins with; per document that costs a sort and a binary search for each part.

Cases: null text is empty and gives no span; repeated rows give repeated results; ids may be null;
an empty table gives an empty result; extra columns are ignored; texts of any length are scanned whole.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterable, Iterator
from itertools import accumulate

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read

KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
_NAMES = ("passw", "secret", "token", "apikey", "api_key")

IDENTIFIER = re.compile(r"(?:access_?key_?id|client_?id|app_?id|account_?id|user(?:_?name)?|login|key_?id)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9._@-]{4,})", re.ASCII | re.IGNORECASE)
OPAQUE = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_-]{20,}+={0,2}(?![A-Za-z0-9+/_=-])")
WEAK_ASSIGN = re.compile(r"(?:pwd|pass|pw|auth|credential|private_?key|signing_?key|key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=!@#%-]{6,})", re.ASCII | re.IGNORECASE)
ENDPOINT = re.compile(r"https?://[A-Za-z0-9.-]+(?::[0-9]+)?[A-Za-z0-9/_.-]*|(?:host|endpoint|server|region)[\"']?\x20*[:=]\x20*[\"']?[A-Za-z0-9.:-]{4,}", re.ASCII)
_SCOPE_END = re.compile(r"\n[\x20\t\r]*\n")

Span = tuple[int, int, str]


def base_spans(text: str) -> list[Span]:
    """(start, end, kind) of the strong spans by start, then kind as listed."""
    out: list[Span] = []
    low = text.lower()
    if any(n in low for n in _NAMES):
        out += [(*m.span(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        out += [(*m.span(), "access") for m in ACCESS.finditer(text)]
    out += [(*m.span(), "hex") for m in HEX.finditer(text)]
    return sorted(out, key=lambda s: (s[0], KINDS.index(s[2])))


def opaque(text: str) -> bool:
    """Mixed characters of high entropy, as in a generated secret."""
    kinds = sum(bool(re.search(p, text)) for p in ("[a-z]", "[A-Z]", "[0-9]"))
    n = len(text)
    return kinds == 3 and -sum(c / n * math.log2(c / n) for c in Counter(text).values()) >= 3.5


class Intervals:
    """Spans by start, with the greatest end so far."""

    def __init__(self, spans: Iterable[tuple]):
        own = sorted(s[:2] for s in spans)
        self.starts, self.ends = [s[0] for s in own], list(accumulate((s[1] for s in own), max))

    def overlap(self, low: int, high: int) -> bool:
        """Whether any of them shares a code point with [low, high)."""
        k = bisect_left(self.starts, high)
        return k > 0 and self.ends[k - 1] > low

    def around(self, low: int, high: int, reach: int) -> tuple[int, int] | None:
        """The least start and the greatest end of those at most reach away from [low, high)."""
        k = bisect_right(self.starts, high + reach)
        if not k or self.ends[k - 1] < low - reach:
            return None
        return self.starts[bisect_left(self.ends, low - reach)], self.ends[k - 1]


def linked_spans(text: str, strong: list[Span], reach: int | None = None) -> list[Span]:
    """Weak parts of credentials: an identifier and a secret in one scope, and an endpoint with them; reach None is the whole scope."""
    reach = len(text) if reach is None else reach
    if not any(s[2] == "access" for s in strong) and not ("=" in text or ":" in text):
        return []
    ids = [s for s in strong if s[2] == "access"] + [(*m.span(), "part_id") for m in IDENTIFIER.finditer(text)]
    if not ids:
        return []
    covered = Intervals(strong)
    secrets = [s for s in strong if s[2] != "access"]
    secrets += [(*m.span(), "part_secret") for m in OPAQUE.finditer(text) if not covered.overlap(*m.span()) and opaque(m[0])]
    secrets += [(*m.span(), "part_secret") for m in WEAK_ASSIGN.finditer(text) if not covered.overlap(*m.span())]
    ends = [(*m.span(), "part_endpoint") for m in ENDPOINT.finditer(text)]
    cuts = [m.start() for m in _SCOPE_END.finditer(text)]
    found: set[Span] = set()
    by_scope: dict[int, tuple[list, list, list]] = {}
    for part, spans in enumerate((ids, secrets, ends)):
        for s in sorted(spans):
            by_scope.setdefault(bisect_left(cuts, s[0]), ([], [], []))[part].append(s)
    for own_ids, own_secrets, own_ends in by_scope.values():
        by_id, by_secret = Intervals(own_ids), Intervals(own_secrets)
        links = []
        for s in own_secrets:
            if mates := by_id.around(s[0], s[1], reach):
                links.append((min(s[0], mates[0]), max(s[1], mates[1])))
                found.add(s)
        found.update(s for s in own_ids if by_secret.around(s[0], s[1], reach))
        by_link = Intervals(links)
        found.update(s for s in own_ends if by_link.around(s[0], s[1], reach))
    return sorted(s for s in found if s[2].startswith("part_"))


def scan(text: str, reach: int | None = None) -> tuple[list[Span], list[Span]]:
    strong = base_spans(text)
    return strong, linked_spans(text, strong, reach)


def joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for a, b, k in spans)


def _scan(batches: Iterator[pd.DataFrame], reach: int | None) -> Iterator[pd.DataFrame]:
    for frame in batches:
        rows = []
        for text in frame["text"].array:
            strong, weak = scan(text, reach)
            n = Counter(s[2] for s in strong)
            every = sorted(strong + weak, key=lambda s: (s[0], KINDS.index(s[2]) if s[2] in KINDS else 9, s[2]))
            rows.append((n["assign"], n["access"], n["hex"], hashlib.sha256(joined(strong).encode()).hexdigest(), joined(every), [text[a:b] for a, b, _ in every]))
        out = pd.DataFrame(rows, columns=["n_assign", "n_access", "n_hex", "base_sha256", "spans", "found"])
        out.insert(0, "doc_id", frame["doc_id"].astype("Int64").array)
        yield out


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", reach: int | None = None) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans, and found: the text of each span.

    reach is the most code points between parts of one credential; None joins them within the whole scope.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return texts.mapInPandas(lambda batches: _scan(batches, reach), "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, found array<string>")


def op6_multipart_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_secrets(read(spark, sf_dir, "documents")).drop("found")
