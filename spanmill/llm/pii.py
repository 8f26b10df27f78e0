"""Personal data by boosted trees over candidate spans, in DataFrame functions only.

Generators of high recall propose spans, which may overlap. Each has features of its format (digits,
separators, check digits) and its context (characters beside it, words before it). Boosted trees,
trained here on a bounded set of written examples, score them; a threshold per kind, set on examples
held out whose phrasings occur in no training text, for PRECISION, selects redactions. Spans of the
base patterns always stay, and what fails a base pattern's condition is reported only as another kind.

Offsets come from splitting the text at the matches of a pattern: the lengths of what lies between
and of the matches add up to code-point offsets. Everything happens within the row, without a shuffle,
and about linearly in a text's matches: running sums go by blocks of about the root of their number,
context is read from pieces of BLOCK code points, and overlaps are settled within runs of overlapping
spans.

Cases: null text is empty and gives no span; repeated rows give repeated results; ids may be null;
an empty table gives an empty result; extra columns of any name are ignored, or kept by redact; texts
of any length are scanned whole, by patterns that never backtrack over a long run.
"""

from __future__ import annotations

import random
from collections.abc import Callable
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import boosting
from .common import nested, read, unnested

BASE = ("email", "ip", "card", "phone")
#: Held-out precision that a kind's threshold must reach.
PRECISION = 0.95
#: Written examples, half of them held out; hits that a threshold needs; code points of context before a candidate, and of a piece of text.
EXAMPLES, LEAST_HITS, BEFORE, BLOCK = 3200, 10, 40, 1024

# kind: (pattern, cheap condition on the text). `\G` keeps a match that begins where the last one ended.
GENERATORS: dict[str, tuple[str, str]] = {
    "email": (r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "@"),
    "ip": (r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", r"[0-9]\.[0-9]"),
    "card": (r"[0-9](?:[\x20-]?[0-9])++", r"[0-9][\x20-]?[0-9]"),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", r"\+[0-9]"),
    "ssn": (r"(?<![0-9-])[0-9]{3}[- ][0-9]{2}[- ][0-9]{4}(?![0-9-])", r"[0-9][- ][0-9]"),
    "local": (r"(?<![0-9+])(?:\([0-9]{2,5}\)[ ]?|[0-9]{2,5}[ ./-])[0-9]{3,4}[ ./-][0-9]{3,4}(?![0-9])", r"[0-9][) ./-]"),
    "iban": (r"(?<![A-Z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Z0-9])", "[A-Z]{2}[0-9]{2}"),
    "spelt": (r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64} ?(?:\(at\)|\[at\]| at ) ?[A-Za-z0-9-]{1,63} ?(?:\(dot\)|\[dot\]| dot ) ?[A-Za-z]{2,24}", r"\(dot\)|\[dot\]| dot "),
    "digits": (r"(?<![0-9])[0-9]{9,15}(?![0-9])", "[0-9]{9}"),
}
#: Words that speak for or against a kind when they come shortly before it.
CONTEXT = {
    "ctx_phone": r"(?i)phone|\btel\b|mobile|call|fax|whatsapp|telefon|móvil",
    "ctx_person": r"(?i)ssn|social security|passport|national id|tax id|licen[cs]e no|patient|account|iban|bank|card",
    "ctx_mail": r"(?i)mail|contact|write|reach|\bat\b",
    "ctx_other": r"(?i)order|invoice|version|isbn|\bsku\b|ticket|page|total|build|model|part no|item|chapter|tracking",
}
FEATURES = [*[f"is_{k}" for k in GENERATORS], "n_digits", "n_separators", "length", "luhn", "open", "shut", *CONTEXT]


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value), with value evaluated once however often body uses it."""
    return F.transform(F.array(value), body)[0]


def _running(values: Column, step: Callable[[Column, Column], Column]) -> Column:
    """Running sums (or maxima) of a non-empty array of int. values is evaluated once.

    Blocks of about the root of the length keep the copying of array_append small.
    """
    none = F.expr("cast(array() as array<int>)")
    last = lambda x: F.try_element_at(x, F.lit(-1))
    grow = lambda acc, v: F.array_append(acc, F.coalesce(step(last(acc), v), v))

    def within(own: Column) -> Column:
        n = F.greatest(F.lit(16), F.ceil(F.sqrt(F.size(own)))).cast("int")
        blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(own) - 1) / n).cast("int")), lambda k: F.aggregate(F.slice(own, k * n + 1, n), none, grow))
        return _let(blocks, lambda rows: _let(
            F.aggregate(rows, none, lambda acc, x: grow(acc, last(x))),
            lambda before: F.flatten(F.transform(rows, lambda x, k: F.when(k == 0, x).otherwise(F.transform(x, lambda v: step(F.get(before, k - 1), v))))),
        ))

    return _let(values, within)


_add = lambda a, b: a + b
_max = lambda a, b: F.when(a.isNull(), b).otherwise(F.greatest(a, b))


def _runs(sorted_spans: Column, body: Callable[[Column, Column, Column], Column]) -> Column:
    """body(spans, ends, firsts) of non-empty spans in order of start: ends are running maxima of their ends,
    firsts the places where a run of overlapping spans begins."""

    def with_ends(spans: Column, ends: Column) -> Column:
        firsts = F.filter(F.sequence(F.lit(0), F.size(spans) - 1), lambda k: (k == 0) | (F.get(spans, k)["start"] >= F.get(ends, k - 1)))
        return _let(firsts, lambda x: body(spans, ends, x))

    return _let(sorted_spans, lambda spans: _let(_running(F.transform(spans, lambda x: x["end"]), _max), lambda ends: with_ends(spans, ends)))


def _blocks(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit("(?s).{1,%d}+" % BLOCK), F.lit(0))


def _piece(blocks: Column, start: Column, end: Column) -> Column:
    """The text from start to end, from its blocks."""
    a, b = F.floor(start / BLOCK).cast("int"), F.floor(end / BLOCK).cast("int")
    of = lambda k: F.coalesce(F.get(blocks, k), F.lit(""))
    apart = F.concat(F.substring(of(a), start - a * BLOCK + 1, F.lit(BLOCK)), F.array_join(F.slice(blocks, a + 2, b - a - 1), ""), F.substring(of(b), F.lit(1), end - b * BLOCK))
    return F.when(a == b, F.substring(of(a), start - a * BLOCK + 1, end - start)).otherwise(apart)


_SPAN = "struct<kind:string,start:int,end:int,value:string>"


def _spans(text: Column, kind: str) -> Column:
    """array<(kind, start, end, value)> of a generator's leftmost, non-overlapping matches."""
    pattern, quick = GENERATORS[kind]
    none = F.expr(f"cast(array() as array<{_SPAN}>)")

    def placed(values: Column) -> Column:
        between = F.slice(F.split(text, pattern, -1), F.lit(1), F.size(values))
        lengths = F.zip_with(between, values, lambda gap, x: F.length(gap) + F.length(x))
        return F.when(F.size(values) > 0, F.zip_with(_running(lengths, _add), values, lambda end, x: F.struct(
            F.lit(kind).alias("kind"), (end - F.length(x)).alias("start"), end.alias("end"), x.alias("value")
        ))).otherwise(none)

    return F.when(text.rlike(quick), _let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), placed)).otherwise(none)


def _luhn(digits: Column) -> Column:
    """Whether a string of digits passes the check-digit rule; false above 19 digits."""

    def add(total: Column, k: Column) -> Column:
        d = F.substring(digits, F.length(digits) - k + 1, F.lit(1)).cast("int")
        return total + F.when(k % 2 == 0, 2 * d - F.when(d > 4, 9).otherwise(0)).otherwise(d)

    n = F.length(digits)
    return F.when(n.between(2, 19), F.aggregate(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), F.lit(0), add) % 10 == 0).otherwise(False)


def _featured(span: Column, blocks: Column) -> Column:
    """The span with its features. blocks are those of the text."""
    value, start, end = span["value"], span["start"], span["end"]
    digits = F.regexp_replace(value, "[^0-9]", "")
    low = F.greatest(start - BEFORE, F.lit(0))
    before = _piece(blocks, low, start)
    beside = lambda c: F.when(c.rlike(r"^[\p{L}0-9_-]$"), 0).otherwise(1)
    own = {
        **{f"is_{k}": F.when(span["kind"] == k, 1).otherwise(0) for k in GENERATORS},
        "n_digits": F.length(digits), "n_separators": F.length(F.regexp_replace(value, "[A-Za-z0-9]", "")), "length": F.length(value),
        "luhn": F.when(_luhn(digits), 1).otherwise(0),
        "open": beside(_piece(blocks, F.greatest(start - 1, F.lit(0)), start)),
        "shut": beside(_piece(blocks, end, end + 1)),
        **{k: F.when(before.rlike(p), 1).otherwise(0) for k, p in CONTEXT.items()},
    }
    return F.struct(span["kind"].alias("kind"), start.alias("start"), end.alias("end"), value.alias("value"), *[c.cast("double").alias(k) for k, c in own.items()])


def _is_base(span: Column) -> Column:
    """Whether a candidate is a span of the base patterns. span has features."""
    part = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})"
    return (
        F.when(span["kind"] == "email", True)
        .when(span["kind"] == "ip", span["value"].rlike(rf"^{part}\.{part}\.{part}\.{part}$"))
        .when(span["kind"] == "card", span["n_digits"].between(16, 19) & (span["luhn"] == 1))
        .when(span["kind"] == "phone", span["n_digits"].between(8, 15))
        .otherwise(False)
    )


def candidates(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """_row (docs' columns), _text and _spans: the candidates of all generators, with their features."""
    text = nested(docs, _text=F.coalesce(F.col(f"`{text_col}`"), F.lit("")))
    found = F.concat(*[_spans(F.col("_text"), k) for k in GENERATORS])
    blocks = lambda spans: F.when(F.size(spans) > 0, _blocks(F.col("_text"))).otherwise(F.expr("cast(array() as array<string>)"))
    return text.withColumn("_spans", _let(found, lambda spans: _let(blocks(spans), lambda own: F.transform(spans, lambda x: _featured(x, own)))))


#: Phrasings before a value, those at even places for training and the others held out, and the value's maker.
#: Some hold a word of CONTEXT and some don't.
Written = tuple[list[str], Callable[[random.Random], str]]


def _digits(rng: random.Random, n: int) -> str:
    return "".join(rng.choice("0123456789") for _ in range(n))


def _word(rng: random.Random) -> str:
    return "".join(rng.choice("aeiou") + rng.choice("bcdfglmnrst") for _ in range(rng.randint(1, 4)))


def _card(rng: random.Random) -> str:
    body = rng.choice("3456") + _digits(rng, 14)
    odd = sum((2 * int(c) - 9 * (int(c) > 4)) if k % 2 == 0 else int(c) for k, c in enumerate(body))
    return body + str(-odd % 10)


def _shaped(shape: str) -> Callable[[random.Random], str]:
    """A maker of values in which # is a digit and ~ a short word."""
    return lambda rng: "".join(_digits(rng, 1) if c == "#" else _word(rng) if c == "~" else c for c in shape)


PRIVATE: list[Written] = [
    (["phone", "call", "ring me on", "phone number is", "my mobile", "tel", "text me at", "fax", "whatsapp", "mobile"], _shaped("(###) ###-####")),
    (["call", "phone", "dial", "her mobile", "fax", "cell phone", "telephone", "call me", "tel", "call him on"], _shaped("###-###-####")),
    (["mobile", "phone", "telefon", "my tel", "call", "reach us by phone"], _shaped("0### ### ####")),
    (["phone", "tel", "", "call", "from abroad", "switchboard"], _shaped("+## ### ### ####")),
    (["SSN", "ssn", "social security number", "social security no.", "his SSN is", "SSN on file"], _shaped("###-##-####")),
    (["social security", "SSN", "social security number", "ssn"], _shaped("### ## ####")),
    (["card", "card number", "", "", "paid with", "charged to", "visa", "the card"], _card),
    (["IBAN", "bank account", "transfer to", "wire it to", "account", "the iban is"], _shaped("DE## #### #### #### #### ##")),
    (["bank", "account", "iban", "bank details", "beneficiary", "payee"], _shaped("GB##NWBK##############")),
    (["mail", "", "write to", "from", "contact", "sent by"], _shaped("~.~@~.example")),
    (["contact", "write", "", "", "my mail is", "reach me"], _shaped("~ at ~ dot org")),
    (["", "mail", "signed", "reach", "by", "contact"], _shaped("~ [at] ~ [dot] com")),
    (["address", "", "from", "host", "client", "logged in from"], lambda rng: ".".join(str(rng.randint(1, 255)) for _ in range(4))),
    (["passport", "passport no", "national id", "his passport", "passport number", "tax id"], _shaped("#########")),
    (["account", "account number", "patient", "patient no", "bank account", "her account"], _shaped("##########")),
]
HARMLESS: list[Written] = [
    (["order", "order no", "ticket", "purchase order", "invoice", "reference"], _shaped("###-###-####")),
    (["ISBN", "isbn", "catalogue", "the book", "isbn-13", "edition"], _shaped("978-#-####-####-#")),
    (["version", "build", "release", "firmware", "model", "update"], lambda rng: f"{rng.randint(300, 999)}.{_digits(rng, 1)}.{_digits(rng, 2)}.{_digits(rng, 4)}"),
    (["", "", "about", "page", "roughly", "in"], _shaped("### ### ####")),
    (["total", "", "sum", "population", "count", "amount"], _shaped("##########")),
    (["", "total", "item", "some", "id", "number"], _shaped("#########")),
    (["", "", "item", "build", "serial", "code"], _shaped("############")),
    (["", "", "order", "key", "hash", "number"], _shaped("################")),
    (["item", "part no", "lot", "batch", "", "size"], _shaped("###-##-####")),
    (["", "page", "between", "chapter", "about", "row"], _shaped("### ## ####")),
    (["tracking", "parcel", "shipment", "tracking code", "order", "package"], _shaped("AB## #### ####")),
    (["part no", "serial", "model", "sku", "item", "unit"], _shaped("XK##########")),
    (["", "look", "she is", "we met", "stay", "chapter"], _shaped("look at ~ dot ~")),
    (["", "on", "page", "dated", "since", "chapter"], _shaped("20##/###/###")),
    (["invoice", "bill", "receipt", "invoice no", "order", "total"], _shaped("###########")),
    (["", "", "from", "total", "values", "rows"], _shaped("#### #### ####")),
]


def examples(n: int = EXAMPLES, seed: int = 3, part: int | None = None) -> list[tuple[int, str, list[tuple[int, int]]]]:
    """(number, text, true spans): short written texts with personal data, and with lookalikes.

    Texts of odd numbers take phrasings at odd places, and those of even numbers the others, or all those of part.
    """
    rng, out = random.Random(seed), []
    for k in range(n):
        good = rng.random() < 0.5
        phrases, maker = rng.choice(PRIVATE if good else HARMLESS)
        cue, value = rng.choice(phrases[k % 2 if part is None else part :: 2]), maker(rng)
        head = " ".join(_word(rng) for _ in range(rng.randint(1, 6))) + f" {cue}" * bool(cue) + rng.choice([" ", ": ", " "])
        out.append((k, head + value + rng.choice([" ", ". ", ", "]) + " ".join(_word(rng) for _ in range(4)), [(len(head), len(head) + len(value))] if good else []))
    return out


_MODEL: dict[str, tuple[boosting.Boosted, dict[str, float]]] = {}


def model(spark: SparkSession) -> tuple[boosting.Boosted, dict[str, float]]:
    """The trees and each kind's threshold on their score. Trained once per process, always alike."""
    if "pii" not in _MODEL:
        written = examples()
        truth = {k: spans for k, _, spans in written}
        frame = candidates(spark.createDataFrame([(k, t) for k, t, _ in written], "k int, text string").coalesce(1))
        rows = frame.select("_row.k", F.explode("_spans").alias("s")).select("k", "s.*").orderBy("k", "kind", "start").collect()
        x = np.array([[r[f] for f in FEATURES] for r in rows])
        y = np.array([float(any(min(r["end"], b) - max(r["start"], a) >= 0.9 * max(r["end"] - r["start"], b - a) for a, b in truth[r["k"]])) for r in rows])
        held = np.array([r["k"] % 2 == 1 for r in rows])
        trees = boosting.fit(x[~held], y[~held], FEATURES)
        scores, kinds = trees.scores(x[held]), np.array([r["kind"] for r, h in zip(rows, held) if h])
        thresholds = {}
        for kind in GENERATORS:
            own, hit = scores[kinds == kind], y[held][kinds == kind]
            fine = [t for t in np.unique(own) if hit[own >= t].mean() >= PRECISION and hit[own >= t].sum() >= LEAST_HITS]
            thresholds[kind] = float(min(fine)) if fine else float("inf")
        _MODEL["pii"] = trees, thresholds
    return _MODEL["pii"]


def detect(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """_row (docs' columns), _text, detections: array<(rank, start, end, kind, value, base, score)>, by kind as listed, then start."""
    trees, thresholds = model(docs.sparkSession)
    limit = lambda s: reduce(lambda c, kt: c.when(s["kind"] == kt[0], kt[1]), thresholds.items(), F.when(F.lit(False), 0.0)).otherwise(float("inf"))
    rank = lambda s: reduce(lambda c, k: c.when(s["kind"] == k[1], k[0]), enumerate(GENERATORS), F.when(F.lit(False), 0))

    def scored(s: Column) -> Column:
        return F.struct(*[s[c].alias(c) for c in ("start", "end")], rank(s).alias("rank"), *[s[c].alias(c) for c in ("kind", "value")], _is_base(s).alias("base"), trees.column(lambda name: s[name]).alias("score"), limit(s).alias("limit"))

    own = candidates(docs, text_col).withColumn("_scored", F.transform("_spans", scored)).drop("_spans")
    picked = F.array_sort(F.filter("_scored", lambda s: s["base"] | ((s["score"] >= s["limit"]) & ~s["kind"].isin(*BASE))))
    # Of overlapping spans the base ones stay; of others the one of highest score, then of the first kind.
    better = lambda s, all_: F.exists(all_, lambda o: (o["start"] < s["end"]) & (s["start"] < o["end"]) & (
        o["base"] | (o["score"] > s["score"]) | ((o["score"] == s["score"]) & (o["rank"] < s["rank"]))))

    def settled(spans: Column, _: Column, firsts: Column) -> Column:
        run = lambda first, k: F.slice(spans, first + 1, F.coalesce(F.get(firsts, k + 1), F.size(spans)) - first)
        return F.flatten(F.transform(F.transform(firsts, run), lambda r: F.when(F.size(r) == 1, r).otherwise(F.filter(r, lambda s: s["base"] | ~better(s, r)))))

    kept = _let(picked, lambda p: F.when(F.size(p) > 1, _runs(p, settled)).otherwise(p))
    ranked = F.array_sort(F.transform(kept, lambda s: F.struct(*[s[c].alias(c) for c in ("rank", "start", "end", "kind", "value", "base", "score")])))
    return own.withColumn("detections", ranked).drop("_scored")


def _listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def scan_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id_col, a count per base kind, base_sha256, spans."""
    own = docs.select(F.col(f"`{id_col}`"), F.col(f"`{text_col}`"))
    found = detect(own, text_col).select(F.col(f"_row.`{id_col}`").alias(id_col), "detections", F.filter("detections", lambda s: s["base"]).alias("_base"))
    count = lambda k: F.size(F.filter("_base", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    return found.select(f"`{id_col}`", *[count(k) for k in BASE], F.sha2(_listed(F.col("_base")).cast("binary"), 256).alias("base_sha256"), _listed(F.col("detections")).alias("spans"))


def redact(docs: DataFrame, text_col: str = "text", chars_col: str = "n_chars") -> DataFrame:
    """docs with each detected span of the text replaced by its kind in brackets; overlapping spans become one.

    chars_col, if docs has it, becomes the length of the new text where something was replaced.
    """
    found = detect(docs, text_col)
    by_start = F.array_sort(F.transform("detections", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))

    def replaced(spans: Column, ends: Column, firsts: Column) -> Column:
        stop = lambda k: F.get(ends, F.coalesce(F.get(firsts, k + 1), F.size(spans)) - 1)
        part = lambda blocks: lambda first, k: F.concat(
            _piece(blocks, F.when(k == 0, 0).otherwise(stop(k - 1)), F.get(spans, first)["start"]), F.lit("["), F.upper(F.get(spans, first)["kind"]), F.lit("]"))
        return _let(_blocks(F.col("_text")), lambda blocks: F.concat(F.array_join(F.transform(firsts, part(blocks)), ""), _piece(blocks, stop(F.size(firsts) - 1), F.length("_text"))))

    some = F.size("detections") > 0
    out = found.withColumn("_new", F.when(some, _runs(by_start, replaced)).otherwise(F.col(f"_row.`{text_col}`")))
    changed = {text_col: F.col("_new")}
    if chars_col in docs.columns:
        changed[chars_col] = F.when(some, F.length("_new").cast(docs.schema[chars_col].dataType)).otherwise(F.col(f"_row.`{chars_col}`"))
    return unnested(out, **changed)


def op9_boosted_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_pii(read(spark, sf_dir, "documents"))
