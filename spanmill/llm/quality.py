"""Quality rules by weak supervision, in DataFrame functions only.

Each rule votes good, bad or abstains on a document. The table of vote patterns and their counts
(at most 3 to the number of rules, whatever the input, so the driver holds it) feeds
expectation-maximisation: for both classes and every rule it estimates how often a vote of the rule is
good, and so the rule's accuracy. An abstention is a missing value and moves nothing. The posterior
probability of good quality, a column expression over the votes, replaces all-must-pass filtering: a
document is kept if it reaches min_posterior. Base rules reject before that.

The estimation is plain: each step uses the very posterior that its estimates give. Estimates are
means of Beta(2, 1) or Beta(1, 2) counts, so that no rule is held to be certain.

Cases: null or empty text has no words, and is rejected; ties at the threshold are kept; repeated
rows are judged alike; an empty table gives an empty result; extra columns of any name are kept by
filter_quality and ignored by judge; words and lines are those of the whole text. Equality of
three-word windows is that of their 64-bit hashes.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import WORD, materialize, nested, read, unnested

GOOD, BAD, NONE = 1, -1, 0


def measure(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """_row (docs' columns), n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and what the rules need besides."""
    text = F.coalesce(F.col(f"_row.`{text_col}`"), F.lit(""))
    with_words = nested(docs).withColumn("_words", F.regexp_extract_all(text, F.lit(WORD), F.lit(0)))
    with_hashes = with_words.withColumn("n_words", F.size("_words").cast("long")).withColumn(
        "_h",
        F.expr("if(size(_words) < 3, cast(array() as array<bigint>), transform(sequence(0, size(_words) - 3), i -> xxhash64(_words[i], _words[i + 1], _words[i + 2])))"),
    ).withColumn("_lines", F.filter(F.split(text, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]")))
    sort = with_hashes.withColumn("_joined", F.array_join("_words", "")).drop("_words").withColumn(
        "_s", F.expr("if(size(array_distinct(_h)) = size(_h), null, array_sort(transform(_h, (x, i) -> struct(x as h, i as i))))")
    ).withColumn(
        "_p", F.expr("sort_array(filter(transform(_s, (x, k) -> if(get(_s, k - 1).h = x.h or get(_s, k + 1).h = x.h, x.i, null)), p -> p is not null))")
    )
    joined = F.col("_joined")
    return sort.select(
        "_row", "n_words",
        F.length(joined).cast("long").alias("word_chars"),
        F.regexp_count(joined, F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.expr("coalesce(aggregate(transform(_p, (x, k) -> if(k = 0, 3, least(3, x - get(_p, k - 1)))), 0L, (a, b) -> a + b), 0L)").alias("n_repeat_words"),
        F.size("_lines").cast("long").alias("n_lines"),
        F.regexp_count(joined, F.lit(r"\p{Lu}")).cast("long").alias("n_upper"),
        F.regexp_count(joined, F.lit(r"[!?]{2}")).cast("long").alias("n_shouts"),
        F.regexp_count(joined, F.lit(r"[^\p{L}\p{M}]+")).cast("long").alias("n_other"),
    )


def _vote(bad: Column, good: Column) -> Column:
    return F.when(bad, BAD).when(good, GOOD).otherwise(NONE).cast("int")


def rules() -> dict[str, Column]:
    """The rules, over the columns of measure()."""
    per_word = lambda c: F.col(c) / F.greatest(F.col("n_words"), F.lit(1))
    per_char = lambda c: F.col(c) / F.greatest(F.col("word_chars"), F.lit(1))
    return {
        "long_enough": _vote(F.col("n_words") < 20, F.col("n_words") >= 100),
        "word_length": _vote((per_word("word_chars") < 2) | (per_word("word_chars") > 15), per_word("word_chars").between(3, 10)),
        "few_symbols": _vote(per_word("n_symbols") > 0.1, per_word("n_symbols") < 0.02),
        "lines_differ": _vote(F.col("n_dup_lines") > 0.3 * F.col("n_lines"), F.col("n_dup_lines") == 0),
        "words_vary": _vote(per_word("n_repeat_words") > 0.3, per_word("n_repeat_words") < 0.1),
        "lower_case": _vote(per_char("n_upper") > 0.4, per_char("n_upper") < 0.15),
        "calm": _vote(per_word("n_shouts") > 0.1, F.col("n_shouts") == 0),
        "letters": _vote(per_word("n_other") > 0.45, per_word("n_other") < 0.3),
    }


def estimate(patterns: DataFrame, names: list[str], rounds: int = 200, tolerance: float = 1e-6) -> tuple[float, dict[tuple[str, int], float]]:
    """Expectation-maximisation over a table of vote patterns and counts n, which is collected.

    Returns the share of good documents, and P(a vote is good | rule, class 0 or 1). It starts from the
    belief that a document with a bad vote is bad with probability 0.95.
    """
    rows = patterns.select(*names, "n").collect()
    votes = np.array([[r[c] for c in names] for r in rows], dtype=np.int8).reshape(-1, len(names))
    n = np.array([r["n"] for r in rows], dtype=np.float64)
    good, prior, table = np.where((votes == BAD).any(axis=1), 0.05, 0.95), 0.5, np.tile([[1 / 3], [2 / 3]], len(names))
    for _ in range(rounds):
        before, weight = prior, np.stack([n * (1 - good), n * good])
        prior = (weight[1].sum() + 1) / (n.sum() + 2)
        voted_good, voted = weight @ (votes == GOOD), weight @ (votes != NONE)
        table = (voted_good + [[1], [2]]) / (voted + 3)
        odds = math.log(prior / (1 - prior)) + (votes == GOOD) @ np.log(table[1] / table[0]) + (votes == BAD) @ np.log((1 - table[1]) / (1 - table[0]))
        good = 1 / (1 + np.exp(-np.clip(odds, -500, 500)))
        if abs(prior - before) < tolerance:
            break
    return float(prior), {(r, y): float(table[y, k]) for k, r in enumerate(names) for y in (0, 1)}


def posterior(prior: float, table: dict[tuple[str, int], float], names: list[str]) -> Column:
    """P(good | votes): the prior odds times each vote's likelihood ratio."""
    odds = F.lit(math.log(prior / (1 - prior)))
    for r in names:
        of_good, of_bad = math.log(table[r, 1] / table[r, 0]), math.log((1 - table[r, 1]) / (1 - table[r, 0]))
        odds = odds + F.when(F.col(r) == GOOD, of_good).when(F.col(r) == BAD, of_bad).otherwise(0.0)
    return 1 / (1 + F.exp(-odds))


BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def _judged(docs: DataFrame, text_col: str, min_posterior: float, keep: list[str]) -> DataFrame:
    """_row (the columns keep of docs), the base figures, base_failed, p_good, kept."""
    own = rules()
    names = list(own)
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    measured = measure(docs, text_col)
    row = F.struct(*[F.col(f"_row.`{c}`") for c in keep]) if keep != docs.columns else F.col("_row")
    voted = materialize(measured.select(row.alias("_row"), *BASE, failed.alias("base_failed"), *[c.alias(r) for r, c in own.items()]), "quality-votes")
    prior, table = estimate(voted.groupBy(*names).agg(F.count("*").alias("n")), names)
    p = posterior(prior, table, names)
    return voted.select("_row", *BASE, "base_failed", p.alias("p_good"), (~F.col("base_failed") & (p >= min_posterior)).alias("kept"))


def judge(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", min_posterior: float = 0.5) -> DataFrame:
    """id_col, the base figures, base_failed, p_good, kept."""
    own = docs.select(F.col(f"`{id_col}`"), F.col(f"`{text_col}`"))
    return _judged(own, text_col, min_posterior, [id_col]).select(F.col(f"_row.`{id_col}`").alias(id_col), *BASE, "base_failed", "p_good", "kept")


def filter_quality(docs: DataFrame, *, text_col: str = "text", min_posterior: float = 0.5) -> DataFrame:
    """The documents that judge() keeps, with all their columns."""
    return unnested(_judged(docs, text_col, min_posterior, docs.columns).where("kept"))


def op8_weak_supervision(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(read(spark, sf_dir, "documents"))
