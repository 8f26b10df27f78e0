"""Spelling variants by anagram hashing.

A word's key is the sum of its letters' fifth powers, so anagrams share a key, and a word without one letter
has the key less that letter's power. Two words are one letter apart only if one's key is the other's less
a letter, or both keys meet when each gives up a letter (an exchange): keys are joined on these integers, and
letters without a partner go no further. The order of letters is verified by a digest of what is left
when the letter is taken out at its place: equal digests at one place are an exchange, a digest equal to a whole
word's an addition or removal. So no pair is formed that fails, words that only share letters never
meet, and a group holds at most a word per letter of the alphabet, or per letter and place.

Words are counted per task before they are shuffled. Digests are polynomials modulo 2^127 - 1, keys are
modulo 2^62; a word of any length costs its length. Rows bear a word's rank by count, not the word.

Cases: null texts hold no words; a null id is written as the empty text; repeated rows count as often as
they occur; words of equal count are taken in code-point order; no words, or no near ones, give rows
without forms; extra columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import materialize, read

#: A run of letters, what is lower-cased, and how misspellings are planted.
RUN = "[A-Za-zÀ-ÿ]+"
PLANTED = 199
#: Distinct words that a task counts before it hands them on.
HELD = 200_000
#: Keys are sums modulo this, below 64 bits with a further power.
KEYS = 1 << 62
_PRIME, _BASE = (1 << 127) - 1, 0x9E3779B97F4A7C15F39CC0605CEDC835 % ((1 << 127) - 1)
_LOWER = {c: c + 32 for c in range(65, 91)}


def planted(doc_id, run: str, one_in: int = PLANTED) -> str:
    """The run in lower case (A to Z alone), less one letter where the checksum of id and run says so."""
    low = run.lower() if run.isascii() else run.translate(_LOWER)
    h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{low}".encode())
    if one_in and h % one_in == 0:
        k = h % len(low)
        return low[:k] + low[k + 1 :]
    return low


def word_counts(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", least_length: int = 6, least_count: int = 5, one_in: int = PLANTED) -> DataFrame:
    """(word, n) of words of least_length code points or more that occur least_count times or more."""
    import pyarrow as pa

    def count(batches):
        found, held = re.compile(RUN), Counter()
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for run, times in Counter(r for r in found.findall(text or "") if len(r) >= least_length).items():
                    word = planted(doc_id, run, one_in)
                    if len(word) >= least_length:
                        held[word] += times
                if len(held) > HELD:
                    yield pa.RecordBatch.from_arrays([pa.array(list(held)), pa.array(list(held.values()), pa.int64())], ["word", "n"])
                    held.clear()
        yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], ["word", "n"])

    return docs.select(F.col(id_col).cast("string"), text_col).mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


def power(letter):
    return F.pow(F.ascii(letter), F.lit(5)).cast("long")


def keyed(words: DataFrame) -> DataFrame:
    """words with length, letters (distinct ones), key, and rank: the more frequent word has the lower one, of equally frequent ones the first."""
    letters = F.split("word", "")
    key = F.aggregate(letters, F.lit(0).cast("long"), lambda acc, c: F.pmod(acc + power(c), F.lit(KEYS)))
    own = words.select("word", "n", F.length("word").alias("length"), F.array_distinct(letters).alias("letters"), key.alias("key"))
    by = [F.desc("n"), F.asc("word")]
    return own.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("rank", F.monotonically_increasing_id())


def candidates(words: DataFrame) -> DataFrame:
    """(rank, letters, whole): of keyed words, those with a partner by key; the letters that may be taken out, and whether the whole word may meet one less a letter."""
    removed = words.select("rank", "length", "key", F.explode("letters").alias("letter")).select(
        "rank", "letter", F.pmod(F.col("key") - power(F.col("letter")), F.lit(KEYS)).alias("key"), (F.col("length") - 1).alias("length")
    )
    asked = removed.select("key", "length", F.lit(1).cast("long").alias("less"), F.lit(0).cast("long").alias("entire"))
    stands = words.select("key", "length", F.lit(0).cast("long").alias("less"), F.lit(1).cast("long").alias("entire"))
    met = asked.unionAll(stands).groupBy("key", "length").agg(F.sum("less").alias("less"), F.sum("entire").alias("entire")).where((F.col("less") > 0) & (F.col("less") + F.col("entire") > 1))
    parts = removed.join(met, ["key", "length"]).select("rank", "letter", F.lit(False).alias("entire"))
    wholes = words.join(met.where("entire > 0").select("key", "length"), ["key", "length"]).select("rank", F.lit(None).cast("string").alias("letter"), F.lit(True).alias("entire"))
    return parts.unionAll(wholes).groupBy("rank").agg(F.collect_list("letter").alias("letters"), F.max("entire").alias("whole"))


def _taken_out(word: str, letters: list[str], whole: bool):
    """(digest, place, role) of what is left of a word less one of the letters, by place; place -1 for additions and removals."""
    sums = [0]
    for c in word:
        sums.append((sums[-1] * _BASE + ord(c)) % _PRIME)
    if whole:
        yield sums[-1], -1, 2
    taken, scale = set(letters), 1
    for k in range(len(word) - 1, -1, -1):  # scale is the base to the power of the letters behind place k
        if word[k] in taken:
            rest = (sums[-1] + (sums[k] - sums[k + 1]) * scale) % _PRIME
            yield rest, k, 0
            if k == 0 or word[k - 1] != word[k]:  # the letters of a run leave the same
                yield rest, -1, 1
        scale = scale * _BASE % _PRIME


def _digests(batches):
    """Rows of _taken_out() with the word's rank, from (rank, word, letters, whole)."""
    import pyarrow as pa

    types = (pa.binary(), pa.int32(), pa.int8(), pa.int64())
    columns: list[list] = [[], [], [], []]
    batch_of = lambda: pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["digest", "place", "role", "rank"])
    for batch in batches:
        for rank, word, letters, whole in zip(*(batch.column(k).to_pylist() for k in range(4))):
            for digest, place, role in _taken_out(word, letters, whole):
                for column, value in zip(columns, (digest.to_bytes(16, "big"), place, role, rank)):
                    column.append(value)
                if len(columns[0]) >= HELD:
                    yield batch_of()
                    for column in columns:
                        column.clear()
    yield batch_of()


def near_words(words: DataFrame) -> DataFrame:
    """(rank, n_near, best) of keyed words with near ones: how many, and the rank of the most frequent of them.

    A pair of near words meets in one group only: at the one place where they differ, or where the longer
    one's letter is taken out of the first place of its run.
    """
    asked = candidates(words).join(words.select("rank", "word"), "rank").select("rank", "word", "letters", "whole")
    rows = asked.mapInArrow(_digests, "digest binary, place int, role byte, rank long").repartition("digest", "place")
    group, ranked = Window.partitionBy("digest", "place"), Window.partitionBy("digest", "place", "role").orderBy("rank")
    whole, at = F.col("role") == 2, F.col("at")
    seen = rows.withColumn("at", F.row_number().over(ranked)).withColumns({
        "first": F.min(F.when(~whole & (at == 1), F.col("rank"))).over(group), "second": F.min(F.when(~whole & (at == 2), F.col("rank"))).over(group),
        "entire": F.min(F.when(whole, F.col("rank"))).over(group), "many": F.count(F.when(~whole, 1)).over(group),
    })
    best = F.when(whole, F.col("first")).when(F.col("role") == 1, F.col("entire")).when(at == 1, F.col("second")).otherwise(F.col("first"))
    many = F.when(whole, F.col("many")).when(F.col("role") == 1, 1).otherwise(F.col("many") - 1)
    return seen.select("rank", best.alias("best"), many.alias("many")).where("best is not null").groupBy("rank").agg(F.sum("many").alias("n_near"), F.min("best").alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) for words with a form (word, form): the last word that forms lead to.

    Forms are more frequent than their words by a factor, so chains are short and have an end; each round
    doubles the steps taken.
    """
    state = materialize(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    for _ in range(8):
        onward = state.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        state = materialize(state.join(onward, "root", "left").select("word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("moved")), "spelling-roots")
        if state.where("moved").isEmpty():
            return state.select("word", "root")
        state = state.select("word", "root")
    raise RuntimeError("chains of forms don't end")


def variants(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", least_length: int = 6, least_count: int = 5, ratio: int = 5, one_in: int = PLANTED) -> DataFrame:
    """(word, form, root, n, n_near, form_n): each word with the near word that it may be a variant of.

    form is the most frequent near word, if it is at least ratio times as frequent (ratio of 2 or more).
    one_in plants misspellings for tests of the search: 0 plants none.
    """
    words = materialize(keyed(word_counts(docs, id_col=id_col, text_col=text_col, least_length=least_length, least_count=least_count, one_in=one_in)), "spelling-words")
    best = words.select(F.col("rank").alias("best"), F.col("word").alias("_best"), F.col("n").alias("_n"))
    near = words.select("rank", "word", "n").join(near_words(words), "rank", "left").join(best, "best", "left")
    frequent = F.col("_n") >= ratio * F.col("n")
    found = materialize(
        near.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(frequent, F.col("_best")).alias("form"), F.when(frequent, F.col("_n")).alias("form_n")), "spelling-forms"
    )
    ends = roots(found.where("form is not null"))
    return found.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op13_anagram_hashing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants(read(spark, sf_dir, "documents"))


#: The same in DuckDB, which has no crc32: a fold over the bytes with the table of the reflected polynomial. Near words there meet by the word without a letter.
OP13_SQL = r"""WITH RECURSIVE tab AS MATERIALIZED (SELECT list(v ORDER BY i) AS t FROM (
    SELECT i, list_reduce(range(8), lambda a, b: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END, i) AS v FROM range(256) r(i))),
  r AS (SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low, count(*) AS times
    FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\x{00C0}-\x{00FF}]+')) AS run FROM documents) GROUP BY ALL HAVING length(low) >= 6),
  h AS (SELECT low, times, xor(list_reduce(list_transform(regexp_extract_all(hex(encode(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || low)), '..'), lambda x: CAST('0x' || x AS BIGINT)),
    lambda a, b: xor(a >> 8, t[1 + (xor(a, b) & 255)]), 4294967295), 4294967295) AS h FROM r, tab),
  v AS MATERIALIZED (SELECT CASE WHEN h % 199 = 0 THEN left(low, h % length(low)) || substring(low, h % length(low) + 2) ELSE low END AS word, CAST(sum(times) AS BIGINT) AS n FROM h GROUP BY 1 HAVING n >= 5 AND length(word) >= 6),
  d AS (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM v),
  e AS MATERIALIZED (SELECT word, n, i, left(word, i - 1) || substring(word, i + 1) AS rest FROM d),
  p AS (SELECT a.word, b.word AS near, b.n FROM e a JOIN e b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
    UNION SELECT e.word, v.word, v.n FROM e JOIN v ON e.rest = v.word UNION SELECT v.word, e.word, e.n FROM e JOIN v ON e.rest = v.word),
  b AS (SELECT word, count(*) AS n_near, first(near ORDER BY n DESC, near) AS best, max(n) AS best_n FROM p GROUP BY word),
  f AS MATERIALIZED (SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN best_n >= 5 * v.n THEN best END AS form, CASE WHEN best_n >= 5 * v.n THEN best_n END AS form_n FROM v LEFT JOIN b USING (word)),
  c AS (SELECT word, word AS root FROM f UNION ALL SELECT c.word, f.form FROM c JOIN f ON c.root = f.word WHERE f.form IS NOT NULL)
  SELECT f.word, f.form, c.root, f.n, f.n_near, f.form_n FROM f JOIN c USING (word) JOIN f g ON c.root = g.word WHERE g.form IS NULL"""
