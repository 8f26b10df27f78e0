"""Fingerprints of documents as Merkle trees over sections and paragraphs.

A paragraph is a line. A section ends at an empty line, before a line that begins with #, and after a
paragraph whose digest begins with 0 to 3, so that documents without headings have branches too and an
edit moves no boundary but its own. A paragraph's digest is the SHA-256 of its text, a section's that of
its paragraphs' digests, the root that of the sections' digests, so roots test equality. Paragraphs
list short digests of their pieces (sentences, of up to 16 words each) below them, for likeness alone.

A fingerprint is one string: the root (64 hexadecimal digits), then for each section / and 16 digits of
its digest, for each paragraph there , and 16 digits, for each piece . and 8 digits. All is columns.

Cases: null text counts as empty, which is one section of one empty paragraph without pieces; a text of any
length is one row's work; null ids come first in the order of documents, rows equal in id come by their
texts' hash, repeated rows follow each other; the only row of a table follows itself; an empty table
gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialize, read, text_or_empty

#: A piece of a paragraph: words up to the end of a sentence, 16 at most, with the spaces around them.
PIECE = r" *(?:[^ ]*[^ .!?] +){0,15}[^ ]+ *| +"


def _let(value: Column, then: Callable[[Column], Column]) -> Column:
    """then(value), with value computed once."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def fingerprint(text: Column) -> Column:
    """The fingerprint of a text without nulls."""

    def paragraph(lines: Column, line: Column, k: Column) -> Column:
        pieces = F.transform(F.regexp_extract_all(line, F.lit(PIECE), F.lit(0)), lambda p: F.concat(F.lit("."), F.substring(F.sha2(p, 256), 1, 8)))
        ends = lambda d: (line == "") | d.rlike("^[0-3]") | F.coalesce(F.get(lines, k + 1).startswith("#"), F.lit(False))
        return _let(F.sha2(line, 256), lambda d: F.concat(F.lit(","), d, F.array_join(pieces, ""), F.when(ends(d), "/").otherwise("")))

    def tree(sections: Column) -> Column:
        short = F.transform(sections, lambda s: F.concat(F.lit("/"), F.sha2(F.regexp_replace(s, r"\.[0-9a-f]{8}", ""), 256), s))
        root = F.sha2(F.array_join(F.transform(short, lambda s: F.substring(s, 1, 65)), ""), 256)
        return F.concat(root, F.regexp_replace(F.array_join(short, ""), r"([/,][0-9a-f]{16})[0-9a-f]{48}", "$1"))

    body = _let(F.split(text, "\n"), lambda lines: F.array_join(F.transform(lines, lambda line, k: paragraph(lines, line, k)), ""))
    return _let(F.split(F.regexp_replace(body, "/$", ""), "/"), tree)


def root(print_: Column) -> Column:
    return F.substring(print_, 1, 64)


def nodes(print_: Column) -> Column:
    """The distinct nodes of a fingerprint: root, sections, paragraphs and pieces."""
    return F.array_distinct(F.regexp_extract_all(print_, F.lit("[/,.]?[0-9a-f]+"), F.lit(0)))


def likeness(a: Column, b: Column) -> Column:
    """Twice the nodes that two fingerprints share over all nodes of both: 1 for equal texts and for no others, 0 if nothing is shared."""
    shared = lambda x, y: 2.0 * F.size(F.array_intersect(x, y)) / (F.size(x) + F.size(y))
    return F.when(root(a) == root(b), 1.0).otherwise(_let(nodes(a), lambda x: _let(nodes(b), lambda y: shared(x, y))))


def changed_paragraphs(a: Column, b: Column) -> Column:
    """How many different paragraphs b has that a doesn't have. Only their sections that differ are looked into."""
    sections = lambda p: F.regexp_extract_all(p, F.lit("/[^/]+"), F.lit(0))
    paragraphs = lambda s: F.regexp_extract_all(F.array_join(s, ""), F.lit(",[0-9a-f]{16}"), F.lit(0))
    return F.when(root(a) == root(b), 0).otherwise(_let(sections(a), lambda x: _let(sections(b), lambda y: F.size(F.array_except(paragraphs(F.array_except(y, x)), paragraphs(F.array_except(x, y)))))))


def edits(prints: DataFrame, key: str, a: str, b: str) -> DataFrame:
    """(key, section, paragraph), from 0, the paragraph within its section, for each paragraph of fingerprint b that a doesn't have.

    Rows of equal roots end at once; sections that a holds are passed over; only paragraphs of the rest are
    compared. key must tell rows apart. Joins on (key, digest), so that a text of any length is linear work.
    """
    differing = prints.where(root(F.col(a)) != root(F.col(b))).select(F.col(key).alias("_key"), F.col(a).alias("_a"), F.col(b).alias("_b"))
    sections = lambda c: differing.select("_key", F.posexplode(F.regexp_extract_all(c, F.lit("/[^/]+"), F.lit(0))).alias("section", "_s"))
    paragraphs = lambda rows: rows.select("_key", "section", F.posexplode(F.regexp_extract_all("_s", F.lit(",[0-9a-f]{16}"), F.lit(0))).alias("paragraph", "_d"))
    before, after = sections("_a"), sections("_b")
    fresh = paragraphs(after.join(before.select("_key", "_s").distinct(), ["_key", "_s"], "left_anti"))
    return fresh.join(paragraphs(before).select("_key", "_d"), ["_key", "_d"], "left_anti").select(F.col("_key").alias(key), "section", "paragraph")


def fingerprints(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, fingerprint) per row."""
    return docs.select(F.col(id_col), fingerprint(text_or_empty(text_col)).alias("fingerprint"))


def _order(keyed: DataFrame, id_col: str) -> DataFrame:
    """Distinct rows as (_a, _b, their id, _n, _copies) with _at, their place in the order: gapless within a block of 2^33."""
    distinct = keyed.groupBy("_a", "_b").agg(F.first(id_col).alias(id_col), F.first("_n").alias("_n"), F.count("*").alias("_copies"))
    by = [F.col(id_col).asc_nulls_first(), "_a", "_b"]
    return materialize(distinct.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("_at", F.monotonically_increasing_id()), "document-order")


def _followed(order: DataFrame) -> DataFrame:
    """order with _next, the place of the row that follows; the last one is followed by the first.

    Within a block the next place is one more. The driver holds two numbers per block, of which there
    are as many as tasks.
    """
    block = F.shiftright("_at", 33)
    ends = order.groupBy(block.alias("_block")).agg(F.min("_at").alias("_first"), F.max("_at").alias("_last")).orderBy("_block").collect()
    jumps = json.dumps([[e["_last"], ends[(k + 1) % len(ends)]["_first"]] for k, e in enumerate(ends)])
    pair = F.explode(F.from_json(F.lit(jumps), "array<array<long>>")).alias("_e")  # a literal: rows from Python would start Python workers
    jump = order.sparkSession.range(1).select(pair).select(F.col("_e")[0].alias("_at"), F.col("_e")[1].alias("_jump"))
    return order.join(F.broadcast(jump), "_at", "left").withColumn("_next", F.coalesce("_jump", F.col("_at") + 1)).drop("_jump")


def edited_by_next(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", share: int = 4) -> DataFrame:
    """Each document, and its text with the last floor(n / share) code points replaced by as many first ones of the next document, or all it has.

    Returns id_col, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, changed
    (the edited text's paragraphs that the text doesn't have).

    Texts meet by their keys, two hashes of id and text, so that copies are one row until the end: one
    shuffle of the distinct texts, one of the pieces that replace others, and narrow ones for the order.
    """
    text = text_or_empty(text_col)
    keyed = docs.select(
        F.col(id_col), text.alias("_text"), F.length(text).cast("long").alias("_n"),
        F.xxhash64(F.lit(1), F.col(id_col).isNull(), id_col, text).alias("_a"), F.xxhash64(F.lit(2), text, id_col).alias("_b"),
    )
    order = _followed(_order(keyed, id_col))
    cut = F.floor(F.col("_n") / share)
    before = order.select(F.col("_next").alias("_at"), F.col("_a").alias("_pa"), F.col("_b").alias("_pb"), cut.alias("_wanted"))
    places = order.join(before, "_at").select("_a", "_b", id_col, "_n", "_copies", "_pa", "_pb", "_wanted")
    texts = keyed.groupBy("_a", "_b").agg(F.first("_text").alias("_text"))
    given = texts.join(places.select("_a", "_b", "_pa", "_pb", "_wanted"), ["_a", "_b"]).select(
        F.col("_pa").alias("_a"), F.col("_pb").alias("_b"), F.substring("_text", F.lit(1), F.col("_wanted").cast("int")).alias("_given"), fingerprint(F.col("_text")).alias("_next_print"), F.lit(True).alias("_other")
    )
    own = texts.join(places.select("_a", "_b", id_col, "_n", "_copies"), ["_a", "_b"]).withColumn("fingerprint", fingerprint(F.col("_text")))
    met = own.join(given, ["_a", "_b"])
    # all copies of a row but the last are followed by themselves
    itself = F.struct(F.substring("_text", F.lit(1), cut.cast("int")).alias("given"), F.col("fingerprint").alias("next_print"), (F.col("_copies") - 1).alias("times"))
    other = F.struct(F.col("_given").alias("given"), F.col("_next_print").alias("next_print"), F.lit(1).cast("long").alias("times"))
    pairs = met.select(id_col, "_text", "_n", "fingerprint", F.explode(F.when(F.col("_copies") > 1, F.array(other, itself)).otherwise(F.array(other))).alias("_p"))
    edited = pairs.withColumn("_edited", F.concat(F.substring("_text", F.lit(1), (F.col("_n") - cut).cast("int")), F.col("_p.given")))
    printed = edited.withColumn("edited_fingerprint", fingerprint(F.col("_edited")))
    done = printed.select(
        id_col, F.col("_n").alias("n_chars"), F.sha2("_edited", 256).alias("edited_sha256"), "fingerprint", "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"), likeness(F.col("fingerprint"), F.col("_p.next_print")).alias("near_next"),
        changed_paragraphs(F.col("fingerprint"), F.col("edited_fingerprint")).alias("changed"), F.col("_p.times").alias("_times"),
    )
    return done.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_times").cast("int")))).drop("_times", "_copy")


def op11_merkle_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edited_by_next(read(spark, sf_dir, "documents"))


#: The same in DuckDB: the tree of a text column as a chain of select lists. Equal ids don't occur there, so that order needs no hash.
OP11_SQL = r"""WITH d AS (SELECT doc_id, coalesce(text, '') AS text, length(coalesce(text, '')) AS n FROM documents),
  f AS (SELECT *, coalesce(lead(text) OVER (ORDER BY doc_id), first_value(text) OVER (ORDER BY doc_id)) AS after FROM d),
  t AS (SELECT *, left(text, n - n // 4) || left(after, n // 4) AS edited FROM f),
  u AS (SELECT DISTINCT text FROM d UNION SELECT edited FROM t),
  l AS (SELECT text, string_split(text, chr(10)) AS ls FROM u),
  b AS (SELECT text, list_aggregate(list_transform(ls, lambda x, i: ',' || sha256(x) || list_aggregate(list_concat([''], list_transform(regexp_extract_all(x, ' *(?:[^ ]*[^ .!?] +){0,15}[^ ]+ *| +'), lambda p: '.' || left(sha256(p), 8))), 'string_agg', '')
      || CASE WHEN x = '' OR left(sha256(x), 1) IN ('0', '1', '2', '3') OR coalesce(starts_with(ls[i + 1], '#'), false) THEN '/' ELSE '' END), 'string_agg', '') AS body FROM l),
  s AS (SELECT text, list_transform(string_split(regexp_replace(body, '/$', ''), '/'), lambda x: '/' || sha256(regexp_replace(x, '\.[0-9a-f]{8}', '', 'g')) || x) AS ss FROM b),
  p AS (SELECT text, sha256(list_aggregate(list_transform(ss, lambda x: left(x, 65)), 'string_agg', '')) || regexp_replace(list_aggregate(ss, 'string_agg', ''), '([/,][0-9a-f]{16})[0-9a-f]{48}', '\1', 'g') AS fp FROM s),
  k AS (SELECT text, fp, list_distinct(regexp_extract_all(fp, '[/,.]?[0-9a-f]+')) AS ns, regexp_extract_all(fp, '/[^/]+') AS ss FROM p)
  SELECT doc_id, CAST(n AS BIGINT) AS n_chars, sha256(edited) AS edited_sha256, a.fp AS fingerprint, e.fp AS edited_fingerprint,
    CASE WHEN left(a.fp, 64) = left(e.fp, 64) THEN 1.0::DOUBLE ELSE 2.0::DOUBLE * len(list_intersect(a.ns, e.ns)) / (len(a.ns) + len(e.ns)) END AS near_edited,
    CASE WHEN left(a.fp, 64) = left(x.fp, 64) THEN 1.0::DOUBLE ELSE 2.0::DOUBLE * len(list_intersect(a.ns, x.ns)) / (len(a.ns) + len(x.ns)) END AS near_next,
    CAST(CASE WHEN left(a.fp, 64) = left(e.fp, 64) THEN 0 ELSE len(list_filter(list_distinct(regexp_extract_all(list_aggregate(list_concat([''], list_filter(e.ss, lambda y: NOT list_contains(a.ss, y))), 'string_agg', ''), ',[0-9a-f]{16}')),
      lambda y: NOT list_contains(regexp_extract_all(list_aggregate(list_concat([''], list_filter(a.ss, lambda z: NOT list_contains(e.ss, z))), 'string_agg', ''), ',[0-9a-f]{16}'), y))) END AS INTEGER) AS changed
  FROM t JOIN k a ON t.text = a.text JOIN k e ON t.edited = e.text JOIN k x ON t.after = x.text"""
