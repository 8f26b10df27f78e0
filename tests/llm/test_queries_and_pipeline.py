"""The registered queries and the pipeline over whole test tables, against brute force."""

import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__
import corpus_pipeline
from spanmill.llm import entry, html, mixing, pii, quality, secrets
from spanmill.llm.common import drop_tables, materialize, read, tables_since
from spanmill.llm.tokens import default_tokenizer, encoder

from .test_neardup import classes_of
from .test_text_operators import brute_top_k, pii_base, quality_figures, secrets_base

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def docs(spark):
    return {r["doc_id"]: r.asDict() for r in read(spark, SF, "documents").collect()}


@pytest.fixture(scope="module")
def run(spark):
    return lambda name: __spark_entry__.queries()[name](spark, SF).collect()


def words(text):
    return WORD.findall(text or "")


def test_tables_are_dropped(spark):
    since = len(tables_since())
    first, second = materialize(spark.range(5), "first"), materialize(spark.range(7), "second")
    drop_tables(spark, tables_since(since), keep=second.where("id > 2").withColumn("k", F.lit(1)))
    assert second.count() == 7 and len(tables_since(since)) == 1
    with pytest.raises(Exception, match="FILE_NOT_EXIST|does not exist|PATH_NOT_FOUND"):
        first.count()
    drop_tables(spark, tables_since(since))
    assert tables_since(since) == []


def test_op1(run, docs):
    total = defaultdict(int)
    for r in run("op1_offset_attribution"):
        total[r["doc_id"]] += r["n_tokens"]
    assert total == {i: len(encoder(default_tokenizer()).slow(d["text"] or "")) for i, d in docs.items()}


def test_op2(run, docs):
    rows = run("op2_sampled_splitters")
    load, slots = Counter(), defaultdict(list)
    for r in rows:
        raw = (docs[r["doc_id"]]["text"] or "").encode()
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(raw) + 1, zlib.crc32(raw), "bytes", None)
        load[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
    assert sorted(r["doc_id"] for r in rows) == sorted(docs) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(load.values()) - min(load.values()) <= 2 * max(r["size"] for r in rows)


def test_op3(spark, run):
    """The pages of these tables hold their article in one element, which a plain pattern finds."""
    pages = {r["page_id"]: r["html"] for r in read(spark, SF, "pages").collect()}
    for r in run("op3_inferred_wrappers"):
        inner = re.search(r"<article>(.*?)</article>", pages[r["page_id"]], re.DOTALL)
        blocks = [re.sub(r"\s+", " ", html.unescape(re.sub(r"<(?!/?(?:p|h1)\b)[^>]*>", lambda m: " " if m[0].startswith("<br") else "", b))).strip() for b in re.split(r"</?(?:p|h1)\b[^>]*>", inner[1])]
        assert r["text"] == "\n".join(b for b in blocks if b) and r["n_chars"] == len(r["text"])


def test_op4(run, docs):
    covered, places = Counter(), defaultdict(list)
    ids = {i: np.array([*encoder(default_tokenizer()).slow(d["text"] or ""), 0], "<u4") for i, d in docs.items()}
    for r in run("op4_best_fit_decreasing"):
        own = ids[r["doc_id"]]
        assert r["doc_tokens"] == len(own) and r["ids_crc32"] == zlib.crc32(own[r["start"] : r["start"] + r["length"]].tobytes())
        covered[r["doc_id"]] += r["length"]
        places[r["sequence_id"]].append((r["offset"], r["length"]))
    assert covered == {i: len(x) for i, x in ids.items()}
    assert all(sum(n for _, n in x) <= 1024 and [o for o, _ in sorted(x)] == list(np.cumsum([0] + [n for _, n in sorted(x)])[:-1]) for x in places.values())


def test_op5(run, docs):
    size = {i: len(words(d["text"])) for i, d in docs.items()}
    of = Counter()
    for i, d in docs.items():
        of[d["source"]] += size[i]
    order = sorted(s for s in of if s is not None) + [None] * (None in of)
    goal = dict(zip(order, mixing.targets([of[s] for s in order], [(1.0, 2.0, 3.0)[k % 3] for k in range(len(order))])))
    taken = Counter()
    for r in run("op5_hypergeometric_mix"):
        source = docs[r["doc_id"]]["source"]
        pieces = [tuple(map(int, p.split(":"))) for p in r["drawn"].split(",") if p]
        assert (r["size"], r["source_size"]) == (size[r["doc_id"]], of[source]) and r["target"] == pytest.approx(goal[source])
        assert r["taken"] == sum(p[4] for p in pieces) <= 3 * r["size"]
        held = Counter((p[1], k) for p in pieces for k in range(p[3], p[3] + p[4]))
        assert all(n == 1 and k < r["size"] for (_, k), n in held.items())  # no word twice in a pass
        taken[source] += r["taken"]
    assert all(abs(taken[s] - goal[s]) <= 1 for s in order)


def test_op6(run, docs):
    for r in run("op6_multipart_secrets"):
        text = docs[r["doc_id"]]["text"] or ""
        assert tuple(r)[1:5] == secrets_base(text)
        assert r["spans"] == secrets.joined(sorted(sum(secrets.scan(text), []), key=lambda s: (s[0], secrets.KINDS.index(s[2]) if s[2] in secrets.KINDS else 9, s[2])))


def test_op7(run, docs):
    order = sorted(docs)
    expected = classes_of([docs[i]["text"] for i in order])
    got = {r["doc_id"]: r["class_id"] for r in run("op7_order_minhash")}
    assert [got[i] for i in order] == [order[k] for k in expected]


def test_op8(run, docs):
    rows = run("op8_weak_supervision")
    assert len(rows) == len(docs) and all(tuple(r)[1:7] == quality_figures(docs[r["doc_id"]]["text"]) for r in rows)


def test_op9(run, docs):
    rows = run("op9_boosted_candidates")
    assert len(rows) == len(docs) and all(tuple(r)[1:6] == pii_base(docs[r["doc_id"]]["text"])[0] for r in rows)


def test_op10(spark, run):
    rows = [(r["vec_id"], r["embedding"]) for r in read(spark, SF, "embeddings").collect()]
    assert sorted(map(tuple, run("op10_uniform_threshold"))) == brute_top_k(rows, 50, 5)


@pytest.mark.parametrize("name", sorted(entry.ORACLE_SQL))
def test_queries_equal_their_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "embeddings"):
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    frame, wanted = __spark_entry__.queries()[name](spark, SF), con.sql(__spark_entry__.oracle_sql()[name])
    columns = sorted(frame.columns)
    assert columns == sorted(wanted.columns)
    places = [wanted.columns.index(c) for c in columns]
    assert sorted(repr([r[c] for c in columns]) for r in frame.collect()) == sorted(repr([r[i] for i in places]) for r in wanted.fetchall())


def test_pipeline(spark, docs):
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality_rules", "near_duplicates", "personal_data", "mixing", "packing"]
    tables, before = {}, read(spark, SF, "documents")
    for name, stage in list(stages.items())[:-1]:
        before = stage(spark, before, SF)
        assert before.columns == read(spark, SF, "documents").columns
        tables[name] = [r.asDict() for r in before.collect()]
        before = spark.createDataFrame([tuple(r.values()) for r in tables[name]], read(spark, SF, "documents").schema)
    judged = {r["doc_id"] for r in quality.judge(read(spark, SF, "documents")).where("kept").collect()}
    assert {r["doc_id"] for r in tables["quality_rules"]} == judged and all(r == docs[r["doc_id"]] for r in tables["quality_rules"])
    assert not any(quality_figures(docs[i]["text"])[5] for i in judged)
    order = sorted(judged)
    classes = classes_of([docs[i]["text"] for i in order])
    assert sorted(r["doc_id"] for r in tables["near_duplicates"]) == sorted(order[k] for k in set(classes))
    spans = {r["doc_id"]: r["spans"] for r in pii.scan_pii(read(spark, SF, "documents")).collect()}
    redacted = {r["doc_id"]: r for r in tables["personal_data"]}
    assert sorted(redacted) == sorted(r["doc_id"] for r in tables["near_duplicates"])
    for i, r in redacted.items():
        found = sorted((int(a), int(b), k) for k, a, b in (s.split(":") for s in spans[i].split(",") if s))
        at, out, text = 0, [], docs[i]["text"]
        for a, b, k in found:
            if a >= at:
                out += [text[at:a], f"[{k.upper()}]"]
            at = max(at, b)
        assert r["text"] == "".join(out) + text[at:] and r["n_chars"] == (len(r["text"]) if found else docs[i]["n_chars"])
        assert not any(pii_base(r["text"])[0][:4])
    size, taken = Counter(), Counter()
    for r in redacted.values():
        size[r["source"]] += len(words(r["text"]))
    for r in tables["mixing"]:
        taken[r["source"]] += len(words(r["text"]))
        assert " ".join(words(r["text"])) in " ".join(words(redacted[r["doc_id"]]["text"]))
    names = sorted(s for s in size if s is not None) + [None] * (None in size)
    goal = mixing.targets([size[s] for s in names], [(1.0, 2.0, 3.0)[k % 3] for k in range(len(names))])
    assert all(abs(taken[s] - g) <= 1 for s, g in zip(names, goal))
    packed = stages["packing"](spark, before, SF)
    total = sum(len(encoder(default_tokenizer()).slow(r["text"])) + 1 for r in tables["mixing"])
    assert packed.agg(F.sum("length")).first()[0] == total
    written = len(tables_since())
    whole = corpus_pipeline.run(spark, SF)
    assert len(tables_since(written)) == 1  # the last stage's input alone is left
    assert whole.columns == packed.columns and whole.agg(F.sum("length")).first()[0] == total
