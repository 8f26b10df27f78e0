"""pii_safety_metrics against its SQL on texts that the test tables lack: all types, words of context, overlaps, characters beyond ASCII."""

import random
import re

import duckdb
import pandas as pd

from spanmill.operators import pii
from spanmill.plans import queries
from tests.test_pii import HITS

ODD = [
    "key dd93acb406f036cedd end", "acct 12345678 and 12345678", "the account of one, two, three: 12345678901", "the account of one, two, three, four and five: 12345678901", "chart 123456789 12345 zip 94105-1234",
    "package: 12 years old 7, aged 3", "000-12-3456 666-12-3456 060-12-3456 661-12-3456 001 12 3456", "é123-45-6789 ٣23-45-6789 1٣3-45-6789", "mail é_a@b.org, ſue@site.org, x@y.KK", "https://a.b/cé. www.a.org/é",
    "linK 1.org foo.com", "vİsit foo.com", "visit foo.com", "dob\xa01/2/80\x1c1/2/8012", "DOB:　1980-01-02", "x+1 415 555 0123 (415)555-0123", "MRN-AB-12345678 mrn AB-12345-XY", "1EG4-TE5-MK73\x00MBI: 1EG4-TE5-MK73", "'zip': 94105", "", None,
]


def both(spark, path, rows):
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{path}/documents.parquet")
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{path}/documents.parquet/*.parquet'")
    listed = lambda found: sorted((str(a), b, c) for a, b, c in found)
    return listed(tuple(r) for r in queries.pii_safety_metrics(spark, str(path)).collect()), listed(con.sql(queries.SQL["pii_safety_metrics"]).fetchall())


def test_safety_metrics_equal_their_sql_on_all_types(spark, tmp_path):
    rng, parts = random.Random(7), [*HITS.values(), *filter(None, ODD)]
    mixed = [rng.choice(["", " ", "\n"]).join(rng.choice(parts) for _ in range(rng.randint(2, 4))) for _ in range(400)]
    texts = [*HITS.values(), *ODD, *mixed, *[t.upper() for t in parts]]
    found = {d[0] for t in texts for d in pii.detect_text(t or "", pii.STRICT)}
    assert found >= {e for _, e, s in pii.PATTERNS if s >= pii.STRICT.score_threshold} | {"MEDICARE_ID"}
    got, want = both(spark, tmp_path, list(enumerate(texts)))
    assert got == want and len(got) == 3 * ((len(texts) + 1) // 2)


def test_safety_metrics_equal_their_sql_on_odd_rows(spark, tmp_path):
    rows = [(0, None), (1, None), (2, "a@b.org"), (5, "10.1.2.3 a@b.org"), (6, "a@b.org 10.1.2.3"), (6, "b@c.org"), (7, "a@b.org"), (None, "a@b.org"), (9, "")]
    got, want = both(spark, tmp_path, rows)
    assert got == want and ("3", "pii_count", 2.0) in got and ("0", "pii_count", 0.0) in got and ("None", "pii_count", 0.0) in got


def test_the_sql_sees_characters_as_the_patterns_do():
    """Every code point is a digit, a space, another character of words or none of these to both, and four beyond ASCII match a letter."""
    chars = [chr(k) for k in range(1, 0x110000) if not 0xD800 <= k <= 0xDFFF]
    frame = pd.DataFrame({"text": chars})  # noqa: F841
    seen = [x for (x,) in duckdb.sql(f"SELECT {queries._SEEN} FROM frame").fetchall()]
    like = {c: next(x for x in "iks" if re.match(x, c, re.IGNORECASE)) for c in chars if c > "\x7f" and re.match("[a-z]", c, re.IGNORECASE)}
    kind = lambda c: like.get(c) or ("D" if re.match(r"\d", c) else " " if re.match(r"\s", c) else "L" if re.match(r"\w", c) else None)
    wrong = [(c, s) for c, s in zip(chars, seen) if (s != c.lower() and not (c.isspace() and s == " ") if c <= "\x7f" else s != k if (k := kind(c)) else s <= "\x7f" or len(s) != 1)]
    assert len(like) == 4 and wrong == []
