"""Every query of the core library against its SQL, run by DuckDB on the same tables."""

import math

import duckdb
import pytest

from spanmill.plans.queries import QUERIES, SQL

TABLES = "region nation customer supplier part orders lineitem events documents conversations".split()


@pytest.fixture(scope="module")
def con(sf_dir):
    own = duckdb.connect()
    for t in TABLES:
        own.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return own


def listed(rows):
    return sorted(tuple(repr("nan" if isinstance(v, float) and math.isnan(v) else v) for v in r) for r in rows)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, sf_dir, con, name):
    frame = QUERIES[name](spark, sf_dir)
    columns = sorted(frame.columns)
    expected = con.sql(SQL[name])
    assert columns == sorted(expected.columns)
    order = [expected.columns.index(c) for c in columns]
    assert listed([r[c] for c in columns] for r in frame.collect()) == listed([r[i] for i in order] for r in expected.fetchall())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_query_has_rows(spark, sf_dir, name):
    assert QUERIES[name](spark, sf_dir).count() > 0
