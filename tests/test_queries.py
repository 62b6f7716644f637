"""Every registered query against its SQL, on the smallest tables."""

import math
import os

import pytest

import __spark_entry__ as entry

duckdb = pytest.importorskip("duckdb")
pytestmark = pytest.mark.skipif(not os.path.isdir(entry.SMOKE_DIR), reason="no test tables")

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def oracle():
    db = duckdb.connect()
    for t in TABLES:
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{entry.SMOKE_DIR}/{t}.parquet'")
    return db


def plain(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    return int(v) if isinstance(v, (float, bool)) and v == int(v) else v


def table(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    rows = [tuple(plain(r[i]) for i in order) for r in data]
    return [columns[i] for i in order], sorted(rows, key=repr)


# the optional subpackage's own tests are in tests/llm
OWN = [n for n in entry.queries() if n != "pipeline" and not (entry.LLM and n in entry.LLM.queries())]


def test_every_query_has_sql():
    assert set(OWN) <= set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", OWN)
def test_query(spark, oracle, name):
    df = entry.queries()[name](spark, entry.SMOKE_DIR)
    result = oracle.execute(entry.oracle_sql()[name])
    columns = [d[0] for d in result.description]
    assert table(df.columns, df.collect()) == table(columns, result.fetchall())


def test_entry(spark):
    assert entry.entry(spark).columns == ["decade", "w1", "w2", "npmi", "pmi", "decade_npmi"]
