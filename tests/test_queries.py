"""Catalogue queries against their DuckDB oracles on the smallest driver tables."""

import decimal
import os

import duckdb
import pytest

import __spark_entry__ as entry
from tests.conftest import SMOKE_DIR

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]
# A representative subset; tools/oracle_check.py runs every query.
FAST = ["canonical_lines", "quarantine_split", "raw_unbalanced_journals", "mec_summary",
        "tb_summary", "book_quarterly", "approval_state", "idempotent_ingest", "stream_replay"]


def _norm(v):
    if isinstance(v, decimal.Decimal):
        return str(v.normalize())
    return str(v)


def _bag(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted("|".join(_norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(SMOKE_DIR, t + '.parquet')}')")
    return con


def test_every_query_has_an_oracle():
    """Of the catalogue; the llm package lists its own."""
    assert set(entry.QUERIES) <= set(entry.oracle_sql())
    assert set(entry.QUERIES) <= set(entry.queries())


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "is_valid" in df.columns


@pytest.mark.parametrize("name", FAST)
def test_query_matches_oracle(spark, duck, name):
    df = entry.queries()[name](spark, SMOKE_DIR)
    rows = [tuple(r) for r in df.collect()]
    res = duck.execute(entry.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert _bag(df.columns, rows) == _bag(ocols, orows)
