"""The registered queries on the smallest driver tables, against their SQL where there is any."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from fxlake.llm.queries import ORACLES, QUERIES
from tests.conftest import SMOKE_DIR


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "labels", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(SMOKE_DIR, t + '.parquet')}')")
    return con


def test_registered():
    names = set(entry.queries())
    assert {f"op{n}_" for n in range(1, 14)} == {name.split("_")[0] + "_" for name in QUERIES} and set(QUERIES) <= names
    assert "pipeline" in names and set(ORACLES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_sql(spark, duck, name):
    out = QUERIES[name](spark, SMOKE_DIR)
    found = duck.execute(ORACLES[name])
    columns = sorted(d[0] for d in found.description)
    want = found.fetchall()
    order = sorted(range(len(found.description or duck.description)), key=lambda i: duck.description[i][0])
    assert sorted(out.columns) == columns
    got = [tuple(str(r[c]) for c in columns) for r in out.collect()]
    assert sorted(got) == sorted(tuple(str(r[i]) for i in order) for r in want)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_one_row_a_document(spark, duck, name):
    ids = sorted(r[0] for r in duck.execute("SELECT doc_id FROM documents").fetchall())
    assert sorted(r.doc_id for r in QUERIES[name](spark, SMOKE_DIR).collect()) == ids
