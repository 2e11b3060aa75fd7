"""Named queries against their SQL, where the given tables are at hand."""

import os

import pytest

from quillbank.plans.oracles import ORACLES
from quillbank.plans.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


def test_every_query_but_one_has_sql():
    assert set(QUERIES) - set(ORACLES) == {"clean_pages"}


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="tables not present")
@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for file in os.listdir(SF_DIR):
        con.execute(f"CREATE VIEW {file.split('.')[0]} AS SELECT * FROM '{SF_DIR}/{file}'")
    got = QUERIES[name](spark, SF_DIR)
    cur = con.execute(ORACLES[name])
    columns = [d[0] for d in cur.description]
    assert sorted(columns) == sorted(got.columns)
    key = repr
    assert sorted(map(tuple, got.select(*columns).collect()), key=key) == sorted(cur.fetchall(), key=key)
