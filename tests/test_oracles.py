"""Every registered query with a SQL twin against DuckDB on the smallest tables; the others must run and have rows."""

import os

import duckdb
import pytest

from roundhouse.plans import catalog
from roundhouse.plans.fixtures import GIVEN

SF = "/root/testdata/sf0.001"


def plain(value):
    return round(value, 6) if isinstance(value, float) else value if value is None or isinstance(value, bool) else str(value)


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables here")
@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, name):
    frame = catalog.QUERIES[name](spark, SF)
    rows, names = frame.collect(), sorted(frame.columns)
    if name not in catalog.ORACLE_SQL:
        assert rows
        return
    con = duckdb.connect()
    for table in GIVEN:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    found = con.execute(catalog.ORACLE_SQL[name])
    columns = [x[0] for x in found.description]
    assert sorted(columns) == names
    want = sorted(repr([plain(r[columns.index(n)]) for n in names]) for r in found.fetchall())
    assert sorted(repr([plain(r[n]) for n in names]) for r in rows) == want
