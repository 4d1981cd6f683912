"""The driver's queries against their SQL, on the smallest tables."""

import glob
import os

import duckdb
import pytest

from tessera.plans import operator_queries as queries

SF = "/root/testdata/sf0.001"


def rows_of(columns, rows):
    return sorted(map(str, ([None if x is None else round(x, 6) if isinstance(x, float) else x for x in r] for r in rows))), columns


@pytest.mark.skipif(not os.path.isdir(SF), reason="the driver's tables aren't here")
@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query(spark, name):
    con = duckdb.connect()
    for p in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM '{p}'")
    df = queries.QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    want = con.execute(f"SELECT {', '.join(columns)} FROM ({queries.ORACLE_SQL[name]})").fetchall()
    assert rows_of(columns, df.select(*columns).collect()) == rows_of(columns, want)
