"""The queries that have SQL give the rows that DuckDB gives on the same tables."""

import glob
import os
from collections import Counter

import duckdb
import pytest

from quillgraph.llm import queries

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.mark.skipif(not os.path.isdir(SF), reason="no tables")
@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM read_parquet('{path}')")
    df = queries.queries()[name](spark, SF)
    columns = sorted(df.columns)
    got = Counter(tuple(r[c] for c in columns) for r in df.collect())
    result = con.execute(queries.oracle_sql()[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    assert got == Counter(tuple(row[names.index(c)] for c in columns) for row in result.fetchall())
