"""Every query with SQL gives the rows that DuckDB gives on the same tables."""

import glob
import os
from collections import Counter

import duckdb
import pytest

from quillgraph.plans import adapters, catalog

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM read_parquet('{path}')")
    return con


@pytest.mark.skipif(not os.path.isdir(SF), reason="no tables")
@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_query_equals_its_sql(spark, duck, name):
    df = catalog.queries()[name](spark, SF)
    columns = sorted(df.columns)
    got = Counter(tuple(r[c] for c in columns) for r in df.collect())
    result = duck.execute(catalog.oracle_sql()[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    assert got == Counter(tuple(row[names.index(c)] for c in columns) for row in result.fetchall())


def test_quotations_of_any_length(spark):
    texts = ["one two three four five six seven eight nine", "alone", "", None, "ß💡 two  three\n four", "seventh heaven " * 9000 + "two three four five six seven eight end"]
    quotes = ["two three four five six sev", "ne two three four five six seven", "o three four five six seven eigh", "two three", "wo", "alone", "", " ", None, "💡 two  th", "absent", "one two three four five six seven eight nine", "n seventh heaven seventh", "eight end"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    items = spark.createDataFrame([(f"i{k}", q) for k, q in enumerate(quotes)], "item_id string, text string")
    got = Counter((r.item_id, r.doc_id) for r in adapters.quotations(docs, items).collect())
    assert got == Counter((f"i{k}", d) for k, q in enumerate(quotes) for d, t in enumerate(texts) if q is not None and t is not None and q in t)


def test_flagship_has_rows(spark):
    assert catalog.flagship(spark, SF).count() == 6
