"""Queries on tables that pass four digits or a page's lines: the same rows as their SQL."""

from collections import Counter

import duckdb
import pytest

from quillgraph.operators import graph, identity, render
from quillgraph.plans import catalog, narrative


def table(folder, name, sql):
    duckdb.sql(f"COPY ({sql}) TO '{folder}/{name}.parquet' (FORMAT parquet)")
    return str(folder)


def both(spark, folder, name, query):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    df = catalog.queries()[query](spark, folder)
    columns = sorted(df.columns)
    expected = con.execute("SELECT " + ", ".join(f'"{c}"' for c in columns) + f" FROM ({catalog.oracle_sql()[query]})").fetchall()
    return Counter(tuple(r[c] for c in columns) for r in df.collect()), Counter(expected)


def test_ids_of_over_9999_segments(spark, tmp_path):
    folder = table(tmp_path, "documents", "SELECT i AS doc_id, CASE WHEN i % 7 > 0 THEN 'text ' || i % 5 END AS text, 'en' AS lang, 's' AS source, 6 AS n_chars FROM range(10020) t(i)")
    got, expected = both(spark, folder, "documents", "segment_ids")
    assert got == expected


def test_ids_of_over_9999_lines(spark, tmp_path):
    folder = table(tmp_path, "documents", "SELECT 1 AS doc_id, string_agg('a line of twenty or more ' || i, chr(10) ORDER BY i) AS text, 'en' AS lang, 's' AS source, 6 AS n_chars FROM range(10020) t(i)")
    got, expected = both(spark, folder, "documents", "segment_documents")
    assert got == expected


def parts(folder, rows, brands):
    return table(folder, "part", f"SELECT i AS p_partkey, ['hot', 'cold', 'large', 'old'][i % 4 + 1] || ' ' || ['bolt', 'ring', 'rod'][i % 3 + 1] AS p_name, 'Brand#' || i % {brands} AS p_brand, 'SMALL' AS p_type, CAST(i % 11 + 1 AS INTEGER) AS p_size, 900 + i % 100 / 1.0 AS p_retailprice FROM range({rows}) t(i)")


@pytest.fixture(scope="module")
def long_source(tmp_path_factory):
    return parts(tmp_path_factory.mktemp("long"), 10_020, 1)


def test_long_indexes_are_one_page_in_the_query(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(render, "INDEX_LINES", 30)
    folder = parts(tmp_path, 200, 3)
    got, expected = both(spark, folder, "part", "index_pages")
    assert got == expected


def test_no_index_is_among_the_chapters(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(render, "INDEX_LINES", 30)
    folder = parts(tmp_path, 200, 3)
    got, expected = both(spark, folder, "part", "chapter_pages")
    assert got == expected


def test_pages_of_one_kind(spark, tmp_path):
    folder = parts(tmp_path, 60, 3)
    paths = lambda kind: {r.path.split("/")[0] for r in narrative._pages(spark, folder, kind).select("path").collect()}
    assert paths("chapters") == {"Chapters"} and paths("passages") == {"Passages"} and paths("indexes") == {"Chapters", "Passages", "Entities.md"}
    assert paths("entities") == {"Bolts", "Rings", "Rods", "Makers"}


@pytest.mark.parametrize("query", ["entity_pages", "chapter_pages", "passage_pages", "index_pages"])
def test_pages_of_over_9999_chapters(spark, long_source, query):
    got, expected = both(spark, long_source, "part", query)
    assert got == expected


def test_extractions_are_built_once_and_where_parts_are_dealt_to(spark, tmp_path):
    folder = parts(tmp_path, 60, 3)
    found = identity.mentions(narrative.extractions(spark, folder), narrative.segments(spark, folder))
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "RepartitionByExpression" in plan and "Maker " not in plan.split("RepartitionByExpression", 1)[1] and plan.count("Maker ") == 1


def test_merging_looks_at_equal_mentions_once(spark, tmp_path):
    folder = parts(tmp_path, 600, 3)
    found = identity.mentions(narrative.extractions(spark, folder), narrative.segments(spark, folder))
    known = identity.terms(found)
    assert known.count() == found.select("key", "category", "aliases").distinct().count() < found.count() / 2
    owners = lambda rows: {(r.alias_key, tuple(r.owners)) for r in identity.alias_owners(rows).collect()}
    assert owners(known) == owners(found)
    place = lambda rows: {(r.segmentId, r.pos, r.group, r.seq) for r in rows.collect()}
    assert place(identity.group_mentions(found, known=known)) == place(identity.group_mentions(found))


@pytest.mark.parametrize("query", ["identity_gate", "graph_claims", "graph_relationships", "passage_pages", "graph_issues"])
def test_nothing_is_numbered_that_needs_no_numbers(spark, tmp_path, monkeypatch, query):
    monkeypatch.setattr(graph, "numbered", None)
    folder = parts(tmp_path, 60, 3)
    got, expected = both(spark, folder, "part", query)
    assert got == expected


def test_passages_make_no_index(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(render, "numbered", None)
    folder = parts(tmp_path, 60, 3)
    got, expected = both(spark, folder, "part", "passage_pages")
    assert got == expected
