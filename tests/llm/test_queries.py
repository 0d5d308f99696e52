"""Registered queries: equal to their DuckDB twins on a fixture of edge cases and
on the smallest data set; defined on empty tables."""

import pytest

from spindle.llm.queries import ORACLE_SQL, QUERIES
from tests.conftest import SF001
from tests.llm.conftest import SCHEMAS, duck
from tools.oracle_check import digest


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
@pytest.mark.parametrize("folder", ["cases", "sf0.001", "nothing"])
def test_query_equals_sql(spark, request, name, folder):
    path = SF001 if folder == "sf0.001" else request.getfixturevalue(folder)
    df = QUERIES[name](spark, path)
    rows = [tuple(r) for r in df.collect()]
    cur = duck(path).execute(ORACLE_SQL[name])
    columns = [d[0] for d in cur.description]
    want = cur.fetchall()
    assert sorted(df.columns) == sorted(columns)
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    mine = sorted(range(len(columns)), key=lambda i: df.columns[i])
    if digest(df.columns, rows) != digest(columns, want):  # show the rows that differ
        assert sorted(([r[i] for i in mine] for r in rows), key=str) == sorted(([r[i] for i in order] for r in want), key=str)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE_SQL)))
def test_empty_tables(spark, nothing, name):
    assert QUERIES[name](spark, nothing).count() == 0


@pytest.mark.parametrize("name,table", [("op1_suffixes", "documents"), ("op4_toxicity", "documents"), ("op5_html", "pages"),
                                        ("op10_chunks", "documents")])
def test_edge_cases_give_a_row_each(spark, cases, name, table):
    """Null ids and texts, repeated rows and clashing columns: one row per row."""
    rows = QUERIES[name](spark, cases).collect()
    key = "page_id" if table == "pages" else "doc_id"
    want = duck(cases).execute(f"SELECT {key} FROM {table}").fetchall()
    assert sorted((r[key] for r in rows), key=str) == sorted((w[0] for w in want), key=str)


def test_every_operator_has_a_query():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert set(SCHEMAS) == {"documents", "benchmark", "pages", "labels", "conversations"}
