"""Every query on the small tables, on the edge cases and on tables without rows."""

import pytest

from schoolatlas.llm.queries import QUERIES, SQL

from .conftest import _tables


def plain(value):
    return f"{value:.9g}" if isinstance(value, float) else str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted([plain(r[i]) for i in order] for r in rows)


@pytest.mark.parametrize("name", sorted(SQL))
@pytest.mark.parametrize("tables", ["sf_dir", "edge", "empty"])
def test_query_against_sql(spark, duck, request, tables, name):
    folder = request.getfixturevalue(tables)
    df = QUERIES[name](spark, folder)
    expected = duck(folder, SQL[name])
    assert sorted(df.columns) == sorted(expected.columns)
    assert rows_of(df.columns, df.collect()) == rows_of(expected.columns, expected.fetchall())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_query_without_rows(spark, empty, name):
    assert QUERIES[name](spark, empty).collect() == []


def test_lines_of_more_than_fifty_documents_on_a_large_host(spark, duck, tmp_path):
    """A host on which one per cent is more than fifty documents: the limit by number decides, in SQL as well."""
    words = lambda i: " ".join(f"w{i * 7 + k}" for k in range(22))
    texts = [words(i) + ("\nin fifty one of them" if i < 51 else "") + ("\nin fifty of them" if 60 <= i < 110 else "") for i in range(5300)]
    docs = [(i, text, "en", "large") for i, text in enumerate(texts)]
    _tables(str(tmp_path), docs, [], [], [])
    df = QUERIES["op2_line_rules"](spark, str(tmp_path))
    expected = duck(str(tmp_path), SQL["op2_line_rules"])
    rows = df.collect()
    assert rows_of(df.columns, rows) == rows_of(expected.columns, expected.fetchall())
    removed = {r.doc_id: r.n_removed_words for r in rows}
    assert [removed[i] for i in (0, 50, 51, 60, 109)] == [5, 5, 0, 0, 0]


def test_parts_of_items_are_in_the_edge_tables(spark, edge):
    rows = {(r.doc_id, r.item_id): r for r in QUERIES["op10_decontaminate"](spark, edge).collect()}
    assert (33, 1) in rows and rows[33, 1].similarity < 0.8 and (35, 1) in rows
    assert (34, 1) not in rows
