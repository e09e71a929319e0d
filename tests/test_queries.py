"""Every query against its SQL statement, on the whole small tables."""

import math
import os
from decimal import Decimal

import duckdb
import pytest

from workload.inputs import TABLES
from workload.oracle import SQL
from workload.queries import QUERIES

SF_DIR = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, (float, Decimal)):
        return "nan" if math.isnan(value) else f"{float(value):.9g}"
    return str(value)


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted([_plain(r[i]) for i in order] for r in rows)


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)


LOOKUPS = [n for n in QUERIES if n.startswith(("q12", "q18", "q24", "q25", "q26", "q27", "q28", "q29", "q33", "q34"))]


@pytest.mark.parametrize("name", LOOKUPS)
def test_query_without_broadcast(spark, duck, name):
    """The same rows when no lookup may be broadcast."""
    limits = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    before = {c: spark.conf.get(c, None) for c in limits}
    try:
        for c in limits:
            spark.conf.set(c, "-1")
        df = QUERIES[name](spark, SF_DIR)
        rows = df.collect()
    finally:
        for c, value in before.items():
            spark.conf.unset(c) if value is None else spark.conf.set(c, value)
    result = duck.sql(SQL[name])
    assert _rows(df.columns, rows) == _rows(result.columns, result.fetchall())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    found = df.collect()
    assert found
    assert name in SQL, "no SQL statement"
    result = duck.sql(SQL[name])
    assert sorted(df.columns) == sorted(result.columns)
    kinds = {c: str(t) for c, t in zip(result.columns, result.types)}
    expected = result.fetchall()
    ours, theirs = _rows(df.columns, found), _rows(result.columns, expected)
    extra = [r for r in ours if r not in theirs][:3] if len(ours) < 5000 else ""
    lacking = [r for r in theirs if r not in ours][:3] if len(ours) < 5000 else ""
    assert len(ours) == len(theirs)
    assert ours == theirs, f"extra {extra} lacking {lacking}"
    spark_kinds = {
        "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR",
        "double": "DOUBLE", "boolean": "BOOLEAN",
    }
    assert {c: spark_kinds[t] for c, t in df.dtypes} == kinds
