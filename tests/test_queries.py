"""Every registered query against its SQL counterpart on the smallest tables."""

import os
import re

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry_module

ROOT = "/root/testdata/sf0.001"
QUERIES, ORACLE = entry_module.queries(), entry_module.oracle_sql()
TYPES = {
    "double": "DOUBLE",
    "bigint": "BIGINT",
    "int": "INTEGER",
    "string": "VARCHAR",
    "timestamp_ntz": "TIMESTAMP",
    "boolean": "BOOLEAN",
}

pytestmark = pytest.mark.skipif(not os.path.isdir(ROOT), reason="no test tables")


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for name in os.listdir(ROOT):
        con.execute(f"CREATE VIEW {name.split('.')[0]} AS SELECT * FROM '{ROOT}/{name}'")
    return con


def as_rows(frame, columns):
    def text(v):
        if v is None or v is pd.NaT or (isinstance(v, float) and v != v):
            return "null"
        return str(pd.Timestamp(v)) if hasattr(v, "isoformat") else repr(v)

    return sorted(tuple(text(v) for v in row) for row in frame[columns].itertuples(index=False))


# The corpus queries, where they are present, have tests of their own.
@pytest.mark.parametrize("name", sorted(n for n in QUERIES if not re.match(r"op\d+_|pipeline$", n)))
def test_query(spark, db, name):
    df = QUERIES[name](spark, ROOT)
    got = df.toPandas()
    if name not in ORACLE:
        assert len(got) > 0
        return
    cursor = db.execute(ORACLE[name])
    types = {d[0]: str(d[1]) for d in cursor.description}
    want = cursor.df()
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    assert {c: TYPES[t] for c, t in df.dtypes} == types
    assert as_rows(got, columns) == as_rows(want, columns)


def test_every_oracle_belongs_to_a_query():
    assert set(ORACLE) <= set(QUERIES)


def test_entry(spark):
    df = entry_module.entry(spark)
    assert df.columns[:2] == ["bucket", "symbol"] and df.count() > 0
