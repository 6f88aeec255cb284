"""Every named query against its check SQL on the smallest tables."""

import pytest
from oracle import compare, duck, normal_rows

import __spark_entry__ as contract

SF_DIR = "/root/testdata/sf0.001"
SQL = contract.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


# Spark's and the check engine's names of the same types.
SAME_TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "float": "FLOAT",
    "string": "VARCHAR",
    "date": "DATE",
    "boolean": "BOOLEAN",
}


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows_as_sql(spark, con, name):
    df = contract.queries()[name](spark, SF_DIR)
    rows = normal_rows(df.columns, [tuple(r) for r in df.collect()])
    assert compare(con, SQL[name], df.columns, rows) == "ok"
    described = con.execute(f"DESCRIBE {SQL[name]}").fetchall()
    assert {c: SAME_TYPES[t] for c, t in df.dtypes} == {r[0]: r[1] for r in described}


@pytest.mark.parametrize("name", sorted(set(contract.queries()) - set(SQL)))
def test_runs_without_sql(spark, name):
    assert contract.queries()[name](spark, SF_DIR).count() > 0


def test_entry(spark):
    assert contract.entry(spark).columns[-1] == "samebucket"
