"""Every registered query against its DuckDB oracle at sf0.01 (the driver's gate)."""

import pytest

import __spark_entry__ as E
from sacctlens.plans.oracle import oracle_sql
from sacctlens.plans.queries import QUERIES
from paths import SF01
from oracle_check import compare, duck

SQL = oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF01)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, name, QUERIES[name], SQL.get(name), SF01, con)
    assert r["spark_rows"] == r["oracle_rows"]
    assert r["cols"], (r["s_cols"], r["o_cols"])
    assert r["values"]


def test_every_query_has_oracle():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(E.queries()) and set(SQL) <= set(E.oracle_sql())


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) == 9
    assert df.columns[:2] == ["tag", "cluster"]


_TYPE_PAIRS = {("bigint", "BIGINT"), ("int", "INTEGER"), ("double", "DOUBLE"), ("string", "VARCHAR"),
               ("date", "DATE"), ("boolean", "BOOLEAN")}


@pytest.mark.parametrize("name", sorted(SQL))
def test_column_types_match_oracle(spark, con, name):
    spark_types = dict(QUERIES[name](spark, SF01).dtypes)
    duck_types = {r[0]: r[1] for r in con.execute(f"DESCRIBE {SQL[name]}").fetchall()}
    assert set(spark_types) == set(duck_types)
    assert all((spark_types[c], duck_types[c]) in _TYPE_PAIRS for c in spark_types), (spark_types, duck_types)
