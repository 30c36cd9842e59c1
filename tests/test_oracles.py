"""Every query with an SQL equivalent agrees with DuckDB on the small tables and plans well."""

import re

import duckdb
import pandas as pd
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from check_queries import TABLES, rows_of

ORACLES = oracle_sql()
UNWANTED = re.compile(
    r"BroadcastNestedLoopJoin|CartesianProduct|PythonUDF|ArrowEvalPython|BatchEvalPython|MapInPandas"
)


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql_and_plans_well(spark, sf_dir, duck, name):
    df = queries()[name](spark, sf_dir)
    got = pd.DataFrame([tuple(r) for r in df.collect()], columns=df.columns, dtype=object)
    cursor = duck.execute(ORACLES[name])
    want = pd.DataFrame(cursor.fetchall(), columns=[c[0] for c in cursor.description], dtype=object)
    assert sorted(got.columns) == sorted(want.columns)
    assert rows_of(got) == rows_of(want)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not UNWANTED.search(plan)


def test_entry_runs(spark, sf_dir):
    assert entry(spark).count() > 0


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(queries())
