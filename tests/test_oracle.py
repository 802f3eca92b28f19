"""Every registered query against DuckDB on the driver's tables."""

import os

import duckdb
import pytest

import __spark_entry__ as contract
from wayfleet.plans import oracle, queries

SF = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")
TABLES = [f[: -len(".parquet")] for f in sorted(os.listdir(SF)) if f.endswith(".parquet")]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return con


def rows(table):
    names = sorted(table.column_names)
    return names, sorted(tuple(map(repr, r)) for r in zip(*(table.column(n).to_pylist() for n in names), strict=True))


def test_every_query_of_the_library_has_sql():
    """The training-data queries, registered beside these, have SQL only where it can express them."""
    assert set(queries.registry()) == set(oracle.oracle())
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", contract.oracle_sql())
def test_query_matches_sql(spark, duck, name):
    got = contract.queries()[name](spark, SF)
    want = duck.sql(contract.oracle_sql()[name])
    kinds = {"string": "VARCHAR", "int": "INTEGER", "timestamp_ntz": "TIMESTAMP"}
    assert {c: kinds.get(t, t.upper()) for c, t in got.dtypes} == dict(zip(want.columns, map(str, want.types), strict=True))
    assert rows(got.toArrow()) == rows(want.to_arrow_table())


def test_entry(spark):
    assert contract.entry(spark).count() == 1000


@pytest.mark.parametrize("name", [n for n in contract.queries() if n.startswith("decode_")])
def test_decoding_needs_no_shuffle(spark, name):
    plan = contract.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan


def test_correlation_shuffles_each_input_once(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = contract.queries()["correlate_five"](spark, SF)
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert plan.count("Exchange hashpartitioning") == 5 and plan.count("SortMergeJoin") == 4
