"""Every registered query against its SQL in another engine, whole results compared."""

import os

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from weftable.bindings import oracle as _oracle
from weftable.bindings import queries as _queries
from engines import connect, in_duckdb, in_spark

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES, ORACLE = _queries.queries(), _oracle.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    assert in_spark(QUERIES[name](spark, FOLDER)) == in_duckdb(duck, ORACLE[name])


def test_contract_registers_them():
    assert set(QUERIES) <= set(contract.queries()) and set(ORACLE) <= set(contract.oracle_sql())


def test_transactions_stay_whole(spark):
    total = QUERIES["z_two_sided"](spark, FOLDER).agg(F.sum("value")).first()[0]
    lines = spark.read.parquet(f"{FOLDER}/lineitem.parquet").agg(F.sum("l_extendedprice")).first()[0]
    assert abs(total - lines) <= 1e-9 * lines


@pytest.mark.parametrize("name", ["repartition_key", "key_conservation", "coverage_gaps", "va_weighted"])
def test_weights_need_no_users(spark, name):
    from weftable.bindings import tables

    for plan in (QUERIES[name](spark, FOLDER), tables.producer_lines(spark, FOLDER)):
        text = plan._jdf.queryExecution().toString()
        assert "o_orderkey" not in text and "c_custkey" not in text


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns == ["resource_id", "use_id", "value"] and df.count() > 0


def test_scan_reads_only_what_it_needs(spark):
    plan = QUERIES["null_propagating_sum"](spark, FOLDER)._jdf.queryExecution().toString()
    assert "ReadSchema: struct<l_linenumber:int,l_extendedprice:double,l_returnflag:string>" in plan


@pytest.mark.parametrize("name", ["z_two_sided", "d_weighted_dense", "hybrid_grid", "vintage_asof", "coverage_gaps"])
def test_no_product_joins(spark, name):
    plan = QUERIES[name](spark, FOLDER)._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
