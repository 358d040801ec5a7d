"""Every registered query against its SQL, over whole tables."""

import re

import pytest
from oracle import compare, connect

import __spark_entry__ as contract
from tripflow.plans import catalogue

QUERIES = catalogue.queries()
ORACLES = catalogue.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_oracles_belong_to_queries():
    assert set(QUERIES) <= set(contract.queries()) and set(ORACLES) <= set(contract.oracle_sql())
    assert set(ORACLES) <= set(QUERIES)
    assert set(QUERIES) - set(ORACLES) == {"pca_explained"}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, sf_dir, con, name):
    result = QUERIES[name](spark, sf_dir)
    plan = result._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert name == "udf_square" or not re.search("Python|InPandas|InArrow", plan)
    assert compare(con, result, ORACLES[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_without_sql_is_repeatable(spark, sf_dir, name):
    first, second = (sorted(map(repr, QUERIES[name](spark, sf_dir).collect())) for _ in range(2))
    assert len(first) == len(second) > 0


def test_directory_scan_reads_all_orders_from_several_files(spark, sf_dir):
    files = QUERIES["scan_parquet_directory"](spark, sf_dir).inputFiles()
    assert len(files) > 1
    assert spark.read.parquet(*files).count() == spark.read.parquet(f"{sf_dir}/orders.parquet").count()


def test_entry(spark):
    result = contract.entry(spark)
    assert result.columns == ["layer", "name", "status", "n"]
    assert result.filter("status = 'written' AND n = 0").count() == 0
