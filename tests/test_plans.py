"""Plan lint: every registered query stays in the JVM (no Python UDF
evaluation), never builds a Cartesian product or nested-loop join, and
filters/projections reach the Parquet scan."""

import pytest

import __spark_entry__ as E
from basketry.plans import views as V
from basketry.plans.catalog import REGISTRY

SF = "/root/testdata/sf0.001"
FORBIDDEN = ["BatchEvalPython", "ArrowEvalPython", "PythonUDF", "MapInPandas", "FlatMapGroupsInPandas",
             "CartesianProduct", "BroadcastNestedLoopJoin"]


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_no_python_no_cross_products(spark, name):
    plan = _plan(E.queries()[name](spark, SF))
    assert not [op for op in FORBIDDEN if op in plan]


def test_filters_and_columns_pushed_to_scan(spark):
    plan = _plan(V.merge_existing(spark, SF))
    assert "PushedFilters: [IsNotNull(o_orderdate), LessThan(o_orderdate," in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderstatus:string,o_totalprice:double," in plan
    assert "o_custkey" not in plan       # unused column pruned from the scan
    daily = _plan(E.queries()["orders_daily_metrics"](spark, SF))
    assert "ReadSchema: struct<o_totalprice:double,o_orderdate:timestamp_ntz>" in daily


def test_distributed_quantiles_have_no_single_partition_exchange_over_values(spark):
    from pyspark.sql import functions as F
    from basketry.functions.quantiles import quantiles
    df = spark.read.parquet(f"{SF}/lineitem.parquet")
    q = quantiles(df, "l_extendedprice", {"p50": .5})
    # the distinct values are checkpointed; they are ranked in ranges of values,
    # and only the totals of those ranges meet in one partition
    plan = _plan(q)
    assert "FileScan" not in plan and "Scan ExistingRDD" in plan
    singles = [line for line in plan.splitlines() if "SinglePartition" in line]
    assert singles and all("_v#" not in line for line in singles)
    grouped = quantiles(df.withColumn("g", F.col("l_returnflag")), "l_extendedprice", {"p50": .5}, by=["g"])
    assert grouped.count() == 3
