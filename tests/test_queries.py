"""Every registered query of the library against its SQL, and rules for their plans."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from check import connect, spark_result, sql_result
from facetframe.plans.registry import RUNS, SQL
from tables import plan

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_agrees_with_sql(spark, con, name):
    assert spark_result(RUNS[name](spark, SF)) == sql_result(con, SQL[name])


def test_every_query_has_sql_and_is_registered():
    assert set(RUNS) == set(SQL)
    assert set(RUNS) <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0


def test_queries_see_rows_that_come_later(spark, tmp_path):
    orders = spark.read.parquet(f"{SF}/orders.parquet")
    for name in ("orders", "lineitem", "customer"):
        spark.read.parquet(f"{SF}/{name}.parquet").write.parquet(f"{tmp_path}/{name}.parquet")

    def counted(name, column):
        return RUNS[name](spark, str(tmp_path)).agg(F.sum(column)).first()[0]

    before = {n: counted(n, "n") for n in ("facet_null_bucket", "facet_by_counts")}
    more = orders.withColumn("o_orderkey", F.col("o_orderkey") + 10**9)
    more.write.mode("append").parquet(f"{tmp_path}/orders.parquet")
    lines = spark.read.parquet(f"{SF}/lineitem.parquet")
    lines = lines.withColumn("l_orderkey", F.col("l_orderkey") + 10**9)
    lines.write.mode("append").parquet(f"{tmp_path}/lineitem.parquet")
    for name, n in before.items():
        assert counted(name, "n") == 2 * n


@pytest.mark.parametrize("name", sorted(RUNS))
def test_no_query_multiplies_tables_or_runs_python(spark, name):
    text = plan(RUNS[name](spark, SF))
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "ArrowEval"):
        assert node not in text
