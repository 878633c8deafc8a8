"""A third of all rows on one key: results stay whole, and the hot task is split."""

import os

import pytest
from pyspark.sql import functions as F

from closebook.checks.bindings import Bindings
from closebook.operators import journal

N = 60_000


@pytest.fixture(scope="module")
def skewed_dir(spark, tmp_path_factory):
    """Test-shaped tables in which one order, one customer and one product hold a third of the lines."""
    root = str(tmp_path_factory.mktemp("skew"))
    hot = F.col("id") % 3 == 0
    spark.range(N).repartition(16).select(
        F.when(hot, 7).otherwise(F.col("id") % 5000).alias("l_orderkey"),
        F.when(hot, 3).otherwise(F.col("id") % 900).alias("l_partkey"),
        (F.col("id") % 50).alias("l_suppkey"),
        F.lit(1).alias("l_linenumber"),
        F.lit(1.0).alias("l_quantity"),
        (F.col("id") % 1000 + 0.25).alias("l_extendedprice"),
        F.lit(0.1).alias("l_discount"),
        F.lit(0.0).alias("l_tax"),
        F.when(F.col("id") % 10 == 0, "R").otherwise("N").alias("l_returnflag"),
        F.lit("F").alias("l_linestatus"),
        F.expr("timestamp_ntz'1997-01-01' + make_interval(0, 0, 0, cast(id % 300 as int))").alias("l_shipdate"),
    ).write.parquet(f"{root}/lineitem.parquet")
    spark.range(5000).selectExpr(
        "id as o_orderkey", "if(id < 1700, 11, id % 400) as o_custkey", "'F' as o_orderstatus",
        "1.0d as o_totalprice", "timestamp_ntz'1997-01-01' as o_orderdate", "'x' as o_orderpriority",
    ).write.parquet(f"{root}/orders.parquet")
    spark.range(400).selectExpr(
        "id as c_custkey", "'n' as c_name", "1 as c_nationkey", "0.0d as c_acctbal",
        "if(id % 5 = 0, 'AUTOMOBILE', 'MACHINERY') as c_mktsegment",
    ).write.parquet(f"{root}/customer.parquet")
    return root


@pytest.fixture
def small_tasks(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k",
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.shuffle.partitions": "24",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key in settings:
        spark.conf.unset(key)
    spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_hot_order_is_split_in_the_join(spark, skewed_dir, small_tasks):
    amounts = journal.billed_amounts(Bindings(spark, skewed_dir).revenue_lines())
    total = amounts.agg(F.sum("amount")).first()[0]
    lines = spark.read.parquet(os.path.join(skewed_dir, "lineitem.parquet"))
    sign = F.when(F.col("l_returnflag") == "R", -1).otherwise(1)
    expected = lines.where("l_partkey != 92").agg(F.sum(sign * F.col("l_extendedprice").cast("decimal(13,2)") * 9)).first()[0]
    # Lines are rounded one by one: within half a cent each.
    assert abs(float(total) - float(expected) / 10) < N * 0.005
    amounts.collect()
    assert "(skew=true)" in amounts._jdf.queryExecution().executedPlan().toString()


def test_hot_product_is_spread_over_files(spark, skewed_dir, small_tasks):
    amounts = journal.billed_amounts(Bindings(spark, skewed_dir).revenue_lines())
    stage = journal.stage_batches(amounts, 50)
    rows = stage.collect()
    keys = ["partner", "sku", "payment_date", "organization_id", "report_month"]
    expected, partner_rows, files = {}, {}, 0
    for row in sorted(amounts.collect(), key=lambda r: tuple(r[k] for k in keys)):
        n = partner_rows.get(row.partner, 0)
        partner_rows[row.partner] = n + 1
        if n % 50 == 0:
            files += 1
        expected[tuple(row[k] for k in keys)] = (files, row.amount)
    assert {tuple(r[k] for k in keys): (r.file_no, r.amount) for r in rows} == expected
