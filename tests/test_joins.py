import random

import pytest
from pyspark.sql import functions as F

from conftest import bag, plan
from starmart.operators import full_outer
from starmart.plans import quality, star

MANY = "k int, a string"
ONE = "k int, b string"


def check(many, one):
    df = full_outer(many, one, "k")
    assert sorted(df.columns) == ["a", "b", "k"]
    assert bag(df) == bag(many.join(one, "k", "outer"))


def test_null_and_single_keys(spark):
    many = spark.createDataFrame([(1, "x"), (2, "y"), (None, "z")], MANY)
    one = spark.createDataFrame([(2, "p"), (3, "q"), (None, "r")], ONE)
    df = full_outer(many, one, "k")
    assert df.count() == 5
    assert [r["k"] for r in df.where("a = 'y'").collect()] == [2]
    check(many, one)


@pytest.mark.parametrize("side", ["many", "one", "both"])
def test_empty_sides(spark, side):
    rows = [(1, "x"), (1, "x"), (None, "y")]
    many = spark.createDataFrame([] if side in ("many", "both") else rows, MANY)
    one = spark.createDataFrame([] if side in ("one", "both") else rows, ONE)
    check(many, one)


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("broadcast", ["10MB", "-1"])
def test_random_bags_with_duplicates_on_both_sides(spark, with_conf, seed, broadcast):
    rng = random.Random(seed)

    def rows(n, keys, hot):
        pool = [None, *range(keys)] + [hot] * keys
        return [(rng.choice(pool), rng.choice("abc")) for _ in range(n)]

    many = spark.createDataFrame(rows(300, 40, 7), MANY).repartition(6)
    one = spark.createDataFrame(rows(60, 60, 11), ONE).repartition(3)
    with with_conf({"spark.sql.autoBroadcastJoinThreshold": broadcast}):
        check(many, one)


def test_different_key_types(spark):
    many = spark.createDataFrame([(1, "x"), (5, "y")], MANY)
    one = spark.createDataFrame([(1, "p"), (2**40, "q")], "k bigint, b string")
    check(many, one)


@pytest.mark.parametrize("order", ["key sorted", "spread"])
def test_hot_key_is_split_over_tasks(spark, with_conf, order):
    """A third of the rows under one key; without broadcasts, by adaptive execution."""
    n = 300_000
    key = F.when(F.col("id") < n // 3, F.lit(7)).otherwise(F.col("id"))
    if order == "spread":
        key = F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id"))
    many = spark.range(n, numPartitions=16).select(
        key.cast("int").alias("k"), F.md5(F.col("id").cast("string")).alias("a")
    )
    one = spark.range(n, numPartitions=4).select(
        F.col("id").cast("int").alias("k"), F.lit("b").alias("b")
    )

    def largest_task(df):
        # A column of each side is needed, else the shuffled rows would be keys alone.
        per_task = df.groupBy(F.spark_partition_id()).agg(
            F.count("*").alias("rows"), F.max("a"), F.max("b")
        )
        return max(row.rows for row in per_task.collect())

    with with_conf(
        {
            "spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.coalescePartitions.enabled": "false",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
            "spark.sql.shuffle.partitions": "32",
        }
    ):
        plain = many.join(one, "k", "outer")
        split = full_outer(many, one, "k")
        assert split.agg(F.sum(F.xxhash64("k", "a", "b") % 1000)).first() == (
            plain.agg(F.sum(F.xxhash64("k", "a", "b") % 1000)).first()
        )
        assert largest_task(plain) > n // 3
        assert largest_task(split) < n // 6


def test_a_small_side_is_broadcast(spark):
    many = spark.range(3_000).select(F.col("id").alias("k"), F.lit("a").alias("a"))
    one = many.limit(10).withColumnRenamed("a", "b")
    df = full_outer(many, one, "k")
    df.collect()
    assert "BroadcastHashJoin" in plan(df)


def test_both_joins_read_one_shuffle(spark, with_conf):
    many = spark.createDataFrame([(1, "a"), (1, "b"), (None, "c")], "k int, a string")
    named = spark.createDataFrame([(1, "x"), (2, "y"), (2, "z"), (None, "n")], "key int, b string")
    one = named.withColumnsRenamed({"key": "k"}).withColumn("c", F.upper("b"))
    with with_conf(
        {
            "spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        }
    ):
        df = full_outer(many, one, "k")
        assert bag(df) == bag(many.join(one, "k", "outer"))
        df.collect()
        assert "ReusedExchange" in plan(df)


def test_builders_run_no_job(spark):
    """Building a DataFrame is free; only an action computes."""
    orders = spark.range(10).selectExpr("id AS o_orderkey", "id AS o_custkey")
    lines = spark.range(10).selectExpr("id AS l_orderkey", "1L AS l_linenumber")
    nation = spark.range(3).selectExpr("id AS n_nationkey", "'n' AS n_name", "id AS n_regionkey")
    region = spark.range(3).selectExpr("id AS r_regionkey", "'r' AS r_name")
    customer = spark.range(9).selectExpr("id AS c_custkey", "id AS c_nationkey")
    supplier = spark.range(9).selectExpr("id AS s_suppkey", "id AS s_nationkey")
    part = spark.range(9).selectExpr("id AS p_partkey")
    offers = spark.range(9).selectExpr("id AS ps_partkey", "id AS ps_suppkey")
    context = spark.sparkContext
    context.setJobGroup("building", "no job may run")
    try:
        tables = {
            "fact_sales": star.fact_sales(orders, lines),
            "dim_customer": star.dim_customer(customer, nation, region),
            "dim_supplier": star.dim_supplier(supplier, nation, region),
            "dim_part": star.dim_part(part, offers),
        }
        quality.alert_summary(quality.alert_rows(tables))
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    assert not context.statusTracker().getJobIdsForGroup("building")
