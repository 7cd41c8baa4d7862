import datetime as dt

import pytest
from pyspark.sql import functions as F

from starmart.functions import (
    acctbal_class,
    array_length,
    order_month,
    order_year,
    revenue,
    surrogate_key,
)
from starmart.plans.clean import acctbal_average, clean_customer


def classes(spark, balances):
    df = spark.createDataFrame([(b,) for b in balances], "c_acctbal double")
    average = acctbal_average(df).scalar()
    rows = df.select(
        "c_acctbal", acctbal_class(F.col("c_acctbal"), average).alias("class")
    )
    return [row["class"] for row in rows.collect()]


def test_balance_classes(spark):
    # The average is 10; NULL and a balance at the average are above it.
    assert classes(spark, [-5.0, 10.0, None, 25.0, 10.0]) == [
        "negative",
        "above_average",
        "above_average",
        "above_average",
        "above_average",
    ]
    assert classes(spark, [0.0, 20.0]) == ["below_average", "above_average"]


def test_balance_class_of_empty_table(spark):
    empty = spark.createDataFrame([], "c_custkey int, c_acctbal double")
    assert clean_customer(empty).collect() == []
    assert acctbal_average(empty).first()[0] is None


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
@pytest.mark.parametrize("zone", ["UTC", "America/Los_Angeles", "Asia/Tokyo"])
def test_order_calendar(spark, with_conf, kind, zone):
    with with_conf({"spark.sql.session.timeZone": zone}):
        df = spark.sql(
            f"SELECT CAST(t AS {kind}) AS t FROM VALUES "
            "('1996-03-13 05:00:00'), ('1995-12-31 23:59:59'), (NULL) AS v(t)"
        )
        rows = df.select(order_year(F.col("t")), order_month(F.col("t"))).collect()
    assert [tuple(r) for r in rows] == [(1996, "Mar"), (1995, "Dec"), (None, None)]


def test_all_month_names(spark):
    days = [(dt.date(2001, month, 28),) for month in range(1, 13)]
    df = spark.createDataFrame(days, "d date").select(order_month(F.col("d")))
    names = "Jan Feb Mar Apr May Jun Jul Aug Sep Oct Nov Dec".split()
    assert [r[0] for r in df.collect()] == names


def test_revenue(spark):
    rows = [(100.0, 0.1, 0.05), (None, 0.1, 0.05), (1.0, None, 0.0), (1.0, 0.0, None)]
    df = spark.createDataFrame(rows, "p double, d double, t double")
    values = [r[0] for r in df.select(revenue(F.col("p"), F.col("d"), F.col("t"))).collect()]
    assert values[0] == 100.0 - 0.1 - 0.05
    assert values[1:] == [None, None, None]


def test_surrogate_key(spark):
    df = spark.createDataFrame([(1, 23), (12, 3), (1, None)], "a int, b bigint")
    keys = [r[0] for r in df.select(surrogate_key(F.col("a"), F.col("b"))).collect()]
    assert keys == ["123", "123", None]


def test_array_length(spark):
    df = spark.createDataFrame([(["a", "b"],), ([],)], "a array<string>")
    assert [r[0] for r in df.select(array_length(F.col("a"))).collect()] == [2, None]
