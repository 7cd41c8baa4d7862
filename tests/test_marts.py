"""Insight queries on inline rows: gaps, ties, NULLs, hot customers and empty tables."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from starmart.plans import marts
from tests.conftest import plan

FACT = (
    "s_custkey long, s_suppkey long, s_orderkey long, s_linenumber long, s_revenue double, "
    "s_orderdate timestamp, s_year int, s_month string"
)
CUSTOMER = "c_custkey long, c_n_name string, c_r_name string"
ORDERS = "o_orderkey long, o_custkey long, o_totalprice double, o_orderdate timestamp, o_year int, o_month string"


def on(year, month, day=1):
    return dt.datetime(year, month, day)


def sale(customer, supplier, revenue, date):
    year, month = (date.year, date.strftime("%b")) if date else (None, None)
    return (customer, supplier, 1, 1, revenue, date, year, month)


def order(key, customer, value, date):
    year, month = (date.year, date.strftime("%b")) if date else (None, None)
    return (key, customer, value, date, year, month)


@pytest.fixture
def customers(spark):
    rows = [(1, "PERU", "AMERICA"), (2, "CHAD", "AFRICA"), (3, None, None), (None, "CUBA", "AMERICA")]
    return spark.createDataFrame(rows, CUSTOMER)


def test_months_without_sales_are_in_the_trend(spark, customers):
    sales = [
        sale(1, 1, 10.0, on(2000, 1, 31)), sale(1, 1, 5.0, on(2000, 1)), sale(1, 1, 7.0, on(2001, 1)),
        sale(2, 1, 1.0, on(2000, 6)), sale(3, 1, 9.0, on(2000, 6)), sale(1, 1, 8.0, None),
        sale(None, 1, 4.0, on(2000, 6)),
    ]
    found = marts.revenue_trend(spark.createDataFrame(sales, FACT), customers).collect()
    rows = {(r.c_r_name, r.month): tuple(r)[2:] for r in found}
    assert len(rows) == 13 + 1
    assert rows["AMERICA", dt.date(2000, 1, 1)] == (15.0, None, None, 15.0, 1)
    assert rows["AMERICA", dt.date(2000, 5, 1)] == (0.0, None, None, 15.0, 5)
    assert rows["AMERICA", dt.date(2001, 1, 1)] == (7.0, 15.0, -8.0, 7.0, 12)
    assert rows["AFRICA", dt.date(2000, 6, 1)] == (1.0, None, None, 1.0, 1)


def test_equal_revenue_has_an_equal_place(spark):
    suppliers = spark.createDataFrame(
        [(k, "PERU") for k in range(1, 7)] + [(9, None), (None, "CHAD")],
        "supp_suppkey long, supp_n_name string",
    )
    revenue = {1: 50.0, 2: 70.0, 3: 70.0, 4: 50.0, 5: 40.0, 6: 30.0, 9: 1.0}
    sales = [sale(1, k, v / 2, on(2000, m)) for k, v in revenue.items() for m in (1, 2)]
    best = marts.best_suppliers(spark.createDataFrame(sales, FACT), suppliers)
    found = {(r.supp_n_name, r.s_suppkey): r.place for r in best.collect()}
    assert found == {("PERU", 2): 1, ("PERU", 3): 1, ("PERU", 1): 3, ("PERU", 4): 3, (None, 9): 1}
    assert "WindowGroupLimit" in plan(best)


def test_every_level_of_the_hierarchy_adds_up(spark, customers):
    sales = [sale(c, 1, 1.0, on(y, m)) for c in (1, 2) for y in (2000, 2001) for m in (1, 2)]
    sales += [sale(3, 1, 100.0, None)]
    found = marts.sales_hierarchy(spark.createDataFrame(sales, FACT), customers).collect()
    levels = {}
    for r in found:
        levels[r.level] = levels.get(r.level, 0) + r.revenue
    assert levels == {0: 108.0, 1: 108.0, 5: 108.0, 7: 108.0, 15: 108.0}
    assert [r.n_lines for r in found if r.level == 15] == [9]


def test_cohorts_and_sessions(spark):
    orders = [
        order(1, 1, 10.0, on(2000, 1, 5)), order(2, 1, 10.0, on(2000, 1, 5)),
        order(3, 1, 1.5, on(2000, 3, 5)), order(4, 1, 1.0, on(2000, 5, 5)),
        order(5, 2, 2.0, on(2000, 1, 31)), order(6, None, 2.0, on(2000, 1)), order(7, 2, 2.0, None),
    ]
    df = spark.createDataFrame(orders, ORDERS)
    cohort = {tuple(r) for r in marts.cohort_retention(df).collect()}
    january = dt.date(2000, 1, 1)
    assert cohort == {(january, 0, 2), (january, 2, 1), (january, 4, 1)}
    found = {tuple(r) for r in marts.order_sessions(df, 60).collect()}
    assert found == {
        (1, 1, dt.date(2000, 1, 5), dt.date(2000, 3, 5), 3, 21.5),
        (1, 2, dt.date(2000, 5, 5), dt.date(2000, 5, 5), 1, 1.0),
        (2, 1, dt.date(2000, 1, 31), dt.date(2000, 1, 31), 1, 2.0),
    }


def test_a_hot_customer_brings_days_not_orders(spark):
    """A third of the orders under one key reach the window as one row per day."""
    orders = spark.range(30_000).select(
        F.col("id").alias("o_orderkey"),
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("o_custkey"),
        F.lit(1.0).alias("o_totalprice"),
        F.timestamp_add("DAY", (F.col("id") % 90).cast("int"), F.lit(on(2000, 1))).alias("o_orderdate"),
    )
    hot = marts.order_sessions(orders).where("o_custkey = 0").collect()
    assert [(r.session, r.n_orders) for r in hot] == [(1, 10_000)]
    text = plan(marts.order_sessions(orders))
    assert text.index("Window") < text.rindex("HashAggregate(keys=[o_custkey")


def test_orders_by_month_count_orders_once(spark):
    orders = [order(1, 1, 1.0, on(2000, 1)), order(2, 1, 1.0, on(2000, 1)), order(None, 1, 1.0, None)]
    lines = spark.createDataFrame(
        [(1, 1, 2.5), (1, 2, 2.5), (9, 1, 1.0), (None, 1, 4.0)],
        "l_orderkey long, l_linenumber long, l_revenue double",
    )
    found = marts.orders_by_month(spark.createDataFrame(orders, ORDERS), lines)
    rows = {(r.s_year, r.s_month): (r.n_orders, r.n_lines, r.revenue) for r in found.collect()}
    assert rows == {(2000, "Jan"): (2, 2, 5.0), (None, None): (1, 2, 5.0)}


def test_sketches_merge_to_the_sketch_of_all(spark, customers):
    orders = [order(i, 1 + i % 2, float(i), on(2000 + i % 4, 1 + i % 12)) for i in range(400)]
    df = spark.createDataFrame(orders, ORDERS)
    checked = marts.customers_by_year_checked(df, marts.customer_sketches(df)).collect()
    assert {(r.o_year, r.n_customers, r.within_error) for r in checked} == {
        (y, 1, True) for y in range(2000, 2004)
    }
    sketches = marts.order_value_sketches(df, customers)
    found = marts.order_value_quantiles_checked(df, customers, sketches).collect()
    assert len(found) == 6 and all(r.within_error and r.n_orders == 200 for r in found)


def test_empty_tables_give_empty_marts(spark, customers):
    fact, orders = (spark.createDataFrame([], schema) for schema in (FACT, ORDERS))
    lines = spark.createDataFrame([], "l_orderkey long, l_linenumber long, l_revenue double")
    for df in (
        marts.revenue_trend(fact, customers),
        marts.cohort_retention(orders),
        marts.order_sessions(orders),
        marts.orders_by_month(orders, lines),
        marts.customers_by_year_checked(orders, marts.customer_sketches(orders)),
        marts.order_value_quantiles_checked(
            orders, customers, marts.order_value_sketches(orders, customers)
        ),
    ):
        assert df.collect() == []
    # Spark makes no total of nothing where rows are expanded to levels.
    assert marts.sales_hierarchy(fact, customers).collect() == []
