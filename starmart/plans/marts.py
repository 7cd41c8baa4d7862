"""Insight queries over the star tables (our own; the star is open to any SQL)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starmart.operators import full_outer


def revenue_by_region_year(fact: DataFrame, customer: DataFrame) -> DataFrame:
    """Revenue and lines by the customer's region and the order year.

    The fact is reduced to (customer, year) before it meets the dimension: a
    customer with a third of all sales arrives at the join as a handful of rows.
    """
    per_customer = fact.groupBy("s_custkey", "s_year").agg(
        F.sum("s_revenue").alias("revenue"), F.count("s_linenumber").alias("n_lines")
    )
    regions = customer.select(F.col("c_custkey").alias("s_custkey"), "c_r_name")
    return (
        per_customer.join(regions, "s_custkey")
        .groupBy("c_r_name", "s_year")
        .agg(
            F.round(F.sum("revenue"), 2).alias("revenue"),
            F.sum("n_lines").alias("n_lines"),
        )
    )


def revenue_by_supplier_nation(fact: DataFrame, supplier: DataFrame) -> DataFrame:
    """Revenue and lines by the supplier's nation; reduced before the join."""
    per_supplier = fact.groupBy("s_suppkey").agg(
        F.sum("s_revenue").alias("revenue"), F.count("s_linenumber").alias("n_lines")
    )
    nations = supplier.select(F.col("supp_suppkey").alias("s_suppkey"), "supp_n_name")
    return (
        per_supplier.join(nations, "s_suppkey")
        .groupBy("supp_n_name")
        .agg(
            F.round(F.sum("revenue"), 2).alias("revenue"),
            F.sum("n_lines").alias("n_lines"),
        )
    )


def orders_by_month(orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    """Orders, lines and revenue by calendar month of the order, from the clean tables.

    Lines are reduced to one row per order before they meet the orders, and orders are
    then counted as rows (the order key is their primary key): no keys are shuffled
    again to tell them apart. Lines of unknown orders count under no month.
    """
    lines = lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.count("l_linenumber").alias("n_lines"), F.sum("l_revenue").alias("revenue")
    )
    known = orders.select("o_orderkey", "o_year", "o_month")
    return (
        full_outer(known, lines, "o_orderkey")
        .groupBy(F.col("o_year").alias("s_year"), F.col("o_month").alias("s_month"))
        .agg(
            F.count("o_orderkey").alias("n_orders"),
            F.coalesce(F.sum("n_lines"), F.lit(0)).alias("n_lines"),
            F.round(F.sum("revenue"), 2).alias("revenue"),
        )
    )


def balance_class_by_segment(clean_customer: DataFrame) -> DataFrame:
    """Customers and balance by market segment and balance class."""
    return clean_customer.groupBy("c_mktsegment", "c_acctbal_class").agg(
        F.count("*").alias("n_customers"),
        F.round(F.sum("c_acctbal"), 2).alias("acctbal"),
    )


def sales_hierarchy(fact: DataFrame, customer: DataFrame) -> DataFrame:
    """Revenue and lines by region, nation, year and month, with all levels above.

    ``level`` is the grouping id: 0 for single months of a nation, 15 for the total. Of
    the fact one small cell per nation and month is made first, and only cells are
    expanded to the levels. A NULL in a level that is summed up stands for all values.
    An empty fact has no levels, not even a total.
    """
    per_customer = fact.groupBy("s_custkey", "s_year", "s_month").agg(
        F.sum("s_revenue").alias("revenue"), F.count("s_linenumber").alias("n_lines")
    )
    places = customer.select(F.col("c_custkey").alias("s_custkey"), "c_r_name", "c_n_name")
    levels = ["c_r_name", "c_n_name", "s_year", "s_month"]
    cells = (
        per_customer.join(places, "s_custkey")
        .groupBy(*levels)
        .agg(F.sum("revenue").alias("revenue"), F.sum("n_lines").alias("n_lines"))
    )
    region, nation, year, month = [F.col(name) for name in levels]
    sets = [[region, nation, year, month], [region, nation, year], [region, year], [region], []]
    return cells.groupingSets(sets, *levels).agg(
        F.grouping_id().alias("level"),
        F.round(F.sum("revenue"), 2).alias("revenue"),
        F.sum("n_lines").alias("n_lines"),
    )


def best_suppliers(fact: DataFrame, supplier: DataFrame, top: int = 3) -> DataFrame:
    """The suppliers of most revenue of each nation and year; equal revenue, equal place.

    The fact is reduced to (supplier, year) before it meets the dimension. Spark keeps
    the best of each task before it shuffles by nation and year.
    """
    per_supplier = fact.groupBy("s_suppkey", "s_year").agg(
        F.round(F.sum("s_revenue"), 2).alias("revenue")
    )
    nations = supplier.select(F.col("supp_suppkey").alias("s_suppkey"), "supp_n_name")
    best = Window.partitionBy("supp_n_name", "s_year").orderBy(F.desc("revenue"))
    return (
        per_supplier.join(nations, "s_suppkey")
        .withColumn("place", F.rank().over(best))
        .where(F.col("place") <= top)
        .select("supp_n_name", "s_year", "place", "s_suppkey", "revenue")
    )


def revenue_trend(fact: DataFrame, customer: DataFrame) -> DataFrame:
    """Revenue of each region by month without gaps, against the year before.

    The calendar is made of a sequence from a region's first to its last month; a month
    without sales has revenue 0. ``year_before`` and ``change`` are NULL in the first
    twelve months; ``trailing`` is over up to twelve months and ``n_months`` says how
    many. Sales without a date or a region have no month to count under.
    """
    month = F.trunc("s_orderdate", "month").alias("month")
    per_customer = fact.groupBy("s_custkey", month).agg(F.sum("s_revenue").alias("revenue"))
    regions = customer.select(F.col("c_custkey").alias("s_custkey"), "c_r_name")
    monthly = (
        per_customer.join(regions, "s_custkey")
        .where("month IS NOT NULL AND c_r_name IS NOT NULL")
        .groupBy("c_r_name", "month")
        .agg(F.sum("revenue").alias("revenue"))
    )
    months = F.sequence(F.min("month"), F.max("month"), F.expr("INTERVAL 1 MONTH"))
    calendar = monthly.groupBy("c_r_name").agg(months.alias("months"))
    series = (
        calendar.select("c_r_name", F.explode("months").alias("month"))
        .join(monthly, ["c_r_name", "month"], "left")
        .withColumn("revenue", F.coalesce("revenue", F.lit(0.0)))
    )
    # One row per region and month: windows of a few hundred rows, however large the fact.
    by_month = Window.partitionBy("c_r_name").orderBy("month")
    year = by_month.rowsBetween(-11, Window.currentRow)
    before = F.lag("revenue", 12).over(by_month)
    return series.select(
        "c_r_name",
        "month",
        F.round("revenue", 2).alias("revenue"),
        F.round(before, 2).alias("year_before"),
        F.round(F.col("revenue") - before, 2).alias("change"),
        F.round(F.sum("revenue").over(year), 2).alias("trailing"),
        F.count("*").over(year).alias("n_months"),
    )


def cohort_retention(orders: DataFrame) -> DataFrame:
    """Customers by the month of their first order and the months until they order again.

    Orders are reduced to (customer, month) before anything else, so a customer with a
    third of all orders is a row per month like any other. Orders without customer or
    date belong to no cohort.
    """
    month = F.trunc("o_orderdate", "month").alias("month")
    active = orders.where("o_custkey IS NOT NULL AND o_orderdate IS NOT NULL").select(
        "o_custkey", month
    )
    active = active.distinct()
    first = active.groupBy("o_custkey").agg(F.min("month").alias("cohort"))
    since = F.months_between("month", "cohort").cast("int").alias("months_since")
    return (
        active.join(first, "o_custkey")
        .groupBy("cohort", since)
        .agg(F.count("*").alias("n_customers"))
    )


def order_sessions(orders: DataFrame, gap_days: int = 60) -> DataFrame:
    """Runs of orders of a customer without a pause of more than ``gap_days`` days.

    Windows go over the days on which a customer ordered, not over the orders: what a
    customer can bring to one task is bounded by the calendar. Orders without customer or
    date belong to no session.
    """
    days = (
        orders.where("o_custkey IS NOT NULL AND o_orderdate IS NOT NULL")
        .groupBy("o_custkey", F.to_date("o_orderdate").alias("day"))
        .agg(F.count("*").alias("n_orders"), F.sum("o_totalprice").alias("value"))
    )
    by_day = Window.partitionBy("o_custkey").orderBy("day")
    pause = F.datediff("day", F.lag("day").over(by_day))
    starts = F.coalesce(pause > gap_days, F.lit(True)).cast("long")
    return (
        days.withColumn("starts", starts)
        .withColumn("session", F.sum("starts").over(by_day))
        .groupBy("o_custkey", "session")
        .agg(
            F.min("day").alias("first_day"),
            F.max("day").alias("last_day"),
            F.sum("n_orders").alias("n_orders"),
            F.round(F.sum("value"), 2).alias("value"),
        )
    )


# --- stored sketches ------------------------------------------------------------

HLL_BITS = 12
# Three standard errors of a sketch of 2 ** HLL_BITS registers.
HLL_ERROR = 3 * 1.04 / 2 ** (HLL_BITS / 2)
KLL_K = 200
# Twice the rank error that a KLL sketch of that size keeps in 99 of 100 cases: sketches
# draw at random, and merging those of several years adds a little.
KLL_ERROR = 2 * 0.0133
QUANTILES = (0.25, 0.5, 0.9)


def customer_sketches(orders: DataFrame) -> DataFrame:
    """A mergeable sketch of the distinct customers of each month, a few KB a month.

    To be stored: customers of any period come from merging its months, without a look
    at the orders.
    """
    return orders.groupBy("o_year", "o_month").agg(
        F.hll_sketch_agg("o_custkey", F.lit(HLL_BITS)).alias("customers")
    )


def customers_by_year(sketches: DataFrame) -> DataFrame:
    """Estimated customers of each year, from the sketches of its months."""
    return sketches.groupBy("o_year").agg(
        F.hll_sketch_estimate(F.hll_union_agg("customers")).alias("estimate")
    )


def customers_by_year_checked(orders: DataFrame, sketches: DataFrame) -> DataFrame:
    """The exact customers of each year, and whether the sketches keep their error."""
    exact = (
        orders.select("o_year", "o_custkey")
        .distinct()
        .groupBy("o_year")
        .agg(F.count("o_custkey").alias("n_customers"))
    )
    error = F.abs(F.col("estimate") - F.col("n_customers"))
    # Few customers are counted exactly but for rounding.
    allowed = F.greatest(F.lit(1.0), HLL_ERROR * F.col("n_customers"))
    estimates = customers_by_year(sketches).withColumnRenamed("o_year", "year")
    return exact.join(estimates, F.col("o_year").eqNullSafe(F.col("year"))).select(
        "o_year", "n_customers", (error <= allowed).alias("within_error")
    )


def order_value_sketches(orders: DataFrame, customer: DataFrame) -> DataFrame:
    """A mergeable quantile sketch of the order values of each region and year."""
    regions = customer.select(F.col("c_custkey").alias("o_custkey"), "c_r_name")
    return (
        orders.select("o_custkey", "o_year", "o_totalprice")
        .join(regions, "o_custkey")
        .groupBy("c_r_name", "o_year")
        .agg(F.kll_sketch_agg_double("o_totalprice", F.lit(KLL_K)).alias("order_values"))
    )


def order_value_quantiles(sketches: DataFrame) -> DataFrame:
    """Estimated quantiles of the order values of each region, from its years' sketches."""
    merged = sketches.groupBy("c_r_name").agg(
        F.kll_merge_agg_double("order_values").alias("order_values")
    )
    found = [
        F.struct(
            F.lit(q).alias("quantile"),
            F.kll_sketch_get_quantile_double("order_values", F.lit(q)).alias("estimate"),
        )
        for q in QUANTILES
    ]
    return merged.select("c_r_name", F.inline(F.array(*found)))


def order_value_quantiles_checked(
    orders: DataFrame, customer: DataFrame, sketches: DataFrame
) -> DataFrame:
    """Orders of each region, and whether the exact rank of each estimated quantile is
    within the sketches' error. Values equal to the estimate may lie on either side."""
    regions = customer.select(F.col("c_custkey").alias("o_custkey"), "c_r_name")
    values = orders.select("o_custkey", "o_totalprice").join(regions, "o_custkey")
    estimates = order_value_quantiles(sketches).withColumnRenamed("c_r_name", "region")
    value, n = F.col("o_totalprice"), F.count("o_totalprice")
    below = F.count_if(value < F.col("estimate")) / n
    up_to = F.count_if(value <= F.col("estimate")) / n
    near = (below <= F.col("quantile") + KLL_ERROR) & (up_to >= F.col("quantile") - KLL_ERROR)
    return (
        values.join(estimates, F.col("c_r_name").eqNullSafe(F.col("region")))
        .groupBy("c_r_name", "quantile")
        .agg(n.alias("n_orders"), near.alias("within_error"))
    )


# The first mart as SQL over registered tables.
REVENUE_BY_REGION_YEAR_SQL = """
    SELECT c.c_r_name,
           f.s_year,
           round(sum(f.revenue), 2) AS revenue,
           sum(f.n_lines) AS n_lines
    FROM (
        SELECT s_custkey, s_year, sum(s_revenue) AS revenue,
               count(s_linenumber) AS n_lines
        FROM {database}.fact_sales
        GROUP BY s_custkey, s_year
    ) f
    JOIN {database}.dim_customer c ON c.c_custkey = f.s_custkey
    GROUP BY c.c_r_name, f.s_year
"""
