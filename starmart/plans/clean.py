"""Clean tables: DataFrames in, DataFrames out, contract columns in contract order."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.functions import acctbal_class, order_month, order_year, revenue
from starmart.operators import contract
from starmart.schemas import CLEAN_COLUMNS


def acctbal_average(customer: DataFrame) -> DataFrame:
    """One row: the average account balance (NULL without customers)."""
    return customer.agg(F.avg("c_acctbal").alias("avg_acctbal"))


def clean_customer(customer: DataFrame, strict: bool = False) -> DataFrame:
    """Customers with their balance class; the average stays a scalar subquery."""
    average = acctbal_average(customer).scalar()
    classed = customer.withColumn(
        "c_acctbal_class", acctbal_class(F.col("c_acctbal"), average)
    )
    return contract(classed, CLEAN_COLUMNS["customer"], strict)


def clean_supplier(supplier: DataFrame, strict: bool = False) -> DataFrame:
    return contract(supplier, CLEAN_COLUMNS["supplier"], strict)


def clean_nation(nation: DataFrame, strict: bool = False) -> DataFrame:
    return contract(nation, CLEAN_COLUMNS["nation"], strict)


def clean_region(region: DataFrame, strict: bool = False) -> DataFrame:
    return contract(region, CLEAN_COLUMNS["region"], strict)


def clean_part(part: DataFrame, strict: bool = False) -> DataFrame:
    return contract(part, CLEAN_COLUMNS["part"], strict)


def clean_partsupp(partsupp: DataFrame, strict: bool = False) -> DataFrame:
    with_id = partsupp.withColumn("ps_id", F.col("ps_suppkey"))
    return contract(with_id, CLEAN_COLUMNS["partsupp"], strict)


def clean_orders(orders: DataFrame, strict: bool = False) -> DataFrame:
    dated = orders.withColumns(
        {
            "o_year": order_year(F.col("o_orderdate")),
            "o_month": order_month(F.col("o_orderdate")),
        }
    )
    return contract(dated, CLEAN_COLUMNS["orders"], strict)


def clean_lineitem(
    lineitem: DataFrame, strict: bool = False, with_partkey: bool = False
) -> DataFrame:
    """Line items with their revenue.

    ``l_ps_id`` is the supplier key; sources in stock layout carry it under its own
    name. ``with_partkey`` appends the part key, which the contract leaves out.
    """
    derived = lineitem.withColumn(
        "l_revenue",
        revenue(F.col("l_extendedprice"), F.col("l_discount"), F.col("l_tax")),
    )
    if "l_ps_id" not in derived.columns:
        derived = derived.withColumn("l_ps_id", F.col("l_suppkey"))
    columns = CLEAN_COLUMNS["lineitem"] + (["l_partkey"] if with_partkey else [])
    return contract(derived, columns, strict)


BUILDERS = {
    "customer": clean_customer,
    "supplier": clean_supplier,
    "nation": clean_nation,
    "region": clean_region,
    "part": clean_part,
    "partsupp": clean_partsupp,
    "orders": clean_orders,
    "lineitem": clean_lineitem,
}


def clean_tables(
    raw: Callable[[str], DataFrame], strict: bool = False
) -> dict[str, DataFrame]:
    """All clean tables from the raw tables that ``raw`` gives by name."""
    return {table: build(raw(table), strict) for table, build in BUILDERS.items()}
