"""Star tables: one fact and three dimensions, all through full outer joins."""

from __future__ import annotations

from collections.abc import Callable
from functools import cache

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.functions import surrogate_key
from starmart.operators import contract, full_outer, prefix_rename
from starmart.schemas import STAR_COLUMNS


def fact_sales(
    orders: DataFrame,
    lineitem: DataFrame,
    strict: bool = False,
    with_partkey: bool = False,
) -> DataFrame:
    """Clean orders and line items joined on the order key, one row per line item.

    Orders without line items are kept, with a NULL surrogate key. The fact has no
    part key unless ``with_partkey`` appends one (from line items that carry it).
    """
    sales_order = prefix_rename(orders, "o_", "s_").withColumnRenamed(
        "s_comment", "s_o_comment"
    )
    sales_line = prefix_rename(lineitem, "l_", "s_").withColumnsRenamed(
        {"s_comment": "s_l_comment", "s_ps_id": "s_suppkey"}
    )
    joined = full_outer(sales_line, sales_order, "s_orderkey")
    sales = joined.withColumn(
        "s_orderkey_linenumber",
        surrogate_key(F.col("s_orderkey"), F.col("s_linenumber")),
    )
    columns = STAR_COLUMNS["fact_sales"] + (["s_partkey"] if with_partkey else [])
    return contract(sales, columns, strict)


def geography(nation: DataFrame, region: DataFrame) -> DataFrame:
    """Nations with their regions, under neutral names; shared by two dimensions."""
    nations = nation.withColumnsRenamed(
        {"n_nationkey": "nationkey", "n_regionkey": "regionkey"}
    )
    regions = region.withColumnsRenamed({"r_regionkey": "regionkey"})
    joined = full_outer(nations, regions, "regionkey")
    return contract(
        joined, ["nationkey", "n_name", "n_comment", "regionkey", "r_name", "r_comment"]
    )


def _with_geography(
    df: DataFrame, nation: DataFrame, region: DataFrame, prefix: str
) -> DataFrame:
    """Full outer join to the geography, whose columns take the dimension's prefix."""
    places = prefix_rename(geography(nation, region), "", prefix)
    return full_outer(df, places, f"{prefix}nationkey")


def dim_customer(
    customer: DataFrame, nation: DataFrame, region: DataFrame, strict: bool = False
) -> DataFrame:
    """Customers with nation and region; nations without customers are kept."""
    joined = _with_geography(customer, nation, region, "c_")
    return contract(joined, STAR_COLUMNS["dim_customer"], strict)


def dim_supplier(
    supplier: DataFrame, nation: DataFrame, region: DataFrame, strict: bool = False
) -> DataFrame:
    """Suppliers with nation and region; nations without suppliers are kept."""
    renamed = prefix_rename(supplier, "s_", "supp_")
    joined = _with_geography(renamed, nation, region, "supp_")
    return contract(joined, STAR_COLUMNS["dim_supplier"], strict)


def dim_part(
    part: DataFrame, partsupp: DataFrame, strict: bool = False
) -> DataFrame:
    """Parts with their suppliers; parts without supplier and the reverse are kept."""
    offers = partsupp.drop("ps_id").withColumnRenamed("ps_partkey", "p_partkey")
    joined = full_outer(offers, part, "p_partkey")
    keyed = joined.withColumn(
        "p_partkey_suppkey", surrogate_key(F.col("p_partkey"), F.col("ps_suppkey"))
    )
    return contract(keyed, STAR_COLUMNS["dim_part"], strict)


# Builder and inputs of every star table.
BUILDERS = {
    "fact_sales": (fact_sales, ("orders", "lineitem")),
    "dim_customer": (dim_customer, ("customer", "nation", "region")),
    "dim_supplier": (dim_supplier, ("supplier", "nation", "region")),
    "dim_part": (dim_part, ("part", "partsupp")),
}


def star_table(
    name: str, clean: Callable[[str], DataFrame], strict: bool = False
) -> DataFrame:
    """One star table from the clean tables that ``clean`` gives by name."""
    build, inputs = BUILDERS[name]
    return build(*[clean(table) for table in inputs], strict=strict)


def star_tables(
    clean: Callable[[str], DataFrame], strict: bool = False
) -> dict[str, DataFrame]:
    once = cache(clean)
    return {name: star_table(name, once, strict) for name in BUILDERS}
