"""Registered queries, each with the SQL that gives the same result.

Every query runs over the whole of the given tables. Queries over files (scan_*,
land_*, zone_*, job_*, sql_over_tables) first let Spark write those tables, or what
is built from them, to a fresh scratch folder and then read the files back.

The given tables have no partsupp; the distinct (part, supplier) pairs of the line
items stand in for it, with the two key columns only.
"""

from __future__ import annotations

import os
import sys
import uuid
import warnings
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from starmart import schemas  # noqa: E402
from starmart.functions import (  # noqa: E402
    acctbal_class,
    order_month,
    order_year,
    revenue,
    surrogate_key,
)
from starmart.operators import (  # noqa: E402
    contract,
    foreign_key_summary,
    foreign_key_violations,
    not_null_summary,
    not_null_violations,
    prefix_rename,
    primary_key_summary,
    primary_key_violations,
)
from starmart.plans import clean, jobs, marts, quality, star  # noqa: E402
from starmart.session import scratch_dir  # noqa: E402
from starmart.sources import (  # noqa: E402
    bucket_count,
    create_database,
    land_raw,
    publish,
    read_raw,
    read_tbl,
    read_zone,
    register_published,
    tbl_path,
    write_bucketed,
    write_tbl,
    write_zone,
)

try:  # The operators for training data are an optional part of the library.
    import corpus_pipeline
    from starmart.llm import queries as llm
except ImportError as missing:
    # Without them, or without a library that only they need, the rest works.
    if getattr(missing, "name", None) not in ("corpus_pipeline", "starmart.llm"):
        warnings.warn(f"no queries for training data: {missing}", stacklevel=2)
    llm = None

Query = Callable[[SparkSession, str], DataFrame]

FLAGSHIP_DIR = os.environ.get("STARMART_SF_DIR", "/root/testdata/sf0.001")
DATASET = "starmart"


# --- inputs ---------------------------------------------------------------------


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name == "partsupp":
        return (
            table(spark, sf_dir, "lineitem")
            .select(
                F.col("l_partkey").alias("ps_partkey"),
                F.col("l_suppkey").alias("ps_suppkey"),
            )
            .distinct()
        )
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def clean_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return clean.BUILDERS[name](table(spark, sf_dir, name))


def star_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return star.star_table(name, lambda t: clean_table(spark, sf_dir, t))


def star_zone(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return star.star_tables(lambda t: clean_table(spark, sf_dir, t))


# --- sources and sinks ----------------------------------------------------------


def scan(name: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        source = table(spark, sf_dir, name)
        path = tbl_path(scratch_dir(spark), name)
        write_tbl(source, path)
        return read_tbl(spark, path, source.schema)

    return query


def land_raw_nation(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = table(spark, sf_dir, "nation")
    scratch = scratch_dir(spark)
    path = tbl_path(scratch, "nation")
    write_tbl(source, path)
    landed = land_raw(spark, path, f"{scratch}/raw", "nation")
    return read_tbl(spark, landed, source.schema)


def zone_clean_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    zone = scratch_dir(spark)
    write_zone(clean_table(spark, sf_dir, "orders"), zone, "orders")
    return read_zone(spark, zone, "orders")


def zone_fact_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    zone = scratch_dir(spark)
    fact = star_table(spark, sf_dir, "fact_sales")
    write_zone(fact, zone, "fact_sales", jobs.PARTITIONS["fact_sales"])
    return read_zone(spark, zone, "fact_sales")


def raw_folder(spark: SparkSession, sf_dir: str) -> str:
    """The given tables as text files of the fixed layouts; absent columns are empty."""
    folder = scratch_dir(spark)
    for name in schemas.TABLES:
        source = table(spark, sf_dir, name)
        fields = [
            (F.col(f.name) if f.name in source.columns else F.lit(None))
            .cast(f.dataType)
            .alias(f.name)
            for f in schemas.raw_schema(name)
        ]
        write_tbl(source.select(fields), tbl_path(folder, name), jobs.RAW_COMPRESSION)
    return folder


def without_zone(df: DataFrame) -> DataFrame:
    """Timestamps as the wall-clock times that the files hold."""
    return df.select(
        [
            F.col(name).cast("timestamp_ntz").alias(name) if kind == "timestamp" else name
            for name, kind in df.dtypes
        ]
    )


def land_raw_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    source, raw = raw_folder(spark, sf_dir), scratch_dir(spark)
    land_raw(spark, tbl_path(source, "lineitem"), raw, "lineitem")
    return without_zone(read_raw(spark, raw, "lineitem"))


def job_clean_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    clean_zone = scratch_dir(spark)
    jobs.run_clean(spark, raw_folder(spark, sf_dir), clean_zone)
    return without_zone(read_zone(spark, clean_zone, "orders", strict=True))


def job_all_fact_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Land, clean, star and register; then the fact as a reader of the tables sees it."""
    scratch = scratch_dir(spark)
    database = f"starmart_{uuid.uuid4().hex}"
    jobs.run_land(spark, raw_folder(spark, sf_dir), f"{scratch}/raw")
    zones = [f"{scratch}/{zone}" for zone in ("raw", "clean", "star")]
    jobs.run_all(spark, *zones, database, location=f"{scratch}/db", on_fail="return")
    return without_zone(spark.table(f"{database}.fact_sales"))


def land_raw_line_ends(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines with carriage returns inside and at their end, as landing leaves them."""
    scratch = scratch_dir(spark)
    line = F.concat_ws(
        "|", "o_orderkey", F.lit("in\rside"), F.concat("o_orderpriority", F.lit("\r"))
    )
    lines = table(spark, sf_dir, "orders").select(line.alias("value"))
    path = tbl_path(scratch, "orders")
    lines.write.option("lineSep", "\n").text(path)
    landed = land_raw(spark, path, f"{scratch}/raw", "orders")
    return spark.read.option("lineSep", "\n").text(landed)


def broken_orders(spark: SparkSession, sf_dir: str) -> str:
    """The raw tables; of the orders, some keys do not parse and some lines end early."""
    folder = raw_folder(spark, sf_dir)
    path = tbl_path(folder, "orders")
    line, key = F.col("value"), F.split("value", "[|]")[0].cast("long")
    broken = (
        F.when(key % 11 == 0, F.concat(F.lit("x"), line))
        .when(key % 13 == 0, F.substring_index(line, "|", 2))
        .otherwise(line)
    )
    broken_path = f"{folder}/broken"
    spark.read.text(path).select(broken.alias("value")).write.text(broken_path)
    spark.read.text(broken_path).write.mode("overwrite").text(path)
    return folder


def job_clean_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the clean job rejects of broken orders, and the clean rows of the same."""
    scratch = scratch_dir(spark)
    clean_zone, rejects = f"{scratch}/clean", f"{scratch}/rejects"
    jobs.run_clean(spark, broken_orders(spark, sf_dir), clean_zone, rejects=rejects)
    rejected = spark.read.parquet(f"{rejects}/orders").select(
        F.lit("reject").alias("kind"),
        "o_orderkey",
        "o_custkey",
        F.substring_index("rejected_line", "|", 2).alias("line_start"),
    )
    kept = (
        read_zone(spark, clean_zone, "orders", strict=True)
        .where("o_orderkey IS NULL OR o_orderstatus IS NULL")
        .select(
            F.lit("clean").alias("kind"),
            "o_orderkey",
            "o_custkey",
            F.lit(None).cast("string").alias("line_start"),
        )
    )
    return rejected.unionAll(kept)


def star_write_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Key counters that the writing of the star zone left, without reading it again."""
    scratch = scratch_dir(spark)
    tables = clean.clean_tables(lambda t: table(spark, sf_dir, t))
    jobs.write_tables(tables, f"{scratch}/clean")
    return jobs.run_star_counted(spark, f"{scratch}/clean", f"{scratch}/star", strict=False)


def published_fact_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact as a reader of the views sees it after two refreshes and a failed third."""
    scratch = scratch_dir(spark)
    database = f"starmart_{uuid.uuid4().hex}"
    zones = [f"{scratch}/clean", f"{scratch}/star"]
    tables = clean.clean_tables(lambda t: table(spark, sf_dir, t))
    half = tables | {"lineitem": tables["lineitem"].where("l_orderkey % 2 = 0")}
    for version in (half, tables):
        jobs.write_tables(version, zones[0])
        jobs.run_publish(spark, *zones, database, f"{scratch}/db", strict=False)
    doubled = star_zone(spark, sf_dir)
    doubled["dim_customer"] = twice(doubled["dim_customer"])

    def audit(written) -> None:
        alerts = quality.alert_summary(quality.alert_rows(written))
        quality.gate(alerts, database).collect()

    try:
        publish(spark, zones[1], doubled, jobs.PARTITIONS, audit)
    except Exception as failed:
        if "Duplicate customer primary key" not in str(failed):
            raise
    register_published(spark, zones[1], database)
    return spark.table(f"{database}.fact_sales")


BUCKETS = 8  # At least.


def fact_sales_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact from orders and line items that are stored in buckets by order key."""
    scratch = scratch_dir(spark)
    database = f"starmart_{uuid.uuid4().hex}"
    create_database(spark, database, f"{scratch}/db")
    keys, stored = {"orders": "o_orderkey", "lineitem": "l_orderkey"}, []
    buckets = bucket_count(spark, [f"{sf_dir}/{name}.parquet" for name in keys], BUCKETS)
    for name, key in keys.items():
        df = clean_table(spark, sf_dir, name)
        path = f"{scratch}/{name}"
        stored.append(spark.table(write_bucketed(df, database, name, path, key, buckets)))
    return star.fact_sales(*stored)


def job_constraints(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = f"{scratch_dir(spark)}/constraints"
    return jobs.run_constraints(spark, raw_folder(spark, sf_dir), report)


def published_database(spark: SparkSession, sf_dir: str) -> str:
    """Clean zone, star zone and registered tables from the given tables.

    The database stays in the session's catalog, like its files in the scratch folder,
    because the caller's DataFrame reads from it; DROP DATABASE ... CASCADE removes it.
    """
    scratch = scratch_dir(spark)
    database = f"starmart_{uuid.uuid4().hex}"
    tables = clean.clean_tables(lambda t: table(spark, sf_dir, t))
    jobs.write_tables(tables, f"{scratch}/clean")
    jobs.run_star(spark, f"{scratch}/clean", f"{scratch}/star", strict=False)
    jobs.run_register(spark, f"{scratch}/star", database, f"{scratch}/db")
    return database


def sql_over_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    database = published_database(spark, sf_dir)
    return spark.sql(marts.REVENUE_BY_REGION_YEAR_SQL.format(database=database))


def job_quality_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jobs.run_quality(spark, published_database(spark, sf_dir))


# --- expressions ----------------------------------------------------------------


def customer_acctbal_avg(spark: SparkSession, sf_dir: str) -> DataFrame:
    average = clean.acctbal_average(table(spark, sf_dir, "customer"))
    return average.select(F.round("avg_acctbal", 2).alias("avg_acctbal"))


def customer_acctbal_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer")
    average = clean.acctbal_average(customer).scalar()
    return customer.select(
        "c_custkey",
        acctbal_class(F.col("c_acctbal"), average).alias("c_acctbal_class"),
    )


def orders_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    ts = F.col("o_orderdate")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", order_year(ts).alias("o_year"), order_month(ts).alias("o_month")
    )


def lineitem_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    value = revenue(F.col("l_extendedprice"), F.col("l_discount"), F.col("l_tax"))
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", value.alias("l_revenue")
    )


def sales_surrogate_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        surrogate_key(F.col("l_orderkey"), F.col("l_linenumber")).alias(
            "s_orderkey_linenumber"
        ),
    )


def part_surrogate_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "partsupp").select(
        "ps_partkey",
        "ps_suppkey",
        surrogate_key(F.col("ps_partkey"), F.col("ps_suppkey")).alias(
            "p_partkey_suppkey"
        ),
    )


def dim_geography(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.geography(
        clean_table(spark, sf_dir, "nation"), clean_table(spark, sf_dir, "region")
    )


def renamed_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_rename(table(spark, sf_dir, "orders"), "o_", "s_")


# --- quality report -------------------------------------------------------------


def dq_checks(name: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        key, unique = next((k, u) for t, k, u, _ in quality.SUBJECTS if t == name)
        return quality.key_checks(star_table(spark, sf_dir, name), key, unique)

    return query


def dq_alert_rows(nulls: str) -> Query:
    return lambda spark, sf_dir: quality.alert_rows(star_zone(spark, sf_dir), nulls)


def dq_alert_summary(nulls: str) -> Query:
    return lambda spark, sf_dir: quality.alert_summary(
        quality.alert_rows(star_zone(spark, sf_dir), nulls)
    )


def dq_gate(nulls: str, on_fail: str) -> Query:
    return lambda spark, sf_dir: quality.gate(
        dq_alert_summary(nulls)(spark, sf_dir), DATASET, on_fail
    )


# --- constraint checks ----------------------------------------------------------


def check_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = []
    for name in schemas.TABLES:
        df = table(spark, sf_dir, name)
        columns = contract(df, schemas.NOT_NULL[name]).columns
        parts.append(not_null_summary(df, name, columns))
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def check_primary_key(name: str) -> Query:
    return lambda spark, sf_dir: primary_key_summary(
        table(spark, sf_dir, name), name, schemas.PRIMARY_KEYS[name]
    )


def pk_violations_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return primary_key_violations(
        table(spark, sf_dir, "lineitem"), schemas.PRIMARY_KEYS["lineitem"]
    )


def check_foreign_key(
    child: str, child_key: list[str], parent: str, parent_key: list[str]
) -> Query:
    return lambda spark, sf_dir: foreign_key_summary(
        table(spark, sf_dir, child),
        child,
        child_key,
        table(spark, sf_dir, parent),
        parent,
        parent_key,
    )


def fk_violations_orders_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders without line items, as rows."""
    orders, lines = (table(spark, sf_dir, t) for t in ("orders", "lineitem"))
    return foreign_key_violations(orders, ["o_orderkey"], lines, ["l_orderkey"])


def offers_with_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stand-in partsupp without a fifth of its pairs."""
    offers = table(spark, sf_dir, "partsupp")
    return offers.where((F.col("ps_partkey") + F.col("ps_suppkey")) % 5 != 0)


def check_fk_lineitem_partsupp(spark: SparkSession, sf_dir: str) -> DataFrame:
    return foreign_key_summary(
        table(spark, sf_dir, "lineitem"),
        "lineitem",
        ["l_partkey", "l_suppkey"],
        offers_with_gaps(spark, sf_dir),
        "partsupp",
        ["ps_partkey", "ps_suppkey"],
    )


def with_null_keys(df: DataFrame, key: str) -> DataFrame:
    """NULL in place of every key that seven divides."""
    return df.withColumn(key, F.when(F.col(key) % 7 != 0, F.col(key)))


def fact_sales_null_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact with NULL join keys on both sides: they match nothing and survive."""
    return star.fact_sales(
        with_null_keys(clean_table(spark, sf_dir, "orders"), "o_orderkey"),
        with_null_keys(clean_table(spark, sf_dir, "lineitem"), "l_orderkey"),
    )


def not_null_violations_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = with_null_keys(table(spark, sf_dir, "orders"), "o_custkey")
    return not_null_violations(orders, ["o_orderkey", "o_custkey", "o_orderdate"])


def twice(df: DataFrame) -> DataFrame:
    return df.unionAll(df)


def check_pk_customer_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    doubled = twice(table(spark, sf_dir, "customer"))
    return primary_key_summary(doubled, "customer", ["c_custkey"])


def dq_alert_rows_broken(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report over customers that are there twice and a supplier table of no rows."""
    tables = star_zone(spark, sf_dir)
    tables["dim_customer"] = twice(tables["dim_customer"])
    tables["dim_supplier"] = tables["dim_supplier"].where("supp_suppkey < 0")
    return quality.alert_rows(tables, "corrected")


# The composite key to the stand-in partsupp would hold by construction; it is checked
# against one with gaps.
CHECKED_FOREIGN_KEYS = [fk for fk in schemas.FOREIGN_KEYS if len(fk[1]) == 1]
CHECKED_PRIMARY_KEYS = [t for t in schemas.PRIMARY_KEYS if t != "partsupp"]


# --- marts ----------------------------------------------------------------------


def mart_revenue_by_region_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.revenue_by_region_year(
        star_table(spark, sf_dir, "fact_sales"),
        star_table(spark, sf_dir, "dim_customer"),
    )


def mart_revenue_by_supplier_nation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.revenue_by_supplier_nation(
        star_table(spark, sf_dir, "fact_sales"),
        star_table(spark, sf_dir, "dim_supplier"),
    )


def mart_orders_by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.orders_by_month(
        clean_table(spark, sf_dir, "orders"), clean_table(spark, sf_dir, "lineitem")
    )


def of_fact_and(dimension: str, mart: Callable[[DataFrame, DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: mart(
        star_table(spark, sf_dir, "fact_sales"), star_table(spark, sf_dir, dimension)
    )


def of_orders(mart: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: mart(clean_table(spark, sf_dir, "orders"))


def stored(spark: SparkSession, sketches: DataFrame) -> DataFrame:
    """Sketches as a later job finds them: in a zone, without the rows they are of."""
    path = f"{scratch_dir(spark)}/sketches"
    sketches.write.parquet(path)
    return spark.read.parquet(path)


def sketch_customers_by_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = clean_table(spark, sf_dir, "orders")
    sketches = stored(spark, marts.customer_sketches(orders))
    return marts.customers_by_year_checked(orders, sketches)


def sketch_order_value_quantiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = clean_table(spark, sf_dir, "orders")
    customer = star_table(spark, sf_dir, "dim_customer")
    sketches = stored(spark, marts.order_value_sketches(orders, customer))
    return marts.order_value_quantiles_checked(orders, customer, sketches)


def mart_balance_class_by_segment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.balance_class_by_segment(clean_table(spark, sf_dir, "customer"))


# --- contract -------------------------------------------------------------------


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: revenue by customer region and order year over the star."""
    return mart_revenue_by_region_year(spark, FLAGSHIP_DIR)


def queries() -> dict[str, Query]:
    registered: dict[str, Query] = {
        f"scan_{name}": scan(name) for name in schemas.TABLES
    }
    registered |= {
        "land_raw_nation": land_raw_nation,
        "zone_clean_orders": zone_clean_orders,
        "zone_fact_sales": zone_fact_sales,
        "sql_over_tables": sql_over_tables,
        "customer_acctbal_avg": customer_acctbal_avg,
        "customer_acctbal_class": customer_acctbal_class,
        "orders_calendar": orders_calendar,
        "lineitem_revenue": lineitem_revenue,
        "sales_surrogate_key": sales_surrogate_key,
        "part_surrogate_key": part_surrogate_key,
        "prefix_rename": renamed_orders,
        "dim_geography": dim_geography,
    }
    registered |= {
        f"clean_{name}": (lambda spark, sf_dir, n=name: clean_table(spark, sf_dir, n))
        for name in schemas.TABLES
    }
    registered |= {
        name: (lambda spark, sf_dir, n=name: star_table(spark, sf_dir, n))
        for name in schemas.STAR_TABLES
    }
    registered |= {
        "dq_sales_checks": dq_checks("fact_sales"),
        "dq_customer_checks": dq_checks("dim_customer"),
        "dq_supplier_checks": dq_checks("dim_supplier"),
        "dq_part_checks": dq_checks("dim_part"),
        "dq_alert_rows": dq_alert_rows("literal"),
        "dq_alert_rows_corrected": dq_alert_rows("corrected"),
        "dq_alert_summary": dq_alert_summary("literal"),
        "dq_alert_summary_corrected": dq_alert_summary("corrected"),
        "dq_gate": dq_gate("literal", "raise"),
        "dq_gate_corrected": dq_gate("corrected", "return"),
        "job_quality_report": job_quality_report,
        "check_not_null": check_not_null,
        "pk_violations_lineitem": pk_violations_lineitem,
        "land_raw_lineitem": land_raw_lineitem,
        "job_clean_orders": job_clean_orders,
        "job_all_fact_sales": job_all_fact_sales,
        "job_constraints": job_constraints,
        "land_raw_line_ends": land_raw_line_ends,
        "job_clean_rejects": job_clean_rejects,
        "star_write_counters": star_write_counters,
        "published_fact_sales": published_fact_sales,
        "fact_sales_bucketed": fact_sales_bucketed,
        "fact_sales_null_keys": fact_sales_null_keys,
        "dq_alert_rows_broken": dq_alert_rows_broken,
        "not_null_violations_orders": not_null_violations_orders,
        "check_pk_customer_twice": check_pk_customer_twice,
        "check_fk_orders_lineitem": check_foreign_key(
            "orders", ["o_orderkey"], "lineitem", ["l_orderkey"]
        ),
        "fk_violations_orders_lineitem": fk_violations_orders_lineitem,
        "check_fk_lineitem_partsupp": check_fk_lineitem_partsupp,
    }
    registered |= {
        f"check_pk_{name}": check_primary_key(name) for name in CHECKED_PRIMARY_KEYS
    }
    registered |= {
        f"check_fk_{child}_{parent}": check_foreign_key(
            child, child_key, parent, parent_key
        )
        for child, child_key, parent, parent_key in CHECKED_FOREIGN_KEYS
    }
    registered |= {
        "mart_revenue_by_region_year": mart_revenue_by_region_year,
        "mart_revenue_by_supplier_nation": mart_revenue_by_supplier_nation,
        "mart_orders_by_month": mart_orders_by_month,
        "mart_balance_class_by_segment": mart_balance_class_by_segment,
        "mart_sales_hierarchy": of_fact_and("dim_customer", marts.sales_hierarchy),
        "mart_best_suppliers": of_fact_and("dim_supplier", marts.best_suppliers),
        "mart_revenue_trend": of_fact_and("dim_customer", marts.revenue_trend),
        "mart_cohort_retention": of_orders(marts.cohort_retention),
        "mart_order_sessions": of_orders(marts.order_sessions),
        "sketch_customers_by_year": sketch_customers_by_year,
        "sketch_order_value_quantiles": sketch_order_value_quantiles,
    }
    if llm:
        registered |= {**llm.QUERIES, "pipeline": corpus_pipeline.run}
    return registered


# --- the same results in SQL ----------------------------------------------------
#
# Table and column names, texts and keys are fixed values of the contract; they are
# written out here, and nothing is taken from the library's own lists.

PARTSUPP = """
    SELECT DISTINCT l_partkey AS ps_partkey, l_suppkey AS ps_suppkey FROM lineitem
"""

CLEAN_SQL = {
    "customer": """
        SELECT *,
               CASE WHEN c_acctbal < 0 THEN 'negative'
                    WHEN c_acctbal < (SELECT avg(c_acctbal) FROM customer)
                    THEN 'below_average'
                    ELSE 'above_average' END AS c_acctbal_class
        FROM customer
    """,
    "supplier": "SELECT * FROM supplier",
    "nation": "SELECT * FROM nation",
    "region": "SELECT * FROM region",
    "part": "SELECT * FROM part",
    "partsupp": f"SELECT ps_suppkey AS ps_id, ps_partkey, ps_suppkey FROM ({PARTSUPP})",
    "orders": """
        SELECT *,
               CAST(year(o_orderdate) AS INTEGER) AS o_year,
               strftime(o_orderdate, '%b') AS o_month
        FROM orders
    """,
    "lineitem": """
        SELECT l_orderkey, l_suppkey AS l_ps_id, l_linenumber, l_quantity,
               l_extendedprice, l_discount, l_tax,
               l_extendedprice - l_discount - l_tax AS l_revenue,
               l_returnflag, l_linestatus, l_shipdate
        FROM lineitem
    """,
}

GEOGRAPHY_SQL = """
    SELECT n_nationkey AS nationkey, n_name,
           coalesce(n_regionkey, r_regionkey) AS regionkey, r_name
    FROM nation FULL JOIN region ON n_regionkey = r_regionkey
"""

STAR_SQL = {
    "fact_sales": f"""
        SELECT coalesce(o_orderkey, l_orderkey)::VARCHAR || l_linenumber::VARCHAR
                   AS s_orderkey_linenumber,
               coalesce(o_orderkey, l_orderkey) AS s_orderkey, o_custkey AS s_custkey,
               l_ps_id AS s_suppkey, o_orderstatus AS s_orderstatus,
               o_totalprice AS s_totalprice, o_orderdate AS s_orderdate,
               o_year AS s_year, o_month AS s_month,
               o_orderpriority AS s_orderpriority, l_linenumber AS s_linenumber,
               l_quantity AS s_quantity, l_extendedprice AS s_extendedprice,
               l_discount AS s_discount, l_tax AS s_tax, l_revenue AS s_revenue,
               l_returnflag AS s_returnflag, l_linestatus AS s_linestatus,
               l_shipdate AS s_shipdate
        FROM ({CLEAN_SQL["orders"]}) FULL JOIN ({CLEAN_SQL["lineitem"]})
          ON o_orderkey = l_orderkey
    """,
    "dim_customer": f"""
        SELECT c_custkey, c_name, c_acctbal, c_mktsegment,
               coalesce(c_nationkey, nationkey) AS c_nationkey, n_name AS c_n_name,
               regionkey AS c_regionkey, r_name AS c_r_name
        FROM customer FULL JOIN ({GEOGRAPHY_SQL}) ON c_nationkey = nationkey
    """,
    "dim_supplier": f"""
        SELECT s_suppkey AS supp_suppkey, s_name AS supp_name,
               s_acctbal AS supp_acctbal,
               coalesce(s_nationkey, nationkey) AS supp_nationkey,
               n_name AS supp_n_name, regionkey AS supp_regionkey,
               r_name AS supp_r_name
        FROM supplier FULL JOIN ({GEOGRAPHY_SQL}) ON s_nationkey = nationkey
    """,
    "dim_part": f"""
        SELECT coalesce(p_partkey, ps_partkey)::VARCHAR || ps_suppkey::VARCHAR
                   AS p_partkey_suppkey,
               coalesce(p_partkey, ps_partkey) AS p_partkey, p_name, p_brand, p_type,
               p_size, p_retailprice, ps_suppkey
        FROM part FULL JOIN ({PARTSUPP}) ON p_partkey = ps_partkey
    """,
}


def dq_checks_sql(source: str, key: str, unique: bool) -> str:
    distinct = f"count(DISTINCT {key}) AS {key}_unique," if unique else ""
    return f"""
        SELECT count({key}) AS {key}_count, {distinct}
               count(DISTINCT CASE WHEN {key} IS NULL THEN {key} END) AS {key}_null,
               count(*) FILTER (WHERE {key} IS NULL) AS {key}_null_rows
        FROM ({source})
    """


# What the report checks, written out; the library has its own list.
DQ_CHECKS_SQL = {
    "dq_sales_checks": dq_checks_sql(
        STAR_SQL["fact_sales"], "s_orderkey_linenumber", False
    ),
    "dq_customer_checks": dq_checks_sql(STAR_SQL["dim_customer"], "c_custkey", True),
    "dq_supplier_checks": dq_checks_sql(STAR_SQL["dim_supplier"], "supp_suppkey", True),
    "dq_part_checks": dq_checks_sql(STAR_SQL["dim_part"], "p_partkey_suppkey", False),
}


def dq_alert_rows_sql(null: str, checks: dict[str, str] = DQ_CHECKS_SQL) -> str:
    return f"""
        WITH sales AS ({checks["dq_sales_checks"]}),
             customer_keys AS ({checks["dq_customer_checks"]}),
             supplier_keys AS ({checks["dq_supplier_checks"]}),
             part_keys AS ({checks["dq_part_checks"]})
        SELECT 1 AS check_no,
               CASE WHEN s_orderkey_linenumber_count = 0
                    THEN 'Sales data missing; ' END AS alerts
        FROM sales
        UNION ALL
        SELECT 2, CASE WHEN s_orderkey_linenumber_{null} != 0
                       THEN s_orderkey_linenumber_{null}::VARCHAR
                            || ' NULL sales primary key found' END
        FROM sales
        UNION ALL
        SELECT 3, CASE WHEN c_custkey_count = 0 THEN 'Customer data missing; ' END
        FROM customer_keys
        UNION ALL
        SELECT 4, CASE WHEN c_custkey_count != c_custkey_unique
                       THEN 'Duplicate customer primary key found; ' END
        FROM customer_keys
        UNION ALL
        SELECT 5, CASE WHEN c_custkey_{null} != 0
                       THEN c_custkey_{null}::VARCHAR
                            || ' NULL customer primary key found' END
        FROM customer_keys
        UNION ALL
        SELECT 6, CASE WHEN supp_suppkey_count = 0 THEN 'Supplier data missing; ' END
        FROM supplier_keys
        UNION ALL
        SELECT 7, CASE WHEN supp_suppkey_count != supp_suppkey_unique
                       THEN 'Duplicate supplier primary key found; ' END
        FROM supplier_keys
        UNION ALL
        SELECT 8, CASE WHEN supp_suppkey_{null} != 0
                       THEN supp_suppkey_{null}::VARCHAR
                            || ' NULL supplier primary key found' END
        FROM supplier_keys
        UNION ALL
        SELECT 9, CASE WHEN p_partkey_suppkey_count = 0
                       THEN 'Part data missing; ' END
        FROM part_keys
        UNION ALL
        SELECT 10, CASE WHEN p_partkey_suppkey_{null} != 0
                        THEN p_partkey_suppkey_{null}::VARCHAR
                             || ' NULL part primary key found' END
        FROM part_keys
    """


BROKEN_CHECKS_SQL = DQ_CHECKS_SQL | {
    "dq_customer_checks": dq_checks_sql(
        f"FROM ({STAR_SQL['dim_customer']}) UNION ALL FROM ({STAR_SQL['dim_customer']})",
        "c_custkey",
        True,
    ),
    "dq_supplier_checks": dq_checks_sql(
        f"FROM ({STAR_SQL['dim_supplier']}) WHERE supp_suppkey < 0", "supp_suppkey", True
    ),
}


def dq_alert_summary_sql(null_suffix: str) -> str:
    return f"""
        SELECT string_agg(alerts, '.; ' ORDER BY check_no) AS stringify_alert_list,
               CAST(nullif(count(alerts), 0) AS INTEGER) AS issues_found
        FROM ({dq_alert_rows_sql(null_suffix)})
    """


def dq_gate_sql(null_suffix: str, dataset: str) -> str:
    return f"""
        SELECT issues_found,
               CASE WHEN issues_found IS NULL THEN 'all good'
                    ELSE 'ATTENTION: {dataset}. has potential data quality issues '
                         || 'for yesterday: ' || stringify_alert_list
                         || '. for more info.' END AS status
        FROM ({dq_alert_summary_sql(null_suffix)})
    """


# The columns that must not be NULL, those that the given tables have and
# those that they lack.
GIVEN_COLUMNS = {
    "customer": ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"],
    "supplier": ["s_suppkey", "s_name", "s_nationkey", "s_acctbal"],
    "nation": ["n_nationkey", "n_name", "n_regionkey"],
    "region": ["r_regionkey", "r_name"],
    "part": ["p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"],
    "partsupp": ["ps_partkey", "ps_suppkey"],
    "orders": [
        "o_orderkey",
        "o_custkey",
        "o_orderstatus",
        "o_totalprice",
        "o_orderdate",
        "o_orderpriority",
    ],
    "lineitem": [
        "l_orderkey",
        "l_partkey",
        "l_suppkey",
        "l_linenumber",
        "l_quantity",
        "l_extendedprice",
        "l_discount",
        "l_tax",
        "l_returnflag",
        "l_linestatus",
        "l_shipdate",
    ],
}
ABSENT_COLUMNS = {
    "customer": ["c_address", "c_phone", "c_comment"],
    "supplier": ["s_address", "s_phone", "s_comment"],
    "part": ["p_mfgr", "p_container", "p_comment"],
    "partsupp": ["ps_availqty", "ps_supplycost", "ps_comment"],
    "orders": ["o_clerk", "o_shippriority", "o_comment"],
    "lineitem": [
        "l_commitdate",
        "l_receiptdate",
        "l_shipinstruct",
        "l_shipmode",
        "l_comment",
    ],
}
PRIMARY_KEYS_SQL = {
    "nation": "n_nationkey",
    "region": "r_regionkey",
    "part": "p_partkey",
    "supplier": "s_suppkey",
    "partsupp": "ps_partkey, ps_suppkey",
    "customer": "c_custkey",
    "orders": "o_orderkey",
    "lineitem": "l_orderkey, l_linenumber",
}
FOREIGN_KEYS_SQL = [
    ("nation", "n_regionkey", "region", "r_regionkey"),
    ("supplier", "s_nationkey", "nation", "n_nationkey"),
    ("partsupp", "ps_suppkey", "supplier", "s_suppkey"),
    ("partsupp", "ps_partkey", "part", "p_partkey"),
    ("customer", "c_nationkey", "nation", "n_nationkey"),
    ("orders", "o_custkey", "customer", "c_custkey"),
    ("lineitem", "l_orderkey", "orders", "o_orderkey"),
]


def given(name: str) -> str:
    return f"({PARTSUPP})" if name == "partsupp" else name


def check_not_null_sql() -> str:
    return " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, 'not_null({column})' AS check_name, "
        f"count(*) FILTER (WHERE {column} IS NULL) AS violations FROM {given(name)}"
        for name, columns in GIVEN_COLUMNS.items()
        for column in columns
    )


def pk_violations_sql(name: str, source: str | None = None) -> str:
    key = PRIMARY_KEYS_SQL[name]
    not_null = " AND ".join(f"{k} IS NOT NULL" for k in key.split(", "))
    return (
        f"SELECT {key}, count(*) AS n_rows FROM {source or given(name)} "
        f"WHERE {not_null} GROUP BY {key} HAVING count(*) > 1"
    )


def check_pk_sql(name: str, source: str | None = None) -> str:
    return (
        f"SELECT '{name}' AS table_name, "
        f"'primary_key({PRIMARY_KEYS_SQL[name]})' AS check_name, "
        f"count(*) AS violations FROM ({pk_violations_sql(name, source)})"
    )


def check_fk_sql(child: str, child_key: str, parent: str, parent_key: str) -> str:
    return (
        f"SELECT '{child}' AS table_name, "
        f"'foreign_key({child_key} -> {parent})' AS check_name, "
        f"count(*) AS violations FROM {given(child)} c "
        f"WHERE c.{child_key} IS NOT NULL AND NOT EXISTS "
        f"(SELECT 1 FROM {given(parent)} p WHERE p.{parent_key} = c.{child_key})"
    )


def check_offers_sql(offers: str) -> str:
    return f"""
        SELECT 'lineitem' AS table_name,
               'foreign_key(l_partkey, l_suppkey -> partsupp)' AS check_name,
               count(*) AS violations
        FROM lineitem ANTI JOIN {offers}
          ON l_partkey = ps_partkey AND l_suppkey = ps_suppkey
        WHERE l_partkey IS NOT NULL AND l_suppkey IS NOT NULL
    """


def job_constraints_sql() -> str:
    # Columns that the given tables lack are empty fields in every line of text.
    absent = [
        f"SELECT '{name}' AS table_name, 'not_null({column})' AS check_name, "
        f"count(*) AS violations FROM {given(name)}"
        for name, columns in ABSENT_COLUMNS.items()
        for column in columns
    ]
    offers = check_offers_sql(f"({PARTSUPP})")
    return " UNION ALL ".join(
        [
            check_not_null_sql(),
            *absent,
            *[check_pk_sql(name) for name in PRIMARY_KEYS_SQL],
            *[check_fk_sql(*key) for key in FOREIGN_KEYS_SQL],
            offers,
        ]
    )


RAW_ORDERS_SQL = """
    SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate,
           CAST(year(o_orderdate) AS INTEGER) AS o_year,
           strftime(o_orderdate, '%b') AS o_month, o_orderpriority,
           CAST(NULL AS VARCHAR) AS o_clerk, CAST(NULL AS INTEGER) AS o_shippriority,
           CAST(NULL AS VARCHAR) AS o_comment
    FROM orders
"""
RAW_LINEITEM_SQL = """
    SELECT l_orderkey, l_partkey, l_suppkey,
           CAST(l_linenumber AS BIGINT) AS l_linenumber,
           CAST(l_quantity AS INTEGER) AS l_quantity, l_extendedprice, l_discount,
           l_tax, l_returnflag, l_linestatus, l_shipdate,
           CAST(NULL AS TIMESTAMP) AS l_commitdate,
           CAST(NULL AS TIMESTAMP) AS l_receiptdate,
           CAST(NULL AS VARCHAR) AS l_shipinstruct, CAST(NULL AS VARCHAR) AS l_shipmode,
           CAST(NULL AS VARCHAR) AS l_comment, l_orderkey AS l_id
    FROM lineitem
"""
JOB_FACT_SALES_SQL = f"""
    SELECT coalesce(o_orderkey, l_orderkey)::VARCHAR || l_linenumber::VARCHAR
               AS s_orderkey_linenumber,
           coalesce(o_orderkey, l_orderkey) AS s_orderkey, o_custkey AS s_custkey,
           l_suppkey AS s_suppkey, o_orderstatus AS s_orderstatus,
           o_totalprice AS s_totalprice, o_orderdate AS s_orderdate, o_year AS s_year,
           o_month AS s_month, o_orderpriority AS s_orderpriority, o_clerk AS s_clerk,
           o_shippriority AS s_shippriority, o_comment AS s_o_comment, l_id AS s_id,
           l_linenumber AS s_linenumber, l_quantity AS s_quantity,
           l_extendedprice AS s_extendedprice, l_discount AS s_discount, l_tax AS s_tax,
           l_extendedprice - l_discount - l_tax AS s_revenue,
           l_returnflag AS s_returnflag, l_linestatus AS s_linestatus,
           l_commitdate AS s_commitdate, l_shipdate AS s_shipdate,
           l_receiptdate AS s_receiptdate, l_shipinstruct AS s_shipinstruct,
           l_shipmode AS s_shipmode, l_comment AS s_l_comment
    FROM ({RAW_ORDERS_SQL}) FULL JOIN ({RAW_LINEITEM_SQL}) ON o_orderkey = l_orderkey
"""
NULL_KEYS_SQL = f"""
    WITH o AS (SELECT * REPLACE (CASE WHEN o_orderkey % 7 != 0 THEN o_orderkey END
                                 AS o_orderkey) FROM ({CLEAN_SQL["orders"]})),
         l AS (SELECT * REPLACE (CASE WHEN l_orderkey % 7 != 0 THEN l_orderkey END
                                 AS l_orderkey) FROM ({CLEAN_SQL["lineitem"]}))
    SELECT coalesce(o_orderkey, l_orderkey)::VARCHAR || l_linenumber::VARCHAR
               AS s_orderkey_linenumber,
           coalesce(o_orderkey, l_orderkey) AS s_orderkey, o_custkey AS s_custkey,
           l_ps_id AS s_suppkey, o_orderstatus AS s_orderstatus,
           o_totalprice AS s_totalprice, o_orderdate AS s_orderdate, o_year AS s_year,
           o_month AS s_month, o_orderpriority AS s_orderpriority,
           l_linenumber AS s_linenumber, l_quantity AS s_quantity,
           l_extendedprice AS s_extendedprice, l_discount AS s_discount, l_tax AS s_tax,
           l_revenue AS s_revenue, l_returnflag AS s_returnflag,
           l_linestatus AS s_linestatus, l_shipdate AS s_shipdate
    FROM o FULL JOIN l ON o_orderkey = l_orderkey
"""


REVENUE_BY_REGION_YEAR_SQL = f"""
    SELECT c_r_name, s_year, round(sum(s_revenue), 2) AS revenue,
           CAST(count(s_linenumber) AS BIGINT) AS n_lines
    FROM ({STAR_SQL["fact_sales"]}) JOIN ({STAR_SQL["dim_customer"]})
      ON s_custkey = c_custkey
    GROUP BY c_r_name, s_year
"""


def oracle_sql() -> dict[str, str]:
    sql = {
        f"scan_{name}": f"SELECT * FROM {given(name)}" for name in schemas.TABLES
    }
    sql |= {
        "land_raw_nation": "SELECT * FROM nation",
        "zone_clean_orders": CLEAN_SQL["orders"],
        "zone_fact_sales": STAR_SQL["fact_sales"],
        "sql_over_tables": REVENUE_BY_REGION_YEAR_SQL,
        "customer_acctbal_avg": (
            "SELECT round(avg(c_acctbal), 2) AS avg_acctbal FROM customer"
        ),
        "customer_acctbal_class": (
            f"SELECT c_custkey, c_acctbal_class FROM ({CLEAN_SQL['customer']})"
        ),
        "orders_calendar": (
            f"SELECT o_orderkey, o_year, o_month FROM ({CLEAN_SQL['orders']})"
        ),
        "lineitem_revenue": (
            "SELECT l_orderkey, l_linenumber, "
            "l_extendedprice - l_discount - l_tax AS l_revenue FROM lineitem"
        ),
        "sales_surrogate_key": (
            "SELECT l_orderkey, l_linenumber, l_orderkey::VARCHAR || "
            "l_linenumber::VARCHAR AS s_orderkey_linenumber FROM lineitem"
        ),
        "part_surrogate_key": (
            "SELECT ps_partkey, ps_suppkey, ps_partkey::VARCHAR || "
            f"ps_suppkey::VARCHAR AS p_partkey_suppkey FROM ({PARTSUPP})"
        ),
        "prefix_rename": (
            "SELECT o_orderkey AS s_orderkey, o_custkey AS s_custkey, "
            "o_orderstatus AS s_orderstatus, o_totalprice AS s_totalprice, "
            "o_orderdate AS s_orderdate, o_orderpriority AS s_orderpriority "
            "FROM orders"
        ),
        "dim_geography": GEOGRAPHY_SQL,
    }
    sql |= {f"clean_{name}": text for name, text in CLEAN_SQL.items()}
    sql |= STAR_SQL
    sql |= DQ_CHECKS_SQL
    sql |= {
        "dq_alert_rows": dq_alert_rows_sql("null"),
        "dq_alert_rows_corrected": dq_alert_rows_sql("null_rows"),
        "dq_alert_summary": dq_alert_summary_sql("null"),
        "dq_alert_summary_corrected": dq_alert_summary_sql("null_rows"),
        "dq_gate": dq_gate_sql("null", DATASET),
        "dq_gate_corrected": dq_gate_sql("null_rows", DATASET),
        "job_quality_report": dq_gate_sql("null", DATASET),
        "check_not_null": check_not_null_sql(),
        "pk_violations_lineitem": pk_violations_sql("lineitem"),
    }
    sql |= {
        f"check_pk_{name}": check_pk_sql(name)
        for name in PRIMARY_KEYS_SQL
        if name != "partsupp"
    }
    sql |= {f"check_fk_{key[0]}_{key[2]}": check_fk_sql(*key) for key in FOREIGN_KEYS_SQL}
    sql |= {
        "land_raw_lineitem": RAW_LINEITEM_SQL,
        "job_clean_orders": RAW_ORDERS_SQL,
        "job_all_fact_sales": JOB_FACT_SALES_SQL,
        "job_constraints": job_constraints_sql(),
        "fact_sales_null_keys": NULL_KEYS_SQL,
        "dq_alert_rows_broken": dq_alert_rows_sql("null_rows", BROKEN_CHECKS_SQL),
        "not_null_violations_orders": """
            SELECT * REPLACE (CASE WHEN o_custkey % 7 != 0 THEN o_custkey END AS o_custkey)
            FROM orders
            WHERE o_custkey % 7 = 0 OR o_custkey IS NULL OR o_orderkey IS NULL
               OR o_orderdate IS NULL
        """,
        "check_pk_customer_twice": check_pk_sql(
            "customer", "(FROM customer UNION ALL FROM customer)"
        ),
        "check_fk_orders_lineitem": check_fk_sql(
            "orders", "o_orderkey", "lineitem", "l_orderkey"
        ),
        "fk_violations_orders_lineitem": """
            SELECT * FROM orders
            WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)
        """,
        "check_fk_lineitem_partsupp": check_offers_sql(
            f"(SELECT * FROM ({PARTSUPP}) WHERE (ps_partkey + ps_suppkey) % 5 != 0)"
        ),
        "land_raw_line_ends": """
            SELECT o_orderkey::VARCHAR || '|in' || chr(13) || 'side|' || o_orderpriority
                   || chr(13) AS value
            FROM orders
        """,
        "job_clean_rejects": """
            WITH broken AS (
                SELECT CASE WHEN o_orderkey % 11 != 0 THEN o_orderkey END AS o_orderkey,
                       o_custkey,
                       CASE WHEN o_orderkey % 11 = 0 THEN 'x' ELSE '' END
                           || o_orderkey::VARCHAR || '|' || o_custkey::VARCHAR AS line_start
                FROM orders WHERE o_orderkey % 11 = 0 OR o_orderkey % 13 = 0
            )
            SELECT 'reject' AS kind, * FROM broken
            UNION ALL SELECT 'clean', o_orderkey, o_custkey, NULL FROM broken
        """,
        "star_write_counters": " UNION ALL ".join(
            f"SELECT '{name}' AS table_name, '{key}' AS key, count({key}) AS n_keys, "
            f"count(*) - count({key}) AS n_null FROM ({STAR_SQL[name]})"
            for name, key in [
                ("fact_sales", "s_orderkey_linenumber"),
                ("dim_customer", "c_custkey"),
                ("dim_supplier", "supp_suppkey"),
                ("dim_part", "p_partkey_suppkey"),
            ]
        ),
        "published_fact_sales": STAR_SQL["fact_sales"],
        "fact_sales_bucketed": STAR_SQL["fact_sales"],
    }
    sql |= {
        "mart_revenue_by_region_year": REVENUE_BY_REGION_YEAR_SQL,
        "mart_revenue_by_supplier_nation": f"""
            SELECT supp_n_name, round(sum(s_revenue), 2) AS revenue,
                   CAST(count(s_linenumber) AS BIGINT) AS n_lines
            FROM ({STAR_SQL["fact_sales"]}) JOIN ({STAR_SQL["dim_supplier"]})
              ON s_suppkey = supp_suppkey
            GROUP BY supp_n_name
        """,
        "mart_orders_by_month": f"""
            SELECT s_year, s_month, count(DISTINCT s_orderkey) AS n_orders,
                   count(s_linenumber) AS n_lines, round(sum(s_revenue), 2) AS revenue
            FROM ({STAR_SQL["fact_sales"]})
            GROUP BY s_year, s_month
        """,
        "mart_balance_class_by_segment": f"""
            SELECT c_mktsegment, c_acctbal_class, count(*) AS n_customers,
                   round(sum(c_acctbal), 2) AS acctbal
            FROM ({CLEAN_SQL["customer"]})
            GROUP BY c_mktsegment, c_acctbal_class
        """,
        "mart_sales_hierarchy": f"""
            SELECT c_r_name, c_n_name, s_year, s_month,
                   GROUPING(c_r_name, c_n_name, s_year, s_month)::BIGINT AS level,
                   round(sum(s_revenue), 2) AS revenue,
                   CAST(count(s_linenumber) AS BIGINT) AS n_lines
            FROM ({STAR_SQL["fact_sales"]}) JOIN ({STAR_SQL["dim_customer"]})
              ON s_custkey = c_custkey
            GROUP BY GROUPING SETS (
                (c_r_name, c_n_name, s_year, s_month), (c_r_name, c_n_name, s_year),
                (c_r_name, s_year), (c_r_name), ())
        """,
        "mart_best_suppliers": f"""
            WITH sums AS (
                SELECT supp_n_name, s_year, s_suppkey, round(sum(s_revenue), 2) AS revenue
                FROM ({STAR_SQL["fact_sales"]}) JOIN ({STAR_SQL["dim_supplier"]})
                  ON s_suppkey = supp_suppkey
                GROUP BY supp_n_name, s_year, s_suppkey
            )
            SELECT *, rank() OVER (PARTITION BY supp_n_name, s_year
                                   ORDER BY revenue DESC)::INTEGER AS place
            FROM sums QUALIFY place <= 3
        """,
        "mart_revenue_trend": f"""
            WITH monthly AS (
                SELECT c_r_name, date_trunc('month', s_orderdate)::DATE AS month,
                       sum(s_revenue) AS revenue
                FROM ({STAR_SQL["fact_sales"]}) JOIN ({STAR_SQL["dim_customer"]})
                  ON s_custkey = c_custkey
                WHERE s_orderdate IS NOT NULL AND c_r_name IS NOT NULL
                GROUP BY ALL
            ), calendar AS (
                SELECT c_r_name, unnest(generate_series(min(month), max(month),
                                                        INTERVAL 1 MONTH))::DATE AS month
                FROM monthly GROUP BY c_r_name
            ), series AS (
                SELECT c_r_name, month, coalesce(revenue, 0) AS revenue
                FROM calendar LEFT JOIN monthly USING (c_r_name, month)
            )
            SELECT c_r_name, month, round(revenue, 2) AS revenue,
                   round(lag(revenue, 12) OVER series_order, 2) AS year_before,
                   round(revenue - lag(revenue, 12) OVER series_order, 2) AS change,
                   round(sum(revenue) OVER year, 2) AS trailing,
                   count(*) OVER year AS n_months
            FROM series
            WINDOW series_order AS (PARTITION BY c_r_name ORDER BY month),
                   year AS (PARTITION BY c_r_name ORDER BY month
                            ROWS BETWEEN 11 PRECEDING AND CURRENT ROW)
        """,
        "mart_cohort_retention": """
            WITH active AS (
                SELECT DISTINCT o_custkey, date_trunc('month', o_orderdate)::DATE AS month
                FROM orders WHERE o_custkey IS NOT NULL AND o_orderdate IS NOT NULL
            ), first AS (
                SELECT o_custkey, min(month) AS cohort FROM active GROUP BY o_custkey
            )
            SELECT cohort, datediff('month', cohort, month)::INTEGER AS months_since,
                   count(*) AS n_customers
            FROM active JOIN first USING (o_custkey) GROUP BY ALL
        """,
        "mart_order_sessions": """
            WITH days AS (
                SELECT o_custkey, o_orderdate::DATE AS day, count(*) AS n_orders,
                       sum(o_totalprice) AS value
                FROM orders WHERE o_custkey IS NOT NULL AND o_orderdate IS NOT NULL
                GROUP BY ALL
            ), pauses AS (
                SELECT *, day - lag(day) OVER (PARTITION BY o_custkey ORDER BY day) AS pause
                FROM days
            ), numbered AS (
                SELECT *, CAST(sum(CASE WHEN pause <= 60 THEN 0 ELSE 1 END)
                                   OVER (PARTITION BY o_custkey ORDER BY day) AS BIGINT)
                              AS session
                FROM pauses
            )
            SELECT o_custkey, session, min(day) AS first_day, max(day) AS last_day,
                   CAST(sum(n_orders) AS BIGINT) AS n_orders, round(sum(value), 2) AS value
            FROM numbered GROUP BY o_custkey, session
        """,
        "sketch_customers_by_year": f"""
            SELECT o_year, count(DISTINCT o_custkey) AS n_customers, true AS within_error
            FROM ({CLEAN_SQL["orders"]}) GROUP BY o_year
        """,
        "sketch_order_value_quantiles": f"""
            SELECT c_r_name, unnest([0.25, 0.5, 0.9])::DOUBLE AS quantile, n_orders,
                   true AS within_error
            FROM (SELECT c_r_name, count(o_totalprice) AS n_orders
                  FROM orders JOIN ({STAR_SQL["dim_customer"]}) ON o_custkey = c_custkey
                  GROUP BY c_r_name)
        """,
    }
    return sql | (llm.ORACLE_SQL if llm else {})
