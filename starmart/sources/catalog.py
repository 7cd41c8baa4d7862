"""Warehouse tables: external Parquet tables in the session catalog."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.schemas import STAR_COLUMNS
from starmart.sources.files import stored_bytes
from starmart.sources.zones import stored_schema


# Parquet of one bucket: some hundred MB where a task sorts its rows.
BUCKET_BYTES = 16 * 2**20
# Spark refuses tables with more.
MAX_BUCKETS = "spark.sql.sources.bucketing.maxBuckets"


def _quoted(text: str) -> str:
    escaped = text.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def create_database(
    spark: SparkSession, database: str, location: str | None = None
) -> None:
    where = f" LOCATION {_quoted(location)}" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}{where}")


def _drop(spark: SparkSession, name: str) -> None:
    if spark.catalog.tableExists(name):
        view = spark.catalog.getTable(name).tableType == "VIEW"
        spark.sql(f"DROP {'VIEW' if view else 'TABLE'} {name}")


def register_table(
    spark: SparkSession,
    database: str,
    table: str,
    path: str,
    partition_by: list[str] | tuple[str, ...] = (),
    contract_of: str | None = None,
) -> str:
    """(Re-)register the Parquet files at ``path``; files are never touched.

    Spark puts partition columns last. A partitioned table is therefore registered as
    ``<table>_stored``, under a view that has the column order of the contract of
    ``contract_of``, which is the table's own unless it is given.
    """
    name = f"{database}.{table}"
    _drop(spark, name)
    if not partition_by:
        spark.catalog.createTable(name, path=path, source="parquet")
        return name
    stored = f"{name}_stored"
    _drop(spark, stored)
    schema = stored_schema(spark, path)
    spark.sql(
        f"CREATE TABLE {stored} ({schema.toDDL()}) USING parquet "
        f"PARTITIONED BY ({', '.join(partition_by)}) LOCATION {_quoted(path)}"
    )
    spark.catalog.recoverPartitions(stored)
    wanted = STAR_COLUMNS.get(contract_of or table, [])
    columns = [c for c in wanted if c in schema.names]
    columns += [c for c in schema.names if c not in wanted]
    spark.sql(f"CREATE VIEW {name} AS SELECT {', '.join(columns)} FROM {stored}")
    return name


def replace_view(spark: SparkSession, name: str, source: str) -> None:
    """Make ``name`` a view of ``source``; where it is a view already, in one step.

    A table of that name, from ``register_table``, is given up for the view.
    """
    if spark.catalog.tableExists(name) and spark.catalog.getTable(name).tableType != "VIEW":
        _drop(spark, name)
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM {source}")


def bucket_count(spark: SparkSession, paths: Sequence[str], at_least: int = 1) -> int:
    """How many buckets tables that are to meet need, by the stored size of their sources.

    Their number follows the largest table, so that a task sorts as much of a large
    table as of a small one. Beyond the number that Spark allows, buckets grow.
    """
    largest = max(stored_bytes(spark, path) for path in paths)
    allowed = int(spark.conf.get(MAX_BUCKETS, "100000"))
    return min(max(at_least, -(-largest // BUCKET_BYTES)), allowed)


def write_bucketed(
    df: DataFrame, database: str, table: str, path: str, key: str, buckets: int
) -> str:
    """Store a table in ``buckets`` by a key, each sorted by it, and register it.

    Tables in equally many buckets by their join keys are joined, and grouped by it,
    without a shuffle, for as long as they are stored: the shuffle happens here, once per
    refresh. A task writes a bucket, as one file, and sorts it: ``buckets`` must grow with
    the table (``bucket_count``) and be the same for tables that are to meet. A key with
    very many rows is not split, neither here nor in a join that uses the buckets.
    """
    name = f"{database}.{table}"
    _drop(spark := df.sparkSession, name)
    (
        df.repartition(buckets, F.col(key))
        .write.mode("overwrite")
        .option("path", path)
        .bucketBy(buckets, key)
        .sortBy(key)
        .format("parquet")
        .saveAsTable(name)
    )
    spark.catalog.refreshTable(name)
    return name
