"""Lake zones: one Parquet folder per table under a zone's URI."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql.types import StructField, StructType

from starmart.operators.projections import contract
from starmart.schemas import CLEAN_COLUMNS, PARTITION_TYPES, STAR_COLUMNS


def zone_path(zone: str, table: str) -> str:
    return f"{zone.rstrip('/')}/{table}"


# Zones are written once and read often; Spark's default (snappy) takes a quarter more.
COMPRESSION = "zstd"


def _overwrite(
    df: DataFrame, path: str, partition_by: Sequence[str], rebalance: bool
) -> None:
    if partition_by and rebalance:
        df = df.hint("rebalance", *partition_by)
    writer = df.write.partitionBy(*partition_by) if partition_by else df.write
    writer = writer.option("compression", COMPRESSION)
    # A full refresh, also in sessions that overwrite only the partitions they meet.
    writer.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)


def write_zone(
    df: DataFrame,
    zone: str,
    table: str,
    partition_by: Sequence[str] = (),
    rebalance: bool = False,
) -> str:
    """Overwrite a table of a zone; every task writes its own part.

    In a partitioned write each task leaves a file in the folder of every partition
    value it holds, and a hot value is written by all tasks that hold it. After a join
    adaptive execution has sized the tasks. ``rebalance`` shuffles all rows once more,
    by partition value, for fewer files of even size.
    """
    path = zone_path(zone, table)
    _overwrite(df, path, partition_by, rebalance)
    return path


def write_counted(
    df: DataFrame,
    zone: str,
    table: str,
    counters: Mapping[str, Column],
    partition_by: Sequence[str] = (),
    rebalance: bool = False,
) -> dict[str, object]:
    """``write_zone`` that also evaluates aggregates over the rows as they are written.

    The counters cost no scan of their own. They are taken in the tasks that write, after
    any shuffle, where a task that is tried again counts once. Aggregates that need all
    rows of a value together (distinct ones) cannot be observed.
    """
    observation = Observation(f"counters of {table}")
    if partition_by and rebalance:
        df = df.hint("rebalance", *partition_by)
    observed = df.observe(observation, *[c.alias(name) for name, c in counters.items()])
    _overwrite(observed, zone_path(zone, table), partition_by, rebalance=False)
    return observation.get


def stored_schema(spark: SparkSession, path: str) -> StructType:
    """The schema of stored files; partition columns get their declared types.

    Spark would infer those from folder names, and from no value at all a type of
    nothing.
    """
    found = spark.read.parquet(path).schema
    return StructType(
        [
            StructField(f.name, PARTITION_TYPES.get(f.name, f.dataType), True)
            for f in found
        ]
    )


def read_zone(
    spark: SparkSession, zone: str, table: str, strict: bool = False
) -> DataFrame:
    """Read a table of a zone in the contract's column order.

    Extra columns come last and missing ones are left out; ``strict`` makes both an
    error.
    """
    path = zone_path(zone, table)
    df = spark.read.schema(stored_schema(spark, path)).parquet(path)
    columns = STAR_COLUMNS.get(table) or CLEAN_COLUMNS[table]
    extra = [name for name in df.columns if name not in columns]
    if strict and extra:
        raise ValueError(f"{table} has columns beyond its contract: {extra}")
    return contract(df, [*columns, *extra], strict)
