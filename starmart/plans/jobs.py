"""Batch jobs: raw to clean, clean to star, star to tables, tables to report.

Each job is a full refresh that overwrites its output, so a failed run is simply
started again. Folders are URIs of any file system Spark can reach.
"""

from __future__ import annotations

import argparse
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from starmart.operators import (
    absent_summary,
    foreign_key_summary,
    not_null_summary,
    primary_key_summary,
)
from starmart.plans.clean import clean_tables
from starmart.plans.quality import (
    SUBJECTS,
    alert_rows,
    alert_summary,
    gate,
    observable_counters,
)
from starmart.plans.star import star_tables
from starmart.schemas import (
    FOREIGN_KEYS,
    NOT_NULL,
    PRIMARY_KEYS,
    STAR_TABLES,
    TABLES,
)
from starmart.session import get_session, scratch_dir
from starmart.sources import (
    create_database,
    land_raw,
    publish,
    read_raw,
    read_zone,
    register_published,
    register_table,
    split_raw,
    tbl_path,
    write_counted,
    write_zone,
)
from starmart.sources.snapshots import Snapshot
from starmart.sources.zones import zone_path

PARTITIONS = {"fact_sales": ["s_year"]}
# Text takes a quarter of its size. It is kept for replays and read once a refresh.
RAW_COMPRESSION = "gzip"


def write_tables(tables: Mapping[str, DataFrame], zone: str) -> None:
    for table, df in tables.items():
        write_zone(df, zone, table, PARTITIONS.get(table, ()))


def run_land(spark: SparkSession, source: str, raw: str) -> None:
    """Copy the eight text tables into the raw zone, line by line, as compressed files."""
    for table in TABLES:
        land_raw(spark, tbl_path(source, table), raw, table, RAW_COMPRESSION)


def run_clean(
    spark: SparkSession,
    raw: str,
    clean: str,
    lineitem_layout: str = "stock",
    strict: bool = True,
    rejects: str | None = None,
) -> None:
    """Raw text zone to clean Parquet zone.

    With ``rejects``, a folder, the lines of each table that do not parse whole are
    written there, as Parquet with what could be read of them; their rows stay in the
    clean zone, with NULLs. Every table is parsed once for both.
    """
    if not rejects:
        tables = clean_tables(
            lambda table: read_raw(spark, raw, table, lineitem_layout), strict
        )
        write_tables(tables, clean)
        return
    staging = scratch_dir(spark)
    parsed = {
        table: split_raw(spark, raw, table, staging, lineitem_layout) for table in TABLES
    }
    write_tables(clean_tables(lambda table: parsed[table][0], strict), clean)
    for table, (_, rejected) in parsed.items():
        write_zone(rejected, rejects, table)


def run_star(
    spark: SparkSession, clean: str, star: str, strict: bool = True
) -> None:
    """Clean zone to star zone."""
    tables = star_tables(lambda table: read_zone(spark, clean, table, strict), strict)
    write_tables(tables, star)


def run_star_counted(
    spark: SparkSession, clean: str, star: str, strict: bool = True
) -> DataFrame:
    """Clean zone to star zone, and the key counters of what was written.

    One row per table: table_name, key, n_keys, n_null. Both counters come from the
    writing tasks, so no table is read for them.
    """
    tables = star_tables(lambda table: read_zone(spark, clean, table, strict), strict)
    rows = []
    for table, key, _, _ in SUBJECTS:
        counted = write_counted(
            tables[table], star, table, observable_counters(key), PARTITIONS.get(table, ())
        )
        rows.append((table, key, counted["n_keys"], counted["n_null"]))
    return spark.createDataFrame(
        rows, "table_name string, key string, n_keys bigint, n_null bigint"
    )


def run_publish(
    spark: SparkSession,
    clean: str,
    star: str,
    database: str,
    location: str | None = None,
    nulls: str = "literal",
    strict: bool = True,
) -> Snapshot:
    """Build the star as a new snapshot, check it, and only then show it to readers.

    The quality gate runs on the new files before they are published: where it fails, the
    job fails, and readers keep the snapshot they have.
    """
    tables = star_tables(lambda table: read_zone(spark, clean, table, strict), strict)

    def audit(written: Mapping[str, DataFrame]) -> None:
        gate(alert_summary(alert_rows(written, nulls)), database).collect()

    publish(spark, star, tables, PARTITIONS, audit)
    return register_published(spark, star, database, location)


def run_register(
    spark: SparkSession, star: str, database: str, location: str | None = None
) -> None:
    """Publish the star zone as external tables of a database."""
    create_database(spark, database, location)
    for table in STAR_TABLES:
        path = zone_path(star, table)
        register_table(spark, database, table, path, PARTITIONS.get(table, ()))


def run_quality(
    spark: SparkSession,
    database: str,
    nulls: str = "literal",
    on_fail: str = "raise",
) -> DataFrame:
    """The gate over the registered tables, one row."""
    star = {table: spark.table(f"{database}.{table}") for table in STAR_TABLES}
    return gate(alert_summary(alert_rows(star, nulls)), database, on_fail)


def constraint_summary(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per declared constraint: (table_name, check_name, violations).

    A column that must not be NULL but is absent counts as one violation of
    ``present(column)``. Keys of which a column is absent are not checked.
    """
    parts = []
    for table, df in tables.items():
        present = [c for c in NOT_NULL[table] if c in df.columns]
        parts.append(not_null_summary(df, table, present))
        absent = [c for c in NOT_NULL[table] if c not in df.columns]
        if absent:
            parts.append(absent_summary(df.sparkSession, table, absent))
    return reduce(DataFrame.unionByName, [*parts, *_key_checks(tables)])


def key_summary(tables: Mapping[str, DataFrame]) -> DataFrame:
    """The rows of ``constraint_summary`` for primary and foreign keys."""
    return reduce(DataFrame.unionByName, _key_checks(tables))


def _key_checks(tables: Mapping[str, DataFrame]) -> list[DataFrame]:
    parts = []
    for table, df in tables.items():
        key = PRIMARY_KEYS[table]
        if set(key) <= set(df.columns):
            parts.append(primary_key_summary(df, table, key))
    for child, child_key, parent, parent_key in FOREIGN_KEYS:
        if child in tables and parent in tables:
            one, other = tables[child], tables[parent]
            if set(child_key) <= set(one.columns) and set(parent_key) <= set(other.columns):
                parts.append(
                    foreign_key_summary(one, child, child_key, other, parent, parent_key)
                )
    return parts


def key_columns(table: str) -> list[str]:
    """The columns of a table that some key, its own or a foreign one, is made of."""
    wanted = list(PRIMARY_KEYS[table])
    for child, child_key, parent, parent_key in FOREIGN_KEYS:
        wanted += child_key if child == table else []
        wanted += parent_key if parent == table else []
    return list(dict.fromkeys(wanted))


def staged_keys(
    df: DataFrame, table: str, staging: str
) -> tuple[DataFrame, list[tuple[str, str, int]]]:
    """The key columns of a table as narrow Parquet, and its not-null checks.

    One pass over the table gives both: NULLs are counted as the keys are written.
    """
    columns = NOT_NULL[table]
    checks = [F.count_if(F.col(name).isNull()).alias(name) for name in columns]
    observation = Observation(f"not null in {table}")
    path = f"{staging}/{table}"
    keys = df.observe(observation, *checks).select(*key_columns(table))
    keys.write.mode("overwrite").parquet(path)
    counted = observation.get
    rows = [(table, f"not_null({name})", counted[name]) for name in columns]
    return df.sparkSession.read.schema(keys.schema).parquet(path), rows


def run_constraints(
    spark: SparkSession, raw: str, report: str, lineitem_layout: str = "stock"
) -> DataFrame:
    """Checks the raw zone; writes and returns one summary table.

    Every text table is parsed once. All keys are then checked on the few columns that
    they are made of, as Parquet.
    """
    staging, keys, rows = scratch_dir(spark), {}, []
    for table in TABLES:
        df = read_raw(spark, raw, table, lineitem_layout)
        keys[table], checks = staged_keys(df, table, staging)
        rows += checks
    schema = "table_name string, check_name string, violations bigint"
    summary = spark.createDataFrame(rows, schema).unionByName(key_summary(keys))
    summary.coalesce(1).write.mode("overwrite").parquet(report)
    return spark.read.parquet(report)


def run_all(
    spark: SparkSession,
    raw: str,
    clean: str,
    star: str,
    database: str,
    lineitem_layout: str = "stock",
    location: str | None = None,
    nulls: str = "literal",
    on_fail: str = "raise",
    strict: bool = True,
    rejects: str | None = None,
    source: str | None = None,
) -> DataFrame:
    """The whole chain; returns the gate for the caller to evaluate.

    With ``source`` it starts by landing the text tables from there.
    """
    if source:
        run_land(spark, source, raw)
    run_clean(spark, raw, clean, lineitem_layout, strict, rejects)
    run_star(spark, clean, star, strict)
    run_register(spark, star, database, location)
    return run_quality(spark, database, nulls, on_fail)


def main(argv: Sequence[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="starmart")
    parser.add_argument(
        "job",
        choices=[
            "land", "clean", "star", "register", "publish", "quality", "constraints", "all"
        ],
    )
    parser.add_argument("--source", help="folder with the text tables; all: land them first")
    parser.add_argument("--raw")
    parser.add_argument("--clean")
    parser.add_argument(
        "--star", help="for quality: register it first (a catalog may not persist)"
    )
    parser.add_argument("--database", default="starmart")
    parser.add_argument("--location", help="folder of the database")
    parser.add_argument(
        "--lineitem-layout", default="stock", choices=["stock", "named"]
    )
    parser.add_argument(
        "--nulls",
        default="literal",
        choices=["literal", "corrected"],
        help="how NULL keys are counted in the quality report",
    )
    parser.add_argument("--on-fail", default="raise", choices=["raise", "return"])
    parser.add_argument("--rejects", help="folder for lines that do not parse")
    parser.add_argument("--report", help="folder for the summary of constraints")
    args = parser.parse_args(argv)
    spark = get_session()
    report = None
    if args.job == "land":
        run_land(spark, args.source, args.raw)
    elif args.job == "clean":
        run_clean(
            spark, args.raw, args.clean, args.lineitem_layout, rejects=args.rejects
        )
    elif args.job == "star":
        run_star(spark, args.clean, args.star)
    elif args.job == "publish":
        run_publish(
            spark, args.clean, args.star, args.database, args.location, args.nulls
        )
    elif args.job == "register":
        run_register(spark, args.star, args.database, args.location)
    elif args.job == "quality":
        if args.star:
            run_register(spark, args.star, args.database, args.location)
        report = run_quality(spark, args.database, args.nulls, args.on_fail)
    elif args.job == "constraints":
        run_constraints(spark, args.raw, args.report, args.lineitem_layout).show(
            100, truncate=False
        )
    else:
        report = run_all(
            spark,
            args.raw,
            args.clean,
            args.star,
            args.database,
            args.lineitem_layout,
            args.location,
            args.nulls,
            args.on_fail,
            rejects=args.rejects,
            source=args.source,
        )
    if report is not None:
        print(report.first())
