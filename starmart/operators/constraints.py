"""Data checks for declared constraints; Spark itself enforces none of them.

Each check has two forms: the violating rows (or keys), and a one-line summary
``(table_name, check_name, violations)`` that is there also when all is well.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _summary(table: str, check: str, violations: Column) -> list[Column]:
    return [
        F.lit(table).alias("table_name"),
        F.lit(check).alias("check_name"),
        violations.cast("bigint").alias("violations"),
    ]


def not_null_violations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows with a NULL in any of the columns."""
    return df.where(reduce(or_, [F.col(name).isNull() for name in columns]))


def not_null_summary(df: DataFrame, table: str, columns: Sequence[str]) -> DataFrame:
    """NULL count per column: one pass over the table, one output row per column."""
    counts = df.agg(*[F.count_if(F.col(name).isNull()).alias(name) for name in columns])
    return counts.select(
        F.inline(
            F.array(
                *[
                    F.struct(*_summary(table, f"not_null({name})", F.col(name)))
                    for name in columns
                ]
            )
        )
    )


def absent_summary(
    spark: SparkSession, table: str, columns: Sequence[str]
) -> DataFrame:
    """A violation for each column that a table should have and lacks."""
    rows = [(table, f"present({name})", 1) for name in columns]
    return spark.createDataFrame(
        rows, "table_name string, check_name string, violations bigint"
    )


def _with_key(df: DataFrame, key: Sequence[str]) -> DataFrame:
    return df.where(reduce(and_, [F.col(name).isNotNull() for name in key]))


def primary_key_violations(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys held by more than one row, with the number of rows.

    Keys with a NULL part are left to the not-null check. The count is combined
    before the shuffle, so a hot key arrives as one partial count per task.
    """
    return (
        _with_key(df, key)
        .groupBy(*key)
        .agg(F.count("*").alias("n_rows"))
        .where("n_rows > 1")
    )


def primary_key_summary(df: DataFrame, table: str, key: Sequence[str]) -> DataFrame:
    """Number of keys that more than one row holds."""
    check = f"primary_key({', '.join(key)})"
    violations = primary_key_violations(df, key).agg(F.count("*").alias("violations"))
    return violations.select(*_summary(table, check, F.col("violations")))


def _orphan_keys(
    child: DataFrame,
    child_key: Sequence[str],
    parent: DataFrame,
    parent_key: Sequence[str],
) -> DataFrame:
    """Child keys the parent does not know, with their number of rows.

    Only key columns are read. Both sides are reduced to one row per key before the
    shuffle, so no key is hot in the join.
    """
    names = list(child_key)
    known = parent.select(
        *[F.col(p).alias(c) for p, c in zip(parent_key, child_key, strict=True)]
    )
    counts = _with_key(child, names).groupBy(*names).agg(F.count("*").alias("n_rows"))
    return counts.join(known.distinct(), names, "left_anti")


def foreign_key_violations(
    child: DataFrame,
    child_key: Sequence[str],
    parent: DataFrame,
    parent_key: Sequence[str],
) -> DataFrame:
    """Child rows whose key is unknown to the parent; a NULL key is no violation.

    The unknown keys are found first. Spark broadcasts them as long as they are few, so
    that the child is filtered without a shuffle, and splits a hot key otherwise.
    """
    unknown = _orphan_keys(child, child_key, parent, parent_key).select(*child_key)
    return child.join(unknown, list(child_key), "left_semi")


def foreign_key_summary(
    child: DataFrame,
    table: str,
    child_key: Sequence[str],
    parent: DataFrame,
    parent_table: str,
    parent_key: Sequence[str],
) -> DataFrame:
    """Number of child rows with an unknown key."""
    check = f"foreign_key({', '.join(child_key)} -> {parent_table})"
    orphans = _orphan_keys(child, child_key, parent, parent_key)
    total = orphans.agg(F.coalesce(F.sum("n_rows"), F.lit(0)).alias("violations"))
    return total.select(*_summary(table, check, F.col("violations")))
