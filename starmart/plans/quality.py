"""Data-quality report over the star: key checks, alerts, summary and gate.

NULL keys are counted in two ways. The *literal* count keeps the report's own
definition, distinct non-NULL values among the NULL keys, which is 0 for any data.
The *corrected* count is the number of rows whose key is NULL.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmart.functions import array_length

# Fixed values of the report: its tables in order, as (table, key, whether uniqueness
# is checked, name in the texts), and its wording.
SUBJECTS = (
    ("fact_sales", "s_orderkey_linenumber", False, "sales"),
    ("dim_customer", "c_custkey", True, "customer"),
    ("dim_supplier", "supp_suppkey", True, "supplier"),
    ("dim_part", "p_partkey_suppkey", False, "part"),
)
ALERT_SEPARATOR = ".; "
ALL_GOOD = "all good"
GATE_MESSAGE = (
    "ATTENTION: %s. has potential data quality issues for yesterday: %s. for more info."
)


def key_checks(df: DataFrame, key: str, unique: bool = False) -> DataFrame:
    """One row of counters for a key, from one pass that reads only that column.

    The literal NULL counter is declared DISTINCT; what it counts is NULL on every
    row, so DISTINCT cannot change it and is left out, which spares the plan a
    second distinct aggregate.
    """
    column = F.col(key)
    counters = {
        f"{key}_count": F.count(column),
        f"{key}_unique": F.countDistinct(column) if unique else None,
        f"{key}_null": F.count(F.when(column.isNull(), column)),
        f"{key}_null_rows": F.count_if(column.isNull()),
    }
    return df.agg(
        *[value.alias(name) for name, value in counters.items() if value is not None]
    )


def observable_counters(key: str) -> dict[str, Column]:
    """Counters of a key that need no other rows, for a table while it is written."""
    column = F.col(key)
    return {"n_keys": F.count(column), "n_null": F.count_if(column.isNull())}


def _alerts(key: str, unique: bool, name: str, nulls: str) -> list[Column]:
    count = F.col(f"{key}_count")
    null_count = F.col(f"{key}_null" if nulls == "literal" else f"{key}_null_rows")
    alerts = [F.when(count == 0, F.lit(f"{name.capitalize()} data missing; "))]
    if unique:
        duplicate = F.lit(f"Duplicate {name} primary key found; ")
        alerts.append(F.when(count != F.col(f"{key}_unique"), duplicate))
    null_keys = F.lit(f" NULL {name} primary key found")
    found = F.concat(null_count.cast("string"), null_keys)
    alerts.append(F.when(null_count != 0, found))
    return alerts


def alert_rows(star: Mapping[str, DataFrame], nulls: str = "literal") -> DataFrame:
    """Ten numbered checks, each with its alert text or NULL.

    Every table is aggregated once and its counters are turned into rows, so no
    table is scanned per check and no one-row results are cross joined.
    """
    if nulls not in ("literal", "corrected"):
        raise ValueError("nulls must be 'literal' or 'corrected'")
    parts, number = [], 0
    for table, key, unique, name in SUBJECTS:
        rows = []
        for alert in _alerts(key, unique, name, nulls):
            number += 1
            rows.append(
                F.struct(F.lit(number).alias("check_no"), alert.alias("alerts"))
            )
        checks = key_checks(star[table], key, unique)
        parts.append(checks.select(F.inline(F.array(*rows))))
    return reduce(DataFrame.unionByName, parts)


def alert_summary(alerts: DataFrame) -> DataFrame:
    """The alerts as one text in check order, and their number; both NULL if none."""
    numbered = F.when(
        F.col("alerts").isNotNull(), F.struct("check_no", "alerts")
    )
    listed = alerts.agg(F.sort_array(F.collect_list(numbered)).alias("listed"))
    texts = F.transform("listed", lambda alert: alert["alerts"])
    return listed.select(
        F.when(F.size(texts) > 0, F.array_join(texts, ALERT_SEPARATOR)).alias(
            "stringify_alert_list"
        ),
        array_length(texts).alias("issues_found"),
    )


def gate(summary: DataFrame, dataset: str, on_fail: str = "raise") -> DataFrame:
    """``all good``, or the failure: raised when the row is computed, or returned."""
    if on_fail not in ("raise", "return"):
        raise ValueError("on_fail must be 'raise' or 'return'")
    message = F.format_string(
        GATE_MESSAGE, F.lit(dataset), F.col("stringify_alert_list")
    )
    failure = F.raise_error(message).cast("string") if on_fail == "raise" else message
    return summary.select(
        "issues_found",
        F.when(F.col("issues_found").isNull(), F.lit(ALL_GOOD))
        .otherwise(failure)
        .alias("status"),
    )
