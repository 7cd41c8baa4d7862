"""Column expressions. All of them are built-in functions inside codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def acctbal_class(balance: Column, average: Column) -> Column:
    """Three balance classes; NULL and the average itself count as above average."""
    # Fixed values of the contract: the labels, and that the class is a string.
    return (
        F.when(balance < 0, "negative")
        .when(balance < average, "below_average")
        .otherwise("above_average")
        .cast("string")
    )


def order_year(ts: Column) -> Column:
    return F.year(ts)


def order_month(ts: Column) -> Column:
    """Month name, ``Jan`` to ``Dec``; via the date, so no time zone shifts it."""
    return F.date_format(F.to_date(ts), "MMM")


def revenue(price: Column, discount: Column, tax: Column) -> Column:
    """Price less the two rates as they stand (subtracted, not multiplied)."""
    return price - discount - tax


def surrogate_key(*parts: Column) -> Column:
    """Parts joined without a separator; NULL as soon as one part is NULL.

    Different parts can give the same string: (1, 23) and (12, 3) both give
    ``123``. Check uniqueness on the parts, never on this column.
    """
    return F.concat(*[part.cast("string") for part in parts])


def array_length(array: Column) -> Column:
    """Number of elements, NULL (not 0) when there are none."""
    return F.nullif(F.size(array), F.lit(0))
