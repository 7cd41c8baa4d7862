from starmart.functions.expressions import (
    acctbal_class,
    array_length,
    order_month,
    order_year,
    revenue,
    surrogate_key,
)

__all__ = [
    "acctbal_class",
    "array_length",
    "order_month",
    "order_year",
    "revenue",
    "surrogate_key",
]
