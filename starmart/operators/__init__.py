from starmart.operators.constraints import (
    absent_summary,
    foreign_key_summary,
    foreign_key_violations,
    not_null_summary,
    not_null_violations,
    primary_key_summary,
    primary_key_violations,
)
from starmart.operators.joins import full_outer
from starmart.operators.projections import contract, prefix_rename

__all__ = [
    "absent_summary",
    "contract",
    "foreign_key_summary",
    "foreign_key_violations",
    "full_outer",
    "not_null_summary",
    "not_null_violations",
    "prefix_rename",
    "primary_key_summary",
    "primary_key_violations",
]
