"""Projections and renames."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def contract(df: DataFrame, columns: Sequence[str], strict: bool = False) -> DataFrame:
    """The contract's columns in the contract's order.

    Sources that carry fewer columns keep those they have; ``strict`` refuses them.
    """
    given = set(df.columns)
    missing = [name for name in columns if name not in given]
    if strict and missing:
        raise ValueError(f"columns missing: {', '.join(missing)}")
    return df.select(*[name for name in columns if name in given])


def prefix_rename(df: DataFrame, old: str, new: str) -> DataFrame:
    """Replace the prefix of every column that has it; only at the start of the name."""
    return df.withColumnsRenamed(
        {
            name: new + name.removeprefix(old)
            for name in df.columns
            if name.startswith(old)
        }
    )
