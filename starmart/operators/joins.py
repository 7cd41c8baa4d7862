"""The one join the star schema needs: full outer on one key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def full_outer(many: DataFrame, one: DataFrame, key: str) -> DataFrame:
    """Full outer join of a foreign-key side ``many`` and a primary-key side ``one``.

    Spark can neither broadcast a side of a full outer join nor split its skewed
    partitions. A left join and an anti join together give the same rows, and it can do
    both for them by the sizes it meets at run time: a small ``one`` is broadcast and
    ``many`` not shuffled; a key with very many rows in ``many`` is split over tasks.
    The anti join reads the key column of ``many`` alone, as distinct keys. It is written
    as a left join to marked keys, of the rows of ``one`` that have a key: Spark would
    push an anti join below the columns of ``one`` and shuffle them once for each join.

    NULL keys match nothing and survive on both sides; duplicate keys multiply. A key
    with very many rows in ``one``, which breaks that table's contract, is not split.
    """
    matched = many.join(one, key, "left")
    seen = many.select(key).where(F.col(key).isNotNull()).distinct()
    mark = "__seen"
    keyed = F.col(key).isNotNull()
    marked = one.where(keyed).join(seen.withColumn(mark, F.lit(True)), key, "left")
    unmatched = marked.where(F.col(mark).isNull()).select(one.columns)
    unmatched = unmatched.unionByName(one.where(~keyed))
    return matched.unionByName(unmatched, allowMissingColumns=True)
