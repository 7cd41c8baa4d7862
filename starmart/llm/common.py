"""Helpers that several operators share.

Words are runs of characters other than space, tab, line feed, vertical tab, form feed
and carriage return, everywhere in this package. In Python that is ``bytes.split()``.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.session import scratch_dir

SPACE = " \t\n\x0b\f\r"
SPACES = r"[\x20\x09-\x0D]+"


def words(text: Column) -> Column:
    """The words of a text as an array; empty for NULL or blank text."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACE))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(
        F.split(trimmed, SPACES)
    )


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, also if a lambda uses it often."""
    return F.element_at(F.transform(F.array(value), lambda v: body(v)), 1)


def held_out(doc_id: Column) -> Column:
    """True for the fourth of all documents that no model may learn labels from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared scratch folder: computed once, lineage cut."""
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/{name}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores in front until it is no column of ``df``."""
    taken = {column.lower() for column in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- hashes of words and shingles, in numpy -------------------------------------

_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xBF58476D1CE4E5B9)


def word_hashes(tokens: list[bytes]) -> np.ndarray:
    return np.fromiter(
        map(xxhash.xxh3_64_intdigest, tokens), dtype=np.uint64, count=len(tokens)
    )


def shingle_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """One 64-bit hash for each run of ``size`` words, in order."""
    count = len(hashes) - size + 1
    if count <= 0:
        return np.empty(0, dtype=np.uint64)
    out = np.zeros(count, dtype=np.uint64)
    for offset in range(size):
        out = out * _MULTIPLIER + hashes[offset : offset + count]
    out = (out ^ (out >> np.uint64(29))) * _MIX
    return out ^ (out >> np.uint64(32))


def shingle_set(tokens: list[bytes], size: int = 5) -> np.ndarray:
    """Sorted distinct shingle hashes; a shorter text is one shingle as a whole."""
    hashes = word_hashes(tokens)
    return np.unique(shingle_hashes(hashes, min(size, len(hashes)) or 1))


# --- filters of hashes, of fixed size -------------------------------------------


def filter_bits(hashes: DataFrame, bits: int) -> bytes:
    """A bit for each hash, of 2 ** bits; this and no more comes to the driver."""
    slot = F.col("hash").bitwiseAND(F.lit((1 << bits) - 1))
    word = F.shiftright(slot, 6).cast("int").alias("word")
    bit = F.expr("shiftleft(1L, cast(hash & 63 as int))")
    set_bits = hashes.groupBy(word).agg(F.bit_or(bit).alias("bits")).toArrow()
    table = np.zeros(1 << (bits - 6), dtype=np.uint64)
    table[set_bits["word"].to_numpy()] = set_bits["bits"].to_numpy().view(np.uint64)
    return table.tobytes()


def has_bit(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    slot = hashes & np.uint64(64 * len(bits) - 1)
    return (bits[slot >> np.uint64(6)] >> (slot & np.uint64(63))) & np.uint64(1) == 1
