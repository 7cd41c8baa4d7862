"""Benchmark decontamination by size-partitioned MinHash containment search.

A test item is contained in a document if at least 0.8 of the item's distinct five-word
shingles (A-Z lower-cased) occur in it. Items are partitioned by the size of their
shingle set. Within a partition every item has a MinHash signature: its smallest
shingle hashes, as many as its partition needs. An item of n shingles may lack n / 5 of
them, so with one more than that in the signature at least one must occur in the
document; partitions of large items stop at SIGNATURE values, which all miss with a
probability of 0.2 ** SIGNATURE. A document fetches the items that have a signature
value among its own shingle hashes, and each is then verified on the item's full
shingle set.

Items are the query set: they are taken in blocks of BLOCK_ITEMS and BLOCK_CHARS, which
bounds what is broadcast; a longer item is a block of its own. Documents stream past each
block and are not shuffled for it. Of more than one block only what was found is written,
and documents that contain something are then told by id and a hash of their text.

Defined results: NULL and blank items are contained in nothing; an item of fewer than
five words is one shingle, looked for as a run of that many words. NULL and blank
documents contain nothing. Items with the same id are independent items; so are items
without id, which are found under a NULL id, and repeated documents. Other columns of the
tables do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart.llm.common import free_name, shingle_hashes, word_hashes, written

SHINGLE = 5
CONTAINMENT = 0.8
SIGNATURE = 24
# What one broadcast block of several items may hold, which keeps it within about 100 MB.
BLOCK_ITEMS = 50_000
BLOCK_CHARS = 20_000_000


@dataclass(frozen=True)
class ItemBlock:
    """A block of items: the index of signatures and the full sets behind it."""

    ids: tuple[int | None, ...]
    sizes: np.ndarray
    widths: tuple[int, ...]
    signature: np.ndarray
    signature_item: np.ndarray
    members: np.ndarray
    bounds: np.ndarray


def tokens(text: str | bytes | None) -> list[bytes]:
    raw = text.encode("utf-8", "replace") if isinstance(text, str) else text or b""
    return raw.lower().split()


def partition_signature(size: int) -> int:
    """Signature values for the size partition [2^k, 2^(k+1)) that ``size`` is in."""
    upper = (1 << size.bit_length()) - 1
    return min(upper - int(np.ceil(CONTAINMENT * upper)) + 1, SIGNATURE)


def index_items(items: list[tuple[int | None, str]]) -> ItemBlock:
    ids, sets, widths = [], [], []
    for item_id, text in items:
        hashes = word_hashes(tokens(text))
        if len(hashes):
            width = min(SHINGLE, len(hashes))
            ids.append(item_id)
            widths.append(width)
            # Runs of different widths never share a hash.
            sets.append(np.unique(shingle_hashes(hashes, width)))
    signatures = [s[: partition_signature(len(s))] for s in sets]
    owners = np.repeat(np.arange(len(sets)), [len(s) for s in signatures])
    values = np.concatenate([*signatures, np.empty(0, np.uint64)])
    order = np.argsort(values, kind="stable")
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    return ItemBlock(
        tuple(ids),
        sizes,
        tuple(sorted(set(widths))),
        values[order],
        owners[order],
        np.concatenate([*sets, np.empty(0, np.uint64)]),
        np.concatenate([[0], np.cumsum(sizes)]),
    )


def contained(block: ItemBlock, text: str | bytes | None) -> list[tuple[int | None, int, int]]:
    """(item id, item shingles, shared shingles) of the items that ``text`` contains."""
    if not len(block.signature):
        return []
    hashes = word_hashes(tokens(text))
    shingles = np.unique(np.concatenate([shingle_hashes(hashes, w) for w in block.widths]))
    left = np.searchsorted(block.signature, shingles, "left")
    right = np.searchsorted(block.signature, shingles, "right")
    hit = np.flatnonzero(right > left)
    candidates = {
        int(owner) for i in hit for owner in block.signature_item[left[i] : right[i]]
    }
    found = []
    for c in sorted(candidates):
        members = block.members[block.bounds[c] : block.bounds[c + 1]]
        places = np.minimum(np.searchsorted(shingles, members), len(shingles) - 1)
        shared = int((shingles[places] == members).sum())
        if shared >= CONTAINMENT * len(members) - 1e-9:
            found.append((block.ids[c], len(members), shared))
    return found


def item_blocks(items: DataFrame) -> Iterator[ItemBlock]:
    """The item table in blocks, streamed through the driver."""
    usable = items.select(F.col("item_id").cast("long"), "text").filter(F.col("text").isNotNull())
    block: list[tuple[int | None, str]] = []
    chars = 0
    for row in usable.toLocalIterator():
        if block and (len(block) == BLOCK_ITEMS or chars + len(row["text"]) > BLOCK_CHARS):
            yield index_items(block)
            block, chars = [], 0
        block.append((row["item_id"], row["text"]))
        chars += len(row["text"])
    yield index_items(block)


MATCH_NAMES = ("item_id", "n_item", "n_shared")
MATCH = T.ArrayType(T.StructType([T.StructField(n, T.LongType()) for n in MATCH_NAMES]))
MATCH_TYPE = pa.list_(
    pa.struct([("item_id", pa.int64()), ("n_item", pa.int64()), ("n_shared", pa.int64())])
)


def with_items(docs: DataFrame, block: ItemBlock, name: str) -> DataFrame:
    """The rows of ``docs`` with the items of a block that they contain as a further, last
    column ``name``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [
                [dict(zip(MATCH_NAMES, m, strict=True)) for m in contained(block, raw)]
                for raw in batch["text"].cast(pa.binary()).to_pylist()
            ]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(found, MATCH_TYPE)], names=[*batch.schema.names, name]
            )

    return docs.mapInArrow(run, T.StructType([*docs.schema, T.StructField(name, MATCH)]))


def by_blocks(docs: DataFrame, items: DataFrame, of_block) -> DataFrame:
    """The rows that ``of_block`` gives for the documents and each block of items.

    Blocks come one after the other: only the first is still open when this returns, and
    only if there is no second.
    """
    blocks = item_blocks(items)
    result = of_block(docs, next(blocks))
    for number, block in enumerate(blocks):
        result = written(result, "found") if not number else result
        result = result.unionAll(written(of_block(docs, block), "found"))
    return result


def matches(docs: DataFrame, items: DataFrame) -> DataFrame:
    """One row per document and item it contains: doc_id, item_id, n_item, n_shared."""

    def of_block(rows: DataFrame, block: ItemBlock) -> DataFrame:
        return with_items(rows, block, "items").select("doc_id", F.inline("items"))

    return by_blocks(docs.select("doc_id", "text"), items, of_block)


def decontaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of ``docs`` that contain no item."""
    blocks = item_blocks(items)
    first, second = next(blocks), next(blocks, None)
    if second is None:
        name = free_name(docs, "_items")
        return with_items(docs, first, name).filter(F.size(name) == 0).drop(name)

    def of_block(rows: DataFrame, block: ItemBlock) -> DataFrame:
        found = with_items(rows, block, "items").filter(F.size("items") > 0)
        return found.select("doc_id", *text_key(F.col("text"))).distinct()

    # Equal texts contain equal items, so a text's hash (of 128 bits) stands for it.
    found = by_blocks(docs.select("doc_id", "text"), items, of_block).toDF("i", "a", "b")
    one, two = text_key(F.col("text"))
    same = F.col("doc_id").eqNullSafe(F.col("i")) & (one == F.col("a")) & (two == F.col("b"))
    columns = [F.col(f"d.{c}") for c in docs.columns]
    keyed = docs.select(F.struct(*docs.columns).alias("d"), "doc_id", "text")
    return keyed.join(found.distinct(), same, "left_anti").select(columns)


def text_key(text: Column) -> tuple[Column, Column]:
    return F.xxhash64(text).alias("a"), F.xxhash64(F.lit("items"), text).alias("b")
