"""Ranked lexical search by dense blocked matrix products.

Items ask for documents. A term's weight says how rare it is among all documents; its
impact in a document grows with its frequency there and falls with the document's length;
a score is the sum of weight times impact over the item's terms. Everything but the weight
is integer arithmetic, so scores are exact and equal scores are ties.

1. Items come in blocks of BLOCK_ITEMS and BLOCK_CHARS (a longer item is a block of its
   own); a block's vocabulary is all that documents are compared with.
2. Documents are read once per block. Each leaves its length and the frequencies of the
   block's terms, from which Spark sums the number of documents, their length and how many
   hold each term.
3. Tiles of TILE_ITEMS items have a vocabulary of their own. Their weights make one dense
   matrix, the impacts of TILE_DOCS documents another, and BLAS multiplies them in float64.
   The terms of a tile are cut so that no item's sum over a cut can reach 2 ** 53: every
   product and partial sum is an exact integer in float64. Sums over cuts are int64.
4. Of each tile the ``top`` best of an item stay, all that tie with the last one included
   until they are told apart by id; tasks merge those of their tiles, and a ranked window
   those of the tasks. A task holds one tile of documents.

Terms are runs of letters, digits and all that is not ASCII, with A-Z lower-cased.

Defined results: NULL texts and texts without a term are found by nothing and do not count
as documents. Items without a term find nothing. Items with equal ids, or none, are items
of their own; so are repeated documents. Documents without id come last among equal scores.
Empty tables give an empty result. Other columns do not matter.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starmart.llm.common import written

TOP = 10
BLOCK_ITEMS = 20_000
BLOCK_CHARS = 20_000_000
TILE_ITEMS = 256
TILE_DOCS = 1024
# Terms of one matrix product: bounds its matrices to 8 and 32 MB.
TILE_TERMS = 4096
# What an impact stays below, and what float64 counts to without a gap.
IMPACT = 1_000_000
EXACT = 1 << 53

_ASCII = bytes(range(128))
_BETWEEN = bytes(c for c in _ASCII if not chr(c).isalnum())
_TERM_BYTES = bytes.maketrans(
    _BETWEEN + b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b" " * len(_BETWEEN) + b"abcdefghijklmnopqrstuvwxyz"
)


def terms(raw: bytes | None) -> list[bytes]:
    return (raw or b"").translate(_TERM_BYTES).split()


class Vocabulary(dict):
    def __missing__(self, term: bytes) -> int:
        return -1


@dataclass(frozen=True)
class Items:
    """A block of items: their keys, and what terms each has how often."""

    keys: tuple[int, ...]
    vocabulary: Vocabulary
    asked: tuple[dict[int, int], ...]


def item_blocks(items: DataFrame) -> Iterator[tuple[Items, dict[int, int | None]]]:
    """The item table in blocks, streamed through the driver, with the ids of its keys."""
    rows = items.select(
        F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("binary").alias("raw")
    )
    keys, asked, vocabulary, ids, chars = [], [], Vocabulary(), {}, 0
    for key, row in enumerate(rows.toLocalIterator()):
        own = Counter(terms(row["raw"]))
        if not own:
            continue
        if keys and (len(keys) == BLOCK_ITEMS or chars + len(row["raw"]) > BLOCK_CHARS):
            yield Items(tuple(keys), vocabulary, tuple(asked)), ids
            keys, asked, vocabulary, ids, chars = [], [], Vocabulary(), {}, 0
        keys.append(key)
        ids[key] = row["item_id"]
        asked.append({vocabulary.setdefault(t, len(vocabulary)): n for t, n in own.items()})
        chars += len(row["raw"])
    if keys:
        yield Items(tuple(keys), vocabulary, tuple(asked)), ids


DESCRIBED = "doc_id long, n long, terms array<int>, tfs array<long>"


def described(docs: DataFrame, block) -> DataFrame:
    """doc_id, n (terms) and the frequencies of the block's terms, of documents with terms."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Vocabulary(block.value.vocabulary)
        for batch in batches:
            ids, lengths, found, counts, offsets = [], [], [], [], [0]
            for doc_id, raw in zip(batch["doc_id"].to_pylist(), batch["raw"].to_pylist(), strict=True):
                own = terms(raw)
                if own:
                    places = np.fromiter(map(known.__getitem__, own), np.int32, len(own))
                    values, tfs = np.unique(places[places >= 0], return_counts=True)
                    ids.append(doc_id)
                    lengths.append(len(own))
                    found.append(values)
                    counts.append(tfs)
                    offsets.append(offsets[-1] + len(values))
            none = np.empty(0, np.int64)
            at = pa.array(offsets, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids, pa.int64()),
                    pa.array(lengths, pa.int64()),
                    pa.ListArray.from_arrays(at, pa.array(np.concatenate([*found, none]), pa.int32())),
                    pa.ListArray.from_arrays(at, pa.array(np.concatenate([*counts, none]), pa.int64())),
                ],
                names=["doc_id", "n", "terms", "tfs"],
            )

    return docs.mapInArrow(run, DESCRIBED)


@dataclass(frozen=True)
class Cut:
    """Weights (item, term) of a run of a tile's terms, from ``start`` to ``stop``."""

    start: int
    stop: int
    items: np.ndarray
    terms: np.ndarray
    weights: np.ndarray


@dataclass(frozen=True)
class Tile:
    """Items with a vocabulary of their own, ascending, and their weights by cuts."""

    keys: np.ndarray
    vocabulary: np.ndarray
    cuts: list[Cut]


def exact_cuts(entries: list[tuple[int, int, int]]) -> list[Cut]:
    """Cuts of (term, item, weight), ascending, in which no item's sum of weight times
    impact can reach EXACT.

    A weight that is too large by itself (a term asked for hundreds of thousands of
    times) is dealt out to several cuts.
    """
    cuts, now, sums = [], [], Counter()

    def close() -> None:
        terms, items, weights = (np.array(c) for c in zip(*now, strict=True))
        cuts.append(Cut(now[0][0], now[-1][0] + 1, items, terms, weights.astype(np.float64)))
        now.clear()
        sums.clear()

    for term, item, weight in entries:
        while weight > 0:
            portion = min(weight, (EXACT - 1) // IMPACT - sums[item])
            if now and (portion < weight or term - now[0][0] >= TILE_TERMS):
                close()
                continue
            now.append((term, item, portion))
            sums[item] += portion
            weight -= portion
    if now:
        close()
    return cuts


def item_tiles(block: Items, weight: np.ndarray) -> Iterator[Tile]:
    """The block's items by tiles; ``weight`` holds the weight of each of its terms."""
    for start in range(0, len(block.keys), TILE_ITEMS):
        asked = block.asked[start : start + TILE_ITEMS]
        own = sorted({t for item in asked for t in item})
        place = {t: i for i, t in enumerate(own)}
        entries = sorted(
            (place[t], row, n * int(weight[t])) for row, item in enumerate(asked) for t, n in item.items()
        )
        keys = np.array(block.keys[start : start + TILE_ITEMS])
        yield Tile(keys, np.array(own), exact_cuts(entries))


def tile_scores(tile: Tile, term, owner, impact, n_docs: int) -> np.ndarray:
    """Scores of the tile's items (rows) in documents (columns), of which ``owner`` has
    ``term`` with ``impact``."""
    place = np.minimum(np.searchsorted(tile.vocabulary, term), len(tile.vocabulary) - 1)
    own = np.flatnonzero(tile.vocabulary[place] == term)
    own = own[np.argsort(place[own], kind="stable")]
    place, owner, impact = place[own], owner[own], impact[own]
    scores = np.zeros((len(tile.keys), n_docs), dtype=np.int64)
    for cut in tile.cuts:
        asked = np.zeros((len(tile.keys), cut.stop - cut.start))
        asked[cut.items, cut.terms - cut.start] = cut.weights
        a, b = np.searchsorted(place, [cut.start, cut.stop])
        held = np.zeros((cut.stop - cut.start, n_docs))
        held[place[a:b] - cut.start, owner[a:b]] = impact[a:b]
        scores += (asked @ held).astype(np.int64)
    return scores


def best(scores: np.ndarray, top: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows and columns of the ``top`` positive scores of each row, the first of equals."""
    if scores.shape[1] > top:
        last = np.partition(scores, -top, axis=1)[:, -top]
        rows, columns = np.nonzero(scores >= np.maximum(last, 1)[:, None])
    else:
        rows, columns = np.nonzero(scores > 0)
    order = np.lexsort((columns, -scores[rows, columns], rows))
    rows, columns = rows[order], columns[order]
    place = np.arange(len(rows)) - np.searchsorted(rows, rows)
    return rows[place < top], columns[place < top]


NO_ID = np.iinfo(np.int64).max
FOUND = "key long, doc_id long, score long"


def found(documents: DataFrame, block, weights, n_docs: int, length: int, top: int) -> DataFrame:
    """key (of the item), doc_id and score: the ``top`` of each task and perhaps more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tiles = list(item_tiles(block.value, weights.value))
        for batch in batches:
            # By id, so that the first of equal scores has the smallest.
            known = batch["doc_id"].is_valid().to_numpy(zero_copy_only=False)
            ids = batch["doc_id"].fill_null(NO_ID).to_numpy()
            order = np.lexsort((ids, ~known))
            batch = batch.take(pa.array(order))
            out = []
            for start in range(0, len(batch), TILE_DOCS):
                docs = batch.slice(start, TILE_DOCS)
                sizes, lists = docs["n"].to_numpy(), docs["terms"]
                owner = np.repeat(np.arange(len(docs)), lists.value_lengths().to_numpy())
                term, tf = lists.flatten().to_numpy(), docs["tfs"].flatten().to_numpy()
                m = 100 - 75 + (75 * sizes * n_docs) // length
                impact = (IMPACT * 1000 * tf) // (1000 * tf + 8 * m[owner])
                for tile in tiles:
                    scores = tile_scores(tile, term, owner, impact, len(docs))
                    items, places = best(scores, top)
                    out.append((tile.keys[items], places + start, scores[items, places]))
            if not out:
                continue
            keys, places, scores = (np.concatenate(c) for c in zip(*out, strict=True))
            order = np.lexsort((places, -scores, keys))
            keys, places, scores = keys[order], places[order], scores[order]
            stays = np.arange(len(keys)) - np.searchsorted(keys, keys) < top
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(keys[stays]),
                    batch["doc_id"].take(pa.array(places[stays])),
                    pa.array(scores[stays]),
                ],
                names=["key", "doc_id", "score"],
            )

    return documents.mapInArrow(run, FOUND)


def weight_of(n_docs: int, held: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * held + 1)))


def search(docs: DataFrame, items: DataFrame, top: int = TOP) -> DataFrame:
    """item_id, rank, doc_id and score of the best documents of every item."""
    spark = docs.sparkSession
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("raw")
    )
    results = []
    for block, ids in item_blocks(items):
        shared = spark.sparkContext.broadcast(block)
        documents = written(described(rows, shared), "described")
        n_docs, length = documents.agg(F.count("*"), F.sum("n")).first()
        held = documents.select(F.explode("terms").alias("term")).groupBy("term").count().toArrow()
        holders = np.zeros(len(block.vocabulary), dtype=np.int64)
        holders[held["term"].to_numpy()] = held["count"].to_numpy()
        weights = np.array([weight_of(n_docs, int(df)) for df in holders], dtype=np.int64)
        best_of_tasks = found(
            documents, shared, spark.sparkContext.broadcast(weights), n_docs, length or 1, top
        )
        order = Window.partitionBy("key").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
        ranked = best_of_tasks.withColumn("rank", F.row_number().over(order)).filter(
            F.col("rank") <= top
        )
        names = spark.createDataFrame(list(ids.items()), "key long, item_id long")
        results.append(
            written(ranked.join(names, "key").select("item_id", "rank", "doc_id", "score"), "found")
        )
    if not results:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    whole = results[0]
    for more in results[1:]:
        whole = whole.unionAll(more)
    return whole
