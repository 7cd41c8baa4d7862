"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

Documents are cut into blocks of BLOCK words. A source's target says how many of its
words the mix takes: whole passes over all of its blocks, and a last pass over the first
blocks of a random order. The exact number of blocks that every source owes is then
dealt to the output shards down a binary tree: at each node, the blocks of the left half
of the shards are a multivariate-hypergeometric draw from the node's blocks, as if all
of them had been shuffled and cut. A shard takes its quota of every source as the next
run of the source's random order, so shards are disjoint, and orders what it got by a
hash.

The random order of a source is a hash order. Ranks in it come from counts of hash
ranges that hold about RANGE blocks each, so a source with a third of all rows is spread
over many tasks. The driver holds one number per source and shard; both are bounded.

Defined results: NULL and blank texts have size 0 and are taken 0 times. A NULL source
is a source of its own, the last one. Exact repeats of a row are documents of their own,
of which the blocks are drawn separately. An empty table gives an empty result. Reruns
give the same mix, whatever the partitioning. Columns of the input that are not needed
do not matter.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starmart.llm.common import let, words, written

BLOCK = 256
RANGE = 10_000
WEIGHTS = (1, 2, 3)
MAX_REPEATS = 3
# Blocks of a shard, roughly; the number of shards follows from it within the bounds on
# what the driver holds.
SHARD_BLOCKS = 20_000
MAX_SOURCES = 100_000
MAX_SHARDS = 1 << 16
MAX_QUOTAS = 20_000_000
SEED = 1
# numpy's hypergeometric draws need totals below this.
MAX_DRAW = 900_000_000

UNIT = ["doc_id", "text_hash", "size", "copy"]


def targets(sizes: list[int]) -> list[float]:
    """Words to take of each source, in the order of the sources.

    Weights repeat along the sources and share the total; a source stops at MAX_REPEATS
    times its size and what is left over goes to the others by their weights.
    """
    result = [0.0] * len(sizes)
    rest = float(sum(sizes))
    open_sources = list(range(len(sizes)))
    while open_sources:
        weight = {i: WEIGHTS[i % len(WEIGHTS)] for i in open_sources}
        total = sum(weight.values())
        share = {i: rest * weight[i] / total for i in open_sources}
        full = [i for i in open_sources if share[i] > MAX_REPEATS * sizes[i]]
        if not full:
            for i in open_sources:
                result[i] = share[i]
            break
        for i in full:
            result[i] = float(MAX_REPEATS * sizes[i])
            rest -= result[i]
        open_sources = [i for i in open_sources if i not in set(full)]
    return result


def split_quotas(quotas: np.ndarray, shards: int, seed: int = SEED) -> np.ndarray:
    """Blocks of each source (columns) for each shard (rows); columns sum to ``quotas``."""
    rng = np.random.default_rng(seed)
    out = np.zeros((shards, len(quotas)), dtype=np.int64)

    def split(first: int, count: int, here: np.ndarray) -> None:
        if count == 1:
            out[first] = here
            return
        left = count // 2
        unit = max(1, math.ceil(here.sum() / MAX_DRAW))
        units = here // unit
        drawn = rng.multivariate_hypergeometric(
            units, units.sum() * left // count, method="marginals"
        )
        part = drawn * unit + (here - units * unit) * left // count
        split(first, left, part)
        split(first + left, count - left, here - part)

    if len(quotas):
        split(0, shards, np.asarray(quotas, dtype=np.int64))
    return out


def units(docs: DataFrame) -> DataFrame:
    """doc_id, source, text_hash, size and copy of every document; copy numbers the
    exact repeats of a row."""
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        "source",
        F.xxhash64("text").alias("text_hash"),
        F.regexp_count(F.coalesce("text", F.lit("")), F.lit(r"[^\x20\x09-\x0D]+"))
        .cast("long")
        .alias("size"),
    )
    counted = rows.groupBy(rows.columns).agg(F.count("*").alias("copies"))
    # A row may have any number of repeats, so they are numbered in runs of RANGE, which
    # are dealt to all tasks.
    before = F.sequence(F.lit(0).cast("long"), F.col("copies") - 1, F.lit(RANGE).cast("long"))
    runs = counted.select("*", F.explode(before).alias("before"))
    last = F.least(F.col("copies"), F.col("before") + RANGE)
    return runs.repartition(*rows.columns, "before").select(
        *rows.columns, F.explode(F.sequence(F.col("before") + 1, last)).alias("copy")
    )


def source_table(sized: DataFrame) -> DataFrame:
    """source_no, source, source_size, target and n_ranges of each source (bounded)."""
    n_blocks = F.ceil(F.col("size") / BLOCK)
    totals = sized.groupBy("source").agg(
        F.sum("size").alias("source_size"), F.sum(n_blocks).alias("n_blocks")
    )
    rows = totals.limit(MAX_SOURCES + 1).collect()
    if len(rows) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    rows.sort(key=lambda r: (r["source"] is None, r["source"] or ""))
    wanted = targets([r["source_size"] for r in rows])
    return sized.sparkSession.createDataFrame(
        [
            (
                i,
                r["source"],
                r["source_size"],
                target,
                r["n_blocks"],
                max(1, math.ceil(r["n_blocks"] / RANGE)),
            )
            for i, (r, target) in enumerate(zip(rows, wanted, strict=True))
        ],
        "source_no long, source_name string, source_size long, target double, "
        "n_blocks long, n_ranges long",
    )


def ranked_blocks(sized: DataFrame, sources: DataFrame, seed: int) -> DataFrame:
    """A row per block with its rank in the order of its source and its number of draws.

    Documents without words keep one row without a block, which is not ranked: ranges
    are sized by blocks, so any number of such rows could meet in one.
    """
    n_blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    numbers = F.sequence(F.lit(0), n_blocks - 1)
    block_words = F.least(F.lit(BLOCK), F.col("size") - F.col("block") * BLOCK)
    placed = sized.join(
        F.broadcast(sources), F.col("source").eqNullSafe(F.col("source_name"))
    ).drop("source_name")
    blocks = (
        placed.filter("size > 0")
        .select("*", F.explode(numbers).alias("block"))
        .withColumn("words", block_words)
        .withColumn("place", F.xxhash64(F.lit(seed), *UNIT, "block", "source_no"))
    )
    # The place as a share of all hash values picks the range.
    share = F.col("place") / F.lit(2.0**64) + 0.5
    in_range = F.least(F.floor(share * F.col("n_ranges")), F.col("n_ranges") - 1)
    blocks = blocks.withColumn("range", in_range)
    held = blocks.groupBy("source_no", "range").agg(
        F.count("block").alias("held"), F.sum("words").alias("held_words")
    )
    before = Window.partitionBy("source_no").orderBy("range").rowsBetween(
        Window.unboundedPreceding, -1
    )
    offsets = held.select(
        "source_no",
        "range",
        F.coalesce(F.sum("held").over(before), F.lit(0)).alias("first"),
        F.coalesce(F.sum("held_words").over(before), F.lit(0)).alias("first_words"),
    )
    inside = (
        Window.partitionBy("source_no", "range")
        .orderBy("place", *UNIT, "block")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    ranked = (
        blocks.join(offsets, ["source_no", "range"])
        .withColumn("rank", F.col("first") + F.count("block").over(inside))
        .withColumn(
            "words_before", F.col("first_words") + F.coalesce(F.sum("words").over(inside), F.lit(0))
        )
    )
    passes = F.coalesce(F.floor(F.col("target") / F.col("source_size")), F.lit(0))
    rest = F.col("target") - passes * F.col("source_size")
    last = (F.col("words_before") + F.col("words") / 2 <= rest).cast("int")
    own = ["source", "source_no", "source_size", "target", "n_blocks", *UNIT]
    wordless = placed.filter("size = 0").select(
        *own,
        F.lit(None).cast("int").alias("block"),
        *[F.lit(0).cast("long").alias(c) for c in ("words", "rank", "draws")],
    )
    drawn = ranked.select(*own, "block", "words", "rank", (passes + last).alias("draws"))
    return drawn.unionByName(wordless)


def shard_of(draw: Column, ends: Column) -> Column:
    """The number of ends up to ``draw``, by halving steps; ``ends`` ascend."""
    steps = F.array(*[F.lit(1 << k) for k in reversed(range(MAX_SHARDS.bit_length()))])
    return F.aggregate(
        steps,
        F.lit(0),
        lambda at, step: F.when(F.get(ends, at + step - 1) <= draw, at + step).otherwise(at),
    )


def drawn_blocks(docs: DataFrame, shards: int | None = None, seed: int = SEED) -> DataFrame:
    """A row per draw: the block, its pass over the source, its shard, its order there.

    A document of which nothing is drawn keeps one row with NULL for those.
    """
    sized = written(units(docs), "units")
    sources = source_table(sized)
    ranked = written(ranked_blocks(sized, sources, seed), "ranked_blocks")
    owed = dict(ranked.groupBy("source_no").agg(F.sum("draws")).collect())
    numbers = sorted(owed)
    most = min(MAX_SHARDS, MAX_QUOTAS // max(len(numbers), 1))
    shards = shards or min(most, math.ceil(sum(owed.values()) / SHARD_BLOCKS) or 1)
    if not 1 <= shards <= most:
        raise ValueError(f"shards must be between 1 and {most}")
    quotas = split_quotas(np.array([owed[n] for n in numbers], dtype=np.int64), shards, seed)
    # Where the run of the next shard begins, for each source.
    ends = np.cumsum(quotas, axis=0)
    bounds = docs.sparkSession.createDataFrame(
        [(n, ends[:, i].tolist()) for i, n in enumerate(numbers)],
        "source_no long, ends array<long>",
    )
    passes = F.when(F.col("draws") > 0, F.sequence(F.lit(0), F.col("draws").cast("int") - 1))
    draw = F.col("pass") * F.col("n_blocks") + F.col("rank")
    order = F.xxhash64(F.lit(seed + 1), *UNIT, "block", "pass")
    return (
        ranked.join(F.broadcast(bounds), "source_no")
        .select("*", F.explode_outer(passes).alias("pass"))
        .withColumn("draw", draw)
        .withColumn(
            "shard", F.when(F.col("pass").isNotNull(), shard_of(F.col("draw"), F.col("ends")))
        )
        .withColumn("shard_order", F.when(F.col("pass").isNotNull(), order))
        .drop("ends", "draws", "n_blocks", "rank", "draw")
    )


def taken(docs: DataFrame, shards: int | None = None, seed: int = SEED) -> DataFrame:
    """doc_id, size, source_size, target, taken (words in the mix) of every document, and
    where the tree puts them: first_shard and last_shard, and dealt, the exclusive or of
    a hash of each draw (shard, block, pass). These are NULL if nothing is drawn."""
    drawn = F.sum(F.when(F.col("pass").isNotNull(), F.col("words")).otherwise(0))
    draw = F.when(F.col("pass").isNotNull(), F.xxhash64("shard", "block", "pass"))
    return (
        drawn_blocks(docs, shards, seed)
        .groupBy(*UNIT, "source_no", "source_size", "target")
        .agg(
            drawn.cast("long").alias("taken"),
            F.min("shard").alias("first_shard"),
            F.max("shard").alias("last_shard"),
            F.bit_xor(draw).alias("dealt"),
        )
        .select(
            *["doc_id", "size", "source_size", "target", "taken"],
            *["first_shard", "last_shard", "dealt"],
        )
    )


def mix(docs: DataFrame, shards: int | None = None, seed: int = SEED) -> DataFrame:
    """The mix itself: shard, shard_order, doc_id, source, block, pass and text of every
    drawn block; each shard lies in one partition, in its order."""
    texts = docs.select(
        F.col("doc_id").cast("long").alias("d"),
        F.col("source").alias("s"),
        F.xxhash64("text").alias("h"),
        "text",
    ).dropDuplicates(["d", "s", "h"])
    owner = ["doc_id", "source", "text_hash", "copy"]
    drawn = drawn_blocks(docs, shards, seed).filter("pass IS NOT NULL")
    lists = drawn.groupBy(owner).agg(
        F.collect_list(F.struct("shard", "shard_order", "block", "pass")).alias("drawn")
    )
    same = (
        F.col("doc_id").eqNullSafe(F.col("d"))
        & F.col("source").eqNullSafe(F.col("s"))
        & (F.col("text_hash") == F.col("h"))
    )

    def block_texts(w: Column) -> Column:
        def block(d: Column) -> Column:
            text = F.array_join(F.slice(w, d["block"] * BLOCK + 1, BLOCK), " ")
            return F.struct(
                *[d[c].alias(c) for c in ("shard", "shard_order", "block", "pass")],
                text.alias("text"),
            )

        return F.transform("drawn", block)

    return (
        lists.join(texts, same)
        .select("doc_id", "source", F.inline(let(words(F.col("text")), block_texts)))
        .repartition("shard")
        .sortWithinPartitions("shard", "shard_order")
    )
