"""Near-duplicate documents by bottom-k sketches from one hash function.

A document is the set of its five-word shingles (A-Z lower-cased); its sketch is the
SKETCH smallest hashes of the set. Two sets that are similar enough share at least
``needed`` values of their sketches, so it is enough to compare documents that share one
of a sketch's values that remain when the ``needed - 1`` most frequent ones are left
aside: very common passages generate nothing. Inverted lists of those values give the
candidates, the similarity estimated from the union of two sketches filters them, and
the exact similarity of the whole sets decides.

Documents with equal sets are one node throughout. Long lists are not paired off:

1. in every list, all members are compared with one hub, its most typical member;
2. the links so confirmed are joined into components; members of lists longer than CROWD
   are also compared with the hubs of some buckets of like sketches, which joins most of a
   large group that has no typical member;
3. in lists of up to CROWD members, members of different components are compared, all of
   them;
4. members of longer lists (large groups of copies, some of them beyond the threshold)
   are listed anew, under the rarest shingles of their whole sets. Of a set of n, so
   many are taken that any two similar sets must share one; a sixth of n or less. Members
   of different components within those lists are compared.

Two similar documents are thus compared or already in one component, and no link between
components is lost. Groups of many copies cost a few comparisons per copy.

The only inexact step is statistical: two sets at the threshold share fewer than
``needed`` sketch values, or are estimated below the margin, about once in ten million
pairs (chance_of_a_miss).

Defined results: NULL and blank texts have an empty set and are linked with nothing; with
fewer than five words the whole sequence is the one shingle. Rows without id are linked
with nothing. Rows with the same id are one document, with the links of all its texts.
An empty table gives an empty result. Columns that are not needed do not matter.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmart.llm.common import let, shingle_set, written
from starmart.llm.components import components

SKETCH = 32
# Of 32 values in the union's sketch, sets at a similarity of 0.85 share fewer than
# NEEDED, or an estimate falls below the threshold by more than MARGIN, hardly ever.
NEEDED = 14
MARGIN = 0.4
# The same for the members of crowded lists: their longer sketches are more exact.
CROWD_SKETCH = 128
CROWD_MARGIN = 0.2
# Buckets in which a member of crowded lists is compared with one more hub: texts that
# have the BAND smallest values of their sketches, newly hashed, in common.
BUCKETS = 32
BAND = 8
SIMILARITY = 85
# Lists that a document takes part in for the first step, and the longest lists of which
# the sketches alone decide who is compared.
HUBS = 4
CROWD = 50


def shingles(text: str | bytes | None) -> np.ndarray:
    raw = text.encode("utf-8", "replace") if isinstance(text, str) else text or b""
    return shingle_set(raw.lower().split())


def smallest(values: np.ndarray, count: int) -> np.ndarray:
    """The first hashes of a sorted set; a slice would hold the whole set in memory."""
    return values[:count].view(np.int64).copy()


def sketch(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, set_key (the set's identity) and sketch of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, keys, sketches = [], [], []
            for raw in batch["raw"]:
                values = shingles(raw.as_py())
                sizes.append(len(values))
                keys.append(hashlib.md5(values.tobytes()).digest() if len(values) else None)
                sketches.append(smallest(values, SKETCH))
            yield pa.RecordBatch.from_arrays(
                [
                    batch["doc_id"],
                    pa.array(sizes, pa.int64()),
                    pa.array(keys, pa.binary()),
                    pa.array(sketches, pa.list_(pa.int64())),
                ],
                names=["doc_id", "n_shingles", "set_key", "sketch"],
            )

    schema = "doc_id long, n_shingles long, set_key binary, sketch array<long>"
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary").alias("raw"))
    return rows.mapInArrow(run, schema)


def needed(n: Column, percent: int) -> Column:
    """Sketch values that a similar set shares, for a set of n shingles."""
    return F.least(F.lit(NEEDED), F.ceil(n * percent / 100)).cast("int")


def value_lists(nodes: DataFrame, percent: int) -> DataFrame:
    """value, node, n, nth, weight: the sketch values under which a node is listed.

    Values that only one node has come first in its order and are counted, not listed.
    The weight says how common the node's values are; the original of many copies has
    the largest.
    """
    values = nodes.select("node", "n", F.explode("sketch").alias("value"))
    common = values.groupBy("value").agg(F.count("*").alias("held")).filter("held > 1")
    ordered = (
        values.join(common, "value")
        .groupBy("node", "n")
        .agg(
            F.sort_array(F.collect_list(F.struct("held", "value"))).alias("common"),
            F.sum("held").alias("weight"),
        )
    )
    size = F.least(F.col("n"), F.lit(SKETCH)).cast("int")
    listed = F.col("size") - needed(F.col("n"), percent) + 1
    alone = F.col("size") - F.size("common")
    return (
        ordered.withColumn("size", size)
        .withColumn("left", F.greatest(listed - alone, F.lit(0)))
        .select(
            "node", "n", "weight", F.posexplode(F.slice("common", 1, F.col("left"))).alias("nth", "c")
        )
        .select(F.col("c.value").alias("value"), "node", "n", "nth", "weight")
    )


def similar_sizes(a: Column, b: Column, percent: int) -> Column:
    return F.least(a, b) * 100 >= F.greatest(a, b) * percent


def ordered_pairs(pairs: DataFrame, a: str, b: str) -> DataFrame:
    return pairs.select(F.least(a, b).alias("x"), F.greatest(a, b).alias("y")).distinct()


def hub_pairs(lists: DataFrame, percent: int) -> DataFrame:
    """Pairs of a node and the hub of a list it is in."""
    hubs = lists.groupBy("value").agg(F.max(F.struct("weight", "node", "n")).alias("hub"))
    with_hub = (
        lists.filter(F.col("nth") < HUBS)
        .join(hubs, "value")
        .filter(F.col("node") != F.col("hub.node"))
        .filter(similar_sizes(F.col("n"), F.col("hub.n"), percent))
        .select("node", F.col("hub.node").alias("hub"))
    )
    return ordered_pairs(with_hub, "node", "hub")


def remaining_pairs(
    lists: DataFrame, found: DataFrame, sketches: DataFrame, size: int, lowest: float, percent: int
) -> DataFrame:
    """Pairs of nodes that share a list but not a component, if their sketches (node,
    sketch, of ``size`` values) do not rule them out.

    Lists have value, node, n, after (how many values of the set come after this one, the
    rarest first; NULL if unknown) and the flags indexed and probing: of two nodes, the
    one with more shingles must be probing and the other one indexed.
    """
    placed = (
        lists.join(found, "node", "left")
        .withColumn("component", F.coalesce("component", F.col("node")))
        .select("value", "node", "n", "after", "component", "indexed", "probing")
    )
    # Members of the list's largest component meet only those outside it.
    largest = (
        placed.groupBy("value", "component")
        .count()
        .groupBy("value")
        .agg(F.max(F.struct("count", "component"))["component"].alias("major"), F.count("*").alias("k"))
        .filter("k > 1")
        .select("value", "major")
    )
    open_lists = placed.join(largest, "value").join(sketches.hint("merge"), "node")
    open_lists = written(open_lists, "open_lists")
    minor = F.col("component") != F.col("major")
    a = open_lists.filter(minor).drop("major")
    b = open_lists.select(
        "value",
        F.col("node").alias("other"),
        F.col("n").alias("other_n"),
        F.col("after").alias("other_after"),
        F.col("sketch").alias("other_sketch"),
        F.col("component").alias("other_component"),
        F.col("indexed").alias("other_indexed"),
        F.col("probing").alias("other_probing"),
    )
    fits = F.when(
        F.col("n") >= F.col("other_n"), F.col("probing") & F.col("other_indexed")
    ).otherwise(F.col("indexed") & F.col("other_probing"))
    # What comes after the first common value bounds what two sets can share.
    most = 1 + F.least("after", "other_after")
    enough = most * (100 + percent) >= percent * (F.col("n") + F.col("other_n"))
    pairs = a.join(b, "value").filter(
        (F.col("component") != F.col("other_component"))
        & fits
        & (F.col("after").isNull() | enough)
        & similar_sizes(F.col("n"), F.col("other_n"), percent)
        & may_be_similar(F.col("sketch"), F.col("other_sketch"), size, lowest)
    )
    return ordered_pairs(pairs, "node", "other")


def bucket_pairs(sketches: DataFrame, found: DataFrame) -> DataFrame:
    """Pairs of a node and the hub of a bucket, in different components so far."""
    band = F.expr(
        f"slice(sort_array(transform(sketch, v -> xxhash64(bucket, v))), 1, {BAND})"
    )
    placed = (
        sketches.join(found, "node", "left")
        .withColumn("bucket", F.explode(F.sequence(F.lit(1), F.lit(BUCKETS))))
        .select(
            F.xxhash64("bucket", band).alias("value"),
            "node",
            F.coalesce("component", F.col("node")).alias("component"),
        )
    )
    placed = written(placed, "buckets")
    order = F.struct(F.xxhash64("value", "node").alias("h"), "node", "component")
    hubs = placed.groupBy("value").agg(F.max(order).alias("hub"))
    pairs = (
        placed.join(hubs, "value")
        .filter(F.col("component") != F.col("hub.component"))
        .select("node", F.col("hub.node").alias("hub"))
    )
    return ordered_pairs(pairs, "node", "hub")


def crowd_sketches(texts: DataFrame) -> DataFrame:
    """node and its CROWD_SKETCH smallest hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [smallest(shingles(raw.as_py()), CROWD_SKETCH) for raw in batch["raw"]]
            yield pa.RecordBatch.from_arrays(
                [batch["node"], pa.array(found, pa.list_(pa.int64()))], names=["node", "sketch"]
            )

    return texts.mapInArrow(run, "node long, sketch array<long>")


def whole_lists(texts: DataFrame, percent: int) -> DataFrame:
    """value, node, n, after, indexed and probing: the rarest shingles of whole sets.

    Sets of n >= m shingles share p / (100 + p) * (n + m) of them at least; each side is
    listed under one more than it can lack, rarest first.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for node, raw in zip(batch["node"].to_pylist(), batch["raw"], strict=True):
                values = shingles(raw.as_py()).view(np.int64)
                columns = [np.full(len(values), node), np.full(len(values), len(values)), values]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.int64()) for c in columns], names=["node", "n", "value"]
                )

    values = written(texts.mapInArrow(run, "node long, n long, value long"), "whole_sets")
    held = values.groupBy("value").agg(F.count("*").alias("held")).filter("held > 1")
    ordered = (
        values.join(held, "value")
        .groupBy("node", "n")
        .agg(F.sort_array(F.collect_list(F.struct("held", "value"))).alias("common"))
    )
    alone = F.col("n") - F.size("common")
    probe = F.col("n") - F.ceil(F.col("n") * percent / 100) + 1
    index = F.col("n") - F.ceil(F.col("n") * 2 * percent / (100 + percent)) + 1
    listed = F.greatest(probe - alone, F.lit(0)).cast("int")
    return (
        ordered.select(
            "node", "n", alone.alias("alone"), (index - alone).alias("index_end"),
            F.posexplode(F.slice("common", 1, listed)).alias("nth", "c"),
        )
        .select(
            F.col("c.value").alias("value"), "node", "n",
            (F.col("n") - F.col("alone") - F.col("nth") - 1).alias("after"),
            (F.col("nth") < F.col("index_end")).alias("indexed"), F.lit(True).alias("probing"),
        )
    )


def may_be_similar(s: Column, t: Column, size: int, lowest: float) -> Column:
    """Whether the sketch of the union, of which the shared part is known, allows it."""
    union = F.slice(F.sort_array(F.array_union(s, t)), 1, size)
    common = F.array_intersect(s, t)
    return let(union, lambda u: F.size(F.array_intersect(u, common)) >= lowest * F.size(u))


def estimated(pairs: DataFrame, nodes: DataFrame, size: int, lowest: float) -> DataFrame:
    """The pairs that their sketches, of ``size`` values, do not rule out."""
    x = nodes.select(F.col("node").alias("x"), F.col("sketch").alias("s"))
    y = nodes.select(F.col("node").alias("y"), F.col("sketch").alias("t"))
    near = may_be_similar(F.col("s"), F.col("t"), size, lowest)
    return pairs.join(x, "x").join(y, "y").filter(near).select("x", "y")


def verified(pairs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """The pairs whose whole sets are similar enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep, last, left = [], None, None
            for x, s, t in zip(batch["x"].to_pylist(), batch["s"], batch["t"], strict=True):
                if x != last:
                    last, left = x, shingles(s.as_py())
                right = shingles(t.as_py())
                shared = len(np.intersect1d(left, right, assume_unique=True))
                keep.append(100 * shared >= percent * (len(left) + len(right) - shared))
            kept = batch.filter(pa.array(keep, pa.bool_()))
            yield kept.select(["x", "y"])

    x = texts.select(F.col("node").alias("x"), F.col("raw").alias("s"))
    y = texts.select(F.col("node").alias("y"), F.col("raw").alias("t"))
    return pairs.join(x, "x").join(y, "y").select("x", "y", "s", "t").mapInArrow(
        run, "x long, y long"
    )


def stars(found: DataFrame) -> DataFrame:
    """The links that say what components found, in place of those it was given."""
    return found.select(F.col("node").alias("x"), F.col("component").alias("y"))


def near_duplicates(docs: DataFrame, percent: int = SIMILARITY) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every row."""
    sketched = written(sketch(docs), "sketches")
    members = sketched.filter("doc_id IS NOT NULL AND n_shingles > 0")
    # One node per set: its smallest id.
    leaders = members.groupBy("set_key").agg(F.min("doc_id").alias("node"))
    sketch_of_node = F.when(F.col("doc_id") == F.col("node"), F.col("sketch")).alias("sketch")
    owned = members.join(leaders, "set_key").select(
        "doc_id", "node", "set_key", F.col("n_shingles").alias("n"), sketch_of_node
    )
    owned = written(owned, "owned")
    copies = owned.filter("doc_id != node").select(
        F.col("doc_id").alias("x"), F.col("node").alias("y")
    )
    nodes = written(
        owned.filter("doc_id = node")
        .dropDuplicates(["node", "set_key"])
        .select("node", "n", "sketch"),
        "nodes",
    )
    lists = written(value_lists(nodes, percent), "value_lists")
    shared = lists.groupBy("value").agg(F.count("*").alias("held")).filter("held > 1")
    lists = written(lists.join(shared, "value"), "shared_lists")
    listed = lists.select("node").distinct()
    texts = written(
        docs.select(
            F.col("doc_id").cast("long").alias("node"), F.col("text").cast("binary").alias("raw")
        ).join(listed, "node", "left_semi"),
        "listed_texts",
    )

    lowest, crowd_lowest = percent / 100 - MARGIN, percent / 100 - CROWD_MARGIN
    hubs = estimated(hub_pairs(lists, percent), nodes, SKETCH, lowest)
    hub_links = written(
        verified(written(hubs, "hub_candidates"), texts, percent), "hub_links"
    )
    found = components(hub_links)
    both = F.lit(True)
    short = lists.filter(F.col("held") <= CROWD).withColumns(
        {"indexed": both, "probing": both, "after": F.lit(None).cast("long")}
    )
    crowd = lists.filter(F.col("held") > CROWD).select("node").distinct()
    crowd_texts = written(texts.join(crowd, "node", "left_semi"), "crowd_texts")
    crowd_sketch = written(crowd_sketches(crowd_texts), "crowd_sketches")
    buckets = estimated(
        bucket_pairs(crowd_sketch, found), crowd_sketch, CROWD_SKETCH, crowd_lowest
    )
    bucket_links = written(
        verified(written(buckets, "bucket_candidates"), crowd_texts, percent), "bucket_links"
    )
    found = components(stars(found).unionAll(bucket_links))
    whole = whole_lists(crowd_texts, percent)
    rest = remaining_pairs(
        short, found, nodes.select("node", "sketch"), SKETCH, lowest, percent
    ).unionAll(
        remaining_pairs(whole, found, crowd_sketch, CROWD_SKETCH, crowd_lowest, percent)
    )
    rest_links = written(
        verified(written(rest.distinct(), "rest_candidates"), texts, percent), "rest_links"
    )
    joined = components(stars(found).unionAll(rest_links).unionAll(copies))
    component = F.coalesce("component", F.when(F.col("doc_id").isNotNull(), F.col("doc_id")))
    return (
        sketched.select("doc_id", "n_shingles")
        .join(joined.withColumnRenamed("node", "doc_id"), "doc_id", "left")
        .select(
            "doc_id",
            "n_shingles",
            component.alias("component_id"),
            F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept"),
        )
    )


def deduplicated(docs: DataFrame, percent: int = SIMILARITY) -> DataFrame:
    """The rows of ``docs`` with one document of each component, the one of smallest id.

    Of several rows with that id one stays. Rows without id all stay.
    """
    kept = near_duplicates(docs, percent).filter("kept AND doc_id IS NOT NULL")
    known = docs.filter("doc_id IS NOT NULL")
    one_each = known.join(kept.select("doc_id").distinct(), "doc_id", "left_semi")
    return one_each.dropDuplicates(["doc_id"]).unionByName(docs.filter("doc_id IS NULL"))


def chance_of_a_miss(similarity: float = SIMILARITY / 100) -> float:
    """The chance that sets of this similarity share fewer than NEEDED sketch values."""
    return sum(
        math.comb(SKETCH, i) * similarity**i * (1 - similarity) ** (SKETCH - i)
        for i in range(NEEDED)
    )
