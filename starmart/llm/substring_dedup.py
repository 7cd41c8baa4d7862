"""Substring dedup by automata of recurring passages.

A passage recurs where a window of WINDOW words occurs at an earlier place too: in a
document of smaller id, or further up in the same one. Every word inside such a window
is removed; the first occurrence stays.

1. Each window has an anchor, the smallest hash among its runs of SHINGLE words. Equal
   windows have equal anchors, and neighbouring windows mostly share theirs, so a
   document has about one anchor for eight words. Anchors that occur once in all
   documents rule their windows out. Those that recur set the bits of a filter of fixed
   size, by which documents drop nearly all others before they are joined.
2. Around the anchors that recur, documents give out contexts: the words of all
   neighbouring windows with that anchor. Contexts are dealt out by anchor. An anchor
   with very many contexts is dealt out over salts.
3. A task takes the contexts of a few thousand anchors at a time. It confirms by hash
   which windows recur, compiles these, as words, into an Aho-Corasick automaton, and
   streams the contexts with one of them through it in the order of their places. All
   occurrences of a window are located; every one but the first becomes a removal. Where
   an anchor is salted, its windows are counted by hash over all salts beforehand, so
   that an automaton holds recurring windows only.
4. The first occurrences within each salt are compared once more, by window.
5. Documents cut out the union of their removals.

Whole documents that repeat an earlier one word for word need none of this: each of
their windows starts earlier.

Defined results: NULL and blank texts have no words. Documents shorter than a window
lose nothing. Rows without id take no part: they lose nothing and are no occurrence. Rows
with the same id are one document, so equal places in both are equally early; repeated rows
give out their contexts once. An empty table gives an empty result. Columns that are not
needed do not matter.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.llm.common import filter_bits, has_bit, shingle_hashes, word_hashes, written

WINDOW = 20
SHINGLE = 5
# Contexts that one automaton serves, and contexts of one anchor before it is salted.
SHARD = 4000
SALT_ROWS = 50_000
# The filters of recurring hashes have 2 ** FILTER_BITS bits.
FILTER_BITS = 27

KEY = ["doc_id", "text_hash"]


def anchors(hashes: np.ndarray) -> np.ndarray:
    """The anchor of each window: the smallest of its shingle hashes."""
    least = shingle_hashes(hashes, SHINGLE)
    span = WINDOW - SHINGLE + 1
    if len(least) < span:
        return np.empty(0, dtype=np.uint64)
    reach = 1
    while reach < span:
        step = min(reach, span - reach)
        least = np.minimum(least[:-step], least[step:])
        reach += step
    return least


def identified(docs: DataFrame) -> DataFrame:
    return docs.filter("doc_id IS NOT NULL").select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.xxhash64("text").alias("text_hash"),
        F.col("text").cast("binary").alias("raw"),
    )


def anchored(docs: DataFrame) -> DataFrame:
    """doc_id, text_hash, n_words, words_sha (of the words joined by a space) and anchors
    with the number of places each has in the document, of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_words, shas, found, counts, offsets = [], [], [], [], [0]
            for raw in batch["raw"].to_pylist():
                tokens = (raw or b"").split()
                n_words.append(len(tokens))
                shas.append(hashlib.sha256(b" ".join(tokens)).digest())
                hashes = word_hashes(tokens)
                values, places = np.unique(shingle_hashes(hashes, SHINGLE), return_counts=True)
                own = np.unique(anchors(hashes))
                found.append(own)
                counts.append(places[np.searchsorted(values, own)])
                offsets.append(offsets[-1] + len(own))
            pairs = pa.StructArray.from_arrays(
                [
                    pa.array(np.concatenate([*found, np.empty(0, np.uint64)]).view(np.int64)),
                    pa.array(np.concatenate([*counts, np.empty(0, int)]).astype(np.int32)),
                ],
                names=["anchor", "places"],
            )
            yield pa.RecordBatch.from_arrays(
                [
                    batch["doc_id"],
                    batch["text_hash"],
                    pa.array(n_words, pa.int64()),
                    pa.array(shas, pa.binary()),
                    pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pairs),
                ],
                names=[*KEY, "n_words", "words_sha", "anchors"],
            )

    return docs.mapInArrow(
        run,
        "doc_id long, text_hash long, n_words long, words_sha binary, "
        "anchors array<struct<anchor:long,places:int>>",
    )


def copies(described: DataFrame) -> DataFrame:
    """doc_id, text_hash of the documents that repeat an earlier one word for word."""
    long_enough = described.filter(F.col("n_words") >= WINDOW).select(*KEY, "words_sha")
    first = long_enough.groupBy("words_sha").agg(F.min("doc_id").alias("first"))
    return (
        long_enough.join(first, "words_sha").filter("first < doc_id").select(KEY).distinct()
    )


def recurring_anchors(described: DataFrame) -> DataFrame:
    """doc_id, text_hash and anchors (with their number of salts) of the documents that
    have recurring anchors."""
    # Copies word for word have one hash unless their white space differs.
    recurring = (
        described.select("text_hash", F.inline("anchors"))
        .groupBy("anchor")
        .agg(
            F.min("text_hash").alias("low"),
            F.max("text_hash").alias("high"),
            F.max("places").alias("most"),
            F.sum("places").alias("total"),
        )
        .filter("low != high OR most > 1")
        .select("anchor", F.ceil(F.col("total") / SALT_ROWS).cast("int").alias("salts"))
    )
    recurring = written(recurring, "recurring_anchors")
    bits = filter_bits(recurring.select(F.col("anchor").alias("hash")), FILTER_BITS)
    return (
        passing(described, described.sparkSession.sparkContext.broadcast(bits))
        .join(recurring, "anchor")
        .groupBy(KEY)
        .agg(F.collect_set(F.struct("anchor", "salts")).alias("anchors"))
    )


def passing(described: DataFrame, bits) -> DataFrame:
    """doc_id, text_hash and anchor of the anchors whose bit is set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.frombuffer(bits.value, np.uint64)
        for batch in batches:
            lists = batch["anchors"]
            own = lists.flatten().to_numpy().view(np.uint64)
            keep = np.flatnonzero(has_bit(table, own))
            owner = np.repeat(np.arange(len(batch)), lists.value_lengths().to_numpy())[keep]
            yield pa.RecordBatch.from_arrays(
                [
                    batch["doc_id"].take(pa.array(owner)),
                    batch["text_hash"].take(pa.array(owner)),
                    pa.array(own[keep].view(np.int64)),
                ],
                names=[*KEY, "anchor"],
            )

    rows = described.select(*KEY, F.col("anchors.anchor").alias("anchors"))
    return rows.mapInArrow(run, "doc_id long, text_hash long, anchor long")


CONTEXT = "doc_id long, text_hash long, anchor long, salts int, start int, context binary"


def contexts(texts: DataFrame) -> DataFrame:
    """The contexts of the recurring anchors of each document (doc_id, text_hash, raw,
    anchors): a run of windows with one anchor, from word ``start`` on."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc_id, text_hash, raw, own in zip(
                *[batch[c].to_pylist() for c in (*KEY, "raw", "anchors")], strict=True
            ):
                tokens = raw.split()
                salts = {a["anchor"]: a["salts"] for a in own}
                values = anchors(word_hashes(tokens)).view(np.int64)
                cuts = np.flatnonzero(values[1:] != values[:-1]) + 1
                for begin, end in zip([0, *cuts], [*cuts, len(values)], strict=True):
                    anchor = int(values[begin])
                    if anchor in salts:
                        words = b" ".join(tokens[begin : end - 1 + WINDOW])
                        rows.append((doc_id, text_hash, anchor, salts[anchor], int(begin), words))
                    if len(rows) >= 10_000:
                        yield batch_of(CONTEXT_TYPES, rows)
                        rows = []
            yield batch_of(CONTEXT_TYPES, rows)

    return texts.mapInArrow(run, CONTEXT)


CONTEXT_TYPES = [
    ("doc_id", pa.int64()),
    ("text_hash", pa.int64()),
    ("anchor", pa.int64()),
    ("salts", pa.int32()),
    ("start", pa.int32()),
    ("context", pa.binary()),
]
FOUND_TYPES = [
    ("doc_id", pa.int64()),
    ("text_hash", pa.int64()),
    ("start", pa.int32()),
    ("stop", pa.int32()),
    ("window", pa.binary()),
]
FOUND = "doc_id long, text_hash long, start int, stop int, window binary"


def batch_of(types: list, rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [()] * len(types)
    arrays = [pa.array(c, t) for c, (_, t) in zip(columns, types, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, names=[name for name, _ in types])


def window_hashes(found: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of all windows of these contexts, in order, and whose each is."""
    if not found:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    hashes = shingle_hashes(word_hashes(b" ".join(found).split(b" ")), WINDOW)
    owner = np.repeat(np.arange(len(found)), [words.count(b" ") + 1 for words in found])
    begin, end = owner[: len(hashes)], owner[WINDOW - 1 :]
    return hashes[begin == end], begin[begin == end]


def recurring_windows(shard: list[tuple], elsewhere: np.ndarray | None) -> list[np.ndarray]:
    """Of each context, which of its windows may recur, by their hashes.

    With salts, a window may recur in another shard; ``elsewhere`` has the bits of those
    that do so.
    """
    hashes, owner = window_hashes([words for *_, words in shard])
    _, which, times = np.unique(hashes, return_inverse=True, return_counts=True)
    recurs = times[which] > 1
    if elsewhere is not None:
        salted = np.array([salts > 1 for _, _, salts, _, _ in shard])
        recurs |= salted[owner] & has_bit(elsewhere, hashes)
    first = np.searchsorted(owner, np.arange(len(shard)))
    places = np.flatnonzero(recurs)
    ends = np.searchsorted(owner[places], np.arange(len(shard)), side="right")
    return np.split(places - first[owner[places]], ends[:-1])


def locate(shard: list[tuple], elsewhere: np.ndarray | None = None) -> list[tuple]:
    """Removals (window NULL) and salted first occurrences of a shard's windows.

    A context is (doc_id, text_hash, salts, start, words); the contexts of an anchor lie
    together in one shard. Hashes choose the windows that the automaton gets; it decides,
    by words, where each of them occurs.
    """
    numbers: dict[bytes, int] = {}
    windows: dict[tuple, int] = {}
    sequences: list[tuple | None] = []
    for (*_, words), places in zip(shard, recurring_windows(shard, elsewhere), strict=True):
        sequence = None
        if len(places):
            sequence = tuple([numbers.setdefault(w, len(numbers)) for w in words.split(b" ")])
            for at in places.tolist():
                windows.setdefault(sequence[at : at + WINDOW], len(windows))
        sequences.append(sequence)
    if not windows:
        return []
    automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS, ahocorasick.KEY_SEQUENCE)
    for window, number in windows.items():
        automaton.add_word(window, number)
    automaton.make_automaton()
    first: list[tuple | None] = [None] * len(windows)
    del windows
    out = []
    streamed = [i for i, sequence in enumerate(sequences) if sequence]
    for i in sorted(streamed, key=lambda i: (shard[i][0], shard[i][3])):
        doc_id, text_hash, salts, start, words = shard[i]
        removed = []
        for end, number in automaton.iter(sequences[i]):
            place = (doc_id, start + end - WINDOW + 1)
            if first[number] is None:
                first[number] = place
                if salts > 1:
                    at = end - WINDOW + 1
                    window = b" ".join(words.split(b" ")[at : at + WINDOW])
                    out.append((doc_id, text_hash, place[1], place[1] + WINDOW, window))
            elif first[number] < place:
                removed.append(place[1])
        out += [(doc_id, text_hash, a, b, None) for a, b in joined(removed)]
    return out


def joined(starts: list[int]) -> list[tuple[int, int]]:
    """The word ranges that windows at these ascending starts cover."""
    ranges: list[tuple[int, int]] = []
    for start in starts:
        if ranges and start <= ranges[-1][1]:
            ranges[-1] = (ranges[-1][0], start + WINDOW)
        else:
            ranges.append((start, start + WINDOW))
    return ranges


def located(found: DataFrame, by: list[str], bits=None) -> DataFrame:
    """``locate`` over contexts dealt out and ordered by the columns ``by``.

    A task cuts its rows into shards between two anchors; it holds one shard at a time.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, last = [], None
        elsewhere = np.frombuffer(bits.value, np.uint64) if bits else None
        for batch in batches:
            columns = [
                batch[c].to_pylist()
                for c in ("doc_id", "text_hash", "salts", "start", "context", *by)
            ]
            for row in zip(*columns, strict=True):
                if len(shard) >= SHARD and row[5:] != last:
                    yield batch_of(FOUND_TYPES, locate(shard, elsewhere))
                    shard = []
                shard.append(row[:5])
                last = row[5:]
        if shard:
            yield batch_of(FOUND_TYPES, locate(shard, elsewhere))

    return found.repartition(*by).sortWithinPartitions(*by).mapInArrow(run, FOUND)


def removals(docs: DataFrame, described: DataFrame, gone: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The texts of documents with recurring anchors, and the word ranges to remove."""
    wanted = recurring_anchors(described).join(gone, KEY, "left_anti")
    times = described.groupBy(KEY).agg(F.count("*").alias("times"))
    wanted = written(wanted.join(times, KEY), "wanted")
    once = identified(docs).join(wanted.filter("times = 1").drop("times"), KEY)
    often = identified(docs).join(wanted.filter("times > 1").drop("times"), KEY)
    # Rows that repeat a row are one document; tasks combine theirs before the shuffle.
    often = often.groupBy(KEY).agg(F.any_value("raw").alias("raw"), F.any_value("anchors").alias("anchors"))
    texts = written(once.unionAll(often), "recurring_texts")
    found = contexts(texts).withColumn(
        "salt", F.pmod(F.xxhash64("doc_id", "start"), F.col("salts"))
    )
    by_anchor = written(located(found, ["anchor", "salt"], salted_windows(texts)), "located")
    firsts = by_anchor.filter("window IS NOT NULL").select(
        *KEY, "start", F.lit(1).alias("salts"), F.col("window").alias("context"),
        F.xxhash64("window").alias("anchor"),
    )
    by_window = located(firsts, ["anchor"])
    ranges = by_anchor.filter("window IS NULL").unionAll(by_window)
    return texts, ranges.groupBy(KEY).agg(
        F.collect_list(F.struct("start", "stop")).alias("ranges")
    )


def salted_windows(texts: DataFrame):
    """The filter of the windows that occur twice around salted anchors, as a broadcast;
    None where no anchor is salted."""
    salted = texts.withColumn("anchors", F.expr("filter(anchors, a -> a.salts > 1)")).filter(
        F.size("anchors") > 0
    )
    if salted.isEmpty():
        return None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes, _ = window_hashes(batch["context"].to_pylist())
            values, times = np.unique(hashes, return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(values.view(np.int64)), pa.array(times.astype(np.int64))],
                names=["hash", "times"],
            )

    windows = contexts(salted).mapInArrow(run, "hash long, times long")
    often = windows.groupBy("hash").agg(F.sum("times").alias("n")).filter("n > 1")
    return texts.sparkSession.sparkContext.broadcast(filter_bits(often, FILTER_BITS))


def cut(texts: DataFrame) -> DataFrame:
    """doc_id, text_hash, n_removed, kept (words joined by a space), from texts with
    ranges."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            removed, kept = [], []
            for raw, ranges in zip(
                batch["raw"].to_pylist(), batch["ranges"].to_pylist(), strict=True
            ):
                tokens = raw.split()
                gone = np.zeros(len(tokens) + 1, dtype=np.int64)
                for r in ranges:
                    gone[r["start"]] += 1
                    gone[r["stop"]] -= 1
                stays = np.cumsum(gone)[:-1] == 0
                removed.append(int(len(tokens) - stays.sum()))
                kept.append(b" ".join([tokens[i] for i in np.flatnonzero(stays)]))
            yield pa.RecordBatch.from_arrays(
                [
                    batch["doc_id"],
                    batch["text_hash"],
                    pa.array(removed, pa.int64()),
                    pa.array(kept, pa.binary()).cast(pa.string()),
                ],
                names=[*KEY, "n_removed", "kept"],
            )

    return texts.mapInArrow(run, "doc_id long, text_hash long, n_removed long, kept string")


def remove_passages(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed, changed and kept of every row.

    ``kept`` has the words that stay, joined by one space, where any were removed, and
    ``words_sha`` the SHA-256 of all words so joined.
    """
    rows = docs.select("doc_id", "text")
    described = written(anchored(identified(rows)), "described")
    gone = written(copies(described), "copies")
    texts, ranges = removals(rows, described, gone)
    changed = cut(texts.join(ranges, KEY).select(*KEY, "raw", "ranges"))
    changed = changed.unionAll(
        described.join(gone, KEY, "left_semi").select(
            *KEY, F.col("n_words").alias("n_removed"), F.lit("").alias("kept")
        )
    ).dropDuplicates(KEY)
    without_id = rows.filter("doc_id IS NULL").select(
        F.lit(0).cast("long").alias("doc_id"),
        F.xxhash64("text").alias("text_hash"),
        F.col("text").cast("binary").alias("raw"),
    )
    plain = anchored(without_id).select(
        F.lit(None).cast("long").alias("doc_id"), "n_words", "words_sha",
        F.lit(0).cast("long").alias("n_removed"), F.lit(None).cast("string").alias("kept"),
    )
    return (
        described.drop("anchors")
        .join(changed, KEY, "left")
        .select(
            "doc_id", "n_words", "words_sha", F.coalesce("n_removed", F.lit(0)).alias("n_removed"),
            "kept",
        )
        .unionAll(plain)
    )
