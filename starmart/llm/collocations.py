"""Phrase collocations by mergeable Misra-Gries summaries and an exact second count.

Texts (A-Z lower-cased) are cut into pieces at ``.,;:!?`` and line ends, and pieces into
words at spaces and tabs. Phrases are runs of words inside a piece; everything is counted
per language. A phrase of 2 to SIZE words that occurs THRESHOLD times is a candidate.

1. Summaries. Tasks count the hashes of their phrases and cut them by hash partition. A
   partition merges what it gets into one Misra-Gries summary: where more than ``capacity``
   hashes are held, the count of the (capacity + 1)-th is taken off all and what falls to
   zero goes. Capacity exceeds SLACK times the partition's mass (all its occurrences,
   summed first) divided by the threshold, so less than a SLACK-th of the threshold is
   ever taken off a count: every frequent phrase survives, and few others do. A summary
   holds no more than that, however many different phrases pass by. Single words and
   pairs are summarised first; of the longer phrases only those take part of which each
   pair survived, as no other can be frequent.
2. Exact count. Survivors set the bits of a filter of fixed size (2 ** FILTER_BITS). The
   documents are read again; phrases whose bit is set are counted by their text. Tasks
   deal their counts out by hash partition, in a few rows each, and a partition adds them
   up. Rare phrases that pass by chance cost a little and end at the threshold.
3. Scores. A candidate cut after its first k words has l = f(first part), r = f(rest)
   and the score floor(1000 * a * n / (l * r)), in exact decimals; the lowest cut counts.
   A candidate inside a longer one of at least SHARE percent of its count goes.

Counts are combined within tasks before any shuffle, so a phrase that makes up a third of
all mass arrives as one number per task. The number of partitions grows with the input.

Defined results: a NULL text has no words, a NULL language is ``und``. Document ids play no
part: repeated rows count again. Ties: smallest k; equal scores by count, then by the
phrase's UTF-8 bytes. Words that are not UTF-8 are counted as their U+FFFD form. An empty
table gives an empty result. Other columns do not matter.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starmart.llm.common import filter_bits, has_bit, shingle_hashes, written

SIZE = 5
THRESHOLD = 100
SHARE = 100
TOP = 2000
# Occurrences that one summary is for, on average; its capacity is SLACK/THRESHOLD of it.
PART_MASS = 5_000_000
SLACK = 10
# Bytes of text for one occurrence, to plan the number of partitions with.
BYTES_A_WORD = 6
# Text that a task cuts into words at once, and hashes it holds before passing them on.
BLOCK_BYTES = 2_000_000
HELD = 2_000_000
# Distinct words that a task remembers the hashes of, and phrases it counts, at once.
REMEMBERED = 1_000_000
FILTER_BITS = 26

BREAK = b"."
PIECE_ENDS = bytes.maketrans(b",;:!?\n\x0b\x0c\r", BREAK * 9)


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > REMEMBERED:
            self.clear()
        found = self[word] = xxhash.xxh3_64_intdigest(word)
        return found


class Block:
    """The words of some texts of one language. A BREAK is no word but ends a piece."""

    def __init__(self, lang: str, texts: list[bytes], known: WordHashes):
        text = BREAK.join(texts).lower().translate(PIECE_ENDS)
        self.lang = lang
        self.words = text.replace(BREAK, b" . ").split()
        self.hashes = np.fromiter(map(known.__getitem__, self.words), np.uint64, len(self.words))
        self.breaks = np.concatenate([[0], np.cumsum(self.hashes == known[BREAK])])
        self.salt = np.uint64(xxhash.xxh3_64_intdigest(lang.encode()))

    def phrases(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Places and hashes of the phrases of ``size`` words."""
        hashes = shingle_hashes(self.hashes, size)
        whole = self.breaks[size : size + len(hashes)] == self.breaks[: len(hashes)]
        places = np.flatnonzero(whole)
        mixed = (hashes[places] ^ self.salt) * np.uint64(0x9E3779B97F4A7C15)
        return places, mixed ^ (mixed >> np.uint64(31))


def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[Block]:
    known = WordHashes()
    for batch in batches:
        waiting: dict[str, list[bytes]] = {}
        held: Counter = Counter()
        for lang, raw in zip(batch["lang"].to_pylist(), batch["raw"].to_pylist(), strict=True):
            if raw:
                waiting.setdefault(lang, []).append(raw)
                held[lang] += len(raw)
                if held.total() > BLOCK_BYTES:
                    yield from (Block(k, texts, known) for k, texts in waiting.items())
                    waiting.clear()
                    held.clear()
        yield from (Block(k, texts, known) for k, texts in waiting.items())


def added(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes, ascending, with the sums of their counts."""
    hashes = np.concatenate([h for h, _ in parts])
    counts = np.concatenate([c for _, c in parts])
    order = np.argsort(hashes, kind="stable")
    hashes, counts = hashes[order], counts[order]
    starts = np.flatnonzero(np.concatenate([[True], hashes[1:] != hashes[:-1]]))
    return hashes[starts], np.add.reduceat(counts, starts)


SUMMARY = "part int, mass long, hashes binary, counts binary"


def local_counts(docs: DataFrame, sizes: range, parts: int, bits=None) -> DataFrame:
    """Counts of phrase hashes by hash partition: of each partition a row with the mass,
    without hashes, and rows with the counts. With ``bits``, only phrases are counted of
    which every pair has its bit set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = np.frombuffer(bits.value, np.uint64) if bits else None
        held: list[tuple[np.ndarray, np.ndarray]] = []
        count = 0

        def rows() -> pa.RecordBatch:
            hashes, counts = added(held)
            # Partitions are ranges of hashes.
            part = ((hashes >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)
            numbers, starts = np.unique(part, return_index=True)
            ends = [*starts[1:], len(part)]
            out = []
            for number, a, b in zip(numbers.tolist(), starts, ends, strict=True):
                out.append((number, int(counts[a:b].sum()), None, None))
                out.append((number, 0, hashes[a:b].tobytes(), counts[a:b].astype(np.uint32).tobytes()))
            columns = list(zip(*out, strict=True))
            types = (pa.int32(), pa.int64(), pa.binary(), pa.binary())
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types, strict=True)],
                names=["part", "mass", "hashes", "counts"],
            )

        for block in blocks(batches):
            follows = None
            if pairs is not None:
                # How many frequent pairs follow one another from each place on.
                follows = np.zeros(len(block.words) + 1, dtype=bool)
                places, hashes = block.phrases(2)
                follows[places] = has_bit(pairs, hashes)
            for size in sizes:
                places, hashes = block.phrases(size)
                for shift in range(size - 1 if follows is not None else 0):
                    keep = follows[places + shift]
                    places, hashes = places[keep], hashes[keep]
                if len(hashes):
                    held.append(np.unique(hashes, return_counts=True))
                    count += len(held[-1][0])
            if count > 2 * HELD:
                held = [added(held)]
                count = len(held[0][0])
                if count > HELD:
                    yield rows()
                    held, count = [], 0
        if held:
            yield rows()

    return docs.mapInArrow(run, SUMMARY)


class MisraGries:
    """Counts of at most ``capacity`` hashes (more for a moment), each too low by ``error``
    at most."""

    def __init__(self, capacity: int):
        self.capacity, self.error = capacity, 0
        self.hashes, self.counts = np.empty(0, np.uint64), np.empty(0, np.int64)
        self.waiting: list[tuple[np.ndarray, np.ndarray]] = []
        self.n_waiting = 0

    def add(self, hashes: np.ndarray, counts: np.ndarray) -> None:
        self.waiting.append((hashes, counts))
        self.n_waiting += len(hashes)
        if self.n_waiting > 2 * self.capacity:
            self.merge()

    def merge(self) -> None:
        self.hashes, self.counts = added([(self.hashes, self.counts), *self.waiting])
        self.waiting, self.n_waiting = [], 0
        if len(self.hashes) > self.capacity:
            at = len(self.counts) - self.capacity - 1
            off = int(np.partition(self.counts, at)[at])
            self.error += off
            keep = self.counts > off
            self.hashes, self.counts = self.hashes[keep], self.counts[keep] - off

    def frequent(self, threshold: int) -> np.ndarray:
        """The hashes that may have occurred ``threshold`` times."""
        self.merge()
        return self.hashes[self.counts + self.error >= threshold]


def survivors(counts: DataFrame, threshold: int) -> DataFrame:
    """hash of every phrase that a summary holds and that may be frequent."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, mass, summary = None, 0, None

        def rows() -> pa.RecordBatch:
            found = summary.frequent(threshold).view(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(found)], names=["hash"])

        for batch in batches:
            for part, own_mass, hashes, values in zip(
                *[batch[c].to_pylist() for c in ("part", "mass", "hashes", "counts")], strict=True
            ):
                if part != now:
                    if summary:
                        yield rows()
                    now, mass, summary = part, 0, None
                if hashes is None:
                    mass += own_mass
                else:
                    # All masses of a partition come before its first counts.
                    summary = summary or MisraGries(SLACK * (mass // threshold + 1))
                    summary.add(
                        np.frombuffer(hashes, np.uint64),
                        np.frombuffer(values, np.uint32).astype(np.int64),
                    )
        if summary:
            yield rows()

    return (
        counts.repartition("part")
        .sortWithinPartitions("part", F.col("hashes").isNotNull())
        .mapInArrow(run, "hash long")
    )


def part_of(lang: str, phrase: str, parts: int) -> int:
    return xxhash.xxh3_64_intdigest(f"{lang}\n{phrase}".encode()) % parts


def exact_counts(docs: DataFrame, sizes: int, threshold: int, parts: int, bits) -> DataFrame:
    """lang, phrase and f of the phrases of at least ``threshold`` occurrences whose bit is
    set, and of the empty phrase, which has all words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.frombuffer(bits.value, np.uint64)
        held: Counter = Counter()

        def rows() -> pa.RecordBatch:
            dealt: dict[int, tuple[list, list, list]] = {}
            for (lang, raw), n in held.items():
                phrase = raw.decode("utf-8", "replace")
                own = dealt.setdefault(part_of(lang, phrase, parts), ([], [], []))
                for column, value in zip(own, (lang, phrase, n), strict=True):
                    column.append(value)
            columns = list(zip(*dealt.values(), strict=True)) or [(), (), ()]
            types = (pa.string(), pa.string(), pa.int64())
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(dealt.keys(), pa.int32()),
                    *[pa.array(c, pa.list_(t)) for c, t in zip(columns, types, strict=True)],
                ],
                names=["part", "langs", "phrases", "counts"],
            )

        for block in blocks(batches):
            words, lang = block.words, block.lang
            places, hashes = block.phrases(1)
            held[lang, b""] += len(places)
            # Places are taken phrase by phrase: counting equal hashes would trust them.
            for size in range(1, sizes + 1):
                places, hashes = block.phrases(size)
                chosen = places[has_bit(table, hashes)].tolist()
                texts = (
                    [b" ".join(words[p : p + size]) for p in chosen]
                    if size > 1
                    else [words[p] for p in chosen]
                )
                for text, n in Counter(texts).items():
                    held[lang, text] += n
            if len(held) > REMEMBERED:
                yield rows()
                held.clear()
        yield rows()

    def added_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, total = None, Counter()

        def rows() -> pa.RecordBatch:
            kept = [(*k, n) for k, n in total.items() if n >= threshold or not k[1]]
            columns = list(zip(*kept, strict=True)) or [(), (), ()]
            types = (pa.string(), pa.string(), pa.int64())
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types, strict=True)],
                names=["lang", "phrase", "f"],
            )

        for batch in batches:
            for i, part in enumerate(batch["part"].to_pylist()):
                if part != now:
                    yield rows()
                    now, total = part, Counter()
                own = [batch[c][i].as_py() for c in ("langs", "phrases", "counts")]
                for lang, phrase, n in zip(*own, strict=True):
                    total[lang, phrase] += n
        yield rows()

    dealt = "part int, langs array<string>, phrases array<string>, counts array<long>"
    return (
        docs.mapInArrow(run, dealt)
        .repartition("part")
        .sortWithinPartitions("part")
        .mapInArrow(added_up, "lang string, phrase string, f long")
    )


def phrase_counts(docs: DataFrame, size: int = SIZE, threshold: int = THRESHOLD) -> DataFrame:
    """lang, phrase, f of every phrase of up to ``size`` words that occurs ``threshold``
    times, and of the empty phrase, which counts the words of a language."""
    spark = docs.sparkSession
    texts = docs.select(
        F.coalesce("lang", F.lit("und")).alias("lang"), F.col("text").cast("binary").alias("raw")
    )
    total = texts.agg(F.sum(F.octet_length("raw"))).first()[0] or 0
    parts = max(1, math.ceil(2 * total / BYTES_A_WORD / PART_MASS))
    short = survivors(local_counts(texts, range(1, 3), parts), threshold)
    short = written(short, "frequent_pairs")
    pairs = filter_bits(short, FILTER_BITS)
    found = short
    if size > 2:
        bits = spark.sparkContext.broadcast(pairs)
        long = survivors(local_counts(texts, range(3, size + 1), parts, bits), threshold)
        found = found.unionAll(written(long, "frequent_phrases"))
    bits = spark.sparkContext.broadcast(filter_bits(found, FILTER_BITS))
    return exact_counts(texts, size, threshold, parts, bits)


def run_of(words: Column, start: Column, size: Column) -> Column:
    return F.array_join(F.slice(words, start, size), " ")


def floor_score(a: Column, n: Column, left: Column, right: Column) -> Column:
    """floor(1000 * a * n / (left * right)); the products need up to 37 digits."""
    exact = [F.expr("1000") * a, n, left, right]
    a, n, left, right = (c.cast("decimal(18,0)") for c in exact)
    return F.call_function("div", a * n, left * right)


def scored(counts: DataFrame) -> DataFrame:
    """lang, phrase, words, a, l, r, n, score of the candidates, by their lowest cut."""
    totals = counts.filter("phrase = ''").select("lang", F.col("f").alias("n"))
    known = counts.filter("phrase != ''")
    candidates = known.select("lang", "phrase", F.col("f").alias("a")).withColumn(
        "words", F.split("phrase", " ")
    )
    length = F.size("words")
    cuts = candidates.filter(length > 1).select(
        "*", F.explode(F.sequence(F.lit(1), length - 1)).alias("k")
    )
    cuts = cuts.select(
        "*",
        run_of(F.col("words"), F.lit(1), F.col("k")).alias("first"),
        run_of(F.col("words"), F.col("k") + 1, length - F.col("k")).alias("rest"),
    )
    left = known.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l"))
    right = known.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r"))
    valued = (
        cuts.join(left, ["lang", "first"])
        .join(right, ["lang", "rest"])
        .join(totals, "lang")
        .withColumn("score", floor_score(F.col("a"), F.col("n"), F.col("l"), F.col("r")))
    )
    best = F.min(F.struct("score", "k", "l", "r")).alias("best")
    return (
        valued.groupBy("lang", "phrase", "words", "a", "n")
        .agg(best)
        .select("lang", "phrase", "words", "a", "best.l", "best.r", "n", "best.score")
    )


def standing_alone(candidates: DataFrame, share: int = SHARE) -> DataFrame:
    """The candidates that lie in no longer one of ``share`` percent of their count."""
    length = F.size("words")
    inner = (
        candidates.filter(length > 2)
        .select("lang", "words", "a", F.explode(F.sequence(F.lit(2), length - 1)).alias("size"))
        .select("*", F.explode(F.sequence(F.lit(1), length - F.col("size") + 1)).alias("start"))
        .select("lang", run_of(F.col("words"), F.col("start"), F.col("size")).alias("phrase"), "a")
        .groupBy("lang", "phrase")
        .agg(F.max("a").alias("outer_a"))
    )
    covered = F.col("outer_a") * 100 >= F.col("a") * share
    return (
        candidates.join(inner, ["lang", "phrase"], "left")
        .filter(~F.coalesce(covered, F.lit(False)))
        .drop("outer_a")
    )


def collocations(
    docs: DataFrame,
    size: int = SIZE,
    threshold: int = THRESHOLD,
    share: int = SHARE,
    top: int = TOP,
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of each language's ``top`` collocations."""
    counts = written(phrase_counts(docs, size, threshold), "phrase_counts")
    candidates = written(scored(counts), "phrase_scores")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    return (
        standing_alone(candidates, share)
        .withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= top)
        .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
    )
