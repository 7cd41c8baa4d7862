"""Line dedup by a segment-partition edit join, in DataFrame functions only.

Lines that differ by at most EDITS single-character edits are linked. A line is cut into
EDITS + 1 segments; of two linked lines, at least one segment of one occurs unchanged in
the other, at a place that hardly moves. So a line is indexed under (its length, the
number of the segment, the segment), and another line probes that index for each length
up to EDITS shorter than its own, with the few substrings that the bounds on lengths and
places leave. Whoever meets is verified by Spark's banded edit distance.

Index and probes hold hashes only; lines that met fetch their text again. Equal lines
share their hashes and count as one before anything is joined. Where very many lines
share a segment (numbered headings, copies of a page with small changes), they are told
apart instead of being paired off: the part of the line that may hold the edit is cut
into FINER segments, of which all but one must agree, and so on within that one. Each
round signs an eighth of what the last one did, so the whole costs a few passes over the
line, whatever its length. The same is done until at most OPEN_CHARS are open, as Spark's
edit distance takes time with the square of a text: only the open part is put to it, and
what lies around must be equal. For more than one edit, which this does not cover, lines
under a crowded segment are paired, and compared as a whole.

A line of a document is a repeat if an equal or linked line occurs earlier (smaller
doc_id, or same document, further up). Only lines with a word take part; others stay.

Defined results: a NULL text has no lines. A document without id takes no part: it keeps
its lines and is no occurrence. Rows with the same id are one document, so equal places
in both are equally early. Lines of up to EDITS characters are only compared for
equality, as any two of them would be linked. An empty table gives an empty result.
Columns of the input that are not needed do not matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmart.llm.common import SPACE, let, written

EDITS = 1
# Index entries and probes that one signature may have before its lines are signed anew.
CROWD = 50
FINER = 8
OPEN_CHARS = 256


def has_word(line: Column) -> Column:
    return F.btrim(line, F.lit(SPACE)) != ""


def document_lines(docs: DataFrame) -> DataFrame:
    """doc_id, n (place of the line in its text, from 0) and line, for lines with a word."""
    return (
        docs.filter(F.col("doc_id").isNotNull())
        .select(
            F.col("doc_id").cast("long").alias("doc_id"),
            F.posexplode(F.split("text", "\n")).alias("n", "line"),
        )
        .filter(has_word(F.col("line")))
    )


def line_key(line: Column) -> Column:
    """128 bits of hash: two different lines do not share them in practice."""
    return F.struct(F.xxhash64(line).alias("a"), F.xxhash64(F.lit("line"), line).alias("b"))


def segment(length: Column, number: Column, parts: int) -> tuple[Column, Column]:
    """Start (from 0) and length of a segment; the last ones take the odd characters."""
    base = F.floor(length / parts).cast("int")
    odd_from = parts - length % parts
    start = number * base + F.greatest(number - odd_from, F.lit(0))
    return start.cast("int"), (base + (number >= odd_from).cast("int")).cast("int")


def signatures(length: Column, line: Column, edits: int) -> Column:
    """The index entries of a line, one per segment, and then its probes (or NULL).

    For a line that is ``gap`` longer than an indexed one, segment ``i`` can start at
    place p only within the bounds that both neighbours of the segment leave: what is
    left of it may have moved by i edits at most, what is right of it by edits - i.
    """
    entries, probes = [], []
    for gap in range(edits + 1):
        short = length - gap
        for i in range(edits + 1):
            start, size = segment(short, F.lit(i), edits + 1)
            low, high = max(-i, gap - (edits - i)), min(i, gap + (edits - i))
            for shift in range(low, high + 1):
                sig = F.xxhash64(short, F.lit(i), F.substring(line, start + shift + 1, size))
                if gap == 0 and shift == 0:
                    entries.append(sig)  # serves as the line's own probe, too
                else:
                    fits = (start + shift >= 0) & (start + shift + size <= length)
                    probes.append(F.when((short > edits) & fits, sig))
    return F.when(length > edits, F.array(*entries, *probes))


# What is left open about a signed line: its edit, if any, lies in the characters from
# ``low`` up to ``high`` (places in the shorter line); all others agree. ``role`` is 1 for
# a line that is one longer than the indexed ones: what follows the edit has moved by it.
OPEN = ["sig", "role", "a", "low", "high"]


def first_open(met: DataFrame) -> DataFrame:
    """OPEN rows after ``signatures`` for one edit: the half that is not signed is open."""
    short = F.col("length") - F.col("role")
    start, size = segment(short, F.lit(0), 2)
    second = F.col("at") % 2 == 1
    low = F.when(second, F.lit(0)).otherwise(start + size)
    high = F.when(second, start + size).otherwise(short)
    return met.select(
        "sig", "role", "a", low.cast("int").alias("low"), high.cast("int").alias("high")
    )


def narrowed(crowd: DataFrame, texts: DataFrame) -> DataFrame:
    """OPEN rows signed anew, once for each place that the edit may have within the part
    that is open; lines that an edit there makes equal agree in one of them."""
    role, low, high = F.col("role"), F.col("low"), F.col("high")

    def text(start: Column, stop: Column) -> Column:
        return F.substring(F.col("line"), start + 1, stop - start)

    def child(i: Column) -> Column:
        size = high - low
        start = low + F.floor(size * i / FINER).cast("int")
        stop = low + F.floor(size * (i + 1) / FINER).cast("int")
        rest = F.xxhash64("sig", i, text(low, start), text(stop + role, high + role))
        return F.when(
            stop > start, F.struct(rest.alias("sig"), start.alias("low"), stop.alias("high"))
        )

    def inserted(i: int) -> Column:
        """Of a single open character: what is longer by one has it first (0) or second."""
        place = low + i * role
        sig = F.xxhash64("sig", F.lit(-1 - i), text(place, place + 1))
        behind = low + (1 - i)
        return F.struct(sig.alias("sig"), behind.alias("low"), behind.alias("high"))

    children = F.when(high - low > 1, F.transform(F.sequence(F.lit(0), F.lit(FINER - 1)), child))
    children = children.otherwise(F.array(inserted(0), inserted(1)))
    return (
        crowd.join(texts, "a")
        .select("role", "a", F.explode(children).alias("c"))
        .filter("c IS NOT NULL")
        .select("c.sig", "role", "a", "c.low", "c.high")
    )


def shared(entries: DataFrame) -> DataFrame:
    """The entries (sig, role, a, more) of signatures that more than one line has, of
    which one is indexed."""
    # Nearly all signatures belong to one line. Counting combines within tasks, so a
    # line that occurs often costs little.
    found = (
        entries.groupBy("sig")
        .agg(F.min("a").alias("first"), F.max("a").alias("last"), F.min("role").alias("least"))
        .filter("first != last AND least = 0")
        .select("sig")
    )
    return entries.join(found.hint("merge"), "sig", "left_semi").distinct()


def entries_of(signed: DataFrame, parts: int) -> DataFrame:
    """sig, role (0: index entry, 1: probe), a, at (which segment) and length of lines
    (a, length, sigs)."""
    return (
        signed.select("a", "length", F.posexplode_outer("sigs").alias("at", "sig"))
        .filter("sig IS NOT NULL")
        .select("sig", (F.col("at") >= parts).cast("int").alias("role"), "a", "at", "length")
    )


def pairs_of(met: DataFrame) -> DataFrame:
    """x, y, and of OPEN rows role (of y), low and high: an indexed line and another one
    that share a signature; one pair of two that are indexed."""
    parts = [c for c in ("low", "high") if c in met.columns]
    own = met.filter("role = 0").select("sig", F.col("a").alias("x"), *parts)
    other = met.select("sig", F.col("a").alias("y"), "role")
    pairs = own.join(other, "sig").filter("x != y AND (role = 1 OR x < y)")
    return pairs.select("x", "y", "role", *parts).distinct()


def one_edit_apart(s: Column, t: Column) -> Column:
    """Whether a line ``s`` and ``t``, longer by ``role``, differ by one edit between low
    and high of ``s``, where they must not be equal."""
    low, high, role = F.col("low"), F.col("high"), F.col("role")
    longest = 1 << 30
    around = (F.substring(s, F.lit(1), low) == F.substring(t, F.lit(1), low)) & (
        F.substring(s, high + 1, F.lit(longest)) == F.substring(t, high + role + 1, F.lit(longest))
    )
    inside = F.levenshtein(
        F.substring(s, low + 1, high - low), F.substring(t, low + 1, high + role - low), 1
    )
    return around & inside.between(0, 1)


def line_links(signed: DataFrame, lines: DataFrame, edits: int = EDITS) -> DataFrame:
    """Pairs (x, y) of keys of different lines within ``edits`` edits, each pair once.

    Signatures of up to CROWD entries with little open give pairs. For one edit, the lines
    under the others are narrowed down, until that holds for all, or a single character
    is open: there all who meet are linked, equally long ones at once, others by one step
    more.
    """
    met = written(shared(entries_of(signed, edits + 1)), "met")
    texts = written(
        lines.select(F.xxhash64("line").alias("a"), "line")
        .join(met.select("a").distinct().hint("merge"), "a", "left_semi")
        .distinct(),
        "line_texts",
    )
    left = texts.select(F.col("a").alias("x"), F.col("line").alias("s"))
    right = texts.select(F.col("a").alias("y"), F.col("line").alias("t"))
    keys = [line_key(F.col("s")).alias("x"), line_key(F.col("t")).alias("y")]
    if edits != 1:
        near = F.levenshtein("s", "t", edits).between(1, edits)
        pairs = pairs_of(met).select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y"))
        return pairs.distinct().join(left, "x").join(right, "y").filter(near).select(keys)
    found, met = [], first_open(met)
    while True:
        crowded = met.groupBy("sig").count().filter(F.col("count") > CROWD).select("sig")
        many = met.join(crowded, "sig", "left_semi")
        few = met.join(crowded, "sig", "left_anti")
        little = f"high - low <= {OPEN_CHARS}"
        done = pairs_of(few.filter(little).unionAll(many.filter("high = low")))
        alike = pairs_of(many.filter("high - low = 1 AND role = 0"))
        found.append(written(done.unionAll(alike), "line_pairs"))
        more = few.filter(f"NOT {little}").unionAll(many.filter("high > low"))
        more = written(more, "crowd")
        if more.isEmpty():
            break
        met = written(shared(narrowed(more, texts)), "met")
    pairs = found[0]
    for more in found[1:]:
        pairs = pairs.unionAll(more)
    near = one_edit_apart(F.col("s"), F.col("t"))
    links = pairs.join(left, "x").join(right, "y").filter(near)
    # Two lines may meet under several signatures.
    return (
        links.select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y"))
        .distinct()
        .join(left, "x")
        .join(right, "y")
        .select(keys)
    )


def line_classes(docs: DataFrame, edits: int = EDITS) -> tuple[DataFrame, DataFrame]:
    """The lines of all documents (doc_id, n, key), and for each distinct line that is
    linked or occurs twice: key, before (the earliest occurrence of the line and all
    lines linked to it) and n_links."""
    lines = document_lines(docs)
    signed = written(
        lines.select("*", F.length("line").alias("length")).select(
            "doc_id",
            "n",
            line_key(F.col("line")).alias("key"),
            "length",
            signatures(F.col("length"), F.col("line"), edits).alias("sigs"),
        ),
        "lines",
    )
    places = signed.select("doc_id", "n", "key")
    links = written(
        line_links(signed.select("key.a", "length", "sigs"), lines.select("line"), edits), "line_links"
    )
    both_ways = links.unionAll(links.select(F.col("y").alias("x"), F.col("x").alias("y")))
    firsts = written(
        places.groupBy("key").agg(
            F.min(F.struct("doc_id", "n")).alias("earliest"), F.count("*").alias("times")
        ),
        "line_firsts",
    )
    around = (
        both_ways.join(firsts.select(F.col("key").alias("y"), "earliest"), "y")
        .groupBy(F.col("x").alias("key"))
        .agg(F.min("earliest").alias("near"), F.count("*").alias("n_links"))
    )
    classes = (
        firsts.join(around, "key", "left")
        .filter((F.col("times") > 1) | F.col("near").isNotNull())
        .select(
            "key",
            F.least("earliest", "near").alias("before"),
            F.coalesce("n_links", F.lit(0)).alias("n_links"),
        )
    )
    return places, classes


def repeated_places(docs: DataFrame, edits: int = EDITS) -> DataFrame:
    """doc_id, repeats (places of its lines that are repeats, in order), n_links and
    classes (documents where the classes of its repeats start), of each document that
    has a line which is linked or occurs twice."""
    places, classes = line_classes(docs, edits)
    found = places.distinct().join(classes, "key")
    repeat = F.col("before") < F.struct("doc_id", "n")
    return found.groupBy("doc_id").agg(
        F.array_sort(F.collect_set(F.when(repeat, F.col("n")))).alias("repeats"),
        F.sum("n_links").alias("n_links"),
        F.array_sort(F.collect_set(F.when(repeat, F.col("before.doc_id")))).alias("classes"),
    )


def kept_text(text: Column, repeats: Column) -> Column:
    def without(lines: Column) -> Column:
        places = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), repeats)
        return F.array_join(F.transform(places, lambda n: F.get(lines, n)), "\n")

    return F.when(F.size(repeats) > 0, let(F.split(text, "\n"), without)).otherwise(text)


def dedup(docs: DataFrame, edits: int = EDITS) -> DataFrame:
    """doc_id, text (without repeats), n_lines (with a word), n_removed, n_links, classes
    of every row."""
    docs = docs.select("doc_id", "text")
    none = F.array().cast("array<int>")
    lines = F.filter(F.split(F.coalesce("text", F.lit("")), "\n"), has_word)
    return (
        docs.join(repeated_places(docs, edits).hint("merge"), "doc_id", "left")
        .withColumn("repeats", F.coalesce("repeats", none))
        .select(
            "doc_id",
            kept_text(F.col("text"), F.col("repeats")).alias("text"),
            F.size(lines).cast("long").alias("n_lines"),
            F.size("repeats").cast("long").alias("n_removed"),
            F.coalesce("n_links", F.lit(0)).alias("n_links"),
            F.coalesce("classes", F.array().cast("array<bigint>")).alias("classes"),
        )
    )


def line_decisions(docs: DataFrame, edits: int = EDITS) -> DataFrame:
    """doc_id, text_key and repeats of each text with lines, one row for equal rows.

    A text that an earlier document has as a whole gets the decisions of the earliest.
    """
    texts = (
        docs.filter(F.col("doc_id").isNotNull() & F.col("text").isNotNull())
        .select(
            F.col("doc_id").cast("long").alias("doc_id"), line_key(F.col("text")).alias("text_key")
        )
        .distinct()
    )
    repeats = written(repeated_places(docs, edits).select("doc_id", "repeats"), "repeats")
    firsts = (
        texts.groupBy("text_key")
        .agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
        .filter("first != last")
        .join(repeats.toDF("first", "first_repeats"), "first")
        .drop("last")
    )
    return (
        texts.join(repeats, "doc_id")
        .join(firsts, "text_key", "left")
        .select("doc_id", "text_key", F.coalesce("first_repeats", "repeats").alias("repeats"))
    )


def remove_repeats(docs: DataFrame, edits: int = EDITS) -> DataFrame:
    """The rows of ``docs`` (doc_id, text, n_chars, others) without repeated lines.

    Every line decision is carried out, however many lines of a document it takes; one
    that is left without a worded line keeps its row, with what other lines it has. Only
    an exact copy of an earlier document is not emptied line by line: it gets the text
    which the earliest such document is left with, so that document-level dedup, for
    which equal texts are one, drops it as a copy.
    """
    cut = (
        docs.select(
            F.struct(*docs.columns).alias("d"),
            F.col("doc_id"),
            line_key(F.col("text")).alias("text_key"),
        )
        .join(line_decisions(docs, edits).hint("merge"), ["doc_id", "text_key"], "left")
        .withColumn("text", kept_text(F.col("d.text"), F.col("repeats")))
    )
    columns = [F.col(f"d.{c}") for c in docs.columns if c not in ("text", "n_chars")]
    changed = F.size("repeats") > 0
    n_chars = F.when(changed, F.length("text").cast("long")).otherwise(F.col("d.n_chars"))
    return cut.select(*columns, "text", n_chars.alias("n_chars")).select(docs.columns)
