"""Host-level quality rules.

Every document is measured against a few rules. Failures are counted by host (the
document's source), each host's failure rate is shrunk towards the rate of all hosts by
a beta prior that is fitted to them, and hosts whose shrunk rate exceeds a limit are
rejected; the verdict is joined back to their documents.

Defined results: a NULL or blank text has no words and fails the base rules. A document
without source has no host and is judged by the base rules alone. Rows are judged one
by one, so repeated rows give repeated results. Columns of the input other than the
three named ones are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmart.llm.common import SPACE, let, words, written

SYMBOLS = "#*$%&|<>"

# A host is rejected where more than this share of its documents, after shrinking,
# fails one of the rules.
MAX_RATE = 0.5
# Bounds for the weight of the prior, in documents.
MIN_WEIGHT, MAX_WEIGHT = 1.0, 1000.0

# Conditions on the columns of measure() under which a document fails.
TOO_SHORT = "n_words < 50"
REPETITIVE = "100 * n_repeat_words > 50 * n_words"
RULES = {
    "too_short": TOO_SHORT,
    "repetitive": REPETITIVE,
    "symbols": "10 * n_symbols > n_words",
    "dup_lines": "2 * n_dup_lines > n_lines",
    "word_length": "word_chars < 2 * n_words OR word_chars > 12 * n_words",
}


def n_repeat_words(w: Column, size: int = 3) -> Column:
    """Words inside a window of ``size`` words that occurs twice or more.

    Windows are sorted with their positions, so that equal ones are neighbours; that
    is n log n for any text, and no rows leave the document.
    """

    def window(i: Column) -> Column:
        parts = [F.get(w, i + k) for k in range(size)]
        return F.struct(F.concat_ws(" ", *parts).alias("t"), i.alias("p"))

    windows = F.transform(F.sequence(F.lit(0), F.size(w) - size), window)

    def repeated(ordered: Column) -> Column:
        found = F.filter(
            ordered,
            lambda x, i: (x["t"] == F.get(ordered, i - 1)["t"])
            | (x["t"] == F.get(ordered, i + 1)["t"]),
        )
        return F.sort_array(F.transform(found, lambda x: x["p"]))

    def covered(positions: Column) -> Column:
        gaps = F.transform(
            positions,
            lambda p, i: F.least(
                F.lit(size), F.coalesce(F.get(positions, i + 1) - p, F.lit(size))
            ),
        )
        return F.aggregate(gaps, F.lit(0), lambda total, gap: total + gap)

    return F.when(
        F.size(w) >= size, let(let(F.sort_array(windows), repeated), covered)
    ).otherwise(0)


def measure(docs: DataFrame) -> DataFrame:
    """One row of counts per document; no shuffle."""
    text = F.coalesce("text", F.lit(""))
    lines = F.filter(
        F.split(text, "\n"), lambda line: F.translate(line, SPACE, "") != ""
    )
    solid = F.translate(text, SPACE, "")
    counts = {
        "word_chars": F.length(solid),
        "n_symbols": F.length(text) - F.length(F.translate(text, SYMBOLS, "")),
        "n_dup_lines": let(lines, lambda a: F.size(a) - F.size(F.array_distinct(a))),
        "n_lines": F.size(lines),
        "n_repeat_words": let(words(F.col("text")), n_repeat_words),
    }
    return docs.select(
        "doc_id",
        F.col("source").alias("host"),
        F.size(words(F.col("text"))).cast("long").alias("n_words"),
        *[c.cast("long").alias(name) for name, c in counts.items()],
    )


def host_verdicts(measured: DataFrame, max_rate: float = MAX_RATE) -> DataFrame:
    """host, n_docs, the shrunk failure rate of each rule, and host_rejected.

    The prior's mean is the failure rate of all documents with a host; its weight
    comes from the variance of the host rates beyond what sampling alone explains.
    """
    hosts = (
        measured.filter(F.col("host").isNotNull())
        .groupBy("host")
        .agg(
            F.count(F.lit(1)).alias("n_docs"),
            *[F.count_if(F.expr(rule)).alias(name) for name, rule in RULES.items()],
        )
    )
    n = F.col("n_docs")

    def prior(name: str) -> Column:
        rate = F.col(name) / n
        mean = F.sum(name) / F.sum(n)
        spread = F.avg(rate * rate) - 2 * mean * F.avg(rate) + mean * mean
        excess = spread - mean * (1 - mean) * F.avg(1 / n)
        weight = F.when(excess > 0, mean * (1 - mean) / excess - 1).otherwise(MAX_WEIGHT)
        bounded = F.least(F.greatest(weight, F.lit(MIN_WEIGHT)), F.lit(MAX_WEIGHT))
        return F.struct(mean.alias("mean"), bounded.alias("weight")).alias(name)

    fitted = hosts.agg(F.struct(*[prior(name) for name in RULES]).alias("p")).scalar()

    def shrunk(name: str) -> Column:
        p = fitted[name]
        return ((F.col(name) + p["mean"] * p["weight"]) / (n + p["weight"])).alias(
            f"{name}_rate"
        )

    rates = hosts.select("host", "n_docs", *[shrunk(name) for name in RULES])
    worst = F.greatest(*[F.col(f"{name}_rate") for name in RULES])
    return rates.withColumn("host_rejected", worst > max_rate)


def judge(docs: DataFrame, max_rate: float = MAX_RATE) -> DataFrame:
    """The counts of every document with base_failed, host_rejected and kept."""
    measured = written(measure(docs), "measured")
    hosts = host_verdicts(measured, max_rate).select("host", "host_rejected")
    base_failed = F.expr(f"{TOO_SHORT} OR {REPETITIVE}")
    rejected = F.coalesce("host_rejected", F.lit(False))
    return measured.join(hosts, "host", "left").select(
        *measured.columns,
        base_failed.alias("base_failed"),
        rejected.alias("host_rejected"),
        (~base_failed & ~rejected).alias("kept"),
    )
