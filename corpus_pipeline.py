"""From raw documents to a training mixture, stage by stage.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes it and
reads it again as the documents of the next stage. All stages but the last return the
columns they were given. The last one returns the mixture: the drawn blocks of text with
their shard and their order in it.

1. toxicity: documents go that the classifier rejects by the threshold of their language
   (its labels: the labels of documents that are not held out).
2. line_dedup: lines go that repeat an earlier line within one edit. An exact copy of an
   earlier document gets the text which that one is left with; the next stage drops it.
3. near_dedup: one document of each component of near-duplicates stays.
4. decontamination: documents go that contain a benchmark item.
5. mixing: sources are mixed to their target weights.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.llm import decontamination, line_dedup, mixing, near_dedup, toxicity
from starmart.llm.common import free_name, held_out, read, written

# Documents are near-duplicates from this percentage of common shingles on.
SIMILARITY = 80


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = read(spark, sf_dir, "labels").filter(~held_out(F.col("doc_id")))
    model = toxicity.fit(docs, labels)
    score = free_name(docs, toxicity.SCORE)
    scored = toxicity.score(docs, model, score)
    return scored.filter(~toxicity.is_toxic(model, score)).drop(score)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return line_dedup.remove_repeats(docs)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.deduplicated(docs, SIMILARITY)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.decontaminated(docs, read(spark, sf_dir, "benchmark"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs)


STAGES = [
    ("toxicity", toxicity_stage),
    ("line_dedup", line_dedup_stage),
    ("near_dedup", near_dedup_stage),
    ("decontamination", decontamination_stage),
    ("mixing", mixing_stage),
]

# A trained classifier decides in the first stage; SQL cannot express it.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
