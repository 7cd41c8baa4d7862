"""Language identification by nearest centroid.

A text becomes a hashed vector of its two- and three-character n-grams, weighted by
TF-IDF and scaled to length one. Each language has a few centroids, found by spherical
k-means over its training vectors. A text gets the language of the centroid with the
largest cosine; it counts as rejected where that cosine is below what nearly all
training texts of the language reach.

The model is fitted on the driver, on a bounded sample of labelled rows: about SAMPLE
documents, dealt evenly over the languages, none longer than MAX_TRAIN_CHARS, and one row
for an id and language. Classes are the MAX_LANGUAGES most frequent values of lang.
Prediction reads every whole text, without a shuffle.

Defined results: NULL texts and texts without a letter are ``und`` with score 0. So is
every text where nothing could be learned. Repeated rows get equal results. Bytes that
are not UTF-8 read as U+FFFD. Columns of the input that are not needed are left alone.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BUCKETS = 1 << 14
CENTROIDS = 4
SAMPLE = 2400
MAX_LANGUAGES = 200
MAX_TRAIN_CHARS = 50_000
ROUNDS = 10
# The share of training texts of a language that its rejection limit would turn away.
REJECTED_SHARE = 0.01
# What a centroid needs: this share of its language's training texts near it, and this
# share of the texts near it in its language.
MIN_SHARE = 0.05
MIN_PURITY = 0.8
BLOCK = 256


@dataclass(frozen=True)
class LanguageModel:
    languages: list[str]
    idf: np.ndarray
    centroids: np.ndarray
    owners: np.ndarray
    limits: np.ndarray


def ngram_counts(text: str) -> np.ndarray:
    """log(1 + count) of each hashed n-gram of the lower-cased text."""
    padded = " ".join(["", *text.lower().split(), ""])
    codes = np.frombuffer(padded.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    a, b = codes[:-1] * np.uint32(0x9E3779B1), codes[1:] * np.uint32(0x85EBCA77)
    pairs = a ^ (b << np.uint32(7)) ^ (b >> np.uint32(3))
    triples = (pairs[:-1] * np.uint32(0xC2B2AE3D)) ^ (codes[2:] * np.uint32(0x27D4EB2F))
    hashed = np.concatenate([pairs, triples])
    hashed = (hashed ^ (hashed >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
    slots = (hashed >> np.uint32(12)) & np.uint32(BUCKETS - 1)
    counts = np.bincount(slots, minlength=BUCKETS)
    return np.log1p(counts).astype(np.float32)


def unit(rows: np.ndarray) -> np.ndarray:
    lengths = np.linalg.norm(rows, axis=-1, keepdims=True)
    return rows / np.where(lengths > 0, lengths, 1)


def cluster(vectors: np.ndarray, k: int) -> np.ndarray:
    """Centroids of spherical k-means; starts from vectors far from one another."""
    chosen = [0]
    nearest = vectors @ vectors[0]
    while len(chosen) < min(k, len(vectors)):
        chosen.append(int(np.argmin(nearest)))
        nearest = np.maximum(nearest, vectors @ vectors[chosen[-1]])
    centroids = vectors[chosen]
    for _ in range(ROUNDS):
        own = np.argmax(vectors @ centroids.T, axis=1)
        means = [
            vectors[own == c].mean(axis=0) if (own == c).any() else centroids[c]
            for c in range(len(centroids))
        ]
        centroids = unit(np.stack(means))
    return centroids


def pure(
    vectors: np.ndarray, labels: np.ndarray, groups: list[np.ndarray]
) -> list[np.ndarray]:
    """The centroids that stand for their language.

    Mislabelled texts form small clusters of their own, which would attract the texts
    of the language that they are really in. A centroid goes where its language has
    few texts near it, or where too many texts near it are of another language.
    Languages count equally; each keeps its best centroid.
    """
    owners = np.repeat(np.arange(len(groups)), [len(g) for g in groups])
    nearest = (vectors @ np.concatenate(groups).T).argmax(axis=1)
    votes = np.zeros((len(owners), len(groups)))
    np.add.at(votes, (nearest, labels), 1 / np.bincount(labels)[labels])
    own = votes[np.arange(len(owners)), owners]
    good = (own >= MIN_SHARE) & (own >= MIN_PURITY * votes.sum(axis=1))
    kept = []
    for g, group in enumerate(groups):
        keep = good[owners == g]
        keep[own[owners == g].argmax()] = True
        kept.append(group[keep])
    return kept


def fit_rows(texts: list[str], langs: list[str]) -> LanguageModel:
    languages = sorted(set(langs))
    if not languages:
        empty = np.empty((0, BUCKETS), dtype=np.float32)
        return LanguageModel([], np.ones(BUCKETS, np.float32), empty, np.empty(0, int), empty)
    # One matrix, weighted and scaled in place: it is most of what the driver holds.
    vectors = np.empty((len(texts), BUCKETS), dtype=np.float32)
    held = np.zeros(BUCKETS)
    for row, text in zip(vectors, texts, strict=True):
        row[:] = ngram_counts(text)
        held += row > 0
    idf = (np.log((1 + len(texts)) / (1 + held)) + 1).astype(np.float32)
    vectors *= idf
    for row in vectors:
        row /= np.linalg.norm(row) or 1
    labels = np.searchsorted(languages, langs)
    groups = [cluster(vectors[labels == g], CENTROIDS) for g in range(len(languages))]
    groups = pure(vectors, labels, groups)
    limits = [
        np.quantile((vectors[labels == g] @ centroids.T).max(axis=1), REJECTED_SHARE)
        for g, centroids in enumerate(groups)
    ]
    owners = np.repeat(np.arange(len(groups)), [len(g) for g in groups])
    return LanguageModel(languages, idf, np.concatenate(groups), owners, np.array(limits))


def training_sample(labelled: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """About ``sample`` rows of (doc_id, text, lang), evenly over the languages.

    Rows are picked by a hash of their id against the count of their language, so a
    sample is the same on every run and no group is ever gathered.
    """
    usable = labelled.select("doc_id", "text", "lang").filter(
        F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & F.col("text").isNotNull()
    )
    usable = usable.filter(F.length("text") <= MAX_TRAIN_CHARS)
    found = usable.groupBy("lang").agg(F.approx_count_distinct("doc_id", 0.02).alias("n"))
    most = found.orderBy(F.desc("n"), "lang").limit(MAX_LANGUAGES)
    sizes = {row["lang"]: row["n"] for row in most.collect()}
    if not sizes:
        return usable
    share = sample / len(sizes)
    shares = F.create_map(
        *[F.lit(v) for lang, n in sizes.items() for v in (lang, min(1.0, share / n))]
    )
    place = F.pmod(F.xxhash64(F.lit("language"), "doc_id"), F.lit(1 << 30)) / (1 << 30)
    picked = usable.filter(place < shares[F.col("lang")])
    least = F.min(F.struct(F.xxhash64("text").alias("h"), "text")).alias("m")
    return picked.groupBy("doc_id", "lang").agg(least).select("doc_id", "m.text", "lang")


def fit(labelled: DataFrame, sample: int = SAMPLE) -> LanguageModel:
    """A model from rows (doc_id, text, lang); the caller leaves out what is held out."""
    rows = training_sample(labelled, sample).select(
        "doc_id", F.col("text").cast("binary").alias("raw"), "lang"
    )
    found = rows.orderBy("doc_id", "lang").toArrow()
    texts = [raw.decode("utf-8", "replace") for raw in found["raw"].to_pylist()]
    lettered = [i for i, text in enumerate(texts) if any(map(str.isalpha, text))]
    langs = found["lang"].to_pylist()
    return fit_rows([texts[i] for i in lettered], [langs[i] for i in lettered])


def predict_texts(
    model: LanguageModel, texts: list[str | None]
) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Language, cosine and rejection of each text."""
    langs, scores = ["und"] * len(texts), np.zeros(len(texts))
    rejected = np.ones(len(texts), dtype=bool)
    if model.languages:
        lettered = [i for i, t in enumerate(texts) if t and any(map(str.isalpha, t))]
        for start in range(0, len(lettered), BLOCK):
            block = lettered[start : start + BLOCK]
            vectors = unit(np.stack([ngram_counts(texts[i]) for i in block]) * model.idf)
            cosines = vectors @ model.centroids.T
            best = cosines.argmax(axis=1)
            for i, c, cosine in zip(block, best, cosines.max(axis=1), strict=True):
                owner = model.owners[c]
                langs[i] = model.languages[owner]
                scores[i] = min(1.0, max(0.0, float(cosine)))
                rejected[i] = cosine < model.limits[owner]
    return langs, scores, rejected


def identify(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """doc_id, lang_pred, score and rejected of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [
                None if raw is None else raw.decode("utf-8", "replace")
                for raw in batch["raw"].to_pylist()
            ]
            langs, scores, rejected = predict_texts(model, texts)
            yield pa.RecordBatch.from_arrays(
                [
                    batch["doc_id"],
                    pa.array(langs, pa.string()),
                    pa.array(scores, pa.float64()),
                    pa.array(rejected, pa.bool_()),
                ],
                names=["doc_id", "lang_pred", "score", "rejected"],
            )

    schema = "doc_id long, lang_pred string, score double, rejected boolean"
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary").alias("raw"))
    return rows.mapInArrow(run, schema)
