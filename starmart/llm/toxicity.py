"""Toxicity by a convolutional text classifier.

A word's vector is the sum of hashed embeddings: of the word and of its first four and
five characters, which covers words never seen in training. Filters over one, two and
three neighbouring words are pooled by their maximum over the whole text and feed a
logistic output. Everything is trained in numpy.

The model is fitted on the driver, on a bounded sample of labelled rows: about SAMPLE
documents, half of each class where there are as many, none longer than
MAX_TRAIN_CHARS, one row for an id. Tasks turn their texts into hashes of two bytes, three
a word, and only those come to the driver. A fifth of them is kept back to calibrate scores,
so that 0.3 is the best threshold over all languages, and to find the best threshold of
each language. Neither language, source, label nor id is an input of a score. Scoring
reads every whole text, without a shuffle.

Defined results: NULL, empty and blank texts score as a text without words. Without any
usable label, or with one class only, all scores are 0. Repeated rows get equal results;
of several rows of an id, the model is fitted on the one of least text hash. Bytes that are
not UTF-8 read as U+FFFD. Columns of the input that are not needed are left alone.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

BUCKETS = 1 << 16
WIDTH = 16
FILTERS = 16
SPANS = (1, 2, 3)
PREFIXES = (4, 5)
EPOCHS = 4
RATE = 0.05
SAMPLE = 6000
MAX_TRAIN_CHARS = 50_000
# Scores are shifted so that this is the threshold with the best F1.
THRESHOLD = 0.3
# Features of fewer training texts stay zero: what no text or one text has tells nothing,
# and a random vector would win a maximum over a long text sooner or later.
MIN_TEXTS = 3
# A language needs so many calibration rows of each class for its own threshold.
MIN_ROWS = 20
# Word positions that are convolved at once.
BLOCK = 1 << 17
# The column with the score, unless the caller wants another name.
SCORE = "_toxicity"

WORD = re.compile(r"\w+")


@dataclass
class ToxicityModel:
    embeddings: np.ndarray
    filters: list[np.ndarray]
    biases: list[np.ndarray]
    weights: np.ndarray
    bias: float
    scale: float = 1.0
    shift: float = 0.0
    thresholds: dict[str, float] | None = None

    def scores(self, logits: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.scale * logits + self.shift, -30, 30)))


def features(word: str) -> list[int]:
    parts = [word, *[f"{n}:{word[:n]}" for n in PREFIXES]]
    return [xxhash.xxh3_64_intdigest(p.encode("utf-8", "replace")) % BUCKETS for p in parts]


def indexed(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features of the distinct words, and the texts as places among them.

    Place 0 stands for no word; every text ends in enough of it for the longest span,
    so that no window reaches into the next text.
    """
    places: dict[str, int] = {}
    ids, starts = [], [0]
    padding = [0] * max(SPANS)
    for text in texts:
        if text:
            ids += [places.setdefault(w, len(places) + 1) for w in WORD.findall(text.lower())]
        ids += padding
        starts.append(len(ids))
    table = np.array([features(w) for w in places], dtype=np.int64)
    table = table.reshape(len(places), 1 + len(PREFIXES))
    return table, np.array(ids, dtype=np.int32), np.array(starts)


def featurised(texts: list[str | None]) -> list[np.ndarray]:
    """The features of each text's words, in order: a row of 1 + len(PREFIXES) a word."""
    table, ids, starts = indexed(texts)
    found = [ids[a : b - max(SPANS)] - 1 for a, b in zip(starts[:-1], starts[1:], strict=True)]
    return [table[places].astype(np.uint16) for places in found]


def pooled(model: ToxicityModel, table: np.ndarray, ids: np.ndarray, starts: np.ndarray):
    """The maximum of each filter over each text, in blocks of positions."""
    vectors = np.zeros((len(table) + 1, WIDTH), dtype=np.float32)
    vectors[1:] = model.embeddings[table].sum(axis=1)
    out = np.zeros((len(starts) - 1, len(SPANS) * FILTERS), dtype=np.float32)
    pad = max(SPANS)
    for s, span in enumerate(SPANS):
        parts = model.filters[s].reshape(span, WIDTH, FILTERS)
        projected = [vectors @ part for part in parts]
        columns = slice(s * FILTERS, (s + 1) * FILTERS)
        best = np.full((len(starts) - 1, FILTERS), -np.inf, dtype=np.float32)
        # As in training, a text without words is one window of nothing.
        best[np.diff(starts) == pad] = 0
        for begin in range(0, len(ids) - pad + 1, BLOCK):
            end = min(begin + BLOCK, len(ids) - span + 1)
            found = projected[0][ids[begin:end]]
            for k in range(1, span):
                found = found + projected[k][ids[begin + k : end + k]]
            first = np.searchsorted(starts, begin, side="right") - 1
            last = np.searchsorted(starts, end, side="left")
            cuts = np.maximum(starts[first:last], begin)
            # Windows that begin in the padding after a text do not count.
            stops = np.minimum(starts[first + 1 : last + 1] - pad, end)
            keep = cuts < stops
            if keep.any():
                bounds = np.stack([cuts[keep], stops[keep]], axis=1).ravel() - begin
                bounds = bounds[:-1] if bounds[-1] >= end - begin else bounds
                top = np.maximum.reduceat(found, bounds, axis=0)[::2]
                rows = np.arange(first, last)[keep]
                best[rows] = np.maximum(best[rows], top)
        out[:, columns] = np.maximum(best + model.biases[s], 0)
    return out


def logits(model: ToxicityModel, texts: list[str | None]) -> np.ndarray:
    if not texts:
        return np.empty(0)
    return pooled(model, *indexed(texts)) @ model.weights + model.bias


class Adagrad:
    def __init__(self, array: np.ndarray):
        self.array, self.squares = array, np.full_like(array, 1e-6)

    def step(self, gradient: np.ndarray, rows=slice(None)) -> None:
        self.squares[rows] += gradient * gradient
        self.array[rows] -= RATE * gradient / np.sqrt(self.squares[rows])


def known_features(texts: list[np.ndarray]) -> np.ndarray:
    """Whether a feature occurs in at least MIN_TEXTS of the featurised texts."""
    held = np.zeros(BUCKETS, dtype=np.int64)
    for words in texts:
        held[np.unique(words)] += 1
    return held >= min(MIN_TEXTS, len(texts))


def feature_logits(model: ToxicityModel, texts: list[np.ndarray]) -> np.ndarray:
    """``logits`` of featurised texts."""
    pad = max(SPANS)
    out = [np.empty(0)]
    for text in texts:
        ids = np.concatenate([np.arange(1, len(text) + 1), np.zeros(pad, dtype=np.int64)])
        found = pooled(model, text, ids, np.array([0, len(ids)]))
        out.append(found @ model.weights + model.bias)
    return np.concatenate(out)


def train(texts: list[np.ndarray], toxic: np.ndarray, seed: int = 7) -> ToxicityModel:
    """Stochastic gradient steps of one featurised text each.

    Pooling passes a gradient only to the window that won, so a step touches a few rows
    of the embeddings, however long the text is.
    """
    rng = np.random.default_rng(seed)
    model = ToxicityModel(
        rng.normal(0, 0.1, (BUCKETS, WIDTH)).astype(np.float32),
        [rng.normal(0, 0.3, (s * WIDTH, FILTERS)).astype(np.float32) for s in SPANS],
        [np.zeros(FILTERS, dtype=np.float32) for _ in SPANS],
        rng.normal(0, 0.3, len(SPANS) * FILTERS).astype(np.float32),
        0.0,
    )
    known = known_features(texts)
    model.embeddings[~known] = 0
    embeddings = Adagrad(model.embeddings)
    filters = [Adagrad(f) for f in model.filters]
    biases = [Adagrad(b) for b in model.biases]
    weights, bias = Adagrad(model.weights), Adagrad(np.zeros(1, dtype=np.float32))
    balance = np.where(toxic == 1, 0.5 / max(toxic.mean(), 1e-6), 0.5 / max(1 - toxic.mean(), 1e-6))
    for _ in range(EPOCHS):
        for d in rng.permutation(len(texts)):
            real = len(texts[d])
            rows = np.pad(texts[d].astype(np.int64), ((0, max(SPANS)), (0, 0)))
            x = model.embeddings[rows].sum(axis=1)
            x[real:] = 0
            windows, winners, hidden = [], [], []
            for s, span in enumerate(SPANS):
                n = max(real, 1)
                stacked = np.concatenate([x[k : n + k] for k in range(span)], axis=1)
                values = stacked @ model.filters[s]
                winner = values.argmax(axis=0)
                windows.append(stacked[winner])
                winners.append(winner)
                hidden.append(np.maximum(values.max(axis=0) + model.biases[s], 0))
            h = np.concatenate(hidden)
            p = 1 / (1 + np.exp(-np.clip(h @ model.weights + bias.array[0], -30, 30)))
            error = np.float32((p - toxic[d]) * balance[d])
            dh = error * model.weights * (h > 0)
            weights.step(error * h)
            bias.step(np.array([error], dtype=np.float32))
            dx = np.zeros_like(x)
            for s, span in enumerate(SPANS):
                g = dh[s * FILTERS : (s + 1) * FILTERS]
                back = model.filters[s].T * g[:, None]
                filters[s].step(windows[s].T * g[None, :])
                biases[s].step(g)
                for k in range(span):
                    np.add.at(dx, winners[s] + k, back[:, k * WIDTH : (k + 1) * WIDTH])
            dx[real:] = 0
            touched = np.flatnonzero(np.abs(dx).sum(axis=1))
            if len(touched):
                slots, inverse = np.unique(rows[touched], return_inverse=True)
                gradient = np.zeros((len(slots), WIDTH), dtype=np.float32)
                np.add.at(gradient, inverse.reshape(-1), np.repeat(dx[touched], rows.shape[1], axis=0))
                embeddings.step(gradient[known[slots]], slots[known[slots]])
    model.bias = float(bias.array[0])
    return model


def best_threshold(scores: np.ndarray, toxic: np.ndarray, weights: np.ndarray) -> float:
    """Midway between the two scores around the cut with the best F1."""
    order = np.argsort(-scores, kind="stable")
    s, hits = scores[order], np.cumsum((toxic * weights)[order])
    f1 = 2 * hits / (np.cumsum(weights[order]) + (toxic * weights).sum())
    f1[:-1][s[:-1] == s[1:]] = -1
    cut = int(np.argmax(f1))
    return float((s[cut] + s[cut + 1]) / 2) if cut + 1 < len(s) else float(s[cut])


def calibrate(
    model: ToxicityModel, texts: list[np.ndarray], toxic: np.ndarray, langs: list, weights: np.ndarray
) -> None:
    """Sets scale and shift (so that THRESHOLD is best) and the languages' thresholds."""
    raw = feature_logits(model, texts)
    a, b = 1.0, 0.0
    for _ in range(50):  # Newton steps for the logistic fit, with a small ridge
        p = 1 / (1 + np.exp(-np.clip(a * raw + b, -30, 30)))
        r, w = weights * (p - toxic), weights * p * (1 - p) + 1e-9
        g = np.array([r @ raw + 1e-2 * (a - 1), r.sum() + 1e-2 * b])
        h = np.array([[w @ (raw * raw) + 1e-2, w @ raw], [w @ raw, w.sum() + 1e-2]])
        step = np.linalg.solve(h, g)
        a, b = a - np.clip(step[0], -1, 1), b - np.clip(step[1], -1, 1)
    model.scale = max(float(a), 1e-3)
    cut = best_threshold(model.scale * raw, toxic, weights)
    model.shift = float(np.log(THRESHOLD / (1 - THRESHOLD)) - cut)
    scores, langs = model.scores(raw), np.array([str(x) for x in langs])
    model.thresholds = {}
    for lang in np.unique(langs):
        own = langs == lang
        if min(toxic[own].sum(), (1 - toxic[own]).sum()) >= MIN_ROWS:
            model.thresholds[str(lang)] = best_threshold(scores[own], toxic[own], weights[own])


def training_sample(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """About ``sample`` rows (doc_id, text, lang, toxic, weight), half of each class.

    Label rows are picked by a hash of their id against the count of their class; that
    bounded set is broadcast to the documents. Each picked id gives one row, chosen
    within tasks before the few that are left are shuffled, however many rows it has.
    """
    usable = labels.select("doc_id", "toxic").filter(
        F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1)
    )
    one_each = usable.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    sizes = dict(one_each.groupBy("toxic").count().collect())
    shares = [min(1.0, sample / 2 / max(sizes.get(c, 0), 1)) for c in (0, 1)]
    place = F.pmod(F.xxhash64(F.lit("toxicity"), "doc_id"), F.lit(1 << 30)) / (1 << 30)
    share = F.when(F.col("toxic") == 1, shares[1]).otherwise(shares[0])
    picked = one_each.filter(place < share).withColumn("weight", 1 / share)
    short = docs.select("doc_id", "text", "lang").filter(
        F.length("text") <= MAX_TRAIN_CHARS
    )
    row = F.struct("text", "lang")
    found = short.join(F.broadcast(picked), "doc_id").groupBy("doc_id", "toxic", "weight")
    return found.agg(F.min(F.struct(F.xxhash64("text").alias("h"), row.alias("r"))).alias("m")).select(
        "doc_id", "m.r.text", "m.r.lang", "toxic", "weight"
    )


def with_features(sample: DataFrame) -> DataFrame:
    """doc_id, lang, toxic, weight and words (the features, two bytes each) of a sample."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = readable(batch["raw"])
            words = [found.tobytes() for found in featurised(texts)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(words, pa.binary())],
                names=[*batch.schema.names[:-1], "words"],
            )

    rows = sample.select(
        F.col("doc_id").cast("long").alias("doc_id"), "lang", F.col("toxic").cast("int").alias("toxic"),
        F.col("weight").cast("double").alias("weight"), F.col("text").cast("binary").alias("raw"),
    )
    return rows.mapInArrow(run, "doc_id long, lang string, toxic int, weight double, words binary")


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> ToxicityModel | None:
    """A model from documents and their labels; the caller leaves out what is held out."""
    rows = with_features(training_sample(docs, labels, sample)).orderBy("doc_id").toArrow()
    toxic = rows["toxic"].to_numpy().astype(np.float64)
    kept_back = np.array(
        [xxhash.xxh3_64_intdigest(str(i).encode()) % 5 == 0 for i in rows["doc_id"].to_pylist()],
        dtype=bool,
    )
    parts = [np.flatnonzero(~kept_back), np.flatnonzero(kept_back)]
    if any(len(np.unique(toxic[part])) < 2 for part in parts):
        parts = [np.arange(len(toxic))] * 2
    if len(np.unique(toxic)) < 2:
        return None
    width = 1 + len(PREFIXES)
    texts = [
        np.frombuffer(words.as_buffer(), np.uint16).reshape(-1, width) for words in rows["words"]
    ]
    model = train([texts[i] for i in parts[0]], toxic[parts[0]])
    langs, weights = rows["lang"].to_pylist(), rows["weight"].to_numpy()
    calibrate(
        model,
        [texts[i] for i in parts[1]],
        toxic[parts[1]],
        [langs[i] for i in parts[1]],
        weights[parts[1]],
    )
    return model


def readable(texts: pa.Array) -> list[str | None]:
    return [
        t if t is None else t.decode("utf-8", "replace")
        for t in texts.cast(pa.binary()).to_pylist()
    ]


def score(docs: DataFrame, model: ToxicityModel | None, name: str = SCORE) -> DataFrame:
    """The rows of ``docs`` with the score (0 to 1) as a further, last column ``name``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = readable(batch["text"])
            found = model.scores(logits(model, texts)) if model else np.zeros(len(texts))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(found, pa.float64())],
                names=[*batch.schema.names, name],
            )

    return docs.mapInArrow(run, StructType([*docs.schema, StructField(name, DoubleType())]))


def is_toxic(model: ToxicityModel | None, name: str = SCORE) -> Column:
    """The verdict on scored rows, by the threshold of the row's language."""
    verdict = F.col(name) >= THRESHOLD
    for lang, threshold in (model.thresholds if model else {}).items():
        verdict = F.when(F.col("lang") == lang, F.col(name) >= threshold).otherwise(verdict)
    return verdict
