"""Reading level of documents: gradient-boosted regression trees over distributions of length, vocabulary, syntax and cohesion.

Each document becomes a row of numbers that describe how its sentences are distributed (quantiles and shares, so that a
stray hard sentence moves little), how varied and long its words are, how its clauses are joined and how much neighbouring
sentences have in common. Features are computed where the texts are read and written once; no text is read twice.

The trees are trained on the driver on a sample of labelled documents that is bounded by TRAIN_ROWS (below it, on all
labelled documents); raters who differ are averaged. Predictions are calibrated by an isotonic map that is fitted on
cross-validated predictions whose folds never split a source, so that the grades hold for sources never seen. Training is
deterministic.

Defined results: null and empty texts and those of fewer than LEAST_WORDS words have no level; a text of shorter pieces only is
read as one sentence; texts of any length are read whole; equal texts get equal levels; without labels nothing can be trained
and every level is null.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass, field, replace
from math import log1p
from operator import mul

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.plans.durable import durable

#: Labelled documents used for training at most (a sample by the hash of the text, over all labelled documents).
TRAIN_ROWS = 8000
#: Trees, their depth, their learning rate, the fewest rows of a leaf, bins of a feature, folds of the cross-validation.
TREES, DEPTH, RATE, LEAF, BINS, FOLDS = 120, 4, 0.1, 8, 48, 5
#: Documents at or above are too demanding for a general reader: level 4 or 5.
DEMANDING = 3.5
#: Pieces with fewer words are headings, list marks or rests of abbreviations, not sentences.
LEAST_WORDS = 4
#: Letters from which a word is long, and very long.
LONG, VERY_LONG = 7, 11
#: A sentence has so many words or more if it is long, and very long.
LONG_SENTENCE, VERY_LONG_SENTENCE = 20, 35

URL = re.compile(r"https?://\S+|www\.\S+|\[[^\]\n]{0,40}\]")
#: Ends of sentences inside a line, each with the blank after it.
ENDS = tuple(f"{mark}{quote} " for mark in ".!?…" for quote in ("", '"', "”", "’", "»", ")"))
# Words that join clauses side by side, and words that subordinate or qualify, in four languages.
COORDINATE = set("and but so or then und aber oder dann denn et mais ou puis donc y e pero o luego".split())
SUBORDINATE = set(
    "which that who whom whose unless whether although albeit insofar whereas notwithstanding irrespective save provided given under upon itself thereby lest had could would shall may dass sofern wodurch obwohl ungeachtet wonach soweit welche welcher vor qui que dont lorsque bien nonobstant indépendamment dans laquelle selon quoique el cual cuya aunque obstante independientemente medida según quien mientras"
    .split()
)

QUANTILES = (0.1, 0.25, 0.5, 0.75, 0.9)
NAMES = (
    [f"{what}_{int(q * 100)}" for what in ("words", "letters", "long", "clauses", "new") for q in QUANTILES]
    + ["long_sentences", "very_long_sentences", "hard_sentences", "words_in_long", "mean_words", "mean_letters", "share_long", "share_very_long", "variety", "coordinate", "subordinate", "commas", "semicolons", "overlap", "log_words", "log_sentences"]
)


def _quantiles(values: list[float]) -> list[float]:
    values = sorted(values)
    top = len(values) - 1
    out = []
    for q in QUANTILES:
        at = q * top
        i = int(at)
        out.append(values[i] + (at - i) * (values[min(i + 1, top)] - values[i]))
    return out


def features_of(text: str | None) -> list[float] | None:
    if not text:
        return None
    plain = (URL.sub(" ", text) if "http" in text or "[" in text or "www." in text else text).lower()
    for end in ENDS:
        if end in plain:
            plain = plain.replace(end, f"{end[0]}\n")
    counts, letters, longs, clauses, news = [], [], [], [], []
    coordinate = subordinate = commas = semicolons = very = overlap = 0
    seen: set[str] = set()
    last: set[str] = set()
    pieces = plain.split("\n")
    if not any(len(p.split()) >= LEAST_WORDS for p in pieces):
        pieces = [" ".join(pieces)]  # nothing but short pieces: one sentence
    for piece in pieces:
        words = piece.split()
        n = len(words)
        if n < LEAST_WORDS:
            continue
        sizes = sorted(map(len, words))
        own = set(words)
        c, semi = piece.count(","), piece.count(";")
        sub = len(own & SUBORDINATE)
        coordinate += sum(map(words.count, own & COORDINATE))
        subordinate += sub
        commas += c
        semicolons += semi
        counts.append(n)
        letters.append(sum(sizes) / n)
        longs.append((n - bisect_left(sizes, LONG)) / n)
        very += n - bisect_left(sizes, VERY_LONG)
        clauses.append(c + semi + sub)
        overlap += len(own & last) / len(own)
        news.append(len(own - seen) / n)
        seen |= own
        last = own
    k = len(counts)
    if not k:
        return None
    total = sum(counts)
    over = [n for n in counts if n >= LONG_SENTENCE]
    hard = sum(n >= LONG_SENTENCE and (lo >= 0.35 or cl >= 4) for n, lo, cl in zip(counts, longs, clauses, strict=True))
    return [
        *_quantiles(counts), *_quantiles(letters), *_quantiles(longs), *_quantiles(clauses), *_quantiles(news), len(over) / k, sum(n >= VERY_LONG_SENTENCE for n in counts) / k, hard / k, sum(over) / total, total / k, sum(map(mul, letters, counts)) / total, sum(map(mul, longs, counts)) / total, very / total, len(seen) / total**0.7,
        coordinate / total, subordinate / total, commas / total, semicolons / total, overlap / k, log1p(total), log1p(k),
    ]


# ---- gradient-boosted regression trees over binned features


@dataclass
class Forest:
    """Trees of equal depth as arrays: at inner node i a row goes right if its feature exceeds the threshold."""

    base: float = 0.0
    feature: list[np.ndarray] = field(default_factory=list)
    threshold: list[np.ndarray] = field(default_factory=list)
    leaf: list[np.ndarray] = field(default_factory=list)

    def predict(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for f, t, leaf in zip(self.feature, self.threshold, self.leaf, strict=True):
            at = np.zeros(len(x), dtype=np.int64)
            for _ in range(DEPTH):
                at = 2 * at + 1 + (x[rows, f[at]] > t[at])
            out += leaf[at - (2**DEPTH - 1)]
        return out


def train(x: np.ndarray, y: np.ndarray, trees: int = TREES) -> Forest:
    """Squared loss; each level of a tree is found for all its nodes at once from histograms of the residuals."""
    n, m = x.shape
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) for j in range(m)]
    binned = np.stack([np.searchsorted(c, x[:, j], side="left") for j, c in enumerate(cuts)], axis=1)
    wide = BINS
    model = Forest(base=float(y.mean()))
    now = np.full(n, model.base)
    offsets = np.arange(m) * wide
    for _ in range(trees):
        rest = y - now
        at = np.zeros(n, dtype=np.int64)
        feature, threshold = np.zeros(2**DEPTH - 1, dtype=np.int64), np.full(2**DEPTH - 1, np.inf)
        for level in range(DEPTH):
            first, nodes = 2**level - 1, 2**level
            slot = ((at - first)[:, None] * (m * wide) + offsets + binned).ravel()
            count = np.bincount(slot, minlength=nodes * m * wide).reshape(nodes, m, wide)
            total = np.bincount(slot, weights=np.repeat(rest, m), minlength=nodes * m * wide).reshape(nodes, m, wide)
            cl, sl = count.cumsum(2)[:, :, :-1], total.cumsum(2)[:, :, :-1]
            c, s = count.sum(2, keepdims=True), total.sum(2, keepdims=True)
            cr, sr = c - cl, s - sl
            ok = (cl >= LEAF) & (cr >= LEAF)
            gain = np.where(ok, sl**2 / np.maximum(cl, 1) + sr**2 / np.maximum(cr, 1) - s**2 / np.maximum(c, 1), -1.0).reshape(nodes, -1)
            best = gain.argmax(1)
            for i in range(nodes):
                j, b = divmod(int(best[i]), wide - 1)
                if gain[i, best[i]] > 1e-9 and b < len(cuts[j]):
                    feature[first + i], threshold[first + i] = j, cuts[j][b]
            at = 2 * at + 1 + (x[np.arange(n), feature[at]] > threshold[at])
        slot = at - (2**DEPTH - 1)
        count, total = np.bincount(slot, minlength=2**DEPTH), np.bincount(slot, weights=rest, minlength=2**DEPTH)
        leaf = RATE * total / (count + 1.0)
        now += leaf[slot]
        model.feature.append(feature)
        model.threshold.append(threshold)
        model.leaf.append(leaf)
    return model


def isotonic(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The non-decreasing map from predictions to labels with the least squares, as points to interpolate between."""
    order = np.argsort(x, kind="stable")
    blocks: list[list[float]] = []
    for a, b in zip(x[order], y[order], strict=True):
        blocks.append([b, 1.0, a])
        while len(blocks) > 1 and blocks[-2][0] >= blocks[-1][0]:
            v, w, s = blocks.pop()
            u = blocks[-1]
            blocks[-1] = [(u[0] * u[1] + v * w) / (u[1] + w), u[1] + w, (u[2] * u[1] + s * w) / (u[1] + w)]
    return np.array([b[2] for b in blocks]), np.array([b[0] for b in blocks])


@dataclass
class Grader:
    """A forest, its calibration and what the cross-validation by source measured."""

    forest: Forest
    points: tuple[np.ndarray, np.ndarray]
    rows: int
    error: float
    agreement: float
    held: list[tuple[str, float, float]] = field(default_factory=list)  # source, label and held-out grade of each row

    def grade(self, x: np.ndarray) -> np.ndarray:
        return np.clip(np.interp(self.forest.predict(x), *self.points), 1.0, 5.0)


def fit(x: np.ndarray, y: np.ndarray, source: np.ndarray) -> Grader:
    """Cross-validated by source, calibrated on the held-out predictions, then trained on all rows."""
    names, inverse, sizes = np.unique(source.astype(str), return_inverse=True, return_counts=True)
    load, fold_of = np.zeros(FOLDS), np.zeros(len(names), dtype=np.int64)
    for i in np.argsort(-sizes, kind="stable"):  # whole sources, the largest first, into the emptiest fold
        fold_of[i] = load.argmin()
        load[fold_of[i]] += sizes[i]
    fold = fold_of[inverse]
    held = np.zeros(len(y))
    for f in range(FOLDS):
        out = fold == f
        held[out] = train(x[~out], y[~out]).predict(x[out]) if out.any() and (~out).any() else y.mean()
    # what is measured on a fold is calibrated on the others only
    graded = np.full(len(y), y.mean())
    for f in range(FOLDS):
        out = fold == f
        if out.any() and (~out).any():
            graded[out] = np.clip(np.interp(held[out], *isotonic(held[~out], y[~out])), 1.0, 5.0)
    rows = list(zip(source.astype(str).tolist(), y.tolist(), graded.tolist(), strict=True))
    return Grader(train(x, y), isotonic(held, y), len(y), float(np.abs(graded - y).mean()), float(((graded >= DEMANDING) == (y >= DEMANDING)).mean()), rows)


# ---- Spark


def with_features(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """(key, source, a hash of the text, its features); written once to the shared folder."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"key": b["key"], "source": b["source"], "h": b["h"], "x": [features_of(t) for t in b["text"]]})

    slim = docs.filter(F.length(text) > 0).select(F.col(key).alias("key"), F.col(source).alias("source"), F.xxhash64(text).alias("h"), F.col(text).alias("text"))
    kind = docs.schema[key].dataType.simpleString()
    return durable(slim.mapInPandas(run, f"key {kind}, source string, h long, x array<double>").filter("x IS NOT NULL"))


def fit_labels(features: DataFrame, labels: DataFrame, label_key: str = "doc_id", level: str = "reading_level", rows: int = TRAIN_ROWS) -> Grader | None:
    """The grader of the labelled documents; the sample that reaches the driver has at most `rows` rows of features."""
    means = labels.filter(F.col(level).isNotNull()).groupBy(F.col(label_key).alias("key")).agg(F.avg(level).alias("y"))
    sample = features.join(means, "key").orderBy(F.xxhash64("h"), "key").limit(rows).select("x", "y", F.coalesce("source", F.lit("")).alias("source")).toPandas()
    if sample.empty:
        return None
    return fit(np.array(sample["x"].tolist(), dtype=float), sample["y"].to_numpy(dtype=float), sample["source"].to_numpy())


def graded(features: DataFrame, grader: Grader | None, key: str = "doc_id") -> DataFrame:
    """(key, source, level) for each document with features; level from 1 (easiest) to 5."""
    kind = features.schema["key"].dataType.simpleString()
    if grader is None:
        return features.select(F.col("key").alias(key), "source", F.lit(None).cast("double").alias("level"))
    shared = features.sparkSession.sparkContext.broadcast(replace(grader, held=[]))  # TREES * 2**DEPTH numbers

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            x = np.array(b["x"].tolist(), dtype=float).reshape(len(b), -1)
            yield pd.DataFrame({key: b["key"], "source": b["source"], "level": shared.value.grade(x) if len(b) else np.array([])})

    return features.mapInPandas(run, f"{key} {kind}, source string, level double")


def levels(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    features = with_features(docs, key, text, source)
    return graded(features, fit_labels(features, labels), key)


def held_out(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """(source, labelled, mean_label, mean_level, error, agreement): grades against labels by source, each source graded by trees
    and a calibration that have not seen it. Over the training sample, so at most TRAIN_ROWS rows."""
    grader = fit_labels(with_features(docs, key, text, source), labels, key)
    rows = docs.sparkSession.createDataFrame(grader.held if grader else [], "source string, label double, level double")
    agree = (F.col("level") >= DEMANDING) == (F.col("label") >= DEMANDING)
    mean = lambda c, name: F.round(F.avg(c), 4).alias(name)
    return rows.groupBy("source").agg(F.count(F.lit(1)).alias("labelled"), mean("label", "mean_label"), mean("level", "mean_level"), mean(F.abs(F.col("level") - F.col("label")), "error"), mean(agree.cast("int"), "agreement"))
