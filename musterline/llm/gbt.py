"""Quality classifier: histogram gradient-boosted trees over statistics of whole documents.

The trees are grown in numpy on a bounded sample of labelled documents, each level from one histogram of gradients per
node, feature and bin. They are complete binary trees kept in flat arrays, which numpy walks for many documents at once.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fresh, small_batches, strings
from .labelled import SAMPLE, sample_of

_CLASS = np.full(256, 5, dtype=np.int64)  # 0 lower, 1 upper, 2 digit, 3 white, 4 mark, 5 beyond ASCII
_CLASS[:128] = 4
_CLASS[[*range(97, 123)]] = 0
_CLASS[[*range(65, 91)]] = 1
_CLASS[[*range(48, 58)]] = 2
_CLASS[[*range(9, 14), 32]] = 3
_PLAIN = np.frombuffer(b".,;:'-", dtype=np.uint8)
_ENDS = (b".", b",", b";", b":", b"!", b"?")


def statistics(text: str) -> list[float]:
    """Numbers that describe a text; all zero for an empty one."""
    data = text.encode()
    words = data.split()
    if not words:
        return [0.0] * len(NAMES)
    raw = np.frombuffer(data, dtype=np.uint8)
    counts = np.bincount(raw, minlength=256)
    kinds = np.bincount(_CLASS, weights=counts, minlength=6) / len(raw)
    marks = np.where(_CLASS == 4, counts, 0)
    odd = marks.copy()
    odd[_PLAIN] = 0
    share = counts[counts > 0] / len(raw)
    n = len(words)
    size = np.fromiter(map(len, words), dtype=np.int64, count=n)
    distinct = len(set(words))
    lines = [x for x in data.split(b"\n") if x.strip()]
    line_size = np.fromiter(map(len, lines), dtype=np.int64, count=len(lines))
    heads = [w[:1] for w in words]
    return [
        np.log1p(len(raw)), np.log1p(n), *kinds.tolist(), marks.max() / len(raw), odd.sum() / len(raw),
        odd.sum() / n, float(-(share * np.log2(share)).sum()), size.mean(), size.std(), np.log1p(size.max()),
        distinct / n, distinct / np.sqrt(n), sum(a == b for a, b in zip(words, words[1:], strict=False)) / n,
        sum(w.endswith(_ENDS) for w in words) / n, sum(w.isupper() for w in words) / n,
        sum(h.isupper() for h in heads) / n, sum(len(w) == 1 for w in words) / n,
        sum(not w.isalpha() for w in words) / n, len(set(lines)) / len(lines), np.log1p(len(lines)),
        np.log1p(line_size.mean()), float(line_size.max() / len(raw)), counts[46] / n, counts[44] / n,
    ]


NAMES = (
    "log_bytes", "log_words", "lower", "upper", "digit", "white", "mark", "beyond", "top_mark", "odd_marks",
    "odd_per_word", "entropy", "word_mean", "word_std", "log_word_max", "distinct", "distinct_root", "repeated",
    "ended", "upper_words", "upper_heads", "single", "not_alpha", "distinct_lines", "log_lines", "log_line_mean",
    "line_share", "stops", "commas",
)


def statistics_of(texts: list[str]) -> np.ndarray:
    """One row of statistics per text; equal texts of a batch are measured once."""
    known = {t: i for i, t in enumerate(dict.fromkeys(texts))}
    rows = np.array([statistics(t) for t in known], dtype=np.float64).reshape(len(known), len(NAMES))
    return rows[[known[t] for t in texts]]


@dataclass(frozen=True)
class Forest:
    """Complete trees of one depth in flat arrays: (tree, node) features and thresholds, (tree, leaf) values."""

    base: float
    depth: int
    feature: np.ndarray
    threshold: np.ndarray
    value: np.ndarray
    rows: int = 0  # documents it was fitted on

    def margin(self, x: np.ndarray) -> np.ndarray:
        at = np.zeros((len(x), len(self.feature)), dtype=np.int64)
        tree, row = np.arange(len(self.feature))[None, :], np.arange(len(x))[:, None]
        for _ in range(self.depth):
            at = 2 * at + 1 + (x[row, self.feature[tree, at]] > self.threshold[tree, at])
        return self.base + self.value[tree, at - (2**self.depth - 1)].sum(axis=1)

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(x), -30, 30)))


def grow(
    x: np.ndarray, y: np.ndarray, trees: int = 80, depth: int = 4, rate: float = 0.15, bins: int = 64,
    ridge: float = 2.0, least: float = 1.0,
) -> Forest:
    """Trees for the logistic loss. Without rows the score is 0.5; with one class it is near that class."""
    nodes, leaves = 2**depth - 1, 2**depth
    mean = (y.sum() + 0.5) / (len(y) + 1)
    base = float(np.log(mean / (1 - mean)))
    if len(np.unique(y)) < 2:
        return Forest(base, depth, np.zeros((1, nodes), int), np.full((1, nodes), np.inf), np.zeros((1, leaves)))
    edges = np.quantile(x, np.linspace(0, 1, bins + 1)[1:-1], axis=0)  # (bins - 1, features)
    binned = np.stack([np.searchsorted(edges[:, f], x[:, f], side="left") for f in range(x.shape[1])], axis=1)
    features = x.shape[1]
    column = np.arange(features) * bins + binned
    margin = np.full(len(y), base)
    made: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        g, h = p - y, p * (1 - p)
        feature, cut = np.zeros(nodes, int), np.full(nodes, bins)
        at = np.zeros(len(y), dtype=np.int64)
        for level in range(depth):
            width, first = 2**level, 2**level - 1
            place = ((at - first)[:, None] * (features * bins) + column).ravel()
            shape = (width, features, bins)
            hist_g = np.bincount(place, np.repeat(g, features), width * features * bins).reshape(shape).cumsum(axis=2)
            hist_h = np.bincount(place, np.repeat(h, features), width * features * bins).reshape(shape).cumsum(axis=2)
            all_g, all_h = hist_g[:, :, -1:], hist_h[:, :, -1:]
            gain = hist_g**2 / (hist_h + ridge) + (all_g - hist_g) ** 2 / (all_h - hist_h + ridge) - all_g**2 / (all_h + ridge)
            gain[(hist_h < least) | (all_h - hist_h < least)] = -1
            best = gain.reshape(width, -1).argmax(axis=1)
            good = gain.reshape(width, -1)[np.arange(width), best] > 1e-6
            feature[first : first + width] = np.where(good, best // bins, 0)
            cut[first : first + width] = np.where(good, best % bins, bins)
            at = 2 * at + 1 + (binned[np.arange(len(y)), feature[at]] > cut[at])
        leaf = at - nodes
        value = -rate * np.bincount(leaf, g, leaves) / (np.bincount(leaf, h, leaves) + ridge)
        margin += value[leaf]
        limit = np.where(cut < bins - 1, edges[np.minimum(cut, bins - 2), feature], np.inf)
        made.append((feature, limit, value))
    return Forest(base, depth, *(np.stack(z) for z in zip(*made, strict=True)))


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", sample: int = SAMPLE) -> Forest:
    """Trees fitted on at most ``sample`` of the labelled documents, chosen by a hash of doc_id."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = statistics_of(list(strings(batch.column(2))))
            yield pa.record_batch({
                "doc_id": batch.column(0), "y": batch.column(1), "x": pa.array(list(x), pa.list_(pa.float64())),
            })

    rows = sample_of(docs, labels, label, sample).select("doc_id", "y", "text")
    measured = rows.mapInArrow(run, "doc_id long, y int, x array<double>")
    found = measured.groupBy("doc_id", "y").agg(F.min("x").alias("x")).orderBy("doc_id").toPandas()
    x = np.array(found["x"].tolist(), dtype=np.float64).reshape(len(found), len(NAMES))
    return replace(grow(x, found["y"].to_numpy(dtype=np.float64)), rows=len(found))


def score(docs: DataFrame, forest: Forest, into: str = "score") -> DataFrame:
    """``docs`` with the probability of label 1 for each whole text in ``into``; null texts count as empty.

    Rows and other columns are kept as they are; an existing column of that name is replaced.
    """
    small_batches(docs.sparkSession)

    @F.arrow_udf("double")
    def scored(text: pa.Array) -> pa.Array:
        return pa.array(forest.score(statistics_of(list(strings(text)))))

    return docs.withColumn(into, scored("text"))


def accepted(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, sample: int = SAMPLE) -> DataFrame:
    """The rows of ``docs`` that score at least ``threshold``; columns as they were.

    Without any label nothing is known against a document, and all stay; labels of one class decide like any others.
    """
    forest = fit(docs, labels, sample=sample)
    if not forest.rows:
        return docs
    name = fresh(docs, "score")
    return score(docs, forest, name).where(F.col(name) >= threshold).drop(name)
