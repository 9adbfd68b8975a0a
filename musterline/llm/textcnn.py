"""Toxicity: a convolutional text classifier over hashed word embeddings, trained in numpy.

A word has two hashed embeddings, which are added. Filters of several widths slide over the whole text; what each
responds most to anywhere (max pooling) goes through a logistic unit. The scores are calibrated on labelled texts that
the filters have not seen, and a threshold is set for each language.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches, strings
from .labelled import sample_of

BUCKETS = 1 << 16
WIDTHS = (1, 2, 3)
#: Words convolved at a time.
BLOCK = 1 << 15
CACHE = 400_000
_BLANK = bytes(
    b if 97 <= b < 123 or b >= 128 else b + 32 if 65 <= b < 91 else 32 for b in range(256)
)
_cache: dict[bytes, int] = {}


def word_codes(text: str) -> np.ndarray:
    """Hash of each word: runs of letters, A-Z lowered, everything beyond ASCII counted as a letter."""
    words = text.encode().translate(_BLANK).split()
    if len(_cache) > CACHE:
        _cache.clear()
    for w in set(words).difference(_cache):
        _cache[w] = zlib.crc32(w) << 32 | zlib.adler32(w + w[::-1] + b"%d" % len(w)) if w else 0
    return np.fromiter(map(_cache.__getitem__, words), dtype=np.uint64, count=len(words))


def rows_of(codes: np.ndarray) -> np.ndarray:
    """(2, words) rows of the embedding table: one in each half."""
    mixed = codes * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(29)
    first = (mixed >> np.uint64(40)) % np.uint64(BUCKETS)
    second = ((mixed * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(40)) % np.uint64(BUCKETS) + np.uint64(BUCKETS)
    return np.stack([first, second]).astype(np.int64)


@dataclass
class Net:
    embed: np.ndarray  # (2 * BUCKETS, dims)
    filters: list[np.ndarray]  # per width: (width, dims, filters)
    bias: np.ndarray  # (widths * filters,)
    out: np.ndarray  # (widths * filters,)
    offset: float = 0.0
    scale: float = 1.0
    shift: float = 0.0
    thresholds: dict[str, float] = field(default_factory=dict)

    def pooled(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Largest response of each filter over all of a text and where its window begins; 0 and -1 if none fits."""
        count = self.filters[0].shape[2]
        best = np.full(len(WIDTHS) * count, -np.inf, dtype=np.float32)
        where = np.full(len(best), -1)
        for at in range(0, len(codes), BLOCK):
            rows = rows_of(codes[at : at + BLOCK + max(WIDTHS) - 1])
            e = self.embed[rows[0]] + self.embed[rows[1]]
            for k, (width, w) in enumerate(zip(WIDTHS, self.filters, strict=True)):
                if len(e) < width:
                    continue
                r = e[: len(e) - width + 1] @ w[0]
                for j in range(1, width):
                    r += e[j : len(e) - width + 1 + j] @ w[j]
                top = r.argmax(axis=0)
                value = r[top, np.arange(count)]
                part = slice(k * count, (k + 1) * count)
                better = value > best[part]
                where[part] = np.where(better, at + top, where[part])
                best[part] = np.where(better, value, best[part])
        return np.where(where < 0, 0, best), where

    def margin(self, codes: np.ndarray) -> float:
        best, where = self.pooled(codes)
        return float(np.where(where >= 0, np.maximum(best + self.bias, 0), 0) @ self.out + self.offset)

    def score(self, margins: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.scale * margins + self.shift, -30, 30)))


def train(
    codes: list[np.ndarray], y: np.ndarray, dims: int = 8, filters: int = 8, epochs: int | None = None, rate: float = 0.05, seed: int = 7
) -> Net:
    """Stochastic training of all parts by Adagrad, one text after the other; few texts are passed over more often.

    The first dimension of an embedding starts as how much more often its words occur in texts of label 1 than of 0.
    """
    rng = np.random.default_rng(seed)
    net = Net(
        rng.normal(0, 0.05, (2 * BUCKETS, dims)).astype(np.float32),
        [rng.normal(0, 0.3, (w, dims, filters)).astype(np.float32) for w in WIDTHS],
        np.zeros(len(WIDTHS) * filters, dtype=np.float32),
        np.full(len(WIDTHS) * filters, 0.3, dtype=np.float32),
    )
    for w in net.filters:
        w[:, 0, :] = np.abs(w[:, 0, :]) + 0.3 / len(w)
    in_one, in_zero = np.zeros(2 * BUCKETS), np.zeros(2 * BUCKETS)
    for c, label in zip(codes, y, strict=True):
        seen = np.unique(rows_of(c))
        (in_one if label else in_zero)[seen] += 1
    ones, zeros = max(1, y.sum()), max(1, len(y) - y.sum())
    lift = np.log((in_one + 0.5) / (ones + 1)) - np.log((in_zero + 0.5 * zeros / ones) / (zeros + zeros / ones))
    known = in_one + in_zero >= 3
    net.embed[:, 0] = np.where(known, np.clip(lift, -2, 4) * np.sqrt((in_one + in_zero) / (in_one + in_zero + 5)), 0) / 2
    grads = {k: np.full_like(v, 0.1) for k, v in (("e", net.embed), ("b", net.bias), ("o", net.out))}
    grads_f = [np.full_like(w, 0.1) for w in net.filters]
    offset_g = 0.1
    net.offset = float(np.log(ones / zeros)) - 1.0

    def step(value: np.ndarray, total: np.ndarray, grad: np.ndarray, at=slice(None)) -> None:
        total[at] += grad**2
        value[at] -= rate * grad / np.sqrt(total[at])

    for _ in range(epochs or min(12, max(3, 24_000 // max(1, len(codes))))):
        for i in rng.permutation(len(codes)):
            best, where = net.pooled(codes[i])
            active = (where >= 0) & (best + net.bias > 0)
            hidden = np.where(active, best + net.bias, 0)
            error = 1 / (1 + np.exp(-np.clip(hidden @ net.out + net.offset, -30, 30))) - y[i]
            back = np.where(active, error * net.out, 0).astype(np.float32)
            step(net.out, grads["o"], (error * hidden + 1e-5 * net.out).astype(np.float32))
            step(net.bias, grads["b"], back)
            offset_g += error**2
            net.offset -= rate * error / np.sqrt(offset_g)
            if not active.any():
                continue
            for k, width in enumerate(WIDTHS):
                for f in np.flatnonzero(active[k * filters : (k + 1) * filters]):
                    u = k * filters + f
                    rows = rows_of(codes[i][where[u] : where[u] + width])
                    w = net.filters[k][:, :, f]
                    g_w = back[u] * (net.embed[rows[0]] + net.embed[rows[1]])
                    g_e = back[u] * w
                    w_total = grads_f[k][:, :, f]
                    w_total += g_w**2
                    w -= rate * g_w / np.sqrt(w_total)
                    for half in rows:
                        step(net.embed, grads["e"], g_e, half)
    return net


def calibrate(net: Net, margins: np.ndarray, y: np.ndarray, langs: list[str | None], target: float) -> None:
    """Turn margins into probabilities by a logistic fit, and set each language's threshold.

    The threshold of a language is the lowest score at which at least ``target`` of the texts above it have label 1;
    languages without enough labelled texts use the threshold of all.
    """
    a, b = 1.0, 0.0
    goal = np.where(y > 0, (y.sum() + 1) / (y.sum() + 2), 1 / (len(y) - y.sum() + 2))
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * margins + b, -30, 30)))
        g, h = p - goal, np.maximum(p * (1 - p), 1e-6)
        grad = np.array([(g * margins).sum() + 1e-3 * (a - 1), g.sum()])
        hess = np.array([[(h * margins**2).sum() + 1e-3, (h * margins).sum()], [(h * margins).sum(), h.sum()]])
        move = np.linalg.solve(hess + 1e-9 * np.eye(2), grad)
        a, b = a - float(np.clip(move[0], -1, 1)), b - float(np.clip(move[1], -2, 2))
    net.scale, net.shift = max(a, 0.05), b
    scores = net.score(margins)

    def lowest(pick: np.ndarray) -> float:
        order = np.argsort(-scores[pick], kind="stable")
        good = np.cumsum(y[pick][order]) / np.arange(1, len(order) + 1) >= target
        return float(scores[pick][order][np.flatnonzero(good)[-1]]) if good.any() else 0.5

    net.thresholds[""] = lowest(np.arange(len(y)))
    for lang in {x for x in langs if x}:
        pick = np.array([i for i, x in enumerate(langs) if x == lang])
        if y[pick].sum() >= 10:
            net.thresholds[lang] = lowest(pick)


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", sample: int = 8000, target: float = 0.8) -> Net:
    """A net fitted on at most ``sample`` labelled documents, a fifth of which only calibrate it.

    Texts are hashed word by word on the executors; the driver gets one number per word of the sample.
    """
    small_batches(docs.sparkSession)

    @F.arrow_udf("binary")
    def hashed(text: pa.Array) -> pa.Array:
        return pa.array([word_codes(t).tobytes() for t in strings(text)], pa.binary())

    rows = sample_of(docs, labels, label, sample).select("doc_id", "y", "lang", hashed("text").alias("codes"))
    one = rows.groupBy("doc_id").agg(F.min(F.struct("y", "lang", "codes")).alias("r")).select("doc_id", "r.*")
    found = one.orderBy(F.xxhash64("doc_id"), "doc_id").toPandas()
    codes = [np.frombuffer(c, dtype=np.uint64) for c in found["codes"]]
    y = found["y"].to_numpy(dtype=np.float64)
    apart = np.arange(len(y)) % 5 == 4
    net = train([c for c, x in zip(codes, apart, strict=True) if not x], y[~apart])
    if len(np.unique(y[apart])) == 2:
        margins = np.array([net.margin(c) for c, x in zip(codes, apart, strict=True) if x])
        calibrate(net, margins, y[apart], [v for v, x in zip(found["lang"], apart, strict=True) if x], target)
    return net


def score(docs: DataFrame, net: Net, into: str = "score", text: str = "text") -> DataFrame:
    """``docs`` with the probability of label 1 for each whole text in ``into``.

    Only the text counts. Null and empty texts get the score of a text in which no filter responds. Rows and other
    columns are kept; an existing column of that name is replaced.
    """
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(net)

    @F.arrow_udf("double")
    def scored(column: pa.Array) -> pa.Array:
        own = shared.value
        known: dict[str, float] = {}
        for t in strings(column):
            if t not in known:
                known[t] = own.margin(word_codes(t))
        return pa.array(own.score(np.array([known[t] for t in strings(column)], dtype=np.float64)))

    return docs.withColumn(into, scored(text))


def flagged(docs: DataFrame, net: Net, score: str = "score", into: str = "flagged") -> DataFrame:
    """``docs`` with whether the score reaches the threshold of the row's language."""
    limits = F.create_map(*[F.lit(x) for item in net.thresholds.items() for x in item]) if net.thresholds else None
    lang = F.col("lang") if "lang" in docs.columns else F.lit(None).cast("string")
    limit = F.lit(0.5) if limits is None else F.coalesce(limits[F.coalesce(lang, F.lit(""))], limits[F.lit("")])
    return docs.withColumn(into, F.col(score) >= limit)
