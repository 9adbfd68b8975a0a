"""K-means for many numbers of clusters and restarts at once.

All models that have not settled are moved by one pass over the points: a task adds up the points nearest to each of their
centres, Spark adds up the tasks, and the driver gets one row per centre. So a pass serves every model, and the passes are as
many as the longest run takes. The points are packed once into blocks of plain numbers, which the passes read without taking
rows apart; distances to all centres are one matrix product, and so are the sums. The first centres come from a few passes that draw many candidates in parallel, each point
with a chance in proportion to its distance from those drawn so far, and from a weighted choice among the candidates.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Points whose distances to all centres are held at a time.
ROWS = 4096

Array = np.ndarray


@dataclass(frozen=True)
class Centres:
    """Centres of one model, its cost (sum of squared distances) and the passes until it settled."""

    k: int
    restart: int
    places: Array
    cost: float
    passes: int


def _packed(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One block per batch: the numbers of its points, one point after the other."""
    for frame in frames:
        flat = frame.column(0).flatten().to_numpy(zero_copy_only=False)
        if len(flat):
            yield pa.RecordBatch.from_arrays([pa.array([flat.astype("<f8").tobytes()], pa.binary())], names=["block"])


def _points(frames: Iterator[pa.RecordBatch], width: int) -> Iterator[Array]:
    for frame in frames:
        for block in frame.column(0):
            flat = np.frombuffer(block.as_buffer(), dtype="<f8").reshape(-1, width)
            for i in range(0, len(flat), ROWS):
                yield flat[i : i + ROWS]


def _squares(x: Array, centres: Array) -> Array:
    """Squared distances of every point to every centre."""
    return np.maximum((x * x).sum(axis=1)[:, None] - 2 * x @ centres.T + (centres * centres).sum(axis=1), 0.0)


def _uniform(x: Array, salt: int) -> Array:
    """A number from 0 to 1 per row, the same wherever the row is."""
    h = np.full(len(x), salt * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF, dtype=np.uint64)
    for column in np.ascontiguousarray(x).view(np.uint64).T:
        h = (h ^ column) * np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(31)
        h *= np.uint64(0x94D049BB133111EB)
        h ^= h >> np.uint64(29)
    return (h >> np.uint64(11)) / float(1 << 53)


SUMS = "model int, cluster int, n long, cost double, sums array<double>"
BLOCKS = "block binary"


def _sums(models: Sequence[tuple[int, Array]], width: int):
    """Per model and centre: points nearest to it, their sum and squared distances."""
    # Models of as many centres lie together and are compared centre by centre, all at once.
    given = np.concatenate([c for _, c in models])
    ends = np.cumsum([len(c) for _, c in models])
    ranked = sorted(range(len(models)), key=lambda m: len(models[m][1]))
    order = np.concatenate([np.arange(ends[m] - len(models[m][1]), ends[m]) for m in ranked])
    models = [models[m] for m in ranked]
    sizes = [len(c) for _, c in models]
    spans, begin = [], 0
    for k in sorted(set(sizes)):
        spans.append((begin, begin + k * sizes.count(k), k))
        begin = spans[-1][1]

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # The last column counts.
        total, cost = np.zeros((len(given), width + 1)), np.zeros(len(models))
        for x in _points(frames, width):
            squares = np.ascontiguousarray(_squares(x, given).T[order])
            first = 0
            for begin, end, k in spans:
                own = squares[begin:end].reshape(-1, k, len(x))
                best = own.min(axis=1)
                cost[first : first + len(own)] += best.sum(axis=1)
                first += len(own)
                mark = own == best[:, None]
                if np.count_nonzero(mark) != best.size:  # several as near: the first of them
                    mark = own.argmin(axis=1)[:, None] == np.arange(k)[:, None]
                own[...] = mark  # the distances are done with
            total += squares @ np.column_stack([x, np.ones(len(x))])
        model = np.repeat([i for i, _ in models], sizes).astype(np.int32)
        cluster = np.concatenate([np.arange(k) for k in sizes]).astype(np.int32)
        # A model's cost stands with its first centre.
        costs = np.where(cluster == 0, np.repeat(cost, sizes), 0.0)
        yield pa.RecordBatch.from_arrays(
            [pa.array(model), pa.array(cluster), pa.array(total[:, -1].astype(np.int64)), pa.array(costs), pa.array(list(total[:, :-1]), pa.list_(pa.float64()))],
            names=["model", "cluster", "n", "cost", "sums"],
        )

    return run


def one_pass(blocks: DataFrame, models: Sequence[tuple[int, Array]], width: int) -> dict[int, tuple[Array, Array, float]]:
    """Per model: points and their sum for each centre, and the cost. ``blocks`` has one column, packed points."""
    parts = blocks.mapInArrow(_sums(models, width), SUMS).groupBy("model", "cluster")
    rows = parts.agg(
        F.sum("n").alias("n"), F.sum("cost").alias("cost"), F.array(*[F.sum(F.col("sums")[i]) for i in range(width)]).alias("sums")
    ).collect()
    out = {i: (np.zeros(len(c), dtype=np.int64), np.zeros(c.shape), 0.0) for i, c in models}
    for r in sorted(rows, key=lambda r: (r.model, r.cluster)):
        n, total, cost = out[r.model]
        n[r.cluster], total[r.cluster] = r.n, r.sums
        out[r.model] = (n, total, cost + r.cost)
    return out


def _drawn(candidates: Sequence[Array], chances: Sequence[float], width: int, salt: int):
    """Points drawn for each restart, by their distance from its candidates."""

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in _points(frames, width):
            for r, (own, chance) in enumerate(zip(candidates, chances, strict=True)):
                hit = _uniform(x, salt + r) < chance * _squares(x, own).min(axis=1)
                if hit.any():
                    some = np.unique(x[hit], axis=0)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(some), r, dtype=np.int32)), pa.array(list(some), pa.list_(pa.float64()))], names=["restart", "point"]
                    )

    return run


def _seeds(points: DataFrame, blocks: DataFrame, width: int, restarts: int, most: int, seed: int, rounds: int = 2) -> list[tuple[Array, Array]]:
    """Per restart: distinct candidates, about four times ``most`` for each round, and how many points are nearest to each."""
    first = points.agg(*[F.min_by("features", F.xxhash64("features", F.lit(seed + r))).alias(f"r{r}") for r in range(restarts)]).first()
    candidates = [np.array([p]) for p in first]
    found = one_pass(blocks, list(enumerate(candidates)), width)
    # Expected draws per round: the chance of a point is its share of the cost times this number.
    chances = [4 * most / cost if cost > 0 else 0.0 for _, _, cost in (found[r] for r in range(restarts))]
    for i in range(rounds):
        drawn = blocks.mapInArrow(_drawn(candidates, chances, width, seed + restarts * (i + 1)), "restart int, point array<double>").distinct()
        for r in drawn.collect():
            candidates[r.restart] = np.vstack([candidates[r.restart], r.point])
        candidates = [np.unique(c, axis=0) for c in candidates]
    weights = one_pass(blocks, list(enumerate(candidates)), width)
    return [(c, weights[r][0]) for r, c in enumerate(candidates)]


def _chosen(candidates: Array, weights: Array, k: int, seed: int) -> Array:
    """k of the candidates, each next one with a chance in proportion to its weight and squared distance."""
    rng = np.random.default_rng(seed)
    weight = weights.astype(float)
    places = [candidates[rng.choice(len(candidates), p=weight / weight.sum())]]
    while len(places) < k:
        pull = weight * _squares(candidates, np.array(places)).min(axis=1)
        if pull.sum() <= 0:
            break  # fewer distinct points than centres
        places.append(candidates[rng.choice(len(candidates), p=pull / pull.sum())])
    return np.array(places)


def fit_all(points: DataFrame, sizes: Sequence[int], restarts: int = 10, seed: int = 42, most: int = 100, settled: float = 1e-4) -> list[Centres]:
    """All models for every size and restart. ``points`` has one column ``features``, arrays of doubles of equal length.

    A model has settled when no centre moves further than ``settled``, or after ``most`` passes; a centre without points
    stays where it is. Points are best read from memory or a stored table. Without points there are no models.
    """
    head = points.first()
    if head is None:
        return []
    width = len(head[0])
    jobs = [(k, r) for k in sizes for r in range(restarts)]
    blocks = points.mapInArrow(_packed, BLOCKS).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        seeds = _seeds(points, blocks, width, restarts, max(sizes), seed)
        places = {i: _chosen(*seeds[r], k, seed + 1000 * k + r) for i, (k, r) in enumerate(jobs)}
        passes = dict.fromkeys(places, 0)
        moving = set(places)
        for _ in range(most):
            if not moving:
                break
            for i, (n, total, _) in one_pass(blocks, [(i, places[i]) for i in sorted(moving)], width).items():
                new = np.where(n[:, None] > 0, total / np.maximum(n, 1)[:, None], places[i])
                shift = np.sqrt(((new - places[i]) ** 2).sum(axis=1)).max()
                places[i], passes[i] = new, passes[i] + 1
                if shift <= settled:
                    moving.discard(i)
        last = one_pass(blocks, sorted(places.items()), width)
    finally:
        blocks.unpersist()
    # Centres in rising order of their coordinates, so that a cluster's number means something.
    ordered = {i: c[np.lexsort(np.round(c, 6).T[::-1])] for i, c in places.items()}
    return [Centres(k, r, ordered[i], last[i][2], passes[i]) for i, (k, r) in enumerate(jobs)]


def nearest(features: Column, centres: Array) -> Column:
    """Number of the nearest centre, from 0; the first of equally near ones."""
    squares = [sum((features[i] - float(v)) * (features[i] - float(v)) for i, v in enumerate(c)) for c in centres]
    every = F.array(*squares)
    return (F.array_position(every, F.array_min(every)) - 1).cast("int")
