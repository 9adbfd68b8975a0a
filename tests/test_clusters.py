"""Clusters of all sizes and restarts from shared passes."""

import itertools

import numpy as np
import pyarrow as pa
import pytest
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from musterline.operators import clusters


def points(spark, x):
    return spark.createDataFrame([(v,) for v in x.tolist()], "features array<double>").repartition(4)


@pytest.fixture(scope="module")
def blobs():
    rng = np.random.default_rng(4)
    centres = np.array([[0, 0, 0], [6, 0, 1], [0, 7, 2], [5, 6, -3]])
    return np.concatenate([c + rng.normal(size=(150, 3)) for c in centres])


def cost_of(x, places):
    return ((x[:, None, :] - places[None]) ** 2).sum(axis=2).min(axis=1).sum()


def test_costs_are_those_of_the_centres_and_no_worse_than_one_by_one(spark, blobs):
    df = points(spark, blobs)
    found = clusters.fit_all(df, [2, 3, 4, 5], restarts=4)
    assert len(found) == 16
    for c in found:
        assert c.cost == pytest.approx(cost_of(blobs, c.places)) and len(c.places) == c.k
    vectors = df.select(array_to_vector("features").alias("features"))
    for k in (2, 4, 5):
        best = min(c.cost for c in found if c.k == k)
        apart = min(KMeans(k=k, seed=s).fit(vectors).summary.trainingCost for s in range(4))
        assert best <= 1.01 * apart


def test_one_pass_serves_all_models(spark, blobs, monkeypatch):
    seen, real = [], clusters.one_pass

    def counted(df, models, width):
        seen.append(len(models))
        return real(df, models, width)

    monkeypatch.setattr(clusters, "one_pass", counted)
    found = clusters.fit_all(points(spark, blobs), [2, 4], restarts=3)
    longest = max(c.passes for c in found)
    # Two passes for the seeds, one for the costs, and as many as the longest run takes.
    assert len(seen) == longest + 3 and sum(seen[2:-1]) == sum(c.passes for c in found)


def test_best_of_a_few_points_equals_brute_force(spark):
    x = np.array([[0.0], [1.0], [1.5], [7.0], [8.0], [20.0]])
    want = min(
        sum(((g - g.mean(axis=0)) ** 2).sum() for j in range(3) if len(g := x[np.array(p) == j])) for p in itertools.product(range(3), repeat=len(x))
    )
    assert min(c.cost for c in clusters.fit_all(points(spark, x), [3], restarts=5)) == pytest.approx(want)


def test_equal_points_and_none(spark):
    same = clusters.fit_all(points(spark, np.ones((9, 2))), [1, 3], restarts=2)
    assert all(c.cost == 0 and len(c.places) == 1 for c in same)
    assert clusters.fit_all(spark.createDataFrame([], "features array<double>"), [2]) == []


def test_nearest_is_the_first_of_equals(spark):
    df = spark.createDataFrame([([0.0, 0.0],), ([2.0, 0.0],), ([1.0, 0.0],)], "features array<double>")
    got = df.select(clusters.nearest(F.col("features"), np.array([[0.0, 0.0], [2.0, 0.0]])).alias("c"))
    assert [r.c for r in got.collect()] == [0, 1, 0]


def test_passes_read_packed_points_that_are_kept(spark, blobs, monkeypatch):
    seen, real = set(), clusters.one_pass

    def looked(df, models, width):
        seen.add((str(df.dtypes), df.storageLevel.useMemory))
        return real(df, models, width)

    monkeypatch.setattr(clusters, "one_pass", looked)
    clusters.fit_all(points(spark, blobs), [2, 3], restarts=2)
    assert seen == {("[('block', 'binary')]", True)}


def test_sums_of_models_of_several_sizes(monkeypatch):
    monkeypatch.setattr(clusters, "ROWS", 7)
    x = np.random.default_rng(1).integers(0, 4, size=(50, 2)).astype(float)
    # Centres on the grid: many points are as near to several, some of which are equal.
    models = [(5, np.array([[0.0, 0.0], [2.0, 0.0], [2.0, 0.0]])), (2, np.array([[1.0, 1.0]])), (9, np.array([[0.0, 2.0], [2.0, 2.0], [3.0, 3.0]]))]
    frame = pa.RecordBatch.from_arrays([pa.array(x.tolist(), pa.list_(pa.float64()))], names=["features"])
    got = next(clusters._sums(models, 2)(clusters._packed(iter([frame, frame.slice(0, 0)])))).to_pylist()
    assert [(r["model"], r["cluster"]) for r in got] == [(2, 0), (5, 0), (5, 1), (5, 2), (9, 0), (9, 1), (9, 2)]
    for i, c in models:
        squares = ((x[:, None] - c) ** 2).sum(axis=2)
        near = squares.argmin(axis=1)
        own = [r for r in got if r["model"] == i]
        assert [r["n"] for r in own] == [(near == j).sum() for j in range(len(c))]
        assert [r["sums"] for r in own] == [x[near == j].sum(axis=0).tolist() for j in range(len(c))]
        assert sum(r["cost"] for r in own) == squares.min(axis=1).sum()
