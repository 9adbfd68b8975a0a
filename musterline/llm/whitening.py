"""Whitening of embeddings by an eigendecomposition that grows vector by vector.

Each task keeps the spectrum of the centred scatter of the vectors it has seen. A further vector x is one rank-one update,
k / (k + 1) (x - mean)(x - mean)': the new eigenvalues are the roots of the secular equation, found between the old ones
after deflation of what the update leaves alone. Spectra of tasks are combined the same way, with the eigenpairs of one as
rank-one updates of the other and one more for the distance of the means. The directions found are then refined by a
Rayleigh-Ritz step over all vectors, which removes what rounding left in thousands of updates.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import forget, small_batches, stored

#: Spectra combined by one task.
FAN_IN = 16
#: Halvings per root; a root is known to the last digits of its distance from the nearest old eigenvalue.
HALVINGS = 58
_EPS = np.finfo(float).eps
Array = np.ndarray


def _roots(d: Array, z: Array) -> tuple[Array, Array]:
    """Roots of 1 + sum z_j^2 / (d_j - t) = 0 for rising distinct d and z without zeros, each as (old eigenvalue, offset).

    A root lies between d_i and the next one (the last at most |z|^2 above), and is kept as the offset from the nearer
    end, so that differences to the old eigenvalues lose no digits.
    """
    z2 = z * z
    gap = np.r_[np.diff(d), z2.sum()]
    value = lambda shift, t: 1 + (z2 / (shift - t[:, None])).sum(axis=1)
    apart = d[None, :] - d[:, None]
    right = value(apart, gap / 2) < 0
    right[-1] = False
    origin = np.arange(len(d)) + right
    shift = d[None, :] - d[origin][:, None]
    low = np.where(right, -gap / 2, 0.0)
    high = np.where(right, 0.0, np.where(np.arange(len(d)) == len(d) - 1, gap, gap / 2))
    for _ in range(HALVINGS):
        # Near an end the root is found by magnitude, elsewhere by distance.
        near, far = np.minimum(abs(low), abs(high)), np.maximum(abs(low), abs(high))
        size = np.where(near < far / 4, np.where(near == 0, far / 64, np.sqrt(near * far)), (near + far) / 2)
        mid = np.where(right, -size, size)
        with np.errstate(divide="ignore", invalid="ignore"):
            below = value(shift, mid) < 0
        low, high = np.where(below, mid, low), np.where(below, high, mid)
    return origin, (low + high) / 2


def updated(values: Array, vectors: Array, u: Array, weight: float) -> tuple[Array, Array]:
    """Eigenvalues, rising, and eigenvectors (columns) after adding weight u u' with weight > 0."""
    z = np.sqrt(weight) * (vectors.T @ u)
    norm = z @ z
    if norm == 0:
        return values, vectors
    values, vectors = values.copy(), vectors.copy()
    scale = max(abs(values).max(), norm)
    # Deflation: directions that the update hardly touches stay.
    live = np.flatnonzero(abs(z) > _EPS * np.sqrt(scale))
    kept: list[int] = []
    for i in live:
        if kept and values[i] - values[kept[-1]] <= 4 * _EPS * scale:
            # Of equal eigenvalues, a rotation moves the update into one direction.
            j = kept[-1]
            r = np.hypot(z[i], z[j])
            c, s = z[i] / r, z[j] / r
            old_i, old_j = vectors[:, i].copy(), vectors[:, j].copy()
            vectors[:, i], vectors[:, j] = c * old_i + s * old_j, c * old_j - s * old_i
            z[i], z[j] = r, 0.0
            kept[-1] = i
        else:
            kept.append(i)
    if kept:
        at = np.array(kept)
        d, y = values[at], z[at]
        origin, offset = _roots(d, y)
        # difference[j, i] = d_j - root_i
        difference = (d[:, None] - d[origin][None, :]) - offset[None, :]
        difference[difference == 0] = -_EPS * scale
        # The update for which the computed roots are exact: its eigenvectors are orthogonal to rounding.
        ratio = np.ones(len(d))
        others = d[None, :] - d[:, None]
        np.fill_diagonal(others, 1.0)
        ratio = abs(np.prod(np.where(np.eye(len(d), dtype=bool), -difference, -difference / others), axis=1))
        y = np.copysign(np.sqrt(ratio), y)
        new = y[:, None] / difference
        new /= np.sqrt((new * new).sum(axis=0))
        vectors[:, at] = vectors[:, at] @ new
        values[at] = d[origin] + offset
    order = np.argsort(values, kind="stable")
    return values[order], vectors[:, order]


class Spectrum:
    """Number, mean and eigenpairs of the centred scatter of some vectors."""

    def __init__(self, width: int):
        self.n = 0
        self.mean = np.zeros(width)
        self.values, self.vectors = np.zeros(width), np.eye(width)

    def add(self, x: Array) -> None:
        away = x - self.mean
        self.values, self.vectors = updated(self.values, self.vectors, away, self.n / (self.n + 1)) if self.n else (self.values, self.vectors)
        self.n += 1
        self.mean = self.mean + away / self.n

    def merge(self, other: Spectrum) -> None:
        """Take another one's vectors in, one rank-one update per eigenpair and one for the means."""
        if not other.n:
            return
        values, vectors = self.values, self.vectors
        for value, vector in zip(other.values, other.vectors.T, strict=True):
            if value > 0:
                values, vectors = updated(values, vectors, vector, float(value))
        away, n = other.mean - self.mean, self.n + other.n
        if self.n:
            values, vectors = updated(values, vectors, away, self.n * other.n / n)
        self.values, self.vectors = values, vectors
        self.mean = self.mean + away * (other.n / n)
        self.n = n

    def row(self, group: int) -> pa.RecordBatch:
        data = np.concatenate([self.mean, self.values, self.vectors.ravel()]).tobytes()
        return pa.RecordBatch.from_arrays([pa.array([group]), pa.array([self.n]), pa.array([data])], names=["part", "n", "data"])

    @classmethod
    def read(cls, n: int, data: bytes) -> Spectrum:
        flat = np.frombuffer(data)
        width = int(round((np.sqrt(4 + 4 * len(flat)) - 2) / 2))
        out = cls(width)
        out.n, out.mean, out.values = n, flat[:width], flat[width : 2 * width]
        out.vectors = flat[2 * width :].reshape(width, width)
        return out


SPECTRUM = "part long, n long, data binary"


def _grown(width: int):
    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        spectrum = Spectrum(width)
        for frame in frames:
            for x in _matrix(frame.column("x"), width).astype(np.float64):
                spectrum.add(x)
        if spectrum.n:
            yield spectrum.row(TaskContext.get().partitionId())

    return run


def _matrix(column: pa.Array, width: int) -> Array:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _merged(table: pa.Table) -> pa.Table:
    rows = table.sort_by("part").to_pylist()
    first = Spectrum.read(rows[0]["n"], rows[0]["data"])
    for row in rows[1:]:
        first.merge(Spectrum.read(row["n"], row["data"]))
    return pa.Table.from_batches([first.row(rows[0]["part"])])


def _combined(rows: DataFrame, merge, count: int, schema: str) -> list:
    """Rows of fixed size, one per task, brought together in rounds of ``FAN_IN``; at most that many reach the driver."""
    step = 1
    while count > FAN_IN:
        step *= FAN_IN
        rows = rows.groupBy(F.expr(f"part div {step}").alias("group")).applyInArrow(lambda t: merge(t.drop_columns("group")), schema)
        count = -(-count // FAN_IN)
    return rows.collect()


def _product(frames: Iterator[pa.RecordBatch], sums: Array, n: int, basis: Array) -> Iterator[pa.RecordBatch]:
    """Sum of y y' over the centred vectors of a task, in the coordinates of ``basis``."""
    from pyspark import TaskContext

    total = np.zeros((basis.shape[1],) * 2)
    for frame in frames:
        x = _matrix(frame.column("x"), len(basis)).astype(np.float64)
        y = (x - sums / n) @ basis
        total += y.T @ y
    yield pa.RecordBatch.from_arrays(
        [pa.array([TaskContext.get().partitionId()]), pa.array([0]), pa.array([total.tobytes()])], names=["part", "n", "data"]
    )


def _added(table: pa.Table) -> pa.Table:
    rows = table.sort_by("part").to_pylist()
    total = sum(np.frombuffer(r["data"]) for r in rows)
    return pa.Table.from_pydict({"part": [rows[0]["part"]], "n": [0], "data": [total.tobytes()]})


def _scatter(vectors: DataFrame, sums: Array, n: int, basis: Array, parts: int) -> Array:
    """Covariance of all vectors in the coordinates of ``basis``."""
    rows = vectors.mapInArrow(lambda f: _product(f, sums, n, basis), SPECTRUM)
    got = _combined(rows, _added, parts, SPECTRUM)
    return sum(np.frombuffer(r["data"]) for r in sorted(got, key=lambda r: r["part"])).reshape((basis.shape[1],) * 2) / n


def _sums(vectors: DataFrame, width: int) -> tuple[int, list[int]]:
    """Number of vectors and exact sum of every entry."""
    row = vectors.agg(F.count(F.lit(1)), *[F.sum(F.col("x")[i].cast("decimal(20,0)")) for i in range(width)]).first()
    return row[0], [int(v) for v in row[1:]]


def whiten(rows: DataFrame, components: int = 4, step: int = 256, id_column: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """Coordinates of every vector along the first ``components`` axes of the distinct ones, each with unit variance.

    Entries are first brought to whole numbers, floor(``step`` * entry). Rows whose vector is null, empty or holds null
    or non-finite entries are left out, as are vectors of another length than most have (of equally frequent lengths the
    longer). Per row, repeated ones included, and component: (``id_column``, component, n, deviation, whitened, explained,
    identity_error). Axes without variance give no rows, so that equal or too few vectors give fewer components or none.
    ``deviation`` is null where it is beyond a long. Other columns are not read. What the driver gets is at most
    ``FAN_IN`` matrices and grows with the length of a vector, not with their number.
    """
    spark = rows.sparkSession
    small_batches(spark)
    entry = F.col(vector)
    is_sound = lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < float("inf"))
    sound = rows.where(entry.isNotNull() & (F.size(entry) > 0) & F.forall(entry, is_sound))
    whole = stored(
        sound.select(F.col(id_column).alias("id"), F.transform(entry, lambda c: F.floor(c.cast("double") * step).cast("long")).alias("x")),
        "whole-vectors",
    )
    common = whole.groupBy(F.size("x").alias("width")).count().orderBy(F.desc("count"), F.desc("width")).first()
    id_sql = whole.schema["id"].dataType.simpleString()
    shape = f"id {id_sql}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if common is None:
        return spark.createDataFrame([], shape).withColumnRenamed("id", id_column)
    width = common["width"]
    fit = stored(whole.where(F.size("x") == width).select("x").distinct(), "distinct-vectors")
    n, sums = _sums(fit, width)
    parts = fit.rdd.getNumPartitions()
    spectrum = Spectrum(width)
    for row in sorted(_combined(fit.mapInArrow(_grown(width), SPECTRUM), _merged, parts, SPECTRUM), key=lambda r: r["part"]):
        spectrum.merge(Spectrum.read(row["n"], row["data"]))
    basis = np.linalg.qr(spectrum.vectors)[0]
    mean = np.array(sums, dtype=np.float64)
    # Rayleigh-Ritz: exact up to rounding within the span of the basis, which is the whole space.
    covariance = _scatter(fit, mean, n, basis, parts)
    ritz, turn = np.linalg.eigh((covariance + covariance.T) / 2)
    trace = float(np.trace(covariance))
    order = np.argsort(-ritz, kind="stable")[:components]
    order = [i for i in order if ritz[i] > width * 64 * _EPS * max(trace, 0.0)]
    axes = basis @ turn[:, order] / np.sqrt(ritz[order]) if order else np.zeros((width, 0))
    explained = [float(ritz[i] / trace) for i in order]
    error = float(abs(_scatter(fit, mean, n, axes, parts) - np.eye(len(order))).max()) if order else 0.0
    forget(fit)
    coded = whole.where(F.size("x") == width).mapInArrow(_coordinates(n, sums, axes, explained, error), shape)
    result = stored(coded.withColumnRenamed("id", id_column), "whitened")
    forget(whole)
    return result


def _coordinates(n: int, sums: list[int], axes: Array, explained: list[float], error: float):
    """Rows of every vector and component."""

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = axes.shape[1]
        mean = np.array(sums, dtype=np.float64) / n
        for frame in frames:
            x = _matrix(frame.column("x"), len(sums))
            # Exact in Python's whole numbers where 64 bits might not do.
            most = n * int(abs(x).max(initial=0)) + max(map(abs, sums))
            kind = np.int64 if most * most * len(sums) < 1 << 62 else object
            away = x.astype(kind) * n - np.array(sums, dtype=kind)
            deviation = [v if v < 1 << 63 else None for v in map(int, (away * away).sum(axis=1))]
            spot = (x - mean) @ axes
            rows = len(x)
            again = np.repeat(np.arange(rows), k)
            yield pa.RecordBatch.from_arrays(
                [frame.column("id").take(pa.array(again)), pa.array(np.tile(np.arange(1, k + 1), rows), pa.int32()),
                 pa.array(np.full(rows * k, n)), pa.array([deviation[i] for i in again], pa.int64()), pa.array(spot.ravel()),
                 pa.array(np.tile(explained, rows), pa.float64()), pa.array(np.full(rows * k, error))],
                names=["id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return run
