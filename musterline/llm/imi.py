"""Embedding near-dedup with an inverted multi-index.

Vectors are cut in halves, and each half has its own codebook; the pairs of codewords are the cells of a grid. A vector is
filed in the cell of its two nearest codewords. To search, the multi-sequence traversal visits cells in order of their
summed distance until a limit that is set on a sample so that a target recall is reached; vectors found are verified
by their cosine in double precision.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bounded_sample, components, forget, small_batches, stored

#: Vectors the codebooks and the limit are fitted on at most.
SAMPLE = 8_000
#: Members or queries of a cell compared at a time; larger cells are cut into pairs of slices.
SLICE = 1024


@dataclass(frozen=True)
class Grid:
    """Codebooks of both halves of vectors of ``dims`` components, and how far beyond the nearest cell to search."""

    dims: int
    first: np.ndarray
    second: np.ndarray
    limit: float

    def distances(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Squared distances of each row's halves to all codewords."""
        half = self.dims // 2
        return squared(x[:, :half], self.first), squared(x[:, half:], self.second)

    def cells(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Cell of each row and the distance to it."""
        d, e = self.distances(x)
        return d.argmin(axis=1) * len(self.second) + e.argmin(axis=1), d.min(axis=1) + e.min(axis=1)

    def beyond(self, x: np.ndarray, cell: np.ndarray) -> np.ndarray:
        """How much farther than its nearest cell each row's ``cell`` is."""
        d, e = self.distances(x)
        at = np.arange(len(x))
        there = d[at, cell // len(self.second)] + e[at, cell % len(self.second)]
        return there - d.min(axis=1) - e.min(axis=1)


def squared(x: np.ndarray, words: np.ndarray) -> np.ndarray:
    out = (x**2).sum(axis=1)[:, None] - 2 * (x @ words.T) + (words**2).sum(axis=1)[None, :]
    return np.maximum(out, 0)


def multi_sequence(d: np.ndarray, e: np.ndarray, limit: float) -> list[int]:
    """Cells in order of the sum of their halves' distances, up to ``limit`` beyond the nearest one."""
    first, second = np.argsort(d, kind="stable"), np.argsort(e, kind="stable")
    d, e = d[first], e[second]
    stop = d[0] + e[0] + limit
    heap = [(d[0] + e[0], 0, 0)]
    out: list[int] = []
    while heap:
        near, i, j = heapq.heappop(heap)
        if near > stop:
            break
        out.append(int(first[i]) * len(e) + int(second[j]))
        if j + 1 < len(e):
            heapq.heappush(heap, (d[i] + e[j + 1], i, j + 1))
        if j == 0 and i + 1 < len(d):
            heapq.heappush(heap, (d[i + 1] + e[0], i + 1, 0))
    return out


def codebook(x: np.ndarray, words: int, rounds: int, rng: np.random.Generator) -> np.ndarray:
    """k-means codewords of the rows of ``x``."""
    if not len(x):
        return np.zeros((1, x.shape[1]))
    found = x[rng.choice(len(x), min(words, len(x)), replace=False)].copy()
    for _ in range(rounds):
        at = squared(x, found).argmin(axis=1)
        size = np.bincount(at, minlength=len(found))
        total = np.zeros_like(found)
        np.add.at(total, at, x)
        found = np.where(size[:, None] > 0, total / np.maximum(size, 1)[:, None], found)
    return found


def fit(x: np.ndarray, words: int, cosine: float, recall: float, seed: int = 5) -> Grid:
    """Codebooks for unit vectors ``x``, and the limit at which ``recall`` of close pairs are found.

    Close pairs are those in the sample and, for each of its vectors, partners at exactly ``cosine`` in random
    directions and along single components. A pair is found from either side, so fewer are missed than that.
    """
    rng = np.random.default_rng(seed)
    half = x.shape[1] // 2
    grid = Grid(x.shape[1], codebook(x[:, :half], words, 15, rng), codebook(x[:, half:], words, 15, rng), 0.0)
    if len(x) < 2 or x.shape[1] < 2:
        return Grid(grid.dims, grid.first, grid.second, np.inf)
    away = []
    for turn in range(2):
        side = rng.normal(size=x.shape)
        if turn:
            side[:] = 0
            side[np.arange(len(x)), rng.integers(0, x.shape[1], len(x))] = 1
        side -= (side * x).sum(axis=1, keepdims=True) * x
        side /= np.maximum(np.linalg.norm(side, axis=1, keepdims=True), 1e-12)
        near = cosine * x + np.sqrt(max(0.0, 1 - cosine**2)) * side
        away.append(np.quantile(grid.beyond(x, grid.cells(near)[0]), recall))
    real = [np.zeros(0)]
    own = grid.cells(x)[0]
    for at in range(0, len(x), 512):
        i, j = np.nonzero(x[at : at + 512] @ x.T >= cosine)
        apart = own[at + i] != own[j]
        real.append(grid.beyond(x[at + i[apart]], own[j[apart]]))
        real.append(np.zeros(int((~apart).sum())))
    real = np.concatenate(real)
    if len(real) > len(x):
        away.append(np.quantile(real, recall))
    return Grid(grid.dims, grid.first, grid.second, float(max(away)))


def usable() -> Column:
    """Whether a row can link: a label and a vector of finite components that is not zero."""
    value = F.col("embedding")
    sound = F.forall(value, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    some = F.exists(value, lambda v: v != 0)
    return F.coalesce(F.col("label").isNotNull() & sound & some, F.lit(False))


def unit(column: pa.Array, dims: int) -> np.ndarray:
    x = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dims)
    # The largest component first, so that squares of very large or small ones stay finite.
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def filed(distinct: DataFrame, grid: Grid) -> DataFrame:
    """``distinct`` with ``dims``, each vector's ``cell`` and the cells its search visits.

    Vectors of another length than the grid's have one cell, so they are compared with all of their length.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = batch.column(batch.schema.get_field_index("embedding"))
            size = pc.list_value_length(vectors).to_numpy(zero_copy_only=False)
            cell = np.zeros(len(size), dtype=np.int64)
            visits: list[list[int]] = [[0]] * len(size)
            fits = np.flatnonzero(size == grid.dims)
            if fits.size:
                d, e = grid.distances(unit(vectors.take(pa.array(fits)), grid.dims))
                cell[fits] = d.argmin(axis=1) * len(grid.second) + e.argmin(axis=1)
                for k, at in enumerate(fits):
                    visits[at] = multi_sequence(d[k], e[k], grid.limit)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(size.astype(np.int64)), pa.array(cell), pa.array(visits, pa.list_(pa.int64()))],
                names=[*batch.schema.names, "dims", "cell", "visits"],
            )

    kind = dict(distinct.dtypes)
    columns = ", ".join(f"{c} {kind[c]}" for c in distinct.columns)
    return distinct.mapInArrow(run, f"{columns}, dims long, cell long, visits array<long>")


def compare(grid: Grid, cosine: float):
    """Turns sorted rows of cells into links: (uid, null, n) counts linked vectors, (a, b, null) connects two."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("n", pa.int64())])

    def cell_links(rows: pa.Table, dims: int, out: list[tuple[np.ndarray, ...]]) -> None:
        asks = rows.column("asks").to_numpy()
        uid, copies, home = (rows.column(c).to_numpy() for c in ("uid", "copies", "cell"))
        x = unit(rows.column("embedding").combine_chunks(), dims)
        q, m = np.flatnonzero(asks), np.flatnonzero(~asks)
        if not q.size or not m.size:
            return
        i, j = np.nonzero(x[q] @ x[m].T >= cosine)
        i, j = q[i], m[j]
        keep = uid[i] != uid[j]
        i, j = i[keep], j[keep]
        if not i.size:
            return
        if dims == grid.dims:
            # A pair that the other side finds too is taken once, from its smaller id.
            mutual = np.zeros(len(i), dtype=bool)
            for at in range(0, len(i), 65_536):
                part = slice(at, at + 65_536)
                mutual[part] = grid.beyond(x[j[part]], home[i[part]]) <= grid.limit
        else:
            mutual = np.ones(len(i), dtype=bool)
        take = ~mutual | (uid[i] < uid[j])
        i, j = i[take], j[take]
        ids, place = np.unique(np.concatenate([uid[i], uid[j]]), return_inverse=True)
        count = np.bincount(place, np.concatenate([copies[j], copies[i]])).astype(np.int64)
        none = np.full(len(ids), np.iinfo(np.int64).min)
        out.append((ids, none, count))
        # Links that hold the cell's components together: each node to the smallest it reaches here.
        a, b = place[: len(i)], place[len(i) :]
        root = np.arange(len(ids))
        while True:
            low = np.minimum(root[a], root[b])
            before = root.copy()
            np.minimum.at(root, root[a], low)
            np.minimum.at(root, root[b], low)
            root = root[root]
            if (root == before).all():
                break
        tied = root != np.arange(len(ids))
        out.append((ids[tied], ids[root[tied]], np.zeros(int(tied.sum()), dtype=np.int64)))

    keys = ("label", "dims", "at", "ms", "qs")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: pa.Table | None = None

        def cut(table: pa.Table, last: bool) -> tuple[pa.Table | None, pa.RecordBatch]:
            codes = np.stack([table.column(k).to_numpy().astype(np.int64) for k in keys])
            edge = np.flatnonzero(np.any(codes[:, 1:] != codes[:, :-1], axis=0)) + 1
            bounds = np.r_[0, edge, table.num_rows]
            found: list[tuple[np.ndarray, ...]] = []
            upto = len(bounds) - 1 if last else len(bounds) - 2
            for k in range(upto):
                cell_links(table.slice(bounds[k], bounds[k + 1] - bounds[k]), int(codes[1, bounds[k]]), found)
            a, b, n = (np.concatenate(z) for z in zip(*found, strict=True)) if found else (np.zeros(0, np.int64),) * 3
            counts = b == np.iinfo(np.int64).min
            batch = pa.record_batch(
                [pa.array(a), pa.array(b, mask=counts), pa.array(n, mask=~counts)], schema=schema
            )
            return (None if last else table.slice(bounds[upto])), batch

        for batch in batches:
            new = pa.Table.from_batches([batch])
            table = pa.concat_tables([rest, new]) if rest is not None else new
            if table.num_rows:
                # A cell may go on in the next batch; it is at most two slices.
                rest, made = cut(table, last=False)
                yield made
        if rest is not None and rest.num_rows:
            yield cut(rest, last=True)[1]

    return run


def links(distinct: DataFrame, grid: Grid, cosine: float) -> DataFrame:
    """Links among distinct vectors (uid, copies, label, embedding), as ``compare`` writes them."""
    spark = distinct.sparkSession
    rows = stored(filed(distinct, grid), "imi")
    place = ["label", "dims", "at"]
    members = rows.withColumn("at", F.col("cell"))
    queries = rows.withColumn("at", F.explode("visits"))
    held = members.groupBy(*place).agg(F.count("*").alias("m"))
    asked = queries.groupBy(*place).agg(F.count("*").alias("q"))
    sizes = held.join(asked, place).select(
        *place, F.ceil(F.col("m") / SLICE).alias("m"), F.ceil(F.col("q") / SLICE).alias("q")
    )
    sizes = stored(sizes, "imi")
    mine = lambda n: F.pmod(F.xxhash64("uid"), F.col(n))
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    body = ["uid", "copies", "cell", "embedding"]
    m = members.join(sizes, place).select(*place, *body, mine("m").alias("ms"), every("q").alias("qs"), F.lit(False).alias("asks"))
    q = queries.join(sizes, place).select(*place, *body, every("m").alias("ms"), mine("q").alias("qs"), F.lit(True).alias("asks"))
    keys = [*place, "ms", "qs"]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = m.unionByName(q).repartition(parts, *keys).sortWithinPartitions(*keys)
    found = stored(dealt.mapInArrow(compare(grid, cosine), "a long, b long, n long"), "imi")
    forget(rows, sizes)
    return found


def near_duplicates(
    vectors: DataFrame, cosine: float = 0.98, words: int = 32, recall: float = 0.998, sample: int = SAMPLE
) -> DataFrame:
    """vec_id, n_links, component_id and kept of every row of ``vectors`` (vec_id, embedding, label).

    Rows of equal label are linked when their cosine in double precision is at least ``cosine``; no other pair is.
    Rows without a label, and vectors that are null, empty, zero or hold null or non-finite components, link with
    nothing; neither do vectors of different length. Equal vectors of one label are one entry of the index, with their
    number. n_links counts the other rows linked directly, component_id is the smallest vec_id that links
    reach, kept says whether that is the row's own. A row with null vec_id is linked like others; it is its own component where
    no linked row has an id. An empty table gives no rows; other columns are ignored.

    The codebooks and the search limit come from at most ``sample`` vectors chosen by a hash; every vector is indexed
    and every vector is a query. ``recall`` is what one direction of the search reaches at the lowest cosine.
    """
    small_batches(vectors.sparkSession)
    rows = vectors.select("vec_id", "embedding", "label")
    uid = F.xxhash64("label", "embedding")
    sound = rows.where(usable()).withColumn("uid", uid)
    distinct = sound.groupBy("uid", "label", "embedding").agg(F.count("*").alias("copies"), F.min("vec_id").alias("first"))
    distinct = stored(distinct, "imi")
    some = [np.array(r.embedding, dtype=np.float64) for r in bounded_sample(distinct, sample, "uid").select("embedding").collect()]
    lengths = [len(v) for v in some]
    dims = max(set(lengths), key=lambda n: (lengths.count(n), n)) if lengths else 2
    x = np.array([v for v in some if len(v) == dims]).reshape(-1, dims)
    x = x / np.abs(x).max(axis=1, keepdims=True) if len(x) else x
    grid = fit(x / np.linalg.norm(x, axis=1, keepdims=True), words, cosine, recall)
    found = links(distinct.select("uid", "label", "embedding", "copies"), grid, cosine)
    counts = found.where("n is not null").groupBy(F.col("a").alias("uid")).agg(F.sum("n").alias("n"))
    roots = components(found.where("b is not null").select("a", "b"), "imi").withColumnRenamed("node", "uid")
    facts = distinct.select("uid", "copies", "first").join(roots, "uid", "left").join(counts, "uid", "left")
    facts = stored(
        facts.select("uid", "first", F.coalesce("root", "uid").alias("root"), (F.col("copies") - 1 + F.coalesce("n", F.lit(0))).alias("n_links")),
        "imi",
    )
    names = stored(facts.groupBy("root").agg(F.min("first").alias("component_id")), "imi")
    named = stored(facts.join(names, "root").select("uid", "n_links", "component_id"), "imi")
    forget(distinct, found, facts, names)
    done = sound.select("vec_id", "uid").join(named, "uid").select("vec_id", "n_links", "component_id")
    alone = rows.where(~usable()).select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    return done.unionByName(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.col("component_id").isNull()))
