"""SimHash near-dedup with pigeonhole blocks.

Two fingerprints that differ in at most ``distance`` of 64 bits agree on at least ``blocks - distance`` of ``blocks``
blocks of neighbouring bits. Every distinct fingerprint is therefore filed under each choice of so many blocks;
fingerprints filed together are compared bit by bit, and the links found give the groups.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import components, forget, fresh, small_batches, stored, strings

#: Shingles hashed at a time.
BLOCK = 1 << 16
#: Fingerprints of one block value compared in one group; larger sets are cut into cells of pairs of slices.
CELL = 2048


def text_fingerprint(text: str, shingle: int) -> int:
    """Majority of the bits of all shingle hashes; 0 for a text without words."""
    words = text.encode().lower().split()
    if not words:
        return 0
    data = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1) - 1
    starts = np.r_[0, ends[:-1] + 1]
    width = min(shingle, len(words))
    count = len(words) - width + 1
    hash_ = xxhash.xxh64_intdigest
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, count, BLOCK):
        upto = min(count, at + BLOCK)
        pairs = zip(starts[at:upto].tolist(), ends[at + width - 1 : upto + width - 1].tolist(), strict=True)
        hashes = np.array([hash_(data[a:b], 42) for a, b in pairs], dtype="<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > count, bitorder="little").view("<u8")[0])


def with_fingerprint(docs: DataFrame, shingle: int = 4, text: str = "text", into: str = "simhash") -> DataFrame:
    """``docs`` with the 64-bit fingerprint of each whole text as a signed long in ``into``.

    Words are runs of anything but ASCII white space, A-Z lowered; all shingles count, repeats included. A text of
    fewer words is one shingle; a null, empty or blank text has fingerprint 0. Rows and other columns are kept.
    """
    small_batches(docs.sparkSession)

    @F.arrow_udf("long")
    def fingerprint(column: pa.Array) -> pa.Array:
        out = np.array([text_fingerprint(t, shingle) for t in strings(column)], dtype=np.uint64)
        return pa.array(out.view(np.int64))

    return docs.withColumn(into, fingerprint(F.col(text)))


def block_keys(distance: int, blocks: int) -> list[int]:
    """Masks of the bits of every choice of blocks that two close fingerprints must agree on."""
    edges = [round(64 * i / blocks) for i in range(blocks + 1)]
    masks = [((1 << edges[i + 1]) - (1 << edges[i])) for i in range(blocks)]
    return [sum(choice) for choice in combinations(masks, blocks - distance)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def filed(prints: DataFrame, distance: int, blocks: int) -> DataFrame:
    """Each fingerprint under each of its block values and, where many share one, under cells of pairs of slices."""
    masks = [_signed(m) for m in block_keys(distance, blocks)]
    under = prints.select(
        "simhash",
        F.explode(
            F.array(
                *[
                    F.struct(F.lit(i).alias("choice"), F.col("simhash").bitwiseAND(F.lit(m)).alias("value"))
                    for i, m in enumerate(masks)
                ]
            )
        ).alias("k"),
    ).select("k.choice", "k.value", "simhash")
    sizes = stored(under.groupBy("choice", "value").agg(F.count("*").alias("n")).where("n > 1"), "simhash")
    # Values with one fingerprint drop out here; the others learn how many slices they need.
    slices = F.ceil(F.col("n") / CELL)
    mine = F.pmod(F.xxhash64("simhash"), slices)
    cells = F.transform(
        F.sequence(F.lit(0).cast("long"), slices - 1), lambda s: F.least(s, mine) * slices + F.greatest(s, mine)
    )
    return under.join(sizes, ["choice", "value"]).select("choice", "value", F.explode(cells).alias("cell"), "simhash")


def spanning_links(values: np.ndarray, distance: int) -> list[tuple[int, int]]:
    """Links that hold together what lies within ``distance`` bits among ``values``: at most one per value.

    A breadth-first walk: everything close to the values reached last joins them, so each value is met once.
    """
    out: list[tuple[int, int]] = []
    values = values.view(np.uint64)
    left = np.ones(len(values), dtype=bool)
    for first in range(len(values)):
        if not left[first]:
            continue
        left[first] = False
        queue = [first]
        while queue:
            at = queue.pop()
            rest = np.flatnonzero(left)
            if not rest.size:
                break
            near = rest[np.bitwise_count(values[rest] ^ values[at]) <= distance]
            left[near] = False
            out += [(at, int(i)) for i in near]
            queue += near.tolist()
    return out


def links(prints: DataFrame, distance: int = 4, blocks: int = 6) -> DataFrame:
    """Links (a, b) between distinct fingerprints, enough to connect all that chains of close ones connect."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])
    names = ("choice", "value", "cell")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tail = np.zeros((4, 0), dtype=np.int64)

        def compare(rows: np.ndarray) -> pa.RecordBatch:
            edge = np.flatnonzero(np.any(rows[:3, 1:] != rows[:3, :-1], axis=0)) + 1
            bounds = np.r_[0, edge, rows.shape[1]]
            size = np.diff(bounds)
            a: list[np.ndarray] = []
            b: list[np.ndarray] = []
            # Pairs are compared all at once, larger groups one by one.
            two = bounds[:-1][size == 2]
            x, y = rows[3, two], rows[3, two + 1]
            close = np.bitwise_count((x ^ y).view(np.uint64)) <= distance
            a.append(x[close])
            b.append(y[close])
            for at, n in zip(bounds[:-1][size > 2], size[size > 2], strict=True):
                group = rows[3, at : at + n]
                if n <= 64:
                    i, j = np.triu_indices(n, 1)
                    hit = np.bitwise_count((group[i] ^ group[j]).view(np.uint64)) <= distance
                    if hit.sum() < n:
                        a.append(group[i[hit]])
                        b.append(group[j[hit]])
                        continue
                found = spanning_links(group, distance)
                a.append(group[[i for i, _ in found]])
                b.append(group[[j for _, j in found]])
            return pa.record_batch([pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], schema=schema)

        for batch in batches:
            new = np.stack([batch.column(n).to_numpy(zero_copy_only=False).astype(np.int64) for n in (*names, "simhash")])
            rows = np.concatenate([tail, new], axis=1)
            if not rows.shape[1]:
                continue
            # The last group may go on in the next batch; it is at most two slices.
            same = np.all(rows[:3] == rows[:3, -1:], axis=0)
            cut = rows.shape[1] - int(np.argmin(same[::-1])) if not same.all() else 0
            tail = rows[:, cut:]
            if cut:
                yield compare(rows[:, :cut])
        if tail.shape[1]:
            yield compare(tail)

    placed = filed(prints, distance, blocks)
    parts = int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return placed.repartition(parts, *names).sortWithinPartitions(*names).mapInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame, shingle: int = 4, distance: int = 4, blocks: int = 6) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id of every document.

    Documents whose fingerprints differ in at most ``distance`` bits are linked, equal ones included;
    component_id is the smallest doc_id that links reach. Texts without words have fingerprint 0 and are linked
    like any other; a repeated row is a document of its own; a null doc_id takes part but never names a component
    unless it is alone; an empty table gives no rows; other columns are ignored.

    ``blocks`` may be any number above ``distance``: more blocks mean longer keys, so fewer vain comparisons, and more
    rows per fingerprint; the links found are the same. Copies count once, values shared by many fingerprints are compared
    in slices of bounded size, and of a dense group only links that connect it are kept.
    """
    hashed = stored(with_fingerprint(docs.select("doc_id", "text"), shingle).select("doc_id", "simhash"), "simhash")
    rooted = groups(hashed.groupBy("simhash").agg(F.min("doc_id").alias("doc_id")), distance, blocks)
    names = stored(rooted.groupBy("root").agg(F.min("doc_id").alias("component_id")), "simhash")
    named = stored(rooted.join(names, "root").select("simhash", "component_id"), "simhash")
    forget(rooted, names)
    return hashed.join(named, "simhash").select(
        "doc_id", F.lpad(F.lower(F.hex("simhash")), 16, "0").alias("fingerprint"), "component_id"
    )


def groups(prints: DataFrame, distance: int, blocks: int) -> DataFrame:
    """Distinct fingerprints, with their other columns and the ``root`` of their group, as a stored table.

    Joins read both sides from tables here and above, so that a fingerprint or group with very many rows is split.
    """
    prints = stored(prints, "simhash")
    roots = stored(components(links(prints.select("simhash"), distance, blocks), "simhash"), "simhash")
    rooted = stored(
        prints.join(roots, prints.simhash == roots.node, "left").select(
            *prints.columns, F.coalesce("root", "simhash").alias("root")
        ),
        "simhash",
    )
    forget(prints, roots)
    return rooted


def keep_one(docs: DataFrame, shingle: int = 4, distance: int = 4, blocks: int = 6) -> DataFrame:
    """``docs`` with one document of each group: the one of smallest doc_id, and one row of it.

    All columns are kept as they are. A row without doc_id stays only where its group has no row with one; of rows with
    the same id in one group the one with the smallest hash of its columns stays.
    """
    at, row = F.coalesce(F.col("doc_id").cast("long"), F.lit(0)), F.xxhash64(*docs.columns)
    key = F.struct(F.col("doc_id").isNull().alias("missing"), at.alias("at"), row.alias("row"))
    marked = with_fingerprint(docs.select("text", key.alias("key")), shingle)
    hashed = stored(marked.select("simhash", "key").groupBy("simhash").agg(F.min("key").alias("key")), "simhash")
    rooted = groups(hashed, distance, blocks)
    winners = stored(rooted.groupBy("root").agg(F.min("key").alias("key")).select("key.*"), "simhash")
    forget(hashed, rooted)
    k, copy = fresh(docs, "winner"), fresh(docs, "copy_number")
    keyed = docs.withColumn(k, key)
    won = keyed.join(
        winners,
        (F.col(f"{k}.missing") == winners.missing) & (F.col(f"{k}.at") == winners["at"]) & (F.col(f"{k}.row") == winners["row"]),
    )
    same = Window.partitionBy(winners.missing, winners["at"], winners["row"]).orderBy(winners["at"])
    return won.withColumn(copy, F.row_number().over(same)).where(F.col(copy) == 1).select(*[F.col(f"`{c}`") for c in docs.columns])
