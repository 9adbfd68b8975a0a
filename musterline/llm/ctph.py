"""Document fingerprints by context-triggered piecewise hashing.

A rolling hash of the last seven bytes cuts a text where it ends in enough one bits; the block size is doubled until
at most 64 pieces remain, so that the signature describes the whole text however long it is. Every piece becomes one
12-bit symbol. A fingerprint holds the signatures at its block size and at the next three doublings, and two fingerprints
are compared by edit distance (insertions and deletions) at the finest block size that both have.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches, strings

WINDOW = 7
MOST = 64
#: Bytes hashed at a time.
BLOCK = 1 << 21
_DIGITS = np.frombuffer(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", dtype=np.uint8)

#: Block sizes in a fingerprint: repetitive texts jump several doublings at once.
SIZES = 4

Signature = tuple[int, list[np.ndarray]]  # log2 of the block size, symbols there and at each doubling


def mixed_hashes(data: np.ndarray) -> np.ndarray:
    """Rolling hash at each byte: a function of it and the six bytes before it."""
    out = np.empty(len(data), dtype=np.uint32)
    for at in range(0, len(data), BLOCK):
        begin = max(0, at - WINDOW + 1)
        part = data[begin : at + BLOCK].astype(np.uint32)
        part += 1
        h = np.zeros(len(part), dtype=np.uint32)
        factor = np.uint32(1)
        for back in range(min(WINDOW, len(part))):
            h[back:] += part[: len(part) - back] * factor
            factor = np.uint32((int(factor) * 0x01000193) & 0xFFFFFFFF)
        h ^= h >> np.uint32(15)
        h *= np.uint32(0x2C1B3C6D)
        h ^= h >> np.uint32(13)
        out[at : at + BLOCK] = h[at - begin :]
    return out


def symbols(mixed: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """12-bit symbol of each piece; ``ends`` are the last bytes of all pieces but a final open one."""
    starts = np.r_[0, ends + 1]
    starts = starts[starts < len(mixed)]
    if not starts.size:
        return np.zeros(0, dtype=np.int16)
    total = np.add.reduceat(mixed, starts, dtype=np.uint32) * np.uint32(0x9E3779B1)
    return (total >> np.uint32(20)).astype(np.int16)


def signature(text: str) -> Signature:
    mixed = mixed_hashes(np.frombuffer(text.encode(), dtype=np.uint8))
    size, ends = 0, np.arange(len(mixed))

    def wider() -> np.ndarray:
        return ends[(mixed[ends] >> np.uint32(size)) & np.uint32(1) == 1] if size < 32 else ends[:0]

    while len(ends) >= MOST:
        ends, size = wider(), size + 1
    first, found = size, []
    for _ in range(SIZES):
        found.append(symbols(mixed, ends))
        ends, size = wider(), size + 1
    return first, found


def written(sig: Signature) -> str:
    parts = [np.stack([_DIGITS[s >> 6], _DIGITS[s & 63]], axis=1).tobytes().decode() for s in sig[1]]
    return ":".join([str(1 << sig[0]), *parts])


def read(fingerprint: str) -> Signature:
    """The signature that ``written`` wrote."""
    size, *parts = fingerprint.split(":")
    value = np.zeros(256, dtype=np.int16)
    value[_DIGITS] = np.arange(64)
    codes = [value[np.frombuffer(p.encode(), dtype=np.uint8)].reshape(-1, 2) for p in parts]
    return int(size).bit_length() - 1, [(c[:, 0] << 6) | c[:, 1] for c in codes]


def common_lengths(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Longest common subsequence of each pair of signatures of at most 64 symbols, all pairs bit by bit at once."""
    a = np.full((len(left), MOST), -1, dtype=np.int16)
    b = np.full((len(left), MOST), -2, dtype=np.int16)
    for i, (x, y) in enumerate(zip(left, right, strict=True)):
        a[i, : len(x)] = x
        b[i, : len(y)] = y
    v = np.full(len(left), ~np.uint64(0))
    for j in range(max((len(y) for y in right), default=0)):
        match = np.packbits(a == b[:, j : j + 1], axis=1, bitorder="little").view("<u8")[:, 0]
        u = v & match
        v = (v + u) | (v - u)
    return np.bitwise_count(~v).astype(np.int64)


def likeness(left: list[Signature], right: list[Signature]) -> np.ndarray:
    """0 to 1 for each pair: one minus edit distance by total length; 0 where no block size is in common."""
    pairs = [(x, y, max(x[0], y[0])) for x, y in zip(left, right, strict=True)]
    meet = np.array([top < min(x[0], y[0]) + SIZES for x, y, top in pairs], dtype=bool)
    first = [x[1][top - x[0]] for (x, y, top), m in zip(pairs, meet, strict=True) if m]
    second = [y[1][top - y[0]] for (x, y, top), m in zip(pairs, meet, strict=True) if m]
    size = np.array([len(x) + len(y) for x, y in zip(first, second, strict=True)], dtype=np.float64)
    out = np.zeros(len(pairs))
    out[meet] = np.where(size == 0, 1.0, 2 * common_lengths(first, second) / np.maximum(size, 1))
    return out


def next_rows(docs: DataFrame, buckets: int) -> DataFrame:
    """Rows dealt to ranges of doc_id: key, ahead, doc_id, text, sorted; the first of each range also ends the one before.

    Bounds are approximate quantiles; what the driver holds is one number per range.
    """
    low = -(2**63)
    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(low)).alias("at"), "doc_id", "text")
    shares = [i / buckets for i in range(1, buckets)]
    bounds = np.unique(np.array(rows.stat.approxQuantile("at", shares, 0.2 / buckets) if shares else []))

    @F.arrow_udf("int")
    def range_of(at: pa.Array) -> pa.Array:
        return pa.array(np.searchsorted(bounds, at.to_numpy(zero_copy_only=False), side="left").astype(np.int32))

    firsts = rows.select("at", range_of("at").alias("key")).groupBy("key").agg(F.min("at").alias("at")).collect()
    firsts.sort(key=lambda r: r.key)
    before = {row.at: firsts[i - 1].key for i, row in enumerate(firsts)}

    @F.arrow_udf("int")
    def range_before(at: pa.Array) -> pa.Array:
        return pa.array([before.get(x, -1) for x in at.to_pylist()], pa.int32())

    dealt = F.array(
        F.struct(range_of("at").alias("key"), F.lit(False).alias("ahead")),
        F.struct(range_before("at").alias("key"), F.lit(True).alias("ahead")),
    )
    placed = rows.withColumn("dealt", dealt)
    spread = placed.select(F.explode(F.filter("dealt", lambda d: d.key >= 0)).alias("d"), "at", "doc_id", "text")
    spread = spread.select("d.key", "d.ahead", "at", "doc_id", F.coalesce("text", F.lit("")).alias("text"))
    # One task per range; a hash of the range would put several into one task.
    return spread.repartitionById(max(1, buckets), "key").sortWithinPartitions("key", "ahead", "at", "text")


SCHEMA = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def compare_with_edits(docs: DataFrame, buckets: int | None = None) -> DataFrame:
    """Fingerprints of every whole text and of an edited copy, and how alike both and the next document are.

    The edited text has its last quarter of code points replaced by as many of the beginning of the next document
    in order of doc_id (the first one after the last). Null texts count as empty, null ids come first, equal ids are
    ordered by text; an empty table gives no rows and a lone document is its own next one; other columns are ignored.
    ``buckets`` is the number of ranges the documents are dealt to, as many as the session's shuffle partitions
    by default.
    """
    spark = docs.sparkSession
    small_batches(spark)
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple[int, int | None, str] | None = None
        for batch in batches:
            work: list[tuple[int | None, str, str]] = []
            keys, ahead = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for key, last, doc, text in zip(keys, ahead, batch.column(3).to_pylist(), strings(batch.column(4)), strict=True):
                if held and held[0] == key:
                    work.append((held[1], held[2], text))
                held = None if last else (key, doc, text)
                if len(work) >= 512:
                    yield fingerprints(work)
                    work = []
            if work:
                yield fingerprints(work)

    return next_rows(docs, buckets).mapInArrow(run, SCHEMA)


def fingerprints(work: list[tuple[int | None, str, str]]) -> pa.RecordBatch:
    """Result rows for (doc_id, text, next text)."""
    known: dict[str, Signature] = {}

    def sig(text: str) -> Signature:
        if text not in known:
            known[text] = signature(text)
        return known[text]

    edits = []
    for _, text, after in work:
        cut = len(text) // 4
        edits.append(text[: len(text) - cut] + after[:cut])
    own, edited = [sig(t) for _, t, _ in work], [sig(e) for e in edits]
    following = [sig(a) for _, _, a in work]
    return pa.record_batch(
        {
            "doc_id": pa.array([d for d, _, _ in work], pa.int64()),
            "n_chars": pa.array([len(t) for _, t, _ in work], pa.int64()),
            "edited_sha256": pa.array([sha256(e.encode()).hexdigest() for e in edits]),
            "fingerprint": pa.array([written(s) for s in own]),
            "edited_fingerprint": pa.array([written(s) for s in edited]),
            "near_edited": pa.array(likeness(own, edited)),
            "near_next": pa.array(likeness(own, following)),
        }
    )
