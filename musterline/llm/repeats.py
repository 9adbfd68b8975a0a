"""Suffix-array dedup: bytes covered by a string of ``width`` bytes that also starts elsewhere.

Every window of ``width`` bytes belongs to the smallest hash among its grams of 16 bytes, so that equal windows belong to
the same hash. Runs of windows of one hash form segments; equal segments count as one with their number, and a hash that
occurs once is done. The other segments are brought together by hash and sorted as suffixes with the linear grouping
construction of ``gsaca``. The suffix array is sparse: its symbols are blocks of 16 bytes, and the blocks of all segments of
a hash lie on one grid, because each segment holds the gram itself; windows that begin between two grid points are told
apart by the bytes in front of a grid point within the groups of suffixes that agree far enough.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import forget, fresh, small_batches, stored
from .gsaca import suffix_array

GRAM = 16
#: Windows of a text hashed at a time, and windows of one segment at most.
BLOCK, LONGEST = 1 << 21, 4096
#: Distinct segments of a hash sorted together; more are cut into cells of pairs of slices.
SLICE = 4096
#: Bytes of segments sorted together, whole cells at a time and at most one cell of a hash.
SORTED = 1 << 20
_LAST = ~np.uint64(0)
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """Hash of the 16 bytes that begin at each place."""
    h, factor, step = data.astype(np.uint64) + np.uint64(1), _A, 1
    while step < GRAM:
        h = h[:-step] * factor + h[step:]
        factor = np.uint64(int(factor) ** 2 & 0xFFFFFFFFFFFFFFFF)
        step *= 2
    h ^= h >> np.uint64(29)
    h *= _B
    h ^= h >> np.uint64(32)
    return h


def window_minima(h: np.ndarray, wide: int) -> np.ndarray:
    """Smallest of each ``wide`` neighbours, from running minima of blocks in both directions."""
    count = len(h) - wide + 1
    padded = np.concatenate([h, np.full(-len(h) % wide, _LAST)]).reshape(-1, wide)
    ahead = np.minimum.accumulate(padded, axis=1).ravel()
    back = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:count], ahead[wide - 1 : wide - 1 + count])


def twice(h: np.ndarray, low: np.ndarray, wide: int) -> np.ndarray:
    """Smallest hashes that stand at two places within one run of windows.

    A gram is smallest somewhere if it equals the largest of the minima of the windows it is in. Within a run the
    places of the smallest hash follow each other, less than a window apart.
    """
    edge = np.zeros(wide - 1, dtype=np.uint64)
    top = ~window_minima(~np.concatenate([edge, low, edge]), wide)
    at = np.flatnonzero(h == top)
    value = h[at]
    return value[1:][(value[1:] == value[:-1]) & (np.diff(at) <= wide)]


def segments(data: bytes, width: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(smallest hash, first window, windows, whether it stands there twice) of the runs of windows of one text."""
    raw = np.frombuffer(data, dtype=np.uint8)
    for at in range(0, len(raw) - width + 1, BLOCK):
        h = gram_hashes(raw[at : at + BLOCK + width - 1])
        low = window_minima(h, width - GRAM + 1)
        first = np.r_[0, np.flatnonzero(low[1:] != low[:-1]) + 1]
        count = np.diff(np.r_[first, len(low)])
        if count.max() > LONGEST:
            pieces = -(-count // LONGEST)
            nth = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            begin = np.repeat(first, pieces) + nth * LONGEST
            count = np.minimum(LONGEST, np.repeat(first + count, pieces) - begin)
            first = begin
        inner = np.isin(low[first], twice(h, low, width - GRAM + 1))
        yield low[first].view(np.int64), at + first, count, inner


def listed(docs: DataFrame, width: int) -> DataFrame:
    """Segments of all texts: th and nb (hash and bytes of the text), mh, sh (hash of the segment), p, n, c, inner.

    Equal texts of one batch are cut once; ``c`` is their number. ``inner`` says that a segment may repeat itself.
    """
    schema = pa.schema([("th", pa.int64()), ("nb", pa.int32()), ("mh", pa.int64()), ("sh", pa.int64()), ("p", pa.int32()), ("n", pa.int32()), ("c", pa.int32()), ("inner", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            copies: dict[str, int] = {}
            key: dict[str, int] = {}
            for th, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                copies[text] = copies.get(text, 0) + 1
                key[text] = th
            out: list[tuple] = []
            size = 0
            for text, c in copies.items():
                data = text.encode()
                for mh, p, n, inner in segments(data, width) if len(data) >= width else ():
                    ends = (p + n + width - 1).tolist()
                    sh = [xxhash.xxh64_intdigest(data[a:b]) for a, b in zip(p.tolist(), ends, strict=True)]
                    full = lambda v, m=len(mh): np.full(m, v)
                    out.append((full(key[text]), full(len(data)), mh, np.array(sh, dtype=np.uint64).view(np.int64), p, n, full(c), inner))
                    size += len(mh)
                if size > 50_000:
                    yield made(out)
                    out, size = [], 0
            if out:
                yield made(out)

    def made(out: list[tuple]) -> pa.RecordBatch:
        return pa.record_batch(
            [pa.array(np.concatenate(x), f.type) for x, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema
        )

    text = docs.select(F.xxhash64("text").alias("th"), "text").where(F.octet_length("text") >= width)
    return text.mapInArrow(run, "th long, nb int, mh long, sh long, p int, n int, c int, inner boolean")


def repeated_windows(parts: list[bytes], weights: list[int], grams: list[int], width: int) -> list[np.ndarray]:
    """For each segment which of its windows begin at more than one place, counting ``weights`` of equal segments.

    ``grams`` are the hashes the segments belong to; segments of different hashes have no window in common.
    """
    pad = width + GRAM
    lengths = np.array([len(p) for p in parts])
    offsets = np.cumsum(lengths + pad) - lengths - pad
    data = np.zeros(int((lengths + pad).sum()), dtype=np.uint8)
    for at, part in zip(offsets.tolist(), parts, strict=True):
        data[at : at + len(part)] = np.frombuffer(part, dtype=np.uint8)
    # Grids: one per segment and residue of the places where its gram stands; more than one only in repetitive texts.
    owner_of = np.repeat(np.arange(len(parts)), lengths + pad)
    wanted = np.repeat(np.array(grams, dtype=np.int64), lengths + pad)[: len(data) - GRAM + 1]
    stands = np.flatnonzero(gram_hashes(data).view(np.int64) == wanted)
    owner = owner_of[stands]
    within = stands - offsets[owner]
    inside = within + GRAM <= lengths[owner]
    grids = np.unique(np.stack([owner[inside], within[inside] % GRAM]), axis=1)
    # Grid points from the residue to the segment's end; a final symbol below all others ends each grid.
    seg, lead = grids
    points = -(-(lengths[seg] - lead) // GRAM)
    grid = np.repeat(np.arange(len(seg)), points)
    nth = np.arange(len(grid)) - np.repeat(np.cumsum(points) - points, points)
    inner = lead[grid] + nth * GRAM
    begin = offsets[seg[grid]] + inner
    views = np.lib.stride_tricks.sliding_window_view(data, GRAM)[begin]
    # Bytes beyond a segment are zero; the number of real bytes keeps a cut block apart from a whole one with zeros.
    real = np.minimum(GRAM, lengths[seg[grid]] - inner)
    words = np.ascontiguousarray(views).view(">u8")
    order = np.lexsort((real, words[:, 1], words[:, 0]))
    changed = np.any(words[order][1:] != words[order][:-1], axis=1) | (real[order][1:] != real[order][:-1])
    rank = np.empty(len(order), dtype=np.int64)
    rank[order] = np.r_[0, np.cumsum(changed)] + 2
    at = np.arange(len(grid)) + grid
    symbols = np.ones(len(grid) + len(seg) + 1, dtype=np.int64)
    symbols[at] = rank
    symbols[-1] = 0
    source = np.full(len(symbols), -1)
    source[at] = np.arange(len(grid))
    sorted_ = source[suffix_array(symbols)]
    sorted_ = sorted_[sorted_ >= 0]
    # How many bytes neighbours in the suffix array have in common, up to a whole window.
    agree = np.zeros(len(sorted_), dtype=np.int64)
    rows = np.lib.stride_tricks.sliding_window_view(data, width)
    for lo in range(1, len(sorted_), 8192):
        here = sorted_[lo : lo + 8192]
        differ = rows[begin[here]] != rows[begin[sorted_[lo - 1 : lo - 1 + len(here)]]]
        agree[lo : lo + len(here)] = np.where(differ.any(axis=1), differ.argmax(axis=1), width)
    flat = np.zeros(len(data), dtype=bool)
    left = lengths[seg[grid]] - inner
    weight = np.array(weights, dtype=np.int64)[seg[grid]]
    ahead = np.zeros((2, len(grid)), dtype=np.uint64)  # bytes in front of each grid point, gathered one by one
    for back in range(GRAM):
        if back:
            place = begin - back
            byte = np.where(inner >= back, data[np.maximum(place, 0)], 0).astype(np.uint64)
            half = 0 if back <= 8 else 1
            ahead[half] |= byte << np.uint64(8 * ((back - 1) % 8))
        usable = (inner >= back) & (left >= width - back)
        group = np.cumsum(agree < width - back)
        pick = usable[sorted_]
        who = sorted_[pick]
        if not who.size:
            continue
        key = [ahead[1][who], ahead[0][who], group[pick]]
        by = np.lexsort(key)
        new = np.r_[True, np.any([k[by][1:] != k[by][:-1] for k in key], axis=0)]
        total = np.add.reduceat(weight[who[by]], np.flatnonzero(new))[np.cumsum(new) - 1]
        flat[(begin[who[by]] - back)[total > 1]] = True
    return [flat[a : a + n - width + 1] for a, n in zip(offsets.tolist(), lengths.tolist(), strict=True)]


def ranges(mark: np.ndarray) -> list[dict[str, int]]:
    """Runs of true values as [a, b)."""
    edge = np.flatnonzero(np.diff(np.r_[False, mark, False].astype(np.int8)))
    return [{"a": int(a), "b": int(b)} for a, b in zip(edge[::2], edge[1::2], strict=True)]


RANGES = "array<struct<a:int,b:int>>"


def sorted_cells(width: int):
    """Reads segments in order of their cells and gives each one's repeated windows as (mh, sh, found)."""
    kind = pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[bytes] = []
        weights: list[int] = []
        names: list[tuple[int, int]] = []
        size = 0
        cell: tuple[int, int] | None = None

        def flush() -> pa.RecordBatch:
            found = repeated_windows(parts, weights, [mh for mh, _ in names], width)
            return pa.record_batch(
                {
                    "mh": pa.array([mh for mh, _ in names], pa.int64()),
                    "sh": pa.array([sh for _, sh in names], pa.int64()),
                    "found": pa.array([ranges(m) for m in found], kind),
                }
            )

        for batch in batches:
            for mh, at, sh, count, content in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                # Cells of one hash share segments, whose numbers must not be added up; cells of different hashes share none.
                if cell and (mh, at) != cell and (size > SORTED or mh == cell[0]):
                    yield flush()
                    parts, weights, names, size = [], [], [], 0
                if (mh, at) == cell and names and names[-1] == (mh, sh):
                    continue  # the same segment, fetched by two tasks
                cell = (mh, at)
                parts.append(content)
                weights.append(min(count, 2))
                names.append((mh, sh))
                size += len(content)
        if parts:
            yield flush()

    return run


def spans(docs: DataFrame, width: int = 200) -> DataFrame:
    """th, nb and ``spans`` (structs of begin and end, bytes) of every distinct text with repeated strings, as a stored table."""
    small_batches(docs.sparkSession)
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    every = stored(listed(docs, width), "repeats")
    totals = every.groupBy("mh").agg(F.sum("c").alias("t"), F.max("inner").alias("inner"))
    often = stored(totals.where("t > 1 or inner").select("mh"), "repeats")
    again = stored(every.join(often, "mh"), "repeats")
    forget(every, often)
    # Equal segments are one class; a class of several, alone under its hash, is settled by its number.
    rep = F.min(F.struct("th", "nb", "p", "n")).alias("rep")
    classes = stored(again.groupBy("mh", "sh").agg(F.sum("c").alias("count"), rep), "repeats")
    kinds = classes.groupBy("mh").agg(F.count("*").alias("kinds"), F.max("count").alias("most"))
    kinds = stored(kinds.where("kinds > 1 or most = 1").select("mh", "kinds"), "repeats")
    alone = classes.join(kinds, "mh", "left_anti").select(
        "mh", "sh", F.array(F.struct(F.lit(0).alias("a"), F.col("rep.n").alias("b"))).cast(RANGES).alias("found")
    )
    wanted = classes.join(kinds, "mh").select("rep.th", "rep.nb", F.struct("rep.p", "rep.n", "mh", "sh", "count", "kinds").alias("w"))
    wanted = wanted.groupBy("th", "nb").agg(F.collect_list("w").alias("wanted"))
    texts = docs.select(F.xxhash64("text").alias("th"), F.octet_length("text").alias("nb"), "text").where(F.col("nb") >= width)

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[int, int]] = set()
        for batch in batches:
            rows: list[tuple] = []
            for th, nb, text, some in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (th, nb) in seen:
                    continue
                seen.add((th, nb))
                data = text.encode()
                rows += [(w["mh"], w["kinds"], w["sh"], w["count"], data[w["p"] : w["p"] + w["n"] + width - 1]) for w in some]
            columns = list(zip(*rows, strict=True)) or [[]] * 5
            types = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["mh", "kinds", "sh", "count", "content"]
            )

    got = texts.join(wanted, ["th", "nb"]).select("th", "nb", "text", "wanted")
    got = got.mapInArrow(fetch, "mh long, kinds long, sh long, count long, content binary")
    slices = F.ceil(F.col("kinds") / SLICE)
    mine = F.pmod(F.xxhash64("sh"), slices)
    cells = F.transform(
        F.sequence(F.lit(0).cast("long"), slices - 1), lambda s: F.least(s, mine) * slices + F.greatest(s, mine)
    )
    celled = got.select("mh", F.explode(cells).alias("cell"), "sh", "count", "content")
    celled = celled.repartition(parts, "mh", "cell").sortWithinPartitions("mh", "cell", "sh")
    judged = celled.mapInArrow(sorted_cells(width), f"mh long, sh long, found {RANGES}")
    found = stored(judged.unionByName(alone).where(F.size("found") > 0), "repeats")
    hit = again.join(found, ["mh", "sh"]).select("th", "nb", "p", F.explode("found").alias("f"))
    span = F.struct((F.col("p") + F.col("f.a")).alias("begin"), (F.col("p") + F.col("f.b") + width - 1).alias("end"))
    by_text = stored(hit.select("th", "nb", span.alias("s")).groupBy("th", "nb").agg(F.collect_set("s").alias("spans")), "repeats")
    forget(again, classes, kinds, found)
    return by_text


def _cut(width: int):
    @F.arrow_udf("struct<n_bytes:long,n_removed:long,n_spans:long,kept:binary>")
    def cut(texts: pa.Array, found: pa.Array) -> pa.Array:
        rows = []
        for text, some in zip(texts.to_pylist(), found.to_pylist(), strict=True):
            data = (text or "").encode()
            keep, at, removed, runs = [], 0, 0, 0
            end = -1
            for begin, stop in sorted((s["begin"], s["end"]) for s in some or ()):
                if begin > end:
                    keep.append(data[at:begin])
                    runs += 1
                    removed += stop - begin
                    at = end = stop
                elif stop > end:
                    removed += stop - end
                    at = end = stop
            keep.append(data[at:])
            rows.append((len(data), removed, runs, b"".join(keep)))
        size, gone, runs, kept = zip(*rows, strict=True) if rows else ((), (), (), ())
        whole = [pa.array(size, pa.int64()), pa.array(gone, pa.int64()), pa.array(runs, pa.int64()), pa.array(kept, pa.binary())]
        return pa.StructArray.from_arrays(whole, names=["n_bytes", "n_removed", "n_spans", "kept"])

    return cut


def with_cut(docs: DataFrame, into: str, width: int = 200) -> DataFrame:
    """``docs`` with a struct ``into``: n_bytes, n_removed, n_spans (maximal removed runs) and the kept bytes.

    Every byte that lies in a string of ``width`` bytes which also starts anywhere else, in the same text or another, is
    removed, from all places; strings are judged on the texts as they come. Texts are UTF-8, a null one is empty;
    strings never cross texts. Repeated rows repeat each other's strings; shorter texts stay; other columns are kept; an empty
    table gives no rows. A string of the width is at least 16 bytes long.
    """
    found = spans(docs, width)
    th, nb = fresh(docs, "text_hash"), fresh(docs, "text_bytes")
    keyed = docs.withColumns({th: F.xxhash64("text"), nb: F.octet_length("text")})
    at, size, some = (fresh(docs, n) for n in ("found_hash", "found_bytes", "found_spans"))
    found = found.toDF(at, size, some)
    met = keyed.join(found, (keyed[th] == found[at]) & (keyed[nb] == found[size]), "left")
    own = [F.col(f"`{c}`") for c in docs.columns]
    value: Column = _cut(width)(F.col("text"), F.col(some))
    return met.select(*own, value.alias(into))


def without_repeats(docs: DataFrame, width: int = 200) -> DataFrame:
    """``docs`` with repeated strings cut out of ``text``; characters cut in part go whole; ``n_chars`` is counted anew if present.

    Rows and other columns stay; a null text stays null.
    """
    into = fresh(docs, "cut")
    done = with_cut(docs, into, width)
    whole = F.col(f"{into}.n_removed") == 0

    @F.arrow_udf("string")
    def decoded(kept: pa.Array) -> pa.Array:
        return pa.array([k.decode(errors="ignore") if k is not None else None for k in kept.to_pylist()], pa.string())

    text = F.when(whole, F.col("text")).otherwise(decoded(F.col(f"{into}.kept")))
    out = done.withColumn("text", text).drop(into)
    return out.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else out
