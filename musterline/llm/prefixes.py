"""Prefix trie of conversations in node tables with minimal perfect hashes.

A node is a distinct sequence of first turns, known by a digest chained from turn to turn. Conversations go through in
blocks of bounded size. Each block enumerates its distinct prefix digests, gives each a slot by a minimal perfect hash
(and looks every digest up again, so that a false slot shows), scatters counts into flat arrays by slot and adds them up
through an array of parent slots, deepest first. What blocks find of a node is then added up by digest.

Members come up from the ends of conversations. Leaves and saved tokens need what a node has in all blocks, so they take
a second round: the smallest member of a node carries the node's own share, which is then in one block only.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import forget, small_batches, stored

#: Bytes of a digest; a block takes conversations until it has this many prefixes (one conversation at least).
DIGEST = 16
BLOCK = 200_000
#: Ids that differ in the last so many bits make one stretch of the ends of a node, written as one text.
STRETCH = 12
#: Keys per slot of the first table of a perfect hash, and how often keys that meet there are dealt anew.
GAMMA = 1.5
ROUNDS = 64

Array = np.ndarray
ROOT = bytes(DIGEST)
WORD = r"[^\x20\x09-\x0D]+"


def _hashed(keys: Array, seed: int) -> Array:
    h = (keys[:, 0] ^ np.uint64(seed * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(31)) ^ keys[:, 1]) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(29))


class PerfectHash:
    """Distinct keys of 16 bytes onto 0 .. n-1, one key per slot.

    Keys alone in their place of a table are settled there; those that meet go on to a smaller table under another
    hash. A slot is the number of settled places before a key's own one.
    """

    def __init__(self, keys: Array):
        self.tables: list[tuple[Array, Array]] = []
        self.size = len(keys)
        left, base = keys, 0
        for seed in range(ROUNDS):
            if not len(left):
                break
            size = max(1, int(GAMMA * len(left)))
            place = (_hashed(left, seed) % np.uint64(size)).astype(np.int64)
            alone = np.bincount(place, minlength=size) == 1
            self.tables.append((alone, base + np.cumsum(alone) - alone))
            base += int(alone.sum())
            left = left[~alone[place]]
        if len(left):
            raise ValueError(f"{len(left)} keys share all their places: they are not distinct")
        self.owner = np.zeros_like(keys)
        self.owner[self._slots(keys)] = keys
        if len(np.unique(self._slots(keys))) != self.size:
            raise ValueError("two keys in one slot")

    def _slots(self, keys: Array) -> Array:
        out = np.full(len(keys), -1, dtype=np.int64)
        open_ = np.arange(len(keys))
        for seed, (alone, rank) in enumerate(self.tables):
            place = (_hashed(keys[open_], seed) % np.uint64(len(alone))).astype(np.int64)
            hit = alone[place]
            out[open_[hit]] = rank[place[hit]]
            open_ = open_[~hit]
        return out

    def slots(self, keys: Array) -> Array:
        """Slot of each key; -1 where the slot found belongs to another key."""
        out = self._slots(keys)
        if not self.size:
            return np.full(len(keys), -1)
        right = (out >= 0) & (self.owner[out] == keys).all(axis=1)
        return np.where(right, out, -1)


def _keys(data: bytes | Array) -> Array:
    return np.frombuffer(data, dtype="<u8").reshape(-1, 2)


class NodeTable:
    """Slots, depths and parents of the distinct prefixes of a block of conversations."""

    def __init__(self, paths: list[bytes]):
        keys = _keys(b"".join(paths))
        self.lens = np.array([len(p) // DIGEST for p in paths], dtype=np.int64)
        ends = np.cumsum(self.lens)
        depth = np.arange(len(keys)) - np.repeat(ends - self.lens, self.lens)
        flat = np.ascontiguousarray(keys).view([("a", "<u8"), ("b", "<u8")]).ravel()
        first = np.unique(flat, return_index=True)[1]
        self.hash = PerfectHash(keys[first])
        self.slot = self.hash.slots(keys)
        if (self.slot < 0).any():
            raise ValueError("a prefix without a slot")
        self.n = self.hash.size
        self.ends = self.slot[ends - 1]
        self.depth = np.zeros(self.n, dtype=np.int64)
        self.depth[self.slot] = depth
        self.parent = np.full(self.n, -1, dtype=np.int64)
        below = depth > 0
        self.parent[self.slot[below]] = self.slot[np.flatnonzero(below) - 1]
        #: Slots of every depth but the root's, deepest first.
        order = np.argsort(-self.depth, kind="stable")
        cuts = np.flatnonzero(np.diff(self.depth[order])) + 1
        self.by_depth = [s for s in np.split(order, cuts) if len(s) and self.depth[s[0]] > 0]

    def add_up(self, values: Array) -> Array:
        """Each slot's value and those of all slots below it."""
        out = values.copy()
        for slots in self.by_depth:
            np.add.at(out, self.parent[slots], out[slots])
        return out

    def smallest(self, values: Array) -> Array:
        out = values.copy()
        for slots in self.by_depth:
            np.minimum.at(out, self.parent[slots], out[slots])
        return out

    def digests(self) -> list[bytes]:
        raw = self.hash.owner.tobytes()
        return [raw[i : i + DIGEST] for i in range(0, len(raw), DIGEST)]


def _blocks(frames: Iterator[pa.RecordBatch]) -> Iterator[dict[str, list]]:
    """Columns of conversations, in blocks."""
    held: dict[str, list] = {}
    size = 0
    for frame in frames:
        for row in zip(*(c.to_pylist() for c in frame.columns), strict=True):
            row = dict(zip(frame.schema.names, row, strict=True))
            if held and size + len(row["path"]) // DIGEST > BLOCK:
                yield held
                held, size = {}, 0
            for name, value in row.items():
                held.setdefault(name, []).append(value)
            size += len(row["path"]) // DIGEST
    if held:
        yield held


def _chained(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digests of all prefixes of each conversation, the root's first."""
    for frame in frames:
        paths = []
        for turns in frame.column("turns").to_pylist():
            path = [ROOT]
            for turn in turns:
                path.append(hashlib.blake2b(path[-1] + turn, digest_size=DIGEST).digest())
            paths.append(b"".join(path))
        kept = frame.select(["conv_id", "words"])
        yield pa.RecordBatch.from_arrays([*kept.columns, pa.array(paths, pa.binary())], names=["conv_id", "words", "path"])


NODES = "digest binary, parent binary, depth long, words long, n_convs long, conv_id long"


def _members(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Members of each node of a block, and the smallest of them."""
    for block in _blocks(frames):
        table = NodeTable(block["path"])
        members = np.bincount(table.ends, minlength=table.n)
        smallest = np.full(table.n, np.iinfo(np.int64).max)
        np.minimum.at(smallest, table.ends, np.array(block["conv_id"], dtype=np.int64))
        words = np.zeros(table.n, dtype=np.int64)
        words[table.slot] = np.concatenate([np.r_[0, np.array(w, dtype=np.int64)] for w in block["words"]])
        digests = table.digests()
        yield pa.RecordBatch.from_arrays(
            [pa.array(digests, pa.binary()), pa.array([digests[p] if p >= 0 else None for p in table.parent], pa.binary()),
             pa.array(table.depth), pa.array(words), pa.array(table.add_up(members)), pa.array(table.smallest(smallest))],
            names=["digest", "parent", "depth", "words", "n_convs", "conv_id"],
        )


def _sums(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Leaves and saved tokens below each node of a block, of the shares that its conversations carry."""
    for block in _blocks(frames):
        table = NodeTable(block["path"])
        begin = np.cumsum(table.lens) - table.lens
        leaves, saved = np.zeros(table.n, dtype=np.int64), np.zeros(table.n, dtype=np.int64)
        for at, shares in zip(begin, block["shares"], strict=True):
            for share in shares or ():
                slot = table.slot[at + share["depth"]]
                leaves[slot] += share["leaf"]
                saved[slot] += share["saved"]
        leaves, saved = table.add_up(leaves), table.add_up(saved)
        some = np.flatnonzero((leaves != 0) | (saved != 0))
        digests = table.digests()
        yield pa.RecordBatch.from_arrays(
            [pa.array([digests[i] for i in some], pa.binary()), pa.array(leaves[some]), pa.array(saved[some])],
            names=["digest", "n_leaves", "saved_tokens"],
        )


def _end_digests(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One digest per node of stretches that come in order, read as one text without holding it."""
    node, state, done = None, None, []
    for frame in frames:
        for digest, text in zip(frame.column("digest").to_pylist(), frame.column("ids").to_pylist(), strict=True):
            if digest != node:
                if node is not None:
                    done.append((node, state.hexdigest()))
                node, state = digest, hashlib.sha256(text.encode())
            else:
                state.update(b"," + text.encode())
        yield _named(done)
        done = []
    if node is not None:
        yield _named([(node, state.hexdigest())])


def _named(done: list[tuple[bytes, str]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([d for d, _ in done], pa.binary()), pa.array([h for _, h in done], pa.string())],
        names=["digest", "ends_sha256"],
    )


def turn_rows(rows: DataFrame) -> DataFrame:
    """One row per conversation: (conv_id, turns: array of (digest, words)) by turn, null turns first, ties by digest.

    Null roles and texts count as empty; rows without conv_id belong to no conversation.
    """
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    said = F.concat_ws(":", F.octet_length(role).cast("string"), F.concat(role, text))
    turn = F.struct(
        F.col("turn"),
        F.unhex(F.substring(F.sha2(said, 256), 1, 2 * DIGEST)).alias("digest"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"),
    )
    grouped = rows.where("conv_id IS NOT NULL").select("conv_id", turn.alias("t")).groupBy("conv_id")
    ordered = F.sort_array(F.collect_list("t"))
    return grouped.agg(F.transform(ordered, lambda t: F.struct(t.digest.alias("digest"), t.words.alias("words"))).alias("turns"))


def rebuilt(conversations: DataFrame, every: int = 20, most: int = 4) -> DataFrame:
    """Conversations whose first turns are those of the conversation at the begin of their stretch of ``every`` ids.

    Of a conversation c the first h = crc32(c) % ``most`` turns are replaced; all turns of the other one are taken if it
    has fewer, none if it is absent.
    """
    head = F.crc32(F.col("conv_id").cast("string").cast("binary")) % most
    own = conversations.withColumns({"base": F.col("conv_id") - F.col("conv_id") % every, "head": head.cast("int")})
    lead = conversations.where(F.col("conv_id") % every == 0).select(
        F.col("conv_id").alias("base"), F.slice("turns", 1, most - 1).alias("lead")
    )
    none = F.expr("array()").cast(conversations.schema["turns"].dataType)
    return own.join(lead, "base", "left").select(
        "conv_id",
        F.concat(
            F.coalesce(F.slice("lead", F.lit(1), F.col("head")), none),
            F.slice("turns", F.col("head") + 1, F.size("turns")),
        ).alias("turns"),
    )


def nodes(conversations: DataFrame) -> DataFrame:
    """All nodes of the prefix trie of ``conversations`` (conv_id, turns: array of (digest, words)), one row each.

    conv_id: smallest member; depth; parent_conv_id; n_convs; n_children; n_leaves and saved_tokens of its subtree;
    ends_sha256 of the ids that end there. The root is a node as soon as there is a conversation; without one there are
    no rows. conv_id must be unique and not null. A conversation is handled as a whole; everything else is bounded.
    """
    spark = conversations.sparkSession
    small_batches(spark)
    paths = stored(
        conversations.select("conv_id", F.col("turns.digest").alias("turns"), F.col("turns.words").alias("words")).mapInArrow(
            _chained, "conv_id long, words array<long>, path binary"
        ),
        "prefix-paths",
    )
    parts = paths.select("path", "words", "conv_id").mapInArrow(_members, NODES)
    found = stored(
        parts.groupBy("digest").agg(
            F.min("parent").alias("parent"),
            F.min("depth").alias("depth"),
            F.min("words").alias("words"),
            F.sum("n_convs").alias("n_convs"),
            F.min("conv_id").alias("conv_id"),
            # Two prefixes under one digest would differ in one of these.
            F.assert_true(
                F.min("parent").eqNullSafe(F.max("parent")) & (F.min("depth") == F.max("depth")) & (F.min("words") == F.max("words")),
                "two prefixes share a digest",
            ).cast("string").alias("checked"),
        ),
        "prefix-nodes",
    )
    children = found.where("parent IS NOT NULL").groupBy(F.col("parent").alias("digest")).agg(F.count(F.lit(1)).alias("n_children"))
    known = stored(
        found.drop("checked").join(children, "digest", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0))),
        "prefix-nodes",
    )
    share = F.struct(
        F.col("depth"),
        (F.col("n_children") == 0).cast("long").alias("leaf"),
        ((F.col("n_convs") - 1) * F.col("words")).alias("saved"),
    )
    shares = known.where("n_children = 0 OR (n_convs > 1 AND words > 0)").groupBy("conv_id").agg(F.collect_list(share).alias("shares"))
    sums = (
        paths.select("conv_id", "path")
        .join(shares, "conv_id", "left")
        .select("path", "shares")
        .mapInArrow(_sums, "digest binary, n_leaves long, saved_tokens long")
        .groupBy("digest")
        .agg(F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens"))
    )
    done = _with_parent(known).join(sums, "digest", "left").join(_ends(paths), "digest", "left")
    result = stored(
        done.select(
            "conv_id",
            "depth",
            "parent_conv_id",
            "n_convs",
            F.col("n_children").cast("long").alias("n_children"),
            F.coalesce("n_leaves", F.lit(0)).cast("long").alias("n_leaves"),
            F.coalesce("saved_tokens", F.lit(0)).cast("long").alias("saved_tokens"),
            F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
        ),
        "prefix-trie",
    )
    forget(paths, found, known)
    return result


def _ends(paths: DataFrame) -> DataFrame:
    """Digest of the ids that end at a node; ids are joined to texts by stretches before they meet."""
    stretch = (
        paths.select(F.substring("path", -DIGEST, DIGEST).alias("digest"), "conv_id")
        .groupBy("digest", F.shiftright("conv_id", STRETCH).alias("stretch"))
        .agg(F.array_join(F.transform(F.sort_array(F.collect_list("conv_id")), lambda i: i.cast("string")), ",").alias("ids"))
    )
    ordered = stretch.repartition("digest").sortWithinPartitions("digest", "stretch")
    return ordered.select("digest", "ids").mapInArrow(_end_digests, "digest binary, ends_sha256 string")


def _with_parent(known: DataFrame) -> DataFrame:
    """Smallest member of the parent: that of the node, but for the first node which that one is the smallest of."""
    root = known.where("depth = 0").select("conv_id").first()
    shared = F.lit(root and root[0]).cast("long")
    first = F.row_number().over(Window.partitionBy("conv_id").orderBy("depth")) == 1
    marked = known.withColumn("is_top", first & (F.col("depth") > 1))
    near = F.when(F.col("depth") == 1, shared).when(F.col("depth") > 1, F.col("conv_id"))
    # Nodes of depth 1, of which there may be very many, share the root's member and need no join.
    above = known.where("n_children > 0 AND depth > 0").select(F.col("digest").alias("above"), F.col("conv_id").alias("parent_conv_id"))
    top = marked.where("is_top").join(above, F.col("parent") == F.col("above")).drop("above")
    return marked.where("NOT is_top").withColumn("parent_conv_id", near).unionByName(top)
