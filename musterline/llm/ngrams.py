"""Language-model scores from an n-gram trie whose levels are dealt out by context.

Texts go through in batches. A batch asks about each distinct n-gram once, with how often its learning texts hold it; the
part of a level that owns the n-gram's context adds the counts of all batches up, builds an Elias-Fano trie of the
n-grams that occur with their quantised smoothed probabilities, and answers every batch from it. Orders follow each other,
as what is asked of order n depends on order n - 1. Nothing is pruned: all n-grams of the learning texts count.

Smoothing: p(w | context) = c(context w) / (c(context) + m) + m / (c(context) + m) p(w | shorter context), with m by order,
down to (c(w) + 1) / (N + V + 1) for single words; it sums to one over the vocabulary and one unknown word. The trie holds
the first term, the smoothed share that an n-gram has of its own.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import reduce
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import discard, scratch
from .common import forget, release_shuffles, small_batches, stored
from .eliasfano import Trie

#: Weight of the shorter context by order.
PRIOR = {2: 100.0, 3: 3.0, 4: 3.0, 5: 3.0}
#: Steps of a quantised log10 probability.
STEP = 1024
#: Bytes of text in a batch, texts being whole; questions to one part of a level.
BATCH = 4 << 20
PART = 1_000_000

#: Kinds of rows a batch is stored as: its texts, and its words by part of the vocabulary.
TEXTS, WORDS = "texts", "words"
Array = np.ndarray


def packed(*arrays: Array) -> bytes:
    """Arrays of whole numbers, byte by byte across each array, compressed."""
    out = []
    for a in arrays:
        a = np.ascontiguousarray(a)
        out += [np.array([len(a), a.itemsize], dtype="<i8").tobytes(), a.view(np.uint8).reshape(-1, a.itemsize).T.tobytes()]
    return zstandard.ZstdCompressor(level=3).compress(b"".join(out))


def unpacked(data: bytes) -> list[Array]:
    raw = zstandard.ZstdDecompressor().decompress(data)
    out, at = [], 0
    while at < len(raw):
        n, size = (int(x) for x in np.frombuffer(raw, dtype="<i8", count=2, offset=at))
        body = np.frombuffer(raw, dtype=np.uint8, count=n * size, offset=at + 16)
        out.append(np.ascontiguousarray(body.reshape(size, n).T).view(f"<u{size}").ravel())
        at += 16 + n * size
    return out


def whole(a: Array) -> Array:
    return a.astype(np.int64)


def mixed(*columns: Array) -> Array:
    """A hash of each row of whole numbers."""
    h = np.full(len(columns[0]), 0x9E3779B97F4A7C15, dtype=np.uint64)
    for c in columns:
        h = (h ^ c.astype(np.uint64)) * np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(29)
        h *= np.uint64(0x94D049BB133111EB)
        h ^= h >> np.uint64(32)
    return h


#: Code of the share of an n-gram that did not occur.
NONE = 65535


def code_of(share: Array) -> Array:
    """Shares above 0 as steps of their log10."""
    return np.minimum(np.rint(-np.log10(share) * STEP), NONE - 1).astype(np.uint16)


_SHARE = np.r_[10.0 ** (-np.arange(NONE) / STEP), 0.0]


def distinct(key: Array) -> tuple[Array, Array, Array]:
    """Distinct values in order, a place of each, and which of them stands at every place."""
    n = len(key)
    bits = n.bit_length()
    if n and int(key.max()) < 1 << (63 - bits):
        # Sorting values is several times faster than sorting places.
        both = np.sort((key << bits) | np.arange(n))
        order, values = both & ((1 << bits) - 1), both >> bits
    else:
        order = np.argsort(key)
        values = key[order]
    new = np.ones(n, dtype=bool)
    new[1:] = values[1:] != values[:-1]
    at = np.empty(n, dtype=np.int64)
    at[order] = np.cumsum(new) - 1
    return values[new], order[new], at


# --- Batches: words of texts, once per distinct word


def _tokens(parts: int, batch: int):
    """Batches of texts as local word numbers, and their words asked of the parts of the vocabulary."""

    def batch_rows(number: int, ids: list, learn: list[bool], texts: list[pa.Array]) -> list[dict]:
        split = pc.ascii_split_whitespace(pc.ascii_lower(pa.concat_arrays(texts)))
        offsets = split.offsets.to_numpy()
        flat = split.flatten()
        # What stands before the first blank or after the last one is empty.
        full = pc.binary_length(flat).to_numpy(zero_copy_only=False) > 0
        upto = np.r_[0, np.cumsum(full)]
        lens = upto[offsets[1:]] - upto[offsets[:-1]] + 1
        coded = flat.filter(pa.array(full)).cast(pa.binary()).dictionary_encode()
        words = [b"", *coded.dictionary.to_pylist()]
        # Every text ends with one token, local number 0.
        token = np.zeros(int(lens.sum()), dtype=np.int64)
        inner = np.ones(len(token), dtype=bool)
        inner[np.cumsum(lens) - 1] = False
        token[inner] = coded.indices.to_numpy(zero_copy_only=False) + 1
        learnt = np.repeat(np.array(learn, dtype=bool), lens)
        # Words in falling frequency have small numbers.
        often = np.bincount(token, minlength=len(words))
        order = np.argsort(-often, kind="stable")
        place = np.empty_like(order)
        place[order] = np.arange(len(order))
        words = [words[i] for i in order]
        token = place[token]
        count = np.bincount(token[learnt], minlength=len(words))
        part = np.fromiter((zlib.crc32(w) % parts for w in words), np.uint32, len(words))
        asks = []
        for p, at in _by_part(part):
            text = b" ".join(words[i] for i in at)
            asks.append({"part": p, "data": packed(np.frombuffer(text + b" ", dtype=np.uint8), count[at].astype(np.uint32))})
        end = int(place[0])
        data = packed(token.astype(np.uint32), lens.astype(np.uint32), part, np.array([end], np.uint32))
        row = {"kind": TEXTS, "batch": number, "part": None, "ids": ids, "learn": learn, "learnt": int(learnt.sum()), "data": data}
        return [row, *({"kind": WORDS, "batch": number, "ids": None, "learn": None, "learnt": None, **ask} for ask in asks)]

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        ids, learn, texts, size, schema = [], [], [], 0, None
        for frame in frames:
            schema = pa.schema(
                [("kind", pa.string()), ("batch", pa.int64()), ("part", pa.int32()), ("ids", pa.list_(frame.schema.field("id").type)),
                 ("learn", pa.list_(pa.bool_())), ("learnt", pa.int64()), ("data", pa.binary())]
            )
            text = frame.column("text")
            sizes = pc.binary_length(text).to_numpy(zero_copy_only=False)
            docs, flags = frame.column("id").to_pylist(), frame.column("learn").to_pylist()
            begin = 0
            for i in range(frame.num_rows):
                if (ids or i > begin) and size + sizes[i] > batch:
                    ids, learn, texts = ids + docs[begin:i], learn + flags[begin:i], [*texts, text.slice(begin, i - begin)]
                    yield pa.RecordBatch.from_pylist(batch_rows(number, ids, learn, texts), schema=schema)
                    ids, learn, texts, size, number, begin = [], [], [], 0, number + 1, i
                size += sizes[i]
            ids, learn, texts = ids + docs[begin:], learn + flags[begin:], [*texts, text.slice(begin)]
        if ids:
            yield pa.RecordBatch.from_pylist(batch_rows(number, ids, learn, texts), schema=schema)

    return run


def _by_part(part: Array) -> Iterator[tuple[int, Array]]:
    """Each part with the places that go to it, in order."""
    order = np.argsort(part, kind="stable")
    cuts = np.flatnonzero(np.diff(part[order].astype(np.int64), prepend=-1))
    for a, b in pairwise([*cuts, len(order)]):
        yield int(part[order[a]]), order[a:b]


ANSWER = pa.schema([("batch", pa.int64()), ("part", pa.int32()), ("data", pa.binary()), ("seen", pa.int64())])


def _vocabulary(parts: int):
    """Number (0: not learnt) and count of every asked word of one part; frequent words have small numbers."""

    def run(table: pa.Table) -> pa.Table:
        part = table.column("part")[0].as_py()
        total: dict[bytes, int] = {}
        asked = []
        for batch, data in zip(table.column("batch").to_pylist(), table.column("data").to_pylist(), strict=True):
            text, count = unpacked(data)
            words = text.tobytes()[:-1].split(b" ")
            asked.append((batch, words))
            for w, c in zip(words, count.tolist(), strict=True):
                total[w] = total.get(w, 0) + c
        seen = sorted((w for w, c in total.items() if c), key=lambda w: (-total[w], w))
        number = {w: 1 + rank * parts + part for rank, w in enumerate(seen)}
        rows = []
        for i, (batch, words) in enumerate(asked):
            n = len(words)
            got = np.fromiter((number.get(w, 0) for w in words), np.uint64, n)
            counts = np.fromiter((total[w] for w in words), np.uint64, n)
            rows.append({"batch": batch, "part": part, "data": packed(got, counts), "seen": 0 if i else len(seen)})
        return pa.Table.from_pylist(rows, schema=ANSWER)

    return run


# --- Batches: n-grams


class Grams:
    """The n-grams of a batch, order by order, with what is known of them."""

    def __init__(self, state: list[bytes], total: int, words: int, parts: int, split: int, order: int):
        token, lens, part, end = (whole(a) for a in unpacked(state[0]))
        self.lens, self.parts, self.split = lens, parts, split
        self.first = np.r_[0, np.cumsum(lens)][:-1]
        number, count = np.zeros(len(part), dtype=np.int64), np.zeros(len(part), dtype=np.int64)
        got = [whole(a) for a in unpacked(state[1])]
        at = np.argsort(part, kind="stable")
        number[at], count[at] = got
        self.count0 = int(count[end[0]])  # learning texts, each of which begins once
        self.word = token
        self.number, self.single = number, count
        #: Per distinct n-gram: learnt occurrences, probability; and the n-gram at every place.
        self.count, self.chance, self.at = count, (count + 1) / (total + words + 1), token
        #: Words of each distinct context of the next order, the nearest first; row 0 stands for the begin of a text.
        self.columns = [np.r_[0, number]]
        self.order = 1
        for answers in state[2:]:
            asks = self.ask()
            self.known(asks, [whole(a) for a in unpacked(answers)], self.order == order)

    def ask(self) -> dict[str, Array]:
        """Distinct n-grams of the next order, and which of them some part of its level may hold."""
        self.order += 1
        context = np.empty_like(self.at)
        context[1:] = self.at[:-1] + 1
        context[self.first] = 0
        key, first, at = distinct(context * len(self.number) + self.word)
        context, word = key // len(self.number), key % len(self.number)
        shorter = self.at[first]
        before = np.r_[self.count0, self.count][context]
        open_ = np.flatnonzero((before > 0) & (self.count[shorter] > 0))
        split = mixed(self.number[word[open_]]) % (1 + before[open_] // self.split).astype(np.uint64)
        columns = [c[context[open_]] for c in self.columns]
        part = (mixed(*columns, split) % np.uint64(self.parts)).astype(np.int64)
        turn = np.argsort(part, kind="stable")
        return {"at": at, "context": context, "word": word, "shorter": shorter, "before": before, "open": open_[turn], "part": part[turn]}

    def questions(self, asks: dict[str, Array], learn: Array) -> list[dict]:
        """What is asked of each part: contexts with their counts, and words below them."""
        learnt = np.repeat(learn, self.lens)
        often = np.bincount(asks["at"][learnt], minlength=len(asks["context"]))
        out = []
        for part, where in _by_part(asks["part"]):
            grams = asks["open"][where]
            context = asks["context"][grams]
            begin = np.flatnonzero(np.diff(context, prepend=-1))
            ahead = context[begin]
            data = packed(
                *[c[ahead].astype(np.uint64) for c in self.columns],
                asks["before"][grams[begin]].astype(np.uint64),
                np.diff(np.r_[begin, len(grams)]).astype(np.uint32),
                self.number[asks["word"][grams]].astype(np.uint64),
                often[grams].astype(np.uint32),
            )
            out.append({"part": part, "data": data})
        return out

    def known(self, asks: dict[str, Array], answers: list[Array], last: bool) -> None:
        """Take the answers of the parts; n-grams nobody was asked about follow from the shorter ones."""
        n, m = len(asks["context"]), PRIOR[self.order]
        before = asks["before"]
        share, count = np.zeros(n), np.zeros(n, dtype=np.int64)
        if answers:
            if last:
                share[asks["open"]] = _SHARE[answers[0]]
            else:
                count[asks["open"]] = answers[0]
                share = count / (before + m)
        lower = self.chance[asks["shorter"]]
        chance = share + np.where(before > 0, m / (before + m), 1.0) * lower
        nearest = self.number[asks["word"]]
        self.columns = [np.r_[0, nearest], *[np.r_[0, c[asks["context"]]] for c in self.columns]]
        self.count, self.chance, self.at = count, chance, asks["at"]


def _level(order: int, last: bool):
    """Adds up what all batches counted below the contexts of one part, and answers from the trie of it.

    An answer is the quantised share of each n-gram. Below the last order it is the count instead, which the n-gram needs
    as a context in turn; the share follows from it and what the batch knows.
    """

    def run(table: pa.Table) -> pa.Table:
        part = table.column("part")[0].as_py()
        m = PRIOR[order]
        batches = table.column("batch").to_pylist()
        asked = [unpacked(d) for d in table.column("data").to_pylist()]
        columns = [whole(np.concatenate([a[i] for a in asked])) for i in range(order - 1)]
        before, children, word, often = (whole(np.concatenate([a[order - 1 + i] for a in asked])) for i in range(4))
        sizes = [len(a[order + 1]) for a in asked]
        del asked
        top = 1 + max(int(word.max()), *(int(c.max()) for c in columns))
        node = np.zeros(len(before), dtype=np.int64)
        for column in columns:
            node = distinct(node * top + column)[2]
        _, first, at = distinct(np.repeat(node, children) * top + word)
        count = np.bincount(at, weights=often).astype(np.int64)
        owner = np.repeat(np.arange(len(before)), children)[first]
        rows = [*[c[owner] for c in columns], word[first]]
        held = np.flatnonzero(count > 0)
        share = code_of(count[held] / (before[owner[held]] + m))
        trie = Trie.build([r[held] for r in rows], share, count[held].astype(np.uint64)).mapped()
        # Distinct questions go down the trie from its root.
        leaf = trie.find(rows)
        lacking = leaf < 0
        code, total = np.append(trie.codes, NONE)[leaf], np.append(trie.counts, 0)[leaf]
        code[lacking], total[lacking] = NONE, 0
        answers = []
        for b, i in zip(batches, np.split(at, np.cumsum(sizes)[:-1]), strict=True):
            data = packed(code[i].astype(np.uint16) if last else total[i].astype(np.uint64))
            answers.append({"batch": b, "part": part, "data": data, "seen": 0})
        return pa.Table.from_pylist(answers, schema=ANSWER)

    return run


def _joined(answers: list[dict]) -> bytes:
    """Answers of all parts, in their order, as one."""
    parts = [unpacked(a["data"]) for a in sorted(answers, key=lambda a: a["part"])]
    return packed(*[np.concatenate(c) for c in zip(*parts, strict=True)]) if parts else packed()


def _batches(frames: Iterator[pa.RecordBatch], known: tuple[int, ...]) -> Iterator[tuple[dict, Grams]]:
    """Each batch with its n-grams and the answers of all levels so far."""
    for frame in frames:
        for i in range(frame.num_rows):
            row = frame.slice(i, 1).to_pylist()[0]
            answers: dict[int, list[dict]] = {}
            for a in row["answers"] or []:
                answers.setdefault(a["level"], []).append(a)
            yield row, Grams([row["data"], *(_joined(answers[n]) if n in answers else packed() for n in range(1, row["level"]))], *known)


ASK = pa.schema([("part", pa.int32()), ("batch", pa.int64()), ("data", pa.binary())])


def _asks(known: tuple[int, ...]):
    """The next order's questions of every batch."""

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row, grams in _batches(frames, known):
            asks = grams.questions(grams.ask(), np.array(row["learn"], dtype=bool))
            yield pa.RecordBatch.from_pylist([{"batch": row["batch"], **a} for a in asks], schema=ASK)

    return run


def _scores(known: tuple[int, ...], id_type: pa.DataType):
    """A row per text."""

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, words = known[:2]
        for row, grams in _batches(frames, known):
            count = grams.single[grams.word]
            add = lambda v: np.add.reduceat(v, grams.first)  # noqa: B023, E731
            base = add(np.log10((count + 1) / (total + words + 1)))
            score = add(np.log10(grams.chance)[grams.at])
            yield pa.RecordBatch.from_arrays(
                [pa.array(row["ids"], id_type), pa.array(row["learn"]), pa.array(grams.lens), pa.array(add((count > 0).astype(np.int64))),
                 pa.array(np.full(len(base), total)), pa.array(base), pa.array(score)],
                names=["id", "learn", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
            )

    return run


def score(
    docs: DataFrame,
    learn: Column,
    order: int = 3,
    id_column: str = "doc_id",
    text: str = "text",
    batch: int = BATCH,
    part: int = PART,
) -> DataFrame:
    """Log10 probability of every whole text under the n-grams of the texts for which ``learn`` holds.

    One row per row of ``docs``, repeated ones included: (``id_column``, learn, n_tokens, n_known, train_tokens,
    base_score, score). A-Z count as a-z, words end at blanks and line breaks, and each text has one more token at its
    end; a null or empty text has that token alone. A null ``learn`` counts as false. ``base_score`` takes single words
    only. Without learning texts every token counts as unknown. Other columns of ``docs`` are not read.

    Memory: a task holds one batch of about ``batch`` bytes of texts (one text at least), or one part of a level, of about
    ``part`` questions; a context with more learnt occurrences than a quarter of that is dealt out to several by word.
    """
    spark = docs.sparkSession
    small_batches(spark)
    rows = docs.select(
        F.col(id_column).alias("id"),
        F.coalesce(learn, F.lit(False)).alias("learn"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    id_sql = rows.schema["id"].dataType.simpleString()
    size = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    # A token takes some six bytes of text.
    parts = 1 + size // (6 * part)
    shape = f"kind string, batch long, part int, ids array<{id_sql}>, learn array<boolean>, learnt long, data binary"
    folder = scratch(spark, "ngram-batches")
    rows.mapInArrow(_tokens(parts, batch), shape).write.partitionBy("kind").parquet(folder)
    stored_rows = spark.read.schema(shape).parquet(folder)
    texts = stored_rows.where(F.col("kind") == TEXTS).drop("kind", "part")
    total = texts.agg(F.coalesce(F.sum("learnt"), F.lit(0))).first()[0]
    asks = stored_rows.where(F.col("kind") == WORDS).select("part", "batch", "data")
    known = (total, 0, parts, max(1, part // 4), order)
    levels: list[DataFrame] = []
    for n in range(1, order + 1):
        work = _vocabulary(parts) if n == 1 else _level(n, n == order)
        answers = asks.groupBy("part").applyInArrow(work, "batch long, part int, data binary, seen long")
        levels.append(stored(answers.withColumn("level", F.lit(n)), f"ngram-level-{n}"))
        if n == 1:
            discard(spark, f"{folder}/kind={WORDS}")
            known = (total, levels[0].agg(F.coalesce(F.sum("seen"), F.lit(0))).first()[0], *known[2:])
        # Questions and answers of a level are moved once; what they left behind goes before the next one.
        release_shuffles(spark)
        found = reduce(DataFrame.unionByName, levels).groupBy("batch").agg(F.collect_list(F.struct("level", "part", "data")).alias("answers"))
        batches = texts.join(found, "batch", "left").withColumn("level", F.lit(n + 1))
        asks = batches.mapInArrow(_asks(known), "part int, batch long, data binary")
    scores = batches.mapInArrow(
        _scores(known, _arrow_type(rows)),
        f"id {id_sql}, learn boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double",
    )
    done = stored(scores.withColumnRenamed("id", id_column), "ngram-scores")
    forget(*levels)
    discard(spark, folder)
    return done


def _arrow_type(rows: DataFrame) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(rows.schema["id"].dataType)
