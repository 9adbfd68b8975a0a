"""BPE encoding and decoding in batched numpy merge rounds.

Words of a batch are put into one flat array of symbols. In each round every pair of neighbours is looked up by
binary search among the sorted pair keys, the pair of lowest rank of every word is merged wherever it stands in
that word, and words without a pair left are done.
"""

from __future__ import annotations

import json
import re
from functools import lru_cache
from itertools import pairwise
from os.path import commonprefix
from struct import pack

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from tokenizers import Regex, normalizers, pre_tokenizers

from .common import portions, small_batches

#: White space of the tokenizer files' patterns; \x1c-\x1f, which Python splits at, are not part of it.
SPACES = "\t\n\x0b\x0c\r \x85\xa0  -     　"
_PYTHON_ONLY = re.compile("[\x1c-\x1f]")
_SPLIT = re.compile(f"[{SPACES}]+")
#: Chunks kept per worker before the cache starts anew.
CACHE = 400_000
#: Words whose symbols are merged together.
WORDS = 16_384
_NONE = np.iinfo(np.int64).max


def byte_characters() -> list[str]:
    """Character that stands for each byte in byte-level vocabularies."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(spare)) for b in range(256)]


class Bpe:
    """Vocabulary, sorted pair keys and a cache of encoded chunks."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        vocab: dict[str, int] = model["vocab"]
        self.suffix: str = model.get("end_of_word_suffix") or ""
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special_ids = {text: pack("<i", at) for text, at in self.special.items()}
        #: What every special token begins with; chunks without it need no search for them.
        self.mark = commonprefix(list(self.special)) if self.special else "\n"
        self.special_split = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len)[::-1])) + ")")
        pattern = next(
            p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split"
        )
        # Text beyond ASCII is composed, lowered and cut by the library's own tables, as versions of Unicode differ.
        self.normal = normalizers.Sequence([normalizers.NFC(), normalizers.Lowercase()])
        self.cut = pre_tokenizers.Split(Regex(pattern), behavior="removed", invert=True)
        self.ascii_words = re.compile(
            pattern.replace(r"\p{L}", "a-z").replace(r"\p{N}", "0-9").replace(r"\s", r"\t-\r ")
        )
        self.size = 1 + max([*vocab.values(), *self.special.values()])
        shown = byte_characters()
        self.base = np.array([vocab[c] for c in shown], dtype=np.int64)
        self.last = np.array([vocab[c + self.suffix] for c in shown], dtype=np.int64)
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        keys = np.array([vocab[a] * self.size + vocab[b] for a, b in pairs], dtype=np.int64)
        into = np.array([vocab[a + b] for a, b in pairs], dtype=np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks, self.into = keys[order], order.astype(np.int64), into[order]
        self.tokens = [""] * self.size
        for text, at in [*vocab.items(), *self.special.items()]:
            self.tokens[at] = text
        self.token_array = pa.array(self.tokens, pa.string())
        self.cache: dict[str, bytes] = {}
        self.known: dict[str, bytes] = {}

    def split_words(self, part: str) -> list[str]:
        """Words of a chunk between special tokens: composed, in lower case, cut by the pattern."""
        if part.isascii():
            low = part.lower()
            return [low] if low.isalpha() else self.ascii_words.findall(low)
        low = self.normal.normalize_str(part)
        return [low] if low.isalpha() else [word for word, _ in self.cut.pre_tokenize_str(low)]

    def look_up(self, flat: np.ndarray, word: np.ndarray, at: np.ndarray, where: np.ndarray) -> None:
        """Set ``at`` to the place of the pair that begins at each of ``where`` among the pair keys; -1 if none."""
        where = where[where >= 0]
        at[where] = -1
        where = where[where < len(flat) - 1]
        where = where[word[where] == word[where + 1]]
        key = flat[where] * self.size + flat[where + 1]
        place = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        at[where] = np.where(self.keys[place] == key, place, -1)

    def merge(self, words: list[bytes]) -> list[bytes]:
        """Little-endian 32-bit ids of each word after all merges."""
        if not words:
            return []
        size = np.array([len(w) for w in words], dtype=np.int64)
        ends = np.cumsum(size)
        raw = np.frombuffer(b"".join(words), dtype=np.uint8)
        flat = self.base[raw]
        flat[ends - 1] = self.last[raw[ends - 1]]
        word = np.repeat(np.arange(len(words)), size)
        at = np.full(len(flat), -1)
        self.look_up(flat, word, at, np.arange(len(flat) - 1))
        done_ids: list[np.ndarray] = []
        done_words: list[np.ndarray] = []
        while flat.size:
            rank = np.where(at < 0, _NONE, self.ranks[at])
            heads = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            counts = np.diff(np.r_[heads, len(flat)])
            low = np.repeat(np.minimum.reduceat(rank, heads), counts)
            over = low == _NONE
            if over.any():
                done_ids.append(flat[over])
                done_words.append(word[over])
            take = np.flatnonzero((rank == low) & ~over)
            if take.size:
                # Of overlapping pairs of one symbol the first, third, ... are merged.
                first = np.r_[True, np.diff(take) != 1]
                start = take[first][np.cumsum(first) - 1]
                take = take[(take - start) % 2 == 0]
                flat[take] = self.into[at[take]]
            keep = ~over
            keep[take + 1] = False
            new = np.zeros(len(flat), dtype=bool)
            new[take] = True
            flat, word, at, new = flat[keep], word[keep], at[keep], np.flatnonzero(new[keep])
            # Only pairs with a merged symbol are new: it and its left neighbour.
            self.look_up(flat, word, at, np.union1d(new, new - 1))
        ids, owner = np.concatenate(done_ids), np.concatenate(done_words)
        data = ids[np.argsort(owner, kind="stable")].astype("<i4").tobytes()
        cut = [0, *(4 * np.cumsum(np.bincount(owner, minlength=len(words)))).tolist()]
        return [data[a:b] for a, b in pairwise(cut)]

    def learn(self, chunks: list[str]) -> None:
        """Encode chunks that the cache lacks."""
        plan: list[list[str]] = []
        for chunk in chunks:
            if self.mark in chunk:
                parts = []
                for part in self.special_split.split(chunk):
                    parts += [part] if part in self.special else self.split_words(part)
                plan.append(parts)
            else:
                plan.append(self.split_words(chunk))
        words = list({p for parts in plan for p in parts}.difference(self.known))
        for i in range(0, len(words), WORDS):
            some = words[i : i + WORDS]
            self.known.update(zip(some, self.merge([w.encode() for w in some]), strict=True))
        self.known.update(self.special_ids)
        known = self.known.__getitem__
        for chunk, parts in zip(chunks, plan, strict=True):
            self.cache[chunk] = known(parts[0]) if len(parts) == 1 else b"".join(map(known, parts))

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian 32-bit ids of each text."""
        return [code for run in portions(texts) for code in self.encode_run(run)]

    def encode_run(self, texts: list[str]) -> list[bytes]:
        split = [_SPLIT.split(t) if _PYTHON_ONLY.search(t) else t.split() for t in texts]
        if len(self.cache) > CACHE:
            self.cache.clear()
        if len(self.known) > CACHE:
            self.known.clear()
        missing: set[str] = set()
        for chunks in split:
            missing.update(chunks)
        self.learn(list(missing.difference(self.cache)))
        get = self.cache.__getitem__
        return [b"".join(map(get, chunks)) for chunks in split]

    def decode(self, ids: pa.Array) -> pa.Array:
        """Texts of lists of ids: the tokens joined by a blank; ids that the vocabulary lacks are left out."""
        flat = pc.list_flatten(ids)
        owner = pc.list_parent_indices(ids).to_numpy(zero_copy_only=False)
        known = flat.to_numpy(zero_copy_only=False)
        fine = (known >= 0) & (known < self.size)
        counts = np.bincount(owner[fine], minlength=len(ids))
        tokens = self.token_array.take(pa.array(known[fine].astype(np.int64)))
        offsets = pa.array(np.r_[0, np.cumsum(counts)].astype(np.int64))
        lists = pa.LargeListArray.from_arrays(offsets, tokens)
        return pc.binary_join(lists, " ")


@lru_cache(maxsize=2)
def load(path: str) -> Bpe:
    return Bpe(path)


def _lists(codes: list[bytes]) -> pa.Array:
    """Little-endian 32-bit ids as lists."""
    offsets = np.r_[0, np.cumsum([len(b) // 4 for b in codes])].astype(np.int32)
    values = pa.Array.from_buffers(pa.int32(), int(offsets[-1]), [None, pa.py_buffer(b"".join(codes))])
    return pa.ListArray.from_arrays(pa.array(offsets), values)


def _encode(path: str):
    @F.arrow_udf("array<int>")
    def encode(text: pa.Array) -> pa.Array:
        return _lists(load(path).encode([t or "" for t in text.to_pylist()]))

    return encode


def _both(path: str):
    @F.arrow_udf("struct<ids: array<int>, decoded: string>")
    def both(text: pa.Array) -> pa.Array:
        coder = load(path)
        runs = [_lists(coder.encode_run(run)) for run in portions([t or "" for t in text.to_pylist()])]
        ids = pa.concat_arrays(runs) if runs else pa.array([], pa.list_(pa.int32()))
        decoded = pa.concat_arrays([coder.decode(run) for run in runs]) if runs else pa.array([], pa.string())
        return pa.StructArray.from_arrays([ids, decoded], names=["ids", "decoded"])

    return both


def _decode(path: str):
    @F.arrow_udf("string")
    def decode(ids: pa.Array) -> pa.Array:
        filled = pc.fill_null(ids, pa.scalar([], ids.type)) if ids.null_count else ids
        return load(path).decode(filled)

    return decode


def encode(docs: DataFrame, path: str, text: str | Column = "text", into: str = "ids") -> DataFrame:
    """``docs`` with the ids of each whole text in ``into``, as the tokenizer file at ``path`` defines them.

    Special tokens inside a text are recognised, none is added. A null or blank text gives an empty list; repeated
    rows give repeated results; an existing column ``into`` is replaced, every other column is kept. ``path`` must
    be readable on every executor.
    """
    small_batches(docs.sparkSession)
    return docs.withColumn(into, _encode(path)(F.col(text) if isinstance(text, str) else text))


def decode(rows: DataFrame, path: str, ids: str = "ids", into: str = "decoded") -> DataFrame:
    """``rows`` with the text of the list ``ids`` in ``into``; null or empty lists give an empty text."""
    small_batches(rows.sparkSession)
    return rows.withColumn(into, _decode(path)(F.col(ids)))


def encode_and_decode(docs: DataFrame, path: str, text: str = "text", into: str = "ids", decoded: str = "decoded") -> DataFrame:
    """``encode`` and ``decode`` of its ids in one go: the plan holds one call per text, whatever is made of the two columns."""
    small_batches(docs.sparkSession)
    others = [F.col(f"`{c}`") for c in docs.columns if c.lower() not in (into.lower(), decoded.lower())]
    # As generated columns the results are computed once.
    return docs.select(*others, F.inline(F.array(_both(path)(F.col(text)))).alias(into, decoded))
