"""Sum-of-squares online packing of tokenised documents into windows of equal length.

Every task packs the documents it reads: full windows are cut off a document first, and its rest goes to the fill
level that minimises the sum of the squared counts of partially filled windows, which a level array holds. No row is
shuffled. Windows still open at the end of a task are emptied into each other by cutting pieces.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import lru_cache
from struct import pack

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame

from .bpe import SPACES, byte_characters
from .common import small_batches, strings

#: Words of byte-level BPE, as the tokenizers library cuts them; a fixed value.
WORDS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Runs of white space of at least this many characters are encoded apart: the pattern would go back over them step by step.
LONG = 50_000
_BLANKS = re.compile(f"[{SPACES}]+")
#: Partially filled windows a task keeps open; beyond it the emptier half is poured into the fuller one.
OPEN = 4096
#: Pieces handed to Spark at a time.
ROWS = 4096

SCHEMA = (
    "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"
)
_ARROW = pa.schema(
    [(n, pa.int64()) for n in ("doc_id", "start", "length", "doc_tokens", "sequence_id", "offset")]
    + [("ids", pa.binary())]
)

Piece = tuple[int | None, int, bytes, int]  # doc_id, start, little-endian ids, tokens of the document


class ByteTokens:
    """Ids of whole texts by a byte-level BPE file, through an encoder built from its merges."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        byte_of = {c: b for b, c in enumerate(byte_characters())}
        vocab: dict[str, int] = spec["model"]["vocab"]
        pairs = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        merged = [vocab[a + b] for a, b in pairs]
        if merged != sorted(merged):
            raise ValueError(f"ids of {path} do not follow the order of its merges")
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.encoder = tiktoken.Encoding(
            "byte_bpe",
            pat_str=WORDS,
            mergeable_ranks={bytes(map(byte_of.__getitem__, t)): i for t, i in vocab.items() if t not in special},
            special_tokens=special,
        )

    def encode(self, texts: list[str], long: int = LONG) -> Iterator[bytes]:
        """Little-endian 32-bit ids of each text; special tokens in it are recognised."""
        for text in texts:
            if len(text) < long:
                yield self._ids(text)
            else:
                yield b"".join(self._in_parts(text, long))

    def _ids(self, text: str) -> bytes:
        return self.encoder.encode_to_numpy(text, allowed_special="all").astype("<u4", copy=False).tobytes()

    def _in_parts(self, text: str, long: int) -> Iterator[bytes]:
        """Ids of what stands between long runs of white space, and of the runs.

        A run is one word, but for its last character if more text follows: that one belongs to what comes next.
        """
        done = 0
        for run in _BLANKS.finditer(text):
            begin, end = run.span()
            if end - begin < long:
                continue
            if end < len(text) and not text.startswith(tuple(self.encoder.special_tokens_set), end):
                end -= 1
            yield self._ids(text[done:begin])
            yield np.array(self.encoder._encode_single_piece(text[begin:end]), dtype="<u4").tobytes()
            done = end
        yield self._ids(text[done:])


@lru_cache(maxsize=2)
def tokens(path: str) -> ByteTokens:
    return ByteTokens(path)


class Packer:
    """Open windows of one task by fill level, and the sequences finished so far."""

    def __init__(self, length: int, task: int, most: int = OPEN):
        self.length, self.most, self.next = length, most, task << 33
        self.level = np.zeros(length + 1, dtype=np.int64)
        self.windows: list[list[list[Piece]]] = [[] for _ in range(length + 1)]
        self.rows: list[tuple] = []

    def close(self, pieces: list[Piece]) -> None:
        """Give a window its number and its pieces their places."""
        offset = 0
        for doc, start, ids, total in pieces:
            self.rows.append((doc, start, len(ids) // 4, total, self.next, offset, ids))
            offset += len(ids) // 4
        self.next += 1

    def add(self, doc: int | None, ids: bytes) -> None:
        total, width = len(ids) // 4, 4 * self.length
        full = total // self.length
        for i in range(full):
            self.close([(doc, i * self.length, ids[i * width : (i + 1) * width], total)])
        if rest := total - full * self.length:
            self.place((doc, full * self.length, ids[full * width :], total), rest)

    def place(self, piece: Piece, size: int) -> None:
        """Put a piece where the sum of squared counts grows least; the fullest such level wins a tie."""
        room = self.length - size
        here, there = self.level[1 : room + 1], self.level[size + 1 : self.length + 1]
        change = np.where(here > 0, 1 - 2 * here + 2 * there + 1, np.iinfo(np.int64).max)
        if room and here[-1]:
            change[-1] = 1 - 2 * here[-1]  # a window that becomes full counts no more
        best = room - int(np.argmin(change[::-1])) if room else 0
        if best and change[best - 1] <= 2 * self.level[size] + 1:
            window = self.windows[best].pop()
            self.level[best] -= 1
        else:
            best, window = 0, []
        window.append(piece)
        self.keep(window, best + size)

    def keep(self, window: list[Piece], fill: int) -> None:
        if fill == self.length:
            self.close(window)
            return
        self.windows[fill].append(window)
        self.level[fill] += 1
        if int(self.level.sum()) > self.most:
            self.pour(max(1, self.most // 2))

    def pour(self, count: int) -> None:
        """Empty the ``count`` least filled windows into the others, cutting pieces where a window becomes full."""
        out: list[Piece] = []
        for fill in range(1, self.length):
            while count and self.windows[fill]:
                out += self.windows[fill].pop()
                self.level[fill] -= 1
                count -= 1
        target: list[Piece] = []
        fill = 0
        for doc, start, ids, total in out:
            while ids:
                if not fill:
                    target, fill = self.fullest()
                part, ids = ids[: 4 * (self.length - fill)], ids[4 * (self.length - fill) :]
                target.append((doc, start, part, total))
                start, fill = start + len(part) // 4, fill + len(part) // 4
                if fill == self.length:
                    self.close(target)
                    fill = 0
        if fill:
            self.windows[fill].append(target)
            self.level[fill] += 1

    def fullest(self) -> tuple[list[Piece], int]:
        filled = np.flatnonzero(self.level)
        if not filled.size:
            return [], 0
        fill = int(filled[-1])
        self.level[fill] -= 1
        return self.windows[fill].pop(), fill

    def finish(self) -> None:
        """Pour all open windows together and cut what remains into sequences of powers of two."""
        while (open_ := int(self.level.sum())) > 1:
            self.pour((open_ + 1) // 2)
        last, fill = self.fullest()
        for bit in reversed(range(fill.bit_length())):
            if not fill >> bit & 1:
                continue
            need, some = 4 << bit, []
            while need:
                doc, start, ids, total = last.pop(0)
                part, ids = ids[:need], ids[need:]
                some.append((doc, start, part, total))
                need -= len(part)
                if ids:
                    last.insert(0, (doc, start + len(part) // 4, ids, total))
            self.close(some)

    def take(self) -> pa.RecordBatch:
        rows, self.rows = self.rows, []
        columns = list(zip(*rows, strict=True)) or [[]] * len(_ARROW)
        return pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, _ARROW, strict=True)], schema=_ARROW)


def pack_documents(docs: DataFrame, path: str, length: int = 1024, separator: int = 0, open_windows: int = OPEN) -> DataFrame:
    """Pieces of all documents, packed into sequences of ``length`` tokens.

    A document's tokens are the ids that the tokenizer file at ``path`` gives its whole text, without special tokens
    of its own adding, and then ``separator``. Each row is one piece: ``doc_id``, ``start`` and ``length`` within
    the document, ``doc_tokens``, ``sequence_id``, ``offset`` within the sequence and ``ids``, 32-bit little-endian.
    Sequences are full but for at most one window per task, whose content is cut into powers of two.

    A null text counts as empty and is packed as the separator alone. Repeated rows and null or repeated ``doc_id``
    are packed row by row; other columns are ignored; no documents give no pieces. A task that is run again packs
    its rows as before, and sequence numbers of different tasks never meet.

    ``open_windows`` bounds a task's memory, as the ids of all open windows are held: with 4,096 windows of 1,024 tokens
    at most 17 MB. When more are open, the emptier half is poured into the fuller one by cutting pieces; nothing is padded
    or left out, there are only more cuts.
    """
    small_batches(docs.sparkSession)
    end = pack("<I", separator)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer, source = Packer(length, TaskContext.get().partitionId(), open_windows), tokens(path)
        for batch in batches:
            texts, ids = list(strings(batch.column(1))), batch.column(0).to_pylist()
            for doc, code in zip(ids, source.encode(texts), strict=True):
                packer.add(doc, code + end)
                if len(packer.rows) >= ROWS:
                    yield packer.take()
        packer.finish()
        yield packer.take()

    return docs.select("doc_id", "text").mapInArrow(run, SCHEMA)
