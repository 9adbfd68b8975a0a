"""Elias-Fano sequences and an n-gram trie of them, laid out in one flat buffer.

A level of the trie holds the words of all its nodes as one rising sequence: the words below one parent are raised by
where the words of the parent before it end. Monotone pointers tell where the children of each parent begin. A word is
found by a successor search among the children of its context alone: two selects in the upper bits give the few values
that share them, a binary search over the lower bits does the rest. All searches are vectorised over many queries.
"""

from __future__ import annotations

import mmap
from collections.abc import Sequence

import numpy as np

Array = np.ndarray

_BITS = ((np.arange(256)[:, None] >> np.arange(8)) & 1).astype(np.int64)
#: Place of the k-th set bit of every byte.
_PLACE = np.zeros((256, 8), dtype=np.int64)
for _byte in range(256):
    _set = np.flatnonzero(_BITS[_byte])
    _PLACE[_byte, : len(_set)] = _set

_0, _1, _2, _4, _8, _BYTE = (np.uint64(x) for x in (0, 1, 2, 4, 8, 255))
_5S, _3S, _FS, _ONES, _TOPS = (np.uint64(b * 0x0101010101010101) for b in (0x55, 0x33, 0x0F, 0x01, 0x80))


def _words(bits: Array) -> Array:
    """Bits (0 or 1) as 64-bit words, with a spare one at the end."""
    packed = np.packbits(bits.astype(np.uint8), bitorder="little")
    out = np.zeros(len(bits) // 64 + 2, dtype=np.uint64)
    out.view(np.uint8)[: len(packed)] = packed
    return out


class EliasFano:
    """A sequence that never falls, of whole numbers from 0 on."""

    def __init__(self, size: int, width: int, low: Array, high: Array, ranks: Array):
        self.size, self.width, self.low, self.high, self.ranks = size, width, low, high, ranks
        #: Zeros before each word; the ones are stored.
        self.zeros = 64 * np.arange(len(ranks), dtype=np.int64) - ranks

    @classmethod
    def build(cls, values: Array) -> EliasFano:
        n = len(values)
        most = int(values[-1]) if n else 0
        width = max(0, (max(1, most) // max(1, n)).bit_length() - 1)
        ones = (values >> width) + np.arange(n)
        bits = np.zeros((most >> width) + n + 2, dtype=np.uint8)
        bits[ones] = 1
        high = _words(bits)
        lows = np.empty((n, width), dtype=np.uint8)
        for bit in range(width):
            lows[:, bit] = (values >> bit) & 1
        low = _words(lows.ravel()) if width and n else np.zeros(2, np.uint64)
        counts = np.bitwise_count(high).astype(np.int64)
        return cls(n, width, low, high, np.r_[0, np.cumsum(counts)][:-1].astype(np.uint32).astype(np.int64))

    def arrays(self) -> list[Array]:
        return [np.array([self.size, self.width], dtype=np.int64), self.low, self.high, self.ranks.astype(np.uint32)]

    @classmethod
    def opened(cls, parts: list[Array]) -> EliasFano:
        (size, width), low, high, ranks = parts
        return cls(int(size), int(width), low, high, ranks.astype(np.int64))

    def _select(self, before: Array, k: Array, flip: bool) -> Array:
        """Place of the k-th one (zero if ``flip``), counted from 0."""
        word = np.searchsorted(before, k, side="right") - 1
        rest = (k - before[word]).astype(np.uint64)
        bits = ~self.high[word] if flip else self.high[word]
        # Ones up to and with each byte of a word, as the bytes of one number.
        upto = bits - ((bits >> _1) & _5S)
        upto = (upto & _3S) + ((upto >> _2) & _3S)
        upto = (((upto + (upto >> _4)) & _FS) * _ONES).astype(np.uint64)
        # Bytes that end before the wanted one: their count is not above ``rest``.
        at = np.bitwise_count((((rest * _ONES) | _TOPS) - upto) & _TOPS).astype(np.uint64)
        rest = rest - np.where(at > 0, (upto >> (np.maximum(at, _1) * _8 - _8)) & _BYTE, _0)
        octet = (bits >> (at * _8)) & _BYTE
        return 64 * word + 8 * at.astype(np.int64) + _PLACE[octet.astype(np.int64), rest.astype(np.int64)]

    def lows(self, index: Array) -> Array:
        if not self.width:
            return np.zeros(len(index), dtype=np.int64)
        bit = index * self.width
        word, off = bit >> 6, (bit & 63).astype(np.uint64)
        up = np.where(off > 0, self.low[word + 1] << ((np.uint64(64) - off) & np.uint64(63)), np.uint64(0))
        return (((self.low[word] >> off) | up) & np.uint64((1 << self.width) - 1)).astype(np.int64)

    def get(self, index: Array) -> Array:
        """Values at the places ``index``."""
        if not len(index):
            return np.zeros(0, dtype=np.int64)
        return ((self._select(self.ranks, index, False) - index) << self.width) | self.lows(index)

    def successor(self, value: Array) -> Array:
        """First place whose value is at least each ``value``; ``size`` if there is none."""
        if not self.size or not len(value):
            return np.full(len(value), self.size)
        last = int(self.get(np.array([self.size - 1]))[0])
        inside = np.clip(value, 0, last)
        bucket, low = inside >> self.width, inside & ((1 << self.width) - 1)
        a = np.where(bucket > 0, self._select(self.zeros, np.maximum(bucket, 1) - 1, True) - bucket + 1, 0)
        b = self._select(self.zeros, bucket, True) - bucket
        while (open_ := a < b).any():
            mid = np.where(open_, (a + b) >> 1, 0)
            less = self.lows(mid) < low
            a, b = np.where(open_ & less, mid + 1, a), np.where(open_ & ~less, mid, b)
        return np.where(value > last, self.size, a)


class Trie:
    """Sequences of equal length as levels of nodes, with a quantised number at every leaf."""

    def __init__(self, levels: list[tuple[EliasFano, EliasFano | None]], codes: Array, counts: Array):
        self.levels, self.codes, self.counts = levels, codes, counts

    @classmethod
    def build(cls, columns: Sequence[Array], codes: Array, counts: Array) -> Trie:
        """From distinct rows in lexical order, one column per level."""
        n = len(columns[0])
        new = np.zeros(n, dtype=bool)
        new[:1] = True
        parents = np.zeros(n, dtype=np.int64)
        levels: list[tuple[EliasFano, EliasFano | None]] = []
        for column in columns:
            new[1:] |= column[1:] != column[:-1]
            nodes = np.flatnonzero(new)
            owner, ids = parents[nodes], column[nodes]
            begins = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]]) if len(nodes) else nodes
            ends = np.r_[begins[1:], len(nodes)] - 1 if len(nodes) else nodes
            # Each parent's words start where those of the one before it end.
            spans = np.cumsum(ids[ends] + 1)
            raised = ids + np.repeat(np.r_[0, spans][:-1], np.diff(np.r_[begins, len(nodes)])) if len(nodes) else ids
            levels.append((EliasFano.build(raised), EliasFano.build(np.r_[begins, len(nodes)])))
            parents = np.cumsum(new) - 1
        return cls(levels, codes, counts)

    def find(self, columns: Sequence[Array]) -> Array:
        """Leaf of each row; -1 where the trie lacks it."""
        n = len(columns[0])
        node = np.zeros(n, dtype=np.int64)
        found = np.ones(n, dtype=bool)
        for (values, pointers), column in zip(self.levels, columns, strict=True):
            if not values.size:
                return np.full(n, -1)
            at = np.flatnonzero(found)
            # Rows in a row often share their context or even the node: each is looked up once per run.
            asked, owner = column[at], node[at]
            run = np.ones(len(at), dtype=bool)
            run[1:] = owner[1:] != owner[:-1]
            begins = np.flatnonzero(run)
            parent = owner[begins]
            begin, end = pointers.get(parent), pointers.get(parent + 1)
            base = np.where(begin > 0, values.get(np.maximum(begin, 1) - 1) + 1, 0)
            context = np.cumsum(run) - 1
            run[1:] |= asked[1:] != asked[:-1]
            heads = np.flatnonzero(run)
            context = context[heads]
            wanted = base[context] + asked[heads]
            place = values.successor(wanted)
            hit = place < end[context]
            hit[hit] = values.get(place[hit]) == wanted[hit]
            size = np.diff(np.r_[heads, len(at)])
            found[at] = np.repeat(hit, size)
            node[at] = np.repeat(place, size)
        return np.where(found, node, -1)

    def mapped(self) -> Trie:
        """The same trie over one memory-mapped buffer outside Python's heap, read in place."""
        arrays = [a for level in self.levels for ef in level for a in ef.arrays()] + [self.codes, self.counts]
        sizes = [-(-a.nbytes // 8) * 8 for a in arrays]
        memory = mmap.mmap(-1, max(8, sum(sizes)))
        views, at = [], 0
        for array, size in zip(arrays, sizes, strict=True):
            memory[at : at + array.nbytes] = array.tobytes()
            views.append(np.frombuffer(memory, dtype=array.dtype, count=len(array), offset=at))
            at += size
        pairs = [EliasFano.opened(views[i : i + 4]) for i in range(0, 8 * len(self.levels), 4)]
        return Trie(list(zip(pairs[::2], pairs[1::2], strict=True)), views[-2], views[-1])
