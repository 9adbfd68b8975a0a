"""Linear suffix sorting by grouping: suffix groups share a Lyndon prefix, and no symbol is ever renamed.

First, suffixes are gathered by their first symbol. Groups are processed from the highest down: every member looks for the
nearest earlier suffix in a lower group (its previous-smaller pointer), and the suffixes pointed at move into new
groups right above their old ones, the more pointers they got the higher. In the end a group holds the
suffixes with one Lyndon prefix, and the groups are in order. Second, one pass over the growing suffix array emits the
order within the groups along the same pointers.
"""

from __future__ import annotations

import numpy as np


def lyndon_groups(symbols: np.ndarray) -> tuple[list[int], list[int]]:
    """Start of each suffix's group in the suffix array, and its previous-smaller pointer (-1: none)."""
    n = len(symbols)
    order = np.argsort(symbols, kind="stable")
    edge = np.flatnonzero(np.diff(symbols[order])) + 1
    starts = np.r_[0, edge]
    sizes = np.diff(np.r_[starts, n])
    group_of = np.empty(n, dtype=np.int64)
    group_of[order] = np.repeat(starts, sizes)
    place_of = np.empty(n, dtype=np.int64)
    place_of[order] = np.arange(n)
    size_of = np.zeros(n, dtype=np.int64)
    size_of[starts] = sizes
    suffixes, place, group, size = order.tolist(), place_of.tolist(), group_of.tolist(), size_of.tolist()
    before = [-1] * n
    high = n
    while high > 0:
        low = group[suffixes[high - 1]]
        if high - low == 1:
            i = suffixes[low]
            p = i - 1
            while p >= 0 and group[p] >= low:
                p = before[p]
            before[i] = p
            if p >= 0 and size[group[p]] > 1:
                old = group[p]
                end = old + size[old] - 1
                at, other = place[p], suffixes[end]
                suffixes[at], place[other] = other, at
                suffixes[end], place[p] = p, end
                size[old] -= 1
                size[end] = 1
                group[p] = end
            high = low
            continue
        pointed: dict[int, int] = {}
        for i in sorted(suffixes[low:high]):
            p = i - 1
            while p >= 0 and group[p] >= low:
                p = before[p]
            before[i] = p
            if p >= 0:
                pointed[p] = pointed.get(p, 0) + 1
        high = low
        if not pointed:
            continue
        by_count: dict[int, dict[int, list[int]]] = {}
        for p, count in pointed.items():
            by_count.setdefault(count, {}).setdefault(group[p], []).append(p)
        for count in sorted(by_count, reverse=True):
            for old, moved in by_count[count].items():
                whole = size[old]
                if len(moved) == whole:
                    continue
                end = old + whole
                for p in moved:
                    end -= 1
                    at, other = place[p], suffixes[end]
                    suffixes[at], place[other] = other, at
                    suffixes[end], place[p] = p, end
                    group[p] = -1
                for p in moved:
                    group[p] = end
                size[old] = whole - len(moved)
                size[end] = len(moved)
    return group, before


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """Suffix array of whole numbers of which the last is smaller than all others."""
    n = len(symbols)
    if n == 0:
        return np.zeros(0, dtype=np.int64)
    group, before = lyndon_groups(symbols)
    free = list(range(n))  # next free place of the group that starts here
    out = [-1] * n
    done = bytearray(n)
    out[0] = n - 1
    done[n - 1] = 1
    for i in range(n):
        j = out[i] - 1
        while j >= 0 and not done[j]:
            start = group[j]
            out[free[start]] = j
            free[start] += 1
            done[j] = 1
            j = before[j]
    return np.array(out)
