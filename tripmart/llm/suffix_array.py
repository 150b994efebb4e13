"""Suffix array by the linear grouping construction, over any integer symbols."""

from __future__ import annotations

import numpy as np


def grouped(symbols: np.ndarray) -> tuple[list[int], list[int], list[int]]:
    """Group the suffixes by their longest Lyndon prefix.

    Returns the group of each suffix, the groups in ascending order, and each suffix's pointer to
    the previous suffix in a lower group (-1: none). Groups are processed from the highest to the
    lowest; the suffixes that members point to leave their groups for new ones just above, further up
    the more members point to them.
    """
    kinds, first = np.unique(symbols, return_inverse=True)
    group = first.tolist()
    n, top = len(group), len(kinds)
    by_kind = np.argsort(first, kind="stable")
    cuts = np.searchsorted(first[by_kind], np.arange(top + 1)).tolist()
    flat = by_kind.tolist()
    members = [flat[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
    below, above = list(range(-1, top - 1)), [*range(1, top), -1]
    previous, done, order = [-1] * n, [False] * n, []
    current = top - 1
    while current >= 0:
        own = sorted(s for s in members[current] if group[s] == current)
        members[current] = own
        pointed: dict[int, int] = {}
        for s in own:
            done[s] = True
            p = s - 1
            while p >= 0 and done[p]:
                p = previous[p]
            previous[s] = p
            if p >= 0:
                pointed[p] = pointed.get(p, 0) + 1
        if pointed:
            # suffixes of the same old group and the same number of pointers move together
            moved: dict[tuple[int, int], list[int]] = {}
            for p, times in pointed.items():
                moved.setdefault((times, group[p]), []).append(p)
            for (_, old), suffixes in sorted(moved.items(), reverse=True) if len(moved) > 1 else moved.items():
                new = len(members)
                members.append(suffixes)
                for p in suffixes:
                    group[p] = new
                over = above[old]
                below.append(old)
                above.append(over)
                above[old] = new
                below[over] = new  # an old group lies below the current one, so something is above it
        order.append(current)
        current = below[current]
    order.reverse()
    return group, [g for g in order if members[g]], previous


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """The starts of all suffixes in ascending order; a suffix comes before its extensions."""
    n = len(symbols)
    if n == 0:
        return np.zeros(0, np.int64)
    group, order, previous = grouped(np.asarray(symbols))
    sizes = np.bincount(group)
    free = np.zeros(len(sizes), np.int64)
    ascending = np.array(order)
    free[ascending] = np.cumsum(sizes[ascending]) - sizes[ascending]
    free = free.tolist()
    array, placed = [0] * n, [False] * n
    s, at = n - 1, 0
    while True:
        while s >= 0 and not placed[s]:
            g = group[s]
            array[free[g]] = s
            free[g] += 1
            placed[s] = True
            s = previous[s]
        if at == n:
            return np.array(array, np.int64)
        s = array[at] - 1
        at += 1
