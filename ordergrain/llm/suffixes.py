"""Suffix array of a sequence of numbers by linear grouping."""

from __future__ import annotations

import numpy as np


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """Starts of all suffixes in ascending order; the end counts as smaller than any symbol.

    First phase: suffixes are grouped by their longest Lyndon prefix. To begin with a group holds
    the suffixes with one first symbol. The groups are taken in descending order. For every suffix
    of the group, the nearest earlier suffix of a lower group (the previous-smaller pointer) has its
    prefix followed by this group's; those followed by it k times leave their group for a new one
    just above it, so that more repetitions come higher. Suffixes already taken are skipped over by
    compressed pointers.

    Second phase: a suffix is its group's prefix followed by a smaller suffix, which is already
    in place when the order is read from the front. Every suffix read puts those that end in it at
    the next free place of their groups.
    """
    size = len(symbols)
    if not size:
        return np.zeros(0, dtype=np.int64)
    order = np.argsort(symbols, kind="stable")
    ranked = symbols[order]
    edges = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1], [True]]))
    starts = order.tolist()
    members = [starts[a:b] for a, b in zip(edges[:-1].tolist(), edges[1:].tolist())]
    first_group = np.empty(size, dtype=np.int64)
    first_group[order] = np.repeat(np.arange(len(members)), np.diff(edges))
    group = first_group.tolist()
    below, above = list(range(-1, len(members) - 1)), list(range(1, len(members) + 1))
    prefix = [1] * len(members)  # length of the group's Lyndon prefix
    skip = list(range(-1, size))  # skip[i + 1] is i, or an index further left once i is taken
    sequence = []  # groups from the highest to the lowest
    at = len(members) - 1
    while at >= 0:
        members[at] = own = [i for i in members[at] if group[i] == at]
        for i in own:
            skip[i + 1] = i - 1
        moves: dict[tuple[int, int], list[int]] = {}  # by how often the prefix follows, and old group
        followers: dict[int, int] = {}
        for i in own:
            j = i - 1
            while (k := skip[j + 1]) != j:
                skip[j + 1] = skip[k + 1]
                j = k
            if j < 0:
                continue
            if len(own) == 1:
                moves[-1, group[j]] = [j]
            else:
                followers[j] = followers.get(j, 0) + 1
        for j, times in followers.items():
            key = (-times, group[j])
            if key in moves:
                moves[key].append(j)
            else:
                moves[key] = [j]
        for less, old in sorted(moves) if len(moves) > 1 else moves:
            new, over = len(members), above[old]
            members.append(moves[less, old])
            prefix.append(prefix[old] - less * prefix[at])
            below.append(old)
            above.append(over)
            above[old] = below[over] = new
            for j in members[new]:
                group[j] = new
        if own:
            sequence.append(at)
        at = below[at]

    groups = np.array(group)
    ends = np.arange(size) + np.array(prefix)[groups]  # the smaller suffix that follows the prefix
    by_end = np.argsort(ends, kind="stable")
    first = np.searchsorted(ends[by_end], np.arange(size + 2)).tolist()
    by_end = by_end.tolist()
    free, place = [0] * len(members), 0
    for g in reversed(sequence):
        free[g] = place
        place += len(members[g])
    found = [0] * size
    read, at = size, 0
    while True:
        for i in by_end[first[read] : first[read + 1]]:
            g = group[i]
            found[free[g]] = i
            free[g] += 1
        if at == size:
            return np.array(found, dtype=np.int64)
        read = found[at]
        at += 1
