"""Suffix arrays by linear grouping: suffixes are grouped by their Lyndon prefixes, then put in order.

First all suffixes are grouped by their first symbol. Groups are visited in descending order; the
members of the visited group are final, and each of them extends the prefix of the nearest suffix to its
left that is still in a smaller group (its previous-smaller pointer). Extended suffixes leave their group
for a new one directly above it, one for each number of extensions. When all groups were visited, a
suffix's prefix is its longest Lyndon prefix. Then the order is emitted from the smallest suffix on: a
suffix that has got its place gives the next free place of its group to every suffix whose prefix ends
where it begins. Both passes are linear, and no names are given anew.
"""

from __future__ import annotations

from collections.abc import Sequence


def suffix_array(text: Sequence[int]) -> list[int]:
    """Starts of all suffixes in ascending order; the last symbol must be smaller than all others."""
    n = len(text)
    members: list[list[int]] = []
    width: list[int] = []
    below: list[int] = []
    above: list[int] = []
    group = [0] * n
    by_symbol: dict[int, list[int]] = {}
    for i, symbol in enumerate(text):
        if symbol in by_symbol:
            by_symbol[symbol].append(i)
        else:
            by_symbol[symbol] = [i]
    for g, symbol in enumerate(sorted(by_symbol)):
        members.append(by_symbol[symbol])
        width.append(1)
        below.append(g - 1)
        above.append(g + 1)
        for i in by_symbol[symbol]:
            group[i] = g
    top = len(members) - 1
    above[top] = -1

    final = [False] * n
    smaller = [-1] * n
    highest = visited = top
    while visited >= 0:
        here = [i for i in members[visited] if group[i] == visited]
        members[visited] = here
        extended: dict[tuple[int, int], list[int]] = {}
        last, times = -1, 0
        for i in here:
            j = i - 1
            while j >= 0 and final[j]:
                j = smaller[j]
            final[i] = True
            smaller[i] = j
            if j == last:
                times += 1
                continue
            if last >= 0:
                extended.setdefault((group[last], times), []).append(last)
            last, times = j, 1
        if last >= 0:
            extended.setdefault((group[last], times), []).append(last)
        # more extensions sort higher: put in last what belongs directly above the old group
        for old, times in sorted(extended, reverse=True) if len(extended) > 1 else extended:
            new = len(members)
            moved = extended[old, times]
            for j in moved:
                group[j] = new
            members.append(moved)
            width.append(width[old] + times * width[visited])
            up = above[old]
            below.append(old)
            above.append(up)
            above[old] = new
            if up >= 0:
                below[up] = new
            else:
                highest = new
        visited = below[visited]

    free = [0] * len(members)
    place, g = n, highest
    while g >= 0:
        place -= len(members[g])
        free[g] = place
        g = below[g]
    # suffixes whose prefix ends at each place, as linked lists
    first, after = [-1] * (n + 1), [-1] * n
    for i in range(n):
        end = i + width[group[i]]
        after[i] = first[end]
        first[end] = i
    order = [-1] * n
    end = n
    at = -1
    while True:
        i = first[end]
        while i >= 0:
            g = group[i]
            order[free[g]] = i
            free[g] += 1
            i = after[i]
        at += 1
        if at == n:
            return order
        end = order[at]
