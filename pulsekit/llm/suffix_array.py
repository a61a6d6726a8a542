"""Linear suffix sorting by grouping suffixes on their Lyndon prefixes.

Phase 1 refines an ordered partition of the suffixes. Groups are taken in
descending order; every suffix of the group finds its previous smaller suffix
by following the pointers already known, and the suffixes pointed at move right
behind their old group, those pointed at more often further back. No ranks are
recomputed recursively. Phase 2 reads the groups from the smallest suffix on:
each suffix found emits, along the previous-smaller pointers of its left
neighbour, the next free place of that neighbour's group.
"""

from __future__ import annotations


def suffix_array(text: list[int]) -> list[int]:
    """Suffix array of a list of non-negative ints. The end counts as smaller than any symbol."""
    n = len(text) + 1
    if n == 1:
        return []
    # initial groups: first symbol, the end (position n - 1) alone in the first group
    buckets: dict[int, list[int]] = {}
    for i, s in enumerate(text):
        buckets.setdefault(s, []).append(i)
    order = [n - 1]
    group = [0] * n          # start of the suffix's group in ``order``
    size = [0] * n           # members of the group that starts here
    size[0] = 1
    for s in sorted(buckets):
        at = len(order)
        for i in buckets[s]:
            group[i] = at
        size[at] = len(buckets[s])
        order.extend(buckets[s])
    place = [0] * n
    for p, i in enumerate(order):
        place[i] = p
    previous = [-1] * n

    end = n
    while end > 1:
        g = group[order[end - 1]]
        members = sorted(order[g:end])
        end = g
        count: dict[int, int] = {}
        for i in members:
            j = i - 1
            while j >= 0 and group[j] >= g:
                j = previous[j]
            previous[i] = j
            if j >= 0:
                count[j] = count.get(j, 0) + 1
        if not count:
            continue
        times: dict[int, list[int]] = {}
        for j, c in count.items():
            times.setdefault(c, []).append(j)
        for c in sorted(times, reverse=True):
            pointed = times[c]
            for j in pointed:  # to the end of the old group
                old = group[j]
                size[old] -= 1
                p, q = place[j], old + size[old]
                other = order[q]
                order[p], order[q] = other, j
                place[other], place[j] = p, q
            starts = {old: old + size[old] for old in {group[j] for j in pointed}}
            for j in pointed:
                new = starts[group[j]]
                group[j] = new
                size[new] += 1

    free = list(range(n))    # next free place of each group
    result = [-1] * n
    done = [False] * n
    result[0] = n - 1
    for r in range(n):
        j = result[r] - 1
        while j >= 0 and not done[j]:
            done[j] = True
            g = group[j]
            result[free[g]] = j
            free[g] += 1
            j = previous[j]
    return result[1:]
