"""Linear-time suffix sorting by grouping (Lyndon prefixes).

First the suffixes are grouped by their Lyndon prefix: groups start as the symbols and
are taken from the highest to the lowest. Each suffix of the group at hand finds its
previous smaller suffix, the nearest one to its left in a lower group, by following the
pointers found before; suffixes that were pointed at leave their group for a new one
right above it, the more pointers from this group the higher. Then the suffix array is
written from left to right: the suffix before the one just read takes the first free
place of its group, and so do the suffixes down its chain of pointers until one is
placed already. Nothing is renamed and nothing recurses.
"""

from __future__ import annotations

from itertools import groupby
from typing import Sequence


def suffix_array(text: Sequence[int]) -> list[int]:
    """Start positions of all suffixes in ascending order. The last symbol must be
    smaller than all others."""
    n = len(text)
    by_symbol = sorted(range(n), key=text.__getitem__)
    place = [0] * n                      # where a suffix stands in ``by_symbol``
    group = [0] * n                      # where its group begins there
    begin = 0
    for i, s in enumerate(by_symbol):
        if i and text[s] != text[by_symbol[i - 1]]:
            begin = i
        place[s], group[s] = i, begin
    smaller = [-1] * n                   # previous smaller suffix
    size = {}
    for s in by_symbol:
        size[group[s]] = size.get(group[s], 0) + 1

    end = n
    while end > 0:
        g = group[by_symbol[end - 1]]
        if end - g == 1:
            s = by_symbol[g]
            p = s - 1
            while p >= 0 and group[p] >= g:
                p = smaller[p]
            smaller[s] = p
            votes = {p: 1} if p >= 0 else {}
        else:
            votes = {}
            for s in sorted(by_symbol[g:end]):
                p = s - 1
                while p >= 0 and group[p] >= g:
                    p = smaller[p]
                smaller[s] = p
                if p >= 0:
                    votes[p] = votes.get(p, 0) + 1
        if len(votes) == 1:
            moves = [list(votes)]
        else:
            rank = lambda p: (-votes[p], group[p])                        # noqa: E731
            moves = [list(same) for _, same in groupby(sorted(votes, key=rank), rank)]
        for same in moves:
            h = group[same[0]]
            left = size[h] - len(same)
            if not left:
                continue                 # the whole group moves: it stays where it is
            at = h + left
            free = at
            for p in same:               # to the back of the group
                i, q = place[p], by_symbol[free]
                if i < at:
                    while q in votes and group[q] == h and votes[q] == votes[p]:
                        free += 1
                        q = by_symbol[free]
                    by_symbol[i], by_symbol[free] = q, p
                    place[q], place[p] = i, free
                    free += 1
            for p in same:
                group[p] = at
            size[h], size[at] = left, len(same)
        end = g

    out = [-1] * n
    out[0] = n - 1
    placed = [False] * n
    placed[n - 1] = True
    free_at = group[:]                   # indexed by group start: the next free place
    for g in size:
        free_at[g] = g
    for i in range(n):
        j = out[i] - 1
        while j >= 0 and not placed[j]:
            g = group[j]
            out[free_at[g]] = j
            free_at[g] += 1
            placed[j] = True
            j = smaller[j]
    return out



def repeated_windows(texts: Sequence[bytes], width: int) -> list[list[tuple[int, int]]]:
    """Groups of equal ``width``-byte strings that occur more than once in the texts, each
    a list of (text, start)."""
    m = len(texts)
    symbols: list[int] = []
    owner, start, room = [], [], []
    for k, t in enumerate(texts):
        symbols.extend([b + m for b in t])
        symbols.append(m - 1 - k)        # a separator of its own; the last one is the smallest
        n = len(t)
        owner.extend([k] * (n + 1))
        start.extend(range(n + 1))
        room.extend(range(n, -1, -1))
    groups: list[list[tuple[int, int]]] = []
    last, current = None, []
    for s in suffix_array(symbols):
        if room[s] < width:
            continue
        k, i = owner[s], start[s]
        window = texts[k][i:i + width]
        if window != last:
            if len(current) > 1:
                groups.append(current)
            last, current = window, []
        current.append((k, i))
    if len(current) > 1:
        groups.append(current)
    return groups
