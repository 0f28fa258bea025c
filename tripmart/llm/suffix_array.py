"""Suffix array by linear grouping.

Suffixes start in groups by their first byte. Groups are taken in descending order: the members'
nearest unprocessed positions to the left (previous-smaller pointers) are exactly the suffixes whose
Lyndon prefix goes on with the group's, so those that have most members point to them move to a
new group right above their old one, the next most after them, and so on. When all groups are done,
two suffixes share a group if they share their Lyndon prefix. The order within a group follows from
one scan over the growing array: a suffix sends the suffixes whose Lyndon prefix ends where it starts
to the front of their group. No group is renamed or sorted recursively; both passes are linear.
"""

from __future__ import annotations

import numpy as np


def suffix_array(text: bytes) -> list[int]:
    """Start positions of the suffixes of ``text`` in ascending order (the empty one left out)."""
    n = len(text)
    first: dict[int, list[int]] = {}
    for i, c in enumerate(text):
        if c in first:
            first[c].append(i)
        else:
            first[c] = [i]
    # Group 0 is the end mark, at position n. Groups form a list by above/below.
    members: list[list[int]] = [[n]]
    below, above = [-1], [-1]
    group = [0] * (n + 1)
    size = [1]
    names = {}
    for c in sorted(first):
        g = len(members)
        names[c] = g
        members.append(first[c])
        size.append(len(first[c]))
        below.append(g - 1)
        above.append(-1)
        above[g - 1] = g
    for i, c in enumerate(text):
        group[i] = names[c]
    left = list(range(-1, n))  # neighbours among unprocessed positions; -1: none, and never grouped
    right = list(range(1, n + 2))
    child, sibling = [-1] * (n + 1), [-1] * (n + 1)  # suffixes whose Lyndon prefix ends at a position

    g = len(members) - 1
    while g > 0:
        mine = members[g]
        if len(mine) != size[g]:
            mine = members[g] = [i for i in mine if group[i] == g]
        points: list[int] = []  # unprocessed positions that members point to, and by how many
        count: list[int] = []
        for i in mine:
            p = left[i]
            if p < 0:
                points.append(-1)
                count.append(1)
            elif group[p] == g:
                count[-1] += 1
            else:
                points.append(p)
                count.append(1)
        for i in mine:
            p, r = left[i], right[i]
            sibling[i] = child[r]
            child[r] = i
            left[r] = p
            if p >= 0:
                right[p] = r
        if points and points[0] < 0:
            del points[0], count[0]
        if points:
            if max(count) == 1:
                levels = [points]
            else:
                by_count: dict[int, list[int]] = {}
                for p, c in zip(points, count):
                    by_count.setdefault(c, []).append(p)
                levels = [by_count[c] for c in sorted(by_count, reverse=True)]
            for level in levels:
                by_group: dict[int, list[int]] = {}
                for p in level:
                    h = group[p]
                    if h in by_group:
                        by_group[h].append(p)
                    else:
                        by_group[h] = [p]
                for h, moved in by_group.items():
                    if len(moved) == size[h]:
                        continue
                    new, up = len(members), above[h]
                    members.append(moved)
                    size.append(len(moved))
                    size[h] -= len(moved)
                    below.append(h)
                    above.append(up)
                    above[h] = new
                    if up >= 0:
                        below[up] = new
                    for p in moved:
                        group[p] = new
        g = below[g]

    front = [0] * len(members)
    at, g = 0, 0
    while g >= 0:
        front[g] = at
        at += size[g]
        g = above[g]
    out = [0] * (n + 1)
    out[0] = n
    for s in out:
        j = child[s]
        while j >= 0:
            g = group[j]
            out[front[g]] = j
            front[g] += 1
            j = sibling[j]
    return out[1:]


def _ranges(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """All of start[i], ..., start[i] + size[i] - 1, one range after another."""
    return np.arange(int(size.sum())) + np.repeat(start - (np.cumsum(size) - size), size)


def suffix_arrays(text: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The suffix arrays of the strings text[at[i]:at[i + 1]], one after another, as positions in
    ``text``: all strings advance together, each with its own highest group left. A group is a range
    of the array ``place``, in the groups' order; members that split off move to the range's upper end."""
    lengths = np.diff(at)
    m, n = len(lengths), len(text)
    if not n:
        return np.zeros(0, dtype=np.int64)
    # Position p of string i is slot p + i + 1: every string has an end mark behind it, and the first
    # slot is a dummy, so that a string's first slot has a left neighbour of another group.
    total = n + m + 1
    of = np.repeat(np.arange(m), lengths)
    slot = np.arange(n) + of + 1
    ends = at[1:] + np.arange(m) + 1
    string = np.full(total, -1, dtype=np.int64)
    string[slot], string[ends] = of, np.arange(m)
    key = np.full(total, -1, dtype=np.int64)
    key[ends] = np.arange(m) * 257
    key[slot] = of * 257 + 1 + text
    place = np.argsort(key, kind="stable")[1:]  # slots by string and first byte
    sorted_key = key[place]
    start = np.flatnonzero(np.concatenate([[True], sorted_key[1:] != sorted_key[:-1]]))
    used = len(start)
    group_start, size = np.zeros(used + n, dtype=np.int64), np.zeros(used + n, dtype=np.int64)
    group_start[:used] = start
    size[:used] = np.diff(np.append(start, n + m))
    group = np.full(total, -1, dtype=np.int64)
    group[place] = np.repeat(np.arange(used), size[:used])
    where = np.zeros(total, dtype=np.int64)  # a slot's index in place
    where[place] = np.arange(n + m)
    left, right = np.arange(total) - 1, np.arange(total) + 1
    after = np.zeros(total, dtype=np.int64)  # where a slot's Lyndon prefix ends
    base = at[:-1] + np.arange(m)  # each string's part of place; its first entry is the end mark
    top = base + lengths  # index of the highest entry not processed yet
    while True:
        live = np.flatnonzero(top > base)
        if not len(live):
            break
        current = group[place[top[live]]]
        mine = np.sort(place[_ranges(group_start[current], size[current])])
        top[live] = group_start[current] - 1
        p, r, g = left[mine], right[mine], group[mine]
        after[mine] = r
        head = np.flatnonzero(group[p] != g)  # first of each run of members that are neighbours
        points, count = p[head], np.diff(np.append(head, len(mine)))
        r = r[np.append(head[1:], len(mine)) - 1]
        right[points], left[r] = r, points
        ok = string[points] == string[mine[head]]
        points, count = points[ok], count[ok]
        for c in (np.unique(count)[::-1].tolist() if len(points) else ()):
            level = points[count == c]
            level = level[np.argsort(group[level], kind="stable")]
            old = group[level]
            cut = np.flatnonzero(np.concatenate([[True], old[1:] != old[:-1]]))
            moved, old = np.diff(np.append(cut, len(level))), old[cut]
            part = moved < size[old]  # a group that moves as a whole stays what it is
            if not part.any():
                continue
            level = level[np.repeat(part, moved)]
            old, moved = old[part], moved[part]
            new = np.arange(used, used + len(old))
            used += len(old)
            size[old] -= moved
            size[new] = moved
            group_start[new] = group_start[old] + size[old]
            each = np.repeat(new, moved)
            group[level] = each
            upper = _ranges(group_start[new], moved)
            there = place[upper]
            leave = group[there] != each
            come = where[level] < np.repeat(group_start[new], moved)
            to, back = upper[leave], where[level[come]]
            place[to], where[level[come]] = level[come], to
            place[back], where[there[leave]] = there[leave], back

    # A slot sends the slots whose Lyndon prefix ends there to the front of their groups.
    front = group_start
    child = slot[np.argsort(after[slot], kind="stable")]
    first = np.searchsorted(after[child], np.arange(total + 1))
    out = np.zeros(n + m, dtype=np.int64)
    out[base] = ends
    live = np.arange(m)
    for t in range(int(lengths.max()) + 1):
        live = live[lengths[live] >= t]
        s = out[base[live] + t]
        j = child[_ranges(first[s], first[s + 1] - first[s])]
        g = group[j]
        out[front[g]] = j
        front[g] += 1
    keep = np.ones(n + m, dtype=bool)
    keep[base] = False
    out = out[keep]
    return out - string[out] - 1
