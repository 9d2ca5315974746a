"""Suffix sorting by linear grouping, in pure Python over whole-number symbols.

First, suffixes are grouped by their Lyndon prefix: they start out grouped by first symbol, and
groups are processed from the highest to the lowest. A suffix's pointer leads to the nearest earlier
suffix of a lower group; every suffix that is pointed to has its prefix extended by the processed
group's, as often as it is pointed to, and so moves to a new group right above its old one. Then the
suffix array is filled from the lowest suffix on: each placed suffix gives its predecessor the next
place in the predecessor's group, and so on along the pointers. Nothing is renamed or sorted again.
"""

from __future__ import annotations

from collections.abc import Sequence


def lyndon_groups(text: Sequence[int]) -> tuple[list[int], list[int], list[int]]:
    """Group of each suffix, the groups in ascending order, and the pointers; -1 points nowhere."""
    members: dict[int, list[int]] = {}
    for i, symbol in enumerate(text):
        members.setdefault(symbol, []).append(i)
    ranked = sorted(members)
    number = {symbol: k for k, symbol in enumerate(ranked)}
    group = [number[symbol] for symbol in text]
    rows = [members[symbol] for symbol in ranked]
    size = [len(row) for row in rows]
    below = [k - 1 for k in range(len(rows))]
    above: list[int] = [k + 1 for k in range(len(rows))]
    above[-1] = -1
    pointer = [-1] * len(text)
    done = [False] * len(text)
    at = len(rows) - 1
    while at >= 0:
        row = rows[at]
        if len(row) > size[at]:
            row = rows[at] = [i for i in row if group[i] == at]
        # a group's suffixes in order of position have pointers in order, so equal ones are together
        targets: list[int] = []
        times: list[int] = []
        last = -1
        for i in row:
            done[i] = True
            j = i - 1
            while j >= 0 and done[j]:
                j = pointer[j]
            pointer[i] = j
            if j >= 0:
                if j == last:
                    times[-1] += 1
                else:
                    targets.append(j)
                    times.append(1)
                    last = j
        if targets:
            if len(targets) == 1:
                batches = [targets]
            else:
                by_times: dict[int, list[int]] = {}
                for j, count in zip(targets, times, strict=True):
                    by_times.setdefault(count, []).append(j)
                batches = [by_times[count] for count in sorted(by_times, reverse=True)]
            for batch in batches:
                moved: dict[int, list[int]] = {}
                for j in batch:
                    moved.setdefault(group[j], []).append(j)
                for old, row in moved.items():
                    if len(row) == size[old]:
                        continue  # the whole group moves: it stays where it is
                    new = len(rows)
                    rows.append(row)
                    size.append(len(row))
                    size[old] -= len(row)
                    for j in row:
                        group[j] = new
                    higher = above[old]
                    below.append(old)
                    above.append(higher)
                    above[old] = new
                    below[higher] = new
        at = below[at]
    order, at = [], 0
    while below[at] >= 0:
        at = below[at]
    while at >= 0:
        order.append(at)
        at = above[at]
    return group, order, pointer


def suffix_array(symbols: Sequence[int]) -> list[int]:
    """Starts of all suffixes in ascending order. Symbols are whole numbers above zero."""
    text = [*symbols, 0]
    group, order, pointer = lyndon_groups(text)
    sizes = [0] * len(order)
    for g in group:
        sizes[g] += 1
    place, total = [0] * len(order), 0
    for g in order:
        place[g] = total
        total += sizes[g]
    array, placed = [-1] * len(text), [False] * len(text)
    array[0] = len(text) - 1
    placed[-1] = True
    for k in range(len(text)):
        j = array[k] - 1
        while j >= 0 and not placed[j]:
            g = group[j]
            array[place[g]] = j
            place[g] += 1
            placed[j] = True
            j = pointer[j]
    return array[1:]
