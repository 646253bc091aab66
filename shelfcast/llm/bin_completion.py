"""Bin completion on a histogram of sizes: which sizes share a bin, and how often.

Bins are built around the largest size left. Its fillings are enumerated, dominated ones dropped, and the rest tried in
order of waste. A dive that cannot beat the incumbent within the waste that is left to it is cut. The first incumbent
is the best-fit packing. Because equal sizes are interchangeable the search works on counts: its cost depends on the
capacity, not on the number of documents.
"""

from __future__ import annotations

from collections.abc import Mapping
from itertools import combinations

Pattern = tuple[tuple[int, ...], int]


class _Counts:
    """Counts by size, with the largest size up to a bound in a few operations."""

    def __init__(self, counts: Mapping[int, int]):
        self.of = {s: c for s, c in counts.items() if c > 0}
        self.mask = sum(1 << s for s in self.of)

    def top(self, most: int) -> int:
        """The largest size of at most ``most``, 0 if there is none."""
        return max(0, (self.mask & ((1 << (most + 1)) - 1)).bit_length() - 1) if most > 0 else 0

    def add(self, size: int, n: int) -> None:
        left = self.of.get(size, 0) + n
        if left:
            self.of[size] = left
            self.mask |= 1 << size
        else:
            self.of.pop(size, None)
            self.mask &= ~(1 << size)


def lower_bound(counts: Mapping[int, int], capacity: int) -> int:
    """Martello and Toth's L2: items over half the capacity stand alone and have only so much room for the others."""
    total = sum(s * c for s, c in counts.items())
    best = -(-total // capacity)
    for k in sorted({0, *(s for s in counts if 2 * s <= capacity)}):
        large = sum(c for s, c in counts.items() if s > capacity - k)
        middle = [(s, c) for s, c in counts.items() if capacity >= 2 * s > 0 and s >= k]
        half = [(s, c) for s, c in counts.items() if 2 * s > capacity and s <= capacity - k]
        room = sum((capacity - s) * c for s, c in half)
        rest = sum(s * c for s, c in middle) - room
        best = max(best, large + sum(c for _, c in half) + max(0, -(-rest // capacity)))
    return best


def _largest_sets(counts: _Counts, room: int, n: int, most: int, floor: int) -> list[tuple[int, ...]]:
    """Sets of ``n`` sizes, each at most ``most``, with the largest totals up to ``room``; totals over ``floor`` only."""
    if n == 1:
        s = counts.top(min(room, most))
        return [(s,)] if s > floor else []
    found: list[tuple[int, ...]] = []
    a = counts.top(min(room - n + 1, most))
    while a and a * n > floor:
        counts.add(a, -1)
        for rest in _largest_sets(counts, room - a, n - 1, a, max(0, floor - a)):
            total = a + sum(rest)
            if total > floor:
                found, floor = [(a, *rest)], total
            elif total == floor:
                found.append((a, *rest))
        counts.add(a, 1)
        if floor == room:
            break
        a = counts.top(a - 1)
    return found


def dominates(a: tuple[int, ...], b: tuple[int, ...]) -> bool:
    """Whether the parts of ``b`` fit into the parts of ``a``: then ``a`` is never the worse filling."""
    if not b:
        return True
    if sum(a) < sum(b) or max(a, default=0) < max(b):
        return False
    first, rest = b[0], b[1:]
    return any(
        dominates(tuple(sorted((*a[:i], x - first, *a[i + 1 :]), reverse=True)), rest)
        for i, x in enumerate(a)
        if x >= first
    )


def fillings(counts: _Counts, room: int, width: int, parts: int) -> list[tuple[int, ...]]:
    """Undominated fillings of ``room`` from at most ``parts`` sizes, fullest first; an empty one if nothing fits."""
    if not counts.top(room):
        return [()]
    found: list[tuple[int, ...]] = []
    best = 0
    for n in range(1, parts + 1):
        sets = _largest_sets(counts, room, n, room, best)[:width]
        if sets:
            found, best = [*sets, *found], sum(sets[0])
        if best == room:
            break
    # What still fits beside the last part goes in as well.
    grown = []
    for one in dict.fromkeys(found):
        used = list(one)
        for s in used:
            counts.add(s, -1)
        left = room - sum(used)
        while s := counts.top(left):
            used.append(s)
            left -= s
            counts.add(s, -1)
        for s in used:
            counts.add(s, 1)
        grown.append(tuple(sorted(used, reverse=True)))
    grown = list(dict.fromkeys(grown))
    for a, b in combinations(list(grown), 2):
        if a in grown and b in grown:
            if dominates(a, b):
                grown.remove(b)
            elif dominates(b, a):
                grown.remove(a)
    return sorted(grown, key=lambda f: (-sum(f), len(f)))[:width]


def best_fit(counts: Mapping[int, int], capacity: int) -> list[Pattern]:
    """Largest size first, each bin filled with the largest size that still fits."""
    left, out = _Counts(counts), []
    while size := left.top(capacity):
        bin_: list[int] = []
        room = capacity
        while s := left.top(room):
            bin_.append(s)
            room -= s
            left.add(s, -1)
        for s in bin_:
            left.add(s, 1)
        out.append((tuple(bin_), _often(left, bin_)))
        for s in bin_:
            left.add(s, -out[-1][1])
    return out


def _often(counts: _Counts, bin_: list[int] | tuple[int, ...]) -> int:
    return min(counts.of[s] // bin_.count(s) for s in set(bin_))


def bins(patterns: list[Pattern]) -> int:
    return sum(m for _, m in patterns)


def complete(
    counts: Mapping[int, int], capacity: int, width: int = 4, parts: int = 3, nodes: int = 3_000
) -> list[Pattern]:
    """Patterns (sizes of a bin, number of such bins) that use every item once.

    ``width`` fillings are tried per bin, of up to ``parts`` chosen parts each, and ``nodes`` bins are built in all
    before the incumbent is returned. All items are packed in any case.
    """
    if any(s < 1 or s > capacity for s, c in counts.items() if c):
        raise ValueError("sizes must lie between 1 and the capacity")
    total = sum(s * c for s, c in counts.items())
    incumbent = best_fit(counts, capacity)
    bound = lower_bound(counts, capacity)
    left = _Counts(counts)
    path: list[tuple[Pattern, int]] = []  # the pattern taken and the waste before it
    choices: list[list[tuple[int, ...]]] = []
    waste = 0
    while nodes > 0 and bins(incumbent) > bound:
        nodes -= 1
        size = left.top(capacity)
        allowed = (bins(incumbent) - 1) * capacity - total
        if not size:
            if bins([p for p, _ in path]) < bins(incumbent):
                incumbent = [p for p, _ in path]
            options: list[tuple[int, ...]] = []
        elif waste > allowed:
            options = []
        else:
            left.add(size, -1)
            options = [(size, *f) for f in fillings(left, capacity - size, width, parts)]
            left.add(size, 1)
        choices.append(options)
        while choices and not choices[-1]:  # go back to the last bin with another filling
            choices.pop()
            if path:
                (bin_, often), waste = path.pop()
                for s in bin_:
                    left.add(s, often)
        if not choices:
            break
        bin_ = choices[-1].pop(0)
        often = _often(left, bin_)
        path.append(((bin_, often), waste))
        waste += often * (capacity - sum(bin_))
        for s in bin_:
            left.add(s, -often)
    return incumbent
