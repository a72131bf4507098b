"""Bin packing on a histogram of sizes: dominance reduction, best fit, and slots for items.

A histogram has at most ``capacity`` sizes, and every step of both methods empties a size or
a group of bins, so the work and the plan are bounded by the capacity, whatever the number
of items.
"""

from __future__ import annotations

from bisect import bisect_right
from dataclasses import dataclass, field

import numpy as np

Pattern = tuple[int, ...]


class SegmentTree:
    """Which residual capacities have bins; finds the least one that is large enough."""

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.tree = np.zeros(2 * self.leaves, dtype=bool)

    def set(self, residual: int, present: bool) -> None:
        k = residual + self.leaves
        self.tree[k] = present
        while k > 1:
            k //= 2
            self.tree[k] = self.tree[2 * k] or self.tree[2 * k + 1]

    def at_least(self, size: int) -> int | None:
        k = size + self.leaves
        if self.tree[k]:
            return size
        while k > 1:  # climb until a subtree to the right has bins, then go down to its left end
            if k % 2 == 0 and self.tree[k + 1]:
                k += 1
                while k < self.leaves:
                    k = 2 * k if self.tree[2 * k] else 2 * k + 1
                return k - self.leaves
            k //= 2
        return None


@dataclass
class Packing:
    """Bins by pattern: ``bins`` has (sizes in a bin, number of such bins)."""

    capacity: int
    bins: list[tuple[Pattern, int]] = field(default_factory=list)

    def add(self, sizes: Pattern, count: int) -> None:
        if count:
            self.bins.append((sizes, count))

    @property
    def total(self) -> int:
        return sum(n for _, n in self.bins)


def reduce_dominated(left: dict[int, int], capacity: int) -> Packing:
    """Fix bins that dominate every other bin with their largest item (Martello and Toth).

    A set of items dominates another one if it can be cut into groups that fit, one each,
    under items of the first; then some optimal packing contains the first set.  With an item
    ``j`` and the largest item ``i`` beside which it fits, these sets are fixed:

    * ``{j}`` if nothing fits beside it;
    * ``{j, i}`` if they fill the bin, or no two items fit beside ``j``, or any two that do
      (and no three do) are together no larger than ``i``;
    * ``{j, i, b}`` if no three items fit beside ``j``, ``b`` is the largest that fits beside
      both, and of any two that fit beside ``j`` the smaller one is no larger than ``b``.

    Counts in ``left`` shrink by what is fixed.  Each fixing is repeated while its items last:
    taking items away keeps the conditions true.
    """
    out = Packing(capacity)

    def take(*sizes: int) -> None:
        need: dict[int, int] = {}
        for s in sizes:
            need[s] = need.get(s, 0) + 1
        times = min(left[s] // k for s, k in need.items())
        out.add(tuple(sorted(sizes, reverse=True)), times)
        for s, k in need.items():
            left[s] -= k * times
            if not left[s]:
                del left[s]

    for j in sorted(left, reverse=True):  # full bins are optimal wherever they occur
        rest = capacity - j
        if not rest and j in left:
            take(j)
        elif j in left and left.get(rest, 0) >= (2 if rest == j else 1):
            take(j, rest)
    changed = True
    while changed:
        changed = False
        for j in sorted(left, reverse=True):
            while j in left and (sizes := _dominating(left, j, capacity - j)):
                take(*sizes)
                changed = True
    return out


def _dominating(left: dict[int, int], j: int, room: int) -> Pattern | None:
    sizes = sorted(left)
    count = lambda s: left.get(s, 0) - (s == j)  # noqa: E731  items beside j
    beside = [s for s in sizes[: bisect_right(sizes, room)] if count(s) > 0]
    if not beside:
        return (j,)
    smallest = [s for s in beside[:3] for _ in range(min(count(s), 3))][:3]
    i = beside[-1]
    if i == room or len(smallest) < 2 or smallest[0] + smallest[1] > room:
        return (j, i)
    if len(smallest) == 3 and sum(smallest) <= room:
        return None
    best_sum, best_low = 0, 0
    for x in beside:  # x is the smaller of the two
        y = next((s for s in reversed(beside[: bisect_right(beside, room - x)]) if s > x or s == x and count(x) > 1), None)
        if y is not None and y >= x:
            best_sum, best_low = max(best_sum, x + y), max(best_low, x)
    if best_sum <= i:
        return (j, i)
    b = next((s for s in reversed(beside[: bisect_right(beside, room - i)]) if s != i or count(i) > 1), None)
    return (j, i, b) if b is not None and best_low <= b else None


def best_fit_decreasing(left: dict[int, int], capacity: int) -> Packing:
    """Largest items first, each into the fullest bin that has room for it.

    Items of a size and bins of a residual capacity are handled together: the fullest bin
    with room stays the fullest until it has no more room for that size.
    """
    tree = SegmentTree(capacity)
    open_: dict[int, list[tuple[Pattern, int]]] = {}

    def put(residual: int, pattern: Pattern, count: int) -> None:
        if count:
            if residual not in open_:
                open_[residual] = []
                tree.set(residual, True)
            open_[residual].append((pattern, count))

    def fill(residual: int, pattern: Pattern, bins: int, size: int, items: int) -> int:
        """Put items into bins of one kind; the items that are left."""
        each = residual // size
        full = min(bins, items // each)
        put(residual - each * size, pattern + (size,) * each, full)
        bins, items = bins - full, items - full * each
        if bins and items:
            put(residual - items * size, pattern + (size,) * items, 1)
            bins, items = bins - 1, 0
        put(residual, pattern, bins)
        return items

    for size in sorted(left, reverse=True):
        items = left[size]
        while items:
            residual = tree.at_least(size)
            if residual is None:
                items = fill(capacity, (), -(-items // (capacity // size)), size, items)
                continue
            groups = open_.pop(residual)
            tree.set(residual, False)
            while groups and items:
                pattern, bins = groups.pop()
                items = fill(residual, pattern, bins, size, items)
            for pattern, bins in groups:
                put(residual, pattern, bins)
    out = Packing(capacity)
    for groups in open_.values():
        for pattern, bins in groups:
            out.add(pattern, bins)
    return out


def pack_histogram(sizes: dict[int, int], capacity: int, *, reduce: bool = True) -> Packing:
    """Pack all items: fix dominating bins if asked, then best fit for the remainder."""
    if any(not 0 < s <= capacity for s in sizes):
        raise ValueError("sizes must lie between 1 and the capacity")
    left = {s: n for s, n in sizes.items() if n}
    fixed = reduce_dominated(left, capacity) if reduce else Packing(capacity)
    rest = best_fit_decreasing(left, capacity)
    return Packing(capacity, fixed.bins + rest.bins)


def lower_bound(sizes: dict[int, int], capacity: int) -> int:
    """Bins that any packing needs (Martello and Toth's L2)."""
    best = 0
    for k in range(capacity // 2 + 1):
        alone = sum(n for s, n in sizes.items() if s > capacity - k)
        large = [(s, n) for s, n in sizes.items() if capacity / 2 < s <= capacity - k]
        small = sum(s * n for s, n in sizes.items() if k <= s <= capacity / 2)
        free = sum((capacity - s) * n for s, n in large)
        best = max(best, alone + sum(n for _, n in large) + max(0, -(-(small - free) // capacity)))
    return best


class Slots:
    """Where the r-th item of each size goes: bin number and offset, by binary search."""

    RANK_BITS = 44

    def __init__(self, packing: Packing):
        rows, first_bin, used = [], 0, {}
        for sizes, bins in packing.bins:
            at = 0
            for s in sorted(set(sizes), reverse=True):
                k = sizes.count(s)
                rank = used.get(s, 0)
                rows.append(((s << self.RANK_BITS) | rank, rank, k, first_bin, at))
                used[s], at = rank + k * bins, at + k * s
            first_bin += bins
        rows.sort()
        table = np.array(rows, np.int64).reshape(-1, 5)
        self.key, self.rank, self.each, self.first_bin, self.at = np.ascontiguousarray(table.T)

    def find(self, size: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        k = np.searchsorted(self.key, (size << self.RANK_BITS) | rank, side="right") - 1
        nth, place = np.divmod(rank - self.rank[k], self.each[k])
        return self.first_bin[k] + nth, self.at[k] + place * size
