"""Signature trees: nodes with OR-combined token bitmaps and size ranges.

Sets are the leaves, ordered by size, then by bitmap. A node keeps its smallest and
largest set size, the OR of its bitmaps, and its slack: how many more tokens than bits a set
below it may have. Two sets of two nodes share at most the common bits plus the
smaller slack; if that is too little for the threshold, or the size ranges are too far
apart, the whole pair of nodes is left out. Both trees are walked together from the
root, and what is left at the bottom are pairs of sets for an exact check.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np

BITS = 4096
SHORT_BITS = 512
FANOUT = 8
# Node pairs looked at in one step, which bounds memory.
STEP_PAIRS = 4096


def bitmaps(hashes: np.ndarray, bounds: np.ndarray, bits: int = BITS) -> np.ndarray:
    """One bitmap per set; set k holds hashes[bounds[k]:bounds[k + 1]]."""
    return _cells(hashes >> np.uint64(64 - bits.bit_length() + 1), bounds, bits, False)


def parities(hashes: np.ndarray, bounds: np.ndarray, bits: int = SHORT_BITS) -> np.ndarray:
    """Per set and cell, whether the number of its tokens is odd.

    Each cell in which two sets differ holds a token that only one of them has.
    """
    return _cells(hashes & np.uint64(bits - 1), bounds, bits, True)


def _cells(cell: np.ndarray, bounds: np.ndarray, bits: int, parity: bool) -> np.ndarray:
    count = len(bounds) - 1
    out = np.zeros((count, bits // 64), np.uint64)
    cell = cell.astype(np.int64)
    step = max(1, (1 << 22) // bits)
    for a in range(0, count, step):
        b = min(count, a + step)
        owner = np.repeat(np.arange(b - a), np.diff(bounds[a:b + 1]))
        place = owner * bits + cell[bounds[a]:bounds[b]]
        if parity:
            flags = np.bincount(place, minlength=(b - a) * bits) & 1 == 1
        else:
            flags = np.zeros((b - a) * bits, bool)
            flags[place] = True
        out[a:b] = np.packbits(flags.reshape(b - a, bits), axis=1).view(np.uint64)
    return out


@dataclass(frozen=True)
class Threshold:
    """Jaccard similarity of at least ``num / den``."""

    num: int
    den: int

    def needed(self, total: np.ndarray | int) -> np.ndarray | int:
        """Least common tokens of two sets with that many tokens together."""
        return -(-self.num * total // (self.num + self.den))

    def may_link(self, one: tuple, two: tuple) -> np.ndarray:
        """For pairs of sets given as (size, bitmap, parity) arrays: not ruled out by these."""
        (n, a, p), (m, b, q) = one, two
        near = (n * self.den >= m * self.num) & (m * self.den >= n * self.num)
        # What either set has for itself is at least the bits that the other lacks.
        only_a = np.bitwise_count(a & ~b).sum(axis=1).astype(np.int64)
        only_b = np.bitwise_count(b & ~a).sum(axis=1).astype(np.int64)
        odd = np.bitwise_count(p ^ q).sum(axis=1).astype(np.int64)
        needed = self.needed(n + m)
        near &= np.minimum(n - only_a, m - only_b) >= needed
        return near & (n + m - odd >= 2 * needed)

    def prefix(self, size: np.ndarray) -> np.ndarray:
        """Rarest tokens that are enough to meet any similar set in one of them."""
        return np.where(size > 0, size - -(-self.num * size // self.den) + 1, 0)


@dataclass(frozen=True)
class Level:
    low: np.ndarray
    high: np.ndarray
    slack: np.ndarray
    bits: np.ndarray


class SignatureTree:
    def __init__(self, sizes: np.ndarray, bits: np.ndarray):
        self.order = np.lexsort((bits[:, 0], sizes))
        sizes, bits = sizes[self.order], bits[self.order]
        slack = sizes - np.bitwise_count(bits).sum(axis=1).astype(np.int64)
        self.levels = [Level(sizes, sizes, slack, bits)]
        while len(self.levels[-1].low) > 1:
            below = self.levels[-1]
            at = np.arange(0, len(below.low), FANOUT)
            self.levels.append(Level(
                np.minimum.reduceat(below.low, at), np.maximum.reduceat(below.high, at),
                np.maximum.reduceat(below.slack, at), np.bitwise_or.reduceat(below.bits, at, axis=0)))


def _possible(x: Level, i: np.ndarray, y: Level, j: np.ndarray, limit: Threshold) -> np.ndarray:
    """Node pairs that may hold a similar pair."""
    near = (x.high[i] * limit.den >= y.low[j] * limit.num) & (y.high[j] * limit.den >= x.low[i] * limit.num)
    i, j = i[near], j[near]
    common = np.bitwise_count(x.bits[i] & y.bits[j]).sum(axis=1).astype(np.int64)
    common += np.minimum(x.slack[i], y.slack[j])
    near[near] = common >= limit.needed(x.low[i] + y.low[j])
    return near


def similar_pairs(x: SignatureTree, y: SignatureTree, limit: Threshold,
                  skip: Callable[[np.ndarray, np.ndarray], np.ndarray] | None = None,
                  ) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs (into the sets given to each tree) that may be similar.

    Every pair that is similar comes out, unless ``skip`` leaves it out. With one tree
    given twice each pair comes once. ``skip`` sees index pairs when they are reached.
    """
    same = x is y
    top = max(len(x.levels), len(y.levels)) - 1
    if not len(x.order) or not len(y.order):
        return
    stack = [(top, np.zeros(1, np.int64), np.zeros(1, np.int64))]
    while stack:
        depth, i, j = stack.pop()
        dx, dy = min(depth, len(x.levels) - 1), min(depth, len(y.levels) - 1)
        if same and depth == 0:
            keep = i < j
            i, j = i[keep], j[keep]
        if depth == 0 and skip is not None and len(i):
            keep = ~skip(x.order[i], y.order[j])
            i, j = i[keep], j[keep]
        keep = _possible(x.levels[dx], i, y.levels[dy], j, limit)
        i, j = i[keep], j[keep]
        if not len(i):
            continue
        if depth == 0:
            yield x.order[i], y.order[j]
            continue
        i, j = _children(i, j, dx == depth, dy == depth,
                         len(x.levels[min(depth - 1, dx)].low), len(y.levels[min(depth - 1, dy)].low))
        if same:
            keep = i <= j
            i, j = i[keep], j[keep]
        stack += [(depth - 1, i[a:a + STEP_PAIRS], j[a:a + STEP_PAIRS])
                  for a in range(0, len(i), STEP_PAIRS)]


def _children(i: np.ndarray, j: np.ndarray, open_x: bool, open_y: bool,
              count_x: int, count_y: int) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of children; a node of a tree that is already at its bottom stays."""
    kx = np.arange(FANOUT) if open_x else np.zeros(1, np.int64)
    ky = np.arange(FANOUT) if open_y else np.zeros(1, np.int64)
    ci = (i[:, None] * (FANOUT if open_x else 1) + kx)[:, :, None]
    cj = (j[:, None] * (FANOUT if open_y else 1) + ky)[:, None, :]
    ci, cj = np.broadcast_arrays(ci, cj)
    ci, cj = ci.ravel(), cj.ravel()
    inside = (ci < count_x) & (cj < count_y)
    return ci[inside], cj[inside]


class Groups:
    """Union-find over indices."""

    def __init__(self, count: int):
        self.parent = np.arange(count)

    def roots(self, at: np.ndarray) -> np.ndarray:
        root = self.parent[at]
        while True:
            up = self.parent[root]
            if (up == root).all():
                return root
            root = up

    def find(self, a: int) -> int:
        while self.parent[a] != a:
            self.parent[a] = self.parent[self.parent[a]]
            a = self.parent[a]
        return a

    def join(self, a: int, b: int) -> bool:
        a, b = self.find(a), self.find(b)
        if a == b:
            return False
        self.parent[max(a, b)] = min(a, b)
        return True


def spanning_links(hashes: np.ndarray, bounds: np.ndarray, bits: np.ndarray,
                   limit: Threshold) -> list[tuple[int, int]]:
    """Links between sets that connect all sets connected by similarity, and no others.

    Each set is ascending and distinct. Pairs that earlier links connect are not checked.
    """
    sizes = np.diff(bounds)
    groups = Groups(len(sizes))
    links: list[tuple[int, int]] = []

    def check(a: int, b: int) -> None:
        if groups.find(a) == groups.find(b):
            return
        one, two = hashes[bounds[a]:bounds[a + 1]], hashes[bounds[b]:bounds[b + 1]]
        if common_count(one, two) >= limit.needed(len(one) + len(two)):
            groups.join(a, b)
            links.append((a, b))

    # Neighbours of the first set are joined first: in a group of copies this leaves
    # few pairs of different groups, or none, for the walk.
    for b in range(1, len(sizes)):
        check(0, b)
    if len(links) < len(sizes) - 1 and len(sizes) > 2:
        tree = SignatureTree(sizes, bits)
        for i, j in similar_pairs(tree, tree, limit, lambda i, j: groups.roots(i) == groups.roots(j)):
            for a, b in zip(i.tolist(), j.tolist()):
                check(a, b)
    return links


def common_count(one: np.ndarray, two: np.ndarray) -> int:
    """Common values of two ascending distinct arrays."""
    if len(one) > len(two):
        one, two = two, one
    at = np.searchsorted(two, one)
    at[at == len(two)] = 0
    return int((two[at] == one).sum()) if len(two) else 0
