"""All pairs of 64-bit fingerprints within a Hamming distance, by a Gray-order hierarchical index.

Fingerprints sorted by their rank in the Gray code have neighbours that share long bit patterns. A
node of the index covers consecutive fingerprints and holds the bits on which they all agree. Two
nodes that differ in more agreed bits than the distance allows are dropped with all they cover.
"""

from __future__ import annotations

import numpy as np

FAN_OUT = 8


def components(size: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """For nodes 0..size-1 joined by links: the smallest node of each one's component."""
    label = np.arange(size)
    while True:
        a, b = label[left], label[right]
        if np.array_equal(a, b):
            return label
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while not np.array_equal(following := label[label], label):
            label = following


class Forest:
    """One tree for each run of equal group numbers; members must be in Gray order within it."""

    def __init__(self, members: np.ndarray, group: np.ndarray):
        self.levels = [(members, members, None)]
        bounds = np.flatnonzero(np.append(True, group[1:] != group[:-1])) if len(group) else []
        sizes = np.diff(np.append(bounds, len(group))).astype(np.int64)
        self.trees = len(sizes)
        all_same, any_set = members, members
        while len(sizes) and sizes.max() > 1:
            parents = -(-sizes // FAN_OUT)
            inside = np.arange(parents.sum()) - np.repeat(np.cumsum(parents) - parents, parents)
            start = np.repeat(np.cumsum(sizes) - sizes, parents) + inside * FAN_OUT
            all_same = np.bitwise_and.reduceat(all_same, start)
            any_set = np.bitwise_or.reduceat(any_set, start)
            self.levels.append((all_same, any_set, np.append(start, sizes.sum())))
            sizes = parents

    def links(
        self, roots: tuple[np.ndarray, np.ndarray], distance: int, at_once: int = 2_000_000
    ) -> tuple[np.ndarray, np.ndarray]:
        """Links (i, j) that connect what lies within the distance below the pairs of roots; where
        pairs within the distance are already connected, not each has a link of its own."""
        members = len(self.levels[0][0])
        left, right = np.zeros(0, np.int64), np.zeros(0, np.int64)
        top = len(self.levels) - 1
        near = self._near(top, *roots, distance)
        waiting = [(top, roots[0][near], roots[1][near])]
        while waiting:
            level, a, b = waiting.pop()
            if level == 0:
                left, right = np.append(left, a), np.append(right, b)
                if len(left) > at_once:
                    left, right = _star(members, left, right)
                continue
            children = self.levels[level][2]
            na, nb = children[a + 1] - children[a], children[b + 1] - children[b]
            total = np.cumsum(na * nb)
            if len(a) > 1 and total[-1] > at_once:
                half = len(a) // 2
                waiting += [(level, a[:half], b[:half]), (level, a[half:], b[half:])]
                continue
            pair = np.repeat(np.arange(len(a)), na * nb)
            number = np.arange(len(pair)) - np.repeat(total - na * nb, na * nb)
            i = children[a][pair] + number // nb[pair]
            j = children[b][pair] + number % nb[pair]
            keep = (i < j) | ((i == j) & (level > 1)) | (a != b)[pair]
            i, j = i[keep], j[keep]
            near = self._near(level - 1, i, j, distance)
            if near.any():
                waiting.append((level - 1, i[near], j[near]))
        return _star(members, left, right)

    def _near(self, level: int, a: np.ndarray, b: np.ndarray, distance: int) -> np.ndarray:
        """Whether the bits on which each node agrees differ in no more places than allowed."""
        same, some, _ = self.levels[level]
        differing = (same[a] ^ same[b]) & ~(same[a] ^ some[a]) & ~(same[b] ^ some[b])
        return np.bitwise_count(differing) <= distance


def _star(size: int, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    label = components(size, left, right)
    linked = np.flatnonzero(label != np.arange(size))
    return label[linked], linked
