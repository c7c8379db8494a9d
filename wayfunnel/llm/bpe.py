"""Byte-pair merging of many sequences at once, rank by rank.

Sequences lie one after another in one array. In each step every sequence applies its own
lowest-rank pair, all sequences at the same time; those without a pair that merges are finished.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

NONE = np.iinfo(np.int32).max
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


@dataclass
class Merges:
    """Pairs of symbols that merge, with rank (the lowest goes first) and what they become."""

    left: np.ndarray
    right: np.ndarray
    rank: np.ndarray
    merged: np.ndarray

    def __post_init__(self):
        self.keys = (self.left.astype(np.uint64) << np.uint64(32)) | self.right.astype(np.uint64)
        self.bits = max(4, int(len(self.keys) * 8).bit_length())
        self.slots = np.full(1 << self.bits, -1, np.int32)
        waiting = np.arange(len(self.keys), dtype=np.int32)
        place = self._slot(self.keys)
        while len(waiting):
            free = self.slots[place] < 0
            self.slots[place[free]] = waiting[free]
            lost = self.slots[place] != waiting
            waiting = waiting[lost]
            place = (place[lost] + 1) & ((1 << self.bits) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * MULTIPLIER) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Index of each pair, or -1."""
        keys = (left.astype(np.uint64) << np.uint64(32)) | right.astype(np.uint64)
        place = self._slot(keys)
        found = self.slots[place]
        open_ = np.flatnonzero((found >= 0) & (self.keys[found] != keys))
        while len(open_):
            place[open_] = (place[open_] + 1) & ((1 << self.bits) - 1)
            found[open_] = self.slots[place[open_]]
            still = (found[open_] >= 0) & (self.keys[found[open_]] != keys[open_])
            open_ = open_[still]
        return found


def _pairs(symbols: np.ndarray, last: np.ndarray, merges: Merges) -> tuple[np.ndarray, np.ndarray]:
    """Of each symbol and its successor: index of the pair and its rank; none at the last one."""
    index = np.full(len(symbols), -1, np.int32)
    if len(symbols) > 1:
        index[:-1] = merges.find(symbols[:-1], symbols[1:])
    index[last] = -1
    rank = np.where(index >= 0, merges.rank[index], NONE) if len(merges.rank) else index + NONE
    return index, rank.astype(np.int64)


def _apply(symbols, lengths, row, index, taken, merges):
    """Merges at the taken places; new symbols, lengths and row of each symbol."""
    after = symbols.copy()
    after[taken] = merges.merged[index[taken]]
    keep = np.ones(len(symbols), bool)
    keep[taken + 1] = False
    return after[keep], lengths - np.bincount(row[taken], minlength=len(lengths)), row[keep]


def merge(symbols: np.ndarray, lengths: np.ndarray, merges: Merges) -> tuple[np.ndarray, np.ndarray]:
    """The sequences after all merges, in the same order; a sequence may be empty.

    A sequence merges all places of its lowest-rank pair in one step. Where that could differ from
    merging the leftmost place alone, because a pair of no higher rank comes up, it merges only
    the leftmost.
    """
    result_lengths = np.zeros(len(lengths), np.int64)
    finished: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    number = np.flatnonzero(lengths > 0)
    lengths = lengths[number].astype(np.int64)
    row = np.repeat(np.arange(len(lengths)), lengths)
    ends = np.cumsum(lengths)
    index, rank = _pairs(symbols, ends - 1, merges)
    while len(lengths):
        starts = np.cumsum(lengths) - lengths
        least = np.minimum.reduceat(rank, starts)
        done = least == NONE
        if done.any():
            finished.append((number[done], lengths[done], symbols[done[row]]))
            keep = ~done[row]
            symbols, index, rank, row = symbols[keep], index[keep], rank[keep], row[keep]
            number, lengths, least = number[~done], lengths[~done], least[~done]
            row = (np.cumsum(~done) - 1)[row]
            if not len(lengths):
                break
        lowest = rank == least[row]
        before = np.append(False, lowest[:-1])
        where = np.flatnonzero(lowest)
        first = np.flatnonzero(lowest & ~before)
        run = np.searchsorted(first, where, side="right") - 1
        taken = where[(where - first[run]) % 2 == 0]
        new = _apply(symbols, lengths, row, index, taken, merges)
        new_index, new_rank = _pairs(new[0], np.cumsum(new[1]) - 1, merges)
        if len(taken) > len(lengths):
            new_least = np.minimum.reduceat(new_rank, np.cumsum(new[1]) - new[1])
            several = np.bincount(row[taken], minlength=len(lengths)) > 1
            unsure = several & (new_least <= least)
            if unsure.any():
                leftmost = np.append(True, row[taken[1:]] != row[taken[:-1]])
                taken = taken[leftmost | ~unsure[row[taken]]]
                new = _apply(symbols, lengths, row, index, taken, merges)
                new_index, new_rank = _pairs(new[0], np.cumsum(new[1]) - 1, merges)
        (symbols, lengths, row), index, rank = new, new_index, new_rank
    for rows, sizes, _ in finished:
        result_lengths[rows] = sizes
    result = np.zeros(result_lengths.sum(), np.int64)
    offsets = np.cumsum(result_lengths) - result_lengths
    for rows, sizes, values in finished:
        inside = np.arange(len(values)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        result[np.repeat(offsets[rows], sizes) + inside] = values
    return result, result_lengths
