"""Distinct words of a long array of character codes, without a Python object per word."""

from __future__ import annotations

import numpy as np

FACTORS = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95, 0xAF251AF3B0F025B5, 0xB564EF22EC7AECE5)


def spans(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """All positions of the words, one word after another."""
    first = np.cumsum(lengths) - lengths
    return np.repeat(starts - first, lengths) + np.arange(lengths.sum())


class _Powers:
    """Powers of an odd factor and of its inverse modulo 2 ** 64."""

    def __init__(self, factor: int):
        self.factor, self.inverse = np.uint64(factor), np.uint64(pow(factor, -1, 1 << 64))
        self.up, self.down = self._table(self.factor, 1), self._table(self.inverse, 1)

    @staticmethod
    def _table(base: np.uint64, size: int) -> np.ndarray:
        steps = np.full(size, base, np.uint64)
        steps[0] = 1
        return np.multiply.accumulate(steps)

    def hashes(self, codes: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        if len(self.up) <= len(codes):
            size = len(codes) * 5 // 4 + 1
            self.up, self.down = self._table(self.factor, size), self._table(self.inverse, size)
        sums = np.zeros(len(codes) + 1, np.uint64)
        np.cumsum((codes.astype(np.uint64) + np.uint64(1)) * self.up[: len(codes)], out=sums[1:])
        return (sums[starts + lengths] - sums[starts]) * self.down[starts]


class WordTable:
    """Numbers for words, remembered from call to call up to a bound.

    Words are found by hash and compared code by code, so two words never share a number.
    """

    def __init__(self, kept: int, longest: int = 64):
        self.kept, self.longest = kept, longest
        self.powers = [_Powers(FACTORS[0])]
        self.codes = np.zeros(0, np.uint32)
        self.starts = np.zeros(0, np.int64)
        self.lengths = np.zeros(0, np.int64)
        self.sorted = np.zeros(0, np.uint64)
        self.order = np.zeros(0, np.int64)

    def _distinct(self, codes, starts, lengths):
        for attempt, factor in enumerate(FACTORS):
            if attempt == len(self.powers):
                self.powers.append(_Powers(factor))
            hashed = self.powers[attempt].hashes(codes, starts, lengths)
            unique, first, inverse = np.unique(hashed, return_index=True, return_inverse=True)
            model = first[inverse]
            if np.array_equal(lengths, lengths[model]):
                if np.array_equal(codes[spans(starts, lengths)], codes[spans(starts[model], lengths)]):
                    return attempt, unique, first, inverse
        raise ValueError("words could not be told apart by any hash")

    def find(self, codes: np.ndarray, starts: np.ndarray, lengths: np.ndarray):
        """(number of each word, starts and lengths of the words that are new). Numbers from
        len(self) on are new words, in order; call `keep` after using them."""
        attempt, unique, first, inverse = self._distinct(codes, starts, lengths)
        place = np.full(len(unique), -1, np.int64)
        if attempt == 0 and len(self.sorted):
            near = np.minimum(np.searchsorted(self.sorted, unique), len(self.sorted) - 1)
            hit = np.flatnonzero(self.sorted[near] == unique)
            entry = self.order[near[hit]]
            same = self.lengths[entry] == lengths[first[hit]]
            hit, entry = hit[same], entry[same]
            size = self.lengths[entry]
            differs = self.codes[spans(self.starts[entry], size)] != codes[spans(starts[first[hit]], size)]
            wrong = np.bincount(np.repeat(np.arange(len(hit)), size)[differs], minlength=len(hit)) > 0
            place[hit[~wrong]] = entry[~wrong]
        new = np.flatnonzero(place < 0)
        place[new] = len(self.starts) + np.arange(len(new))
        new_starts, new_lengths = starts[first[new]], lengths[first[new]]
        self.waiting = (codes, new_starts, new_lengths, unique[new], attempt)
        return place[inverse], new_starts, new_lengths

    def keep(self) -> np.ndarray:
        """Remembers the new words that fit; which of them, as positions among the new."""
        codes, starts, lengths, hashes, attempt = self.waiting
        room = max(0, self.kept - len(self.starts)) if attempt == 0 else 0
        kept = np.flatnonzero(lengths <= self.longest)[:room]
        if len(kept):
            sizes = lengths[kept]
            added = codes[spans(starts[kept], sizes)].astype(np.uint32)
            self.starts = np.append(self.starts, len(self.codes) + np.cumsum(sizes) - sizes)
            self.lengths = np.append(self.lengths, sizes)
            self.codes = np.append(self.codes, added)
            all_hashes = np.append(self.sorted, hashes[kept])
            numbers = np.append(self.order, len(self.starts) - len(kept) + np.arange(len(kept)))
            order = np.argsort(all_hashes, kind="stable")
            self.sorted, self.order = all_hashes[order], numbers[order]
        self.waiting = None
        return kept
