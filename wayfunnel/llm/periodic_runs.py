"""Periodic runs of words: maximal stretches that repeat with some period at least twice.

String synchronising sets find them scale by scale, over all texts of a batch laid end to end with
a separator of its own behind each. At scale t a position is in the set if, of the hashes of the
stretches of t words that start at it and up to t words later, the least is the first or the last.
Membership depends on the next 2 t words alone, and each t consecutive positions hold a member
unless the text there has a period of t / 3 at most; those highly periodic stretches are runs that
smaller scales have found, and their hashes count as infinite.

A run with period p, 3 t <= p < 6 t, therefore falls into one of two kinds. Either it holds a member
whose 2 t words come again p later: members of equal context propose their distances. Or its first
period is itself highly periodic, and the run lies across two neighbouring runs of the same small
period q that touch: these propose all p that bring their periods into line. Periods up to 5 are
compared word by word. Every proposal is extended to both sides by hashes as far as the words agree
and then compared word by word; whatever has a smaller period at the same place is dropped.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from wayfunnel.llm.common import map_texts, ragged_positions

SMALL = 5  # periods up to this are compared directly; the first scale is 2
LEAST_LENGTH = 12
_INFINITE = np.uint64(0xFFFFFFFFFFFFFFFF)
_NONE = np.zeros((0, 3), np.int64)


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads them."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _Hashes:
    """Hashes of stretches of a sequence, modulo 2 ** 64."""

    def __init__(self, values: np.ndarray, attempt: int):
        base = int(_mix(np.array([1000 + attempt], np.uint64))[0]) | 1
        size = len(values) + 1
        self.down = self._powers(pow(base, -1, 1 << 64), size)
        self.sums = np.zeros(size, np.uint64)
        letters = _mix(values.astype(np.uint64) * np.uint64(4) + np.uint64(attempt))
        np.cumsum(letters * self._powers(base, size)[:-1], out=self.sums[1:])

    @staticmethod
    def _powers(base: int, size: int) -> np.ndarray:
        powers = np.full(size, base, np.uint64)
        powers[0] = 1
        return np.multiply.accumulate(powers)

    def at(self, starts: np.ndarray, length) -> np.ndarray:
        return (self.sums[starts + length] - self.sums[starts]) * self.down[starts]

    def all(self, length: int, end: int) -> np.ndarray:
        """Of every stretch of that length that ends by `end`, in order of position."""
        n = max(0, end - length + 1)
        return _mix((self.sums[length : length + n] - self.sums[:n]) * self.down[:n])


def _agreement(hashes: _Hashes, i: np.ndarray, j: np.ndarray, most: np.ndarray, forward: bool):
    """For i < j: how many words agree from there on, or before there, up to `most`."""
    low, high = np.zeros_like(i), most.copy()
    while (open_ := low < high).any():
        middle = (low + high + 1) // 2
        a, b = (i, j) if forward else (i - middle, j - middle)
        agree = open_ & (hashes.at(a, middle) == hashes.at(b, middle))
        low = np.where(agree, middle, low)
        high = np.where(open_ & ~agree, middle - 1, high)
    return low


def _smallest_periods(runs: np.ndarray) -> np.ndarray:
    """(start, end, period) rows without those that have a smaller period at the same place."""
    runs = runs[np.lexsort((runs[:, 2], runs[:, 1], runs[:, 0]))]
    first = np.ones(len(runs), bool)
    first[1:] = (runs[1:, :2] != runs[:-1, :2]).any(axis=1)
    return runs[first]


def _small_periods(words: np.ndarray) -> np.ndarray:
    found = [_NONE]
    for p in range(1, SMALL + 1):
        same = np.zeros(len(words) + 2, bool)
        same[1 : max(1, len(words) - p + 1)] = words[:-p] == words[p:]
        edges = np.flatnonzero(same[1:] != same[:-1])
        starts, ends = edges[::2], edges[1::2] + p
        runs = np.column_stack([starts, ends, np.full(len(starts), p)])
        found.append(runs[ends - starts >= 2 * p])
    return _smallest_periods(np.concatenate(found))


def _members(hashes: _Hashes, scale: int, end: int, known: np.ndarray) -> np.ndarray:
    """Positions of the synchronising set."""
    ids = hashes.all(scale, end)
    repeated = known[(3 * known[:, 2] <= scale) & (known[:, 1] - known[:, 0] >= scale)]
    repeated = repeated[repeated[:, 1] <= end]
    edges = np.zeros(len(ids) + 1, np.int32)
    np.add.at(edges, repeated[:, 0], 1)
    np.add.at(edges, repeated[:, 1] - scale + 1, -1)
    ids[np.cumsum(edges[:-1]) > 0] = _INFINITE
    least, step = ids, 1
    while step < scale:  # least of 1, 2, 4, ... stretches
        least = np.minimum(least[:-step], least[step:])
        step *= 2
    least = np.minimum(least[:-1], least[1:])
    n = len(least)
    chosen = (least == ids[:n]) | (least == ids[scale : scale + n])
    return np.flatnonzero(chosen & (least != _INFINITE))


def _by_context(hashes: _Hashes, scale: int, end: int, known: np.ndarray) -> np.ndarray:
    """(position, period): members of equal context, 3 to 6 scales apart."""
    members = _members(hashes, scale, end, known)
    members = members[members + 2 * scale <= end]
    contexts = hashes.at(members, 2 * scale)
    order = np.argsort(contexts, kind="stable")
    members, contexts = members[order], contexts[order]
    found, lag = [np.zeros((0, 2), np.int64)], 1
    while lag < len(members):
        apart = members[lag:] - members[:-lag]
        near = np.flatnonzero((contexts[lag:] == contexts[:-lag]) & (apart < 6 * scale))
        if not len(near):
            break
        far = near[apart[near] >= 3 * scale]
        found.append(np.column_stack([members[far], apart[far]]))
        lag += 1
    return _chains(np.concatenate(found), 2 * scale)


def _chains(proposals: np.ndarray, context: int) -> np.ndarray:
    """The first of each chain of proposals of one period whose contexts touch."""
    proposals = proposals[np.lexsort((proposals[:, 0], proposals[:, 1]))]
    first = np.ones(len(proposals), bool)
    first[1:] = (proposals[1:, 1] != proposals[:-1, 1]) | (
        proposals[1:, 0] - proposals[:-1, 0] > context
    )
    return proposals[first]


def _across(hashes: _Hashes, scale: int, known: np.ndarray) -> np.ndarray:
    """(position, period) that lay neighbouring runs of one small period over each other."""
    small = known[(3 * known[:, 2] <= scale) & (known[:, 1] - known[:, 0] >= 3 * scale)]
    small = small[np.lexsort((small[:, 0], small[:, 2]))]
    left, right = small[:-1], small[1:]
    touch = (left[:, 2] == right[:, 2]) & (right[:, 0] <= left[:, 1])
    left, right = left[touch], right[touch]
    q, meet = left[:, 2], left[:, 1]
    row, step = ragged_positions(q)
    period = 3 * scale + step
    aligned = hashes.at(meet[row] - period, q[row]) == hashes.at(meet[row], q[row])
    row, period = row[aligned], period[aligned]
    most = np.minimum(left[:, 1] - left[:, 0], right[:, 1] - right[:, 0])
    most = np.minimum(most, 6 * scale - 1)
    again, step = ragged_positions(np.maximum(0, (most[row] - period) // q[row] + 1))
    period = period[again] + step * q[row][again]
    return np.column_stack([meet[row][again] - period, period])


def _extended(hashes: _Hashes, proposals: np.ndarray, end: int) -> np.ndarray:
    """Proposals as (start, end, period), as far as they go, where they repeat at least twice."""
    i, p = proposals[:, 0], proposals[:, 1]
    starts = i - _agreement(hashes, i, i + p, i, forward=False)
    ends = i + p + _agreement(hashes, i, i + p, end - i - p, forward=True)
    return np.column_stack([starts, ends, p])[ends - starts >= 2 * p]


def _confirmed(words: np.ndarray, runs: np.ndarray, at_once: int = 1 << 22) -> bool:
    """Whether the words of all runs do repeat."""
    lengths = runs[:, 1] - runs[:, 2] - runs[:, 0]
    part = (np.cumsum(lengths) - lengths) // at_once
    for number in np.unique(part):
        chosen = part == number
        row, step = ragged_positions(lengths[chosen])
        here = runs[chosen][row, 0] + step
        if (words[here] != words[here + runs[chosen][row, 2]]).any():
            return False
    return True


def all_runs(lengths: np.ndarray, words: np.ndarray) -> np.ndarray:
    """(start, end, smallest period) of all runs of texts laid end to end, longest text first.

    words numbers each text's words and has one number of its own behind each text; lengths count
    the words without it. Linear in the words but for sorting and the scales that a text reaches.
    """
    ends = np.cumsum(lengths + 1)
    for attempt in range(4):
        hashes, known, scale = _Hashes(words, attempt), _small_periods(words), 2
        sound = True
        while sound:
            reached = np.searchsorted(-lengths, -6 * scale, side="right")
            if not reached:
                return known
            end = int(ends[reached - 1])
            proposals = [_by_context(hashes, scale, end, known), _across(hashes, scale, known)]
            found = _extended(hashes, np.concatenate(proposals), end)
            found = np.unique(found, axis=0) if len(found) else found
            sound = _confirmed(words, found)
            known = _smallest_periods(np.concatenate([known, found]))
            scale *= 2
    raise ValueError("stretches could not be told apart by any hash")


def runs_of(texts: list[list[bytes]], least: int = LEAST_LENGTH) -> list[np.ndarray]:
    """Per text the (start, length, period) of its runs by start, then period: `least` words long,
    two periods at least."""
    found = [_NONE] * len(texts)
    sizes = np.array([len(t) for t in texts], np.int64)
    order = np.argsort(-sizes, kind="stable")
    order = order[sizes[order] >= max(least, 2)]
    if not len(order):
        return found
    numbers: dict[bytes, int] = {}
    laid = np.empty(int(sizes[order].sum()) + len(order), np.int64)
    at = 0
    for count, i in enumerate(order.tolist()):
        size = len(texts[i])
        laid[at : at + size] = [numbers.setdefault(word, len(numbers)) for word in texts[i]]
        laid[at + size] = -1 - count
        at += size + 1
    starts = np.cumsum(sizes[order] + 1) - sizes[order] - 1
    runs = all_runs(sizes[order], laid)
    runs = runs[runs[:, 1] - runs[:, 0] >= least]
    text = np.searchsorted(starts, runs[:, 0], side="right") - 1
    sort = np.lexsort((runs[:, 2], runs[:, 0], text))
    runs, text = runs[sort], text[sort]
    bounds = np.searchsorted(text, np.arange(len(order) + 1))
    for count in np.flatnonzero(np.diff(bounds)).tolist():
        part = runs[bounds[count] : bounds[count + 1]]
        shift = part[:, 0] - starts[count]
        found[order[count]] = np.column_stack([shift, part[:, 1] - part[:, 0], part[:, 2]])
    return found


def collapsed(words: list[bytes], runs: np.ndarray) -> list[bytes]:
    """The words without those that a run holds after its first period."""
    edges = np.zeros(len(words) + 1, np.int64)
    np.add.at(edges, runs[:, 0] + runs[:, 2], 1)
    np.add.at(edges, runs[:, 0] + runs[:, 1], -1)
    return [words[i] for i in np.flatnonzero(np.cumsum(edges[:-1]) == 0).tolist()]


_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def find_runs(
    documents: DataFrame, *, text: str = "text", carry: list[str], least: int = LEAST_LENGTH
) -> DataFrame:
    """The carried columns, n_words, runs and collapsed of each whole text.

    Words are separated by ASCII white space. runs is an array of (start, length, period) by start,
    then period, of all runs of `least` words and two periods at least; collapsed has the words left
    over, joined by a space, when every run is cut to its first period. Null and empty texts have no
    words, no runs and an empty collapsed text; repeated rows stay. Carried columns must not be
    called n_words, runs or collapsed; other columns are neither read nor returned. Memory follows
    the longest text, of which a task holds some ten numbers a word.
    """

    def work(texts: list[str | None]) -> list[pa.Array]:
        words = [(t or "").encode().split() for t in texts]
        found = runs_of(words, least)
        flat = np.concatenate([_NONE, *found])
        ends = np.cumsum([0, *[len(r) for r in found]])
        runs = pa.StructArray.from_arrays(
            [pa.array(np.ascontiguousarray(flat[:, i])) for i in range(3)], fields=list(_RUN)
        )
        left = [
            b" ".join(collapsed(w, r) if len(r) else w).decode()
            for w, r in zip(words, found, strict=True)
        ]
        return [
            pa.array([len(w) for w in words], pa.int64()),
            pa.ListArray.from_arrays(pa.array(ends, pa.int32()), runs),
            pa.array(left, pa.string()),
        ]

    added = "n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"
    return map_texts(documents, text, carry, added, work)
