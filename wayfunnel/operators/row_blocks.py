"""Rows in bins, held in blocks of arrays, and trees that route them.

Both kinds of boosted trees pass over the same rows many times. Rows are binned once; features of few
bins share a byte. A task holds its rows in blocks of one array per byte, so that a pass over them
costs some nanoseconds a row and column.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import RDD, cloudpickle
from pyspark.sql import DataFrame, Row

# functions that run in Python workers travel with the job: executors need not have this library
cloudpickle.register_pickle_by_value(sys.modules[__name__])

BYTE = 256
BLOCK_ROWS = (1 << 15) - 1  # at most
TASK_ROWS = 4_000_000  # at most about so many rows in a task


@dataclass
class Tree:
    """Nodes as flat arrays; a leaf has no left child (-1). Rows in bins up to `bin` go left."""

    feature: np.ndarray
    bin: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray

    @property
    def depth(self) -> int:
        found, level = 0, np.array([0])
        while len(level := level[self.left[level] >= 0]):
            level = np.concatenate([self.left[level], self.right[level]])
            found += 1
        return found

    def steps(self, bins: np.ndarray | None = None) -> np.ndarray:
        """The next node by node and value of the byte that it looks at; leaves lead to themselves.
        bins: by node and byte, if they are not the bytes themselves."""
        split = (self.left >= 0)[:, None]
        goes_left = (np.arange(BYTE) if bins is None else bins) <= self.bin[:, None]
        after = np.where(goes_left, self.left[:, None], self.right[:, None])
        return np.where(split, after, np.arange(len(self.left))[:, None]).ravel()

    def as_lists(self) -> dict[str, list]:
        return {name: getattr(self, name).tolist() for name in self.__dataclass_fields__}

    @staticmethod
    def from_lists(lists: dict[str, list]) -> Tree:
        kinds = {"value": np.float64}
        return Tree(**{k: np.array(v, kinds.get(k, np.int64)) for k, v in lists.items()})


def in_bins(columns: list[np.ndarray], edges: list[np.ndarray]) -> np.ndarray:
    """A row of bins per column: how many edges lie below each value."""
    found = np.empty((len(columns), len(columns[0])), np.uint8)
    for i, (values, limits) in enumerate(zip(columns, edges, strict=True)):
        found[i] = np.searchsorted(limits, values, side="left")
    return found


def leaves(values: np.ndarray, column: np.ndarray, after: np.ndarray, depth: int) -> np.ndarray:
    """The node of a tree of that depth that each of the rows falls into."""
    rows = values.shape[1]
    flat, at, node = values.ravel(), np.arange(rows), np.zeros(rows, np.int64)
    for _ in range(depth):
        node = after[node * BYTE + flat[column[node] * rows + at]]
    return node


def margins(bins: np.ndarray, trees: list[tuple[Tree, int]], start) -> np.ndarray:
    """The sum of the trees, given with their depths, for a row of bins per feature."""
    total = np.zeros(bins.shape[1]) + start
    for tree, depth in trees:
        column = np.maximum(tree.feature, 0)
        total += tree.value[leaves(bins, column, tree.steps(), depth)]
    return total


@dataclass
class Packing:
    """Which byte holds each feature's bin, and with which place value among those that share it."""

    widths: list[int]
    column: list[int] = field(init=False)
    stride: list[int] = field(init=False)
    sizes: list[int] = field(init=False)  # how many values each byte takes

    def __post_init__(self):
        self.column, self.stride, self.sizes = [0] * len(self.widths), [1] * len(self.widths), []
        for i in sorted(range(len(self.widths)), key=lambda i: -self.widths[i]):
            room = [c for c, size in enumerate(self.sizes) if size * self.widths[i] <= BYTE]
            if not room:
                room = [len(self.sizes)]
                self.sizes.append(1)
            self.column[i], self.stride[i] = room[0], self.sizes[room[0]]
            self.sizes[room[0]] *= self.widths[i]

    def packed(self, bins: np.ndarray) -> np.ndarray:
        """One row of bytes per column, from the matrix of bins."""
        found = np.zeros((len(self.sizes), len(bins)), np.uint8)
        for i, (column, stride) in enumerate(zip(self.column, self.stride, strict=True)):
            found[column] += bins[:, i] * np.uint8(stride % BYTE)
        return found

    def by_feature(self, joint: np.ndarray) -> np.ndarray:
        """(nodes, cells) from (nodes, columns, values of a byte); features' cells lie in order."""
        found = []
        for width, column, stride in zip(self.widths, self.column, self.stride, strict=True):
            values = joint[:, column, : self.sizes[column]]
            found.append(values.reshape(len(joint), -1, width, stride).sum(axis=(1, 3)))
        return np.concatenate(found, axis=1)

    def steps(self, tree: Tree) -> tuple[np.ndarray, np.ndarray]:
        """(column that each node looks at, next node by node and value of that byte); leaves lead
        to themselves."""
        feature = np.maximum(tree.feature, 0)
        column, stride, width = (
            np.array(part)[feature] for part in (self.column, self.stride, self.widths)
        )
        bins = np.arange(BYTE) // stride[:, None] % width[:, None]
        return column, tree.steps(bins)


# rows to fit, then held-out ones: (number to fit, bytes, label as 1 or -1, margin in log-odds); a
# plain tuple, which workers without the library can send
Block = tuple[int, np.ndarray, np.ndarray, np.ndarray]


def moved_by(blocks: RDD, packing: Packing, tree: Tree, depth: int) -> RDD:
    def moved(part: Iterator[Block]) -> Iterator[Block]:
        column, after = packing.steps(tree)
        for fitted, values, sign, margin in part:
            node = leaves(values, column, after, depth)
            yield fitted, values, sign, margin + tree.value[node]

    return blocks.mapPartitions(moved, preservesPartitioning=True)


def added(one: tuple, other: tuple) -> tuple:
    return tuple(a + b for a, b in zip(one, other, strict=True))


_BLOCK = "fitted int, bytes binary, sign binary"


def _in_blocks(rows: DataFrame, edges: list[np.ndarray], packing: Packing) -> DataFrame:
    """From the features' columns, then label and held_out: a row per block."""

    def made(table: pa.Table) -> pa.RecordBatch:
        arrays = [column.to_numpy() for column in table.columns[: len(edges)]]
        label, out = (column.to_numpy() for column in table.columns[len(edges) :])
        order = np.argsort(out, kind="stable")
        values = packing.packed(in_bins(arrays, edges)[:, order].T)
        sign = (2 * label[order] - 1).astype(np.int8)
        cells = [int((~out).sum()), values.tobytes(), sign.tobytes()]
        kinds = [pa.int32(), pa.binary(), pa.binary()]
        columns = [pa.array([v], k) for v, k in zip(cells, kinds, strict=True)]
        return pa.RecordBatch.from_arrays(columns, ["fitted", "bytes", "sign"])

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, held = [], 0
        for batch in batches:
            waiting.append(batch)
            held += batch.num_rows
            if held >= BLOCK_ROWS:
                table, at = pa.Table.from_batches(waiting), 0
                while held >= BLOCK_ROWS:
                    yield made(table.slice(at, BLOCK_ROWS))
                    at, held = at + BLOCK_ROWS, held - BLOCK_ROWS
                waiting = table.slice(at).to_batches()
        if held:
            yield made(pa.Table.from_batches(waiting))

    return rows.mapInArrow(blocks, _BLOCK)


def stored_blocks(
    rows: DataFrame, edges: list[np.ndarray], packing: Packing, path: str
) -> DataFrame:
    """The blocks of rows that have the features' columns, then label and held_out, written to the
    path and read back."""
    _in_blocks(rows, edges, packing).write.parquet(path)
    return rows.sparkSession.read.schema(_BLOCK).parquet(path)


def dealt_blocks(stored: DataFrame, tasks: int, start: float) -> RDD:
    """The stored blocks dealt to tasks, with a margin to start from."""

    def block(row: Row) -> Block:
        sign = np.frombuffer(bytes(row["sign"]), np.int8)
        values = np.frombuffer(bytes(row["bytes"]), np.uint8).reshape(-1, len(sign))
        return row["fitted"], values, sign, np.full(len(sign), start)

    return stored.repartition(tasks).rdd.map(block)
