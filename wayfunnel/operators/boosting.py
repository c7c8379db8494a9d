"""Histogram gradient boosting: second-order gains with an L2 penalty, trees grown best leaf first.

Rows are binned once, written, and held in blocks (``row_blocks.py``) that stay in memory or on
executors' disks between passes. A pass adds up gradients, hessians and counts per (leaf, feature, bin)
over all rows; what reaches the driver is one number of each per such cell and task, which depends on
the parameters and not on the data. From many tasks it is shuffled by cell; from few it is brought
here, which takes half the time. Which leaf is split next depends on the gains of all leaves, so a
pass looks ahead: it takes in every leaf that the splits left over could still reach, and of the two
children of a leaf only the smaller is added up; the other is the difference. Rows are followed only
towards the leaves of the pass.

Only nodes of many rows are split like that, and first. A subtree of few rows, of which a parameter
sets the most, is grown by one task from its rows; it comes out as it would pass by pass. All such
subtrees that the tree can reach are grown in one go, so a tree takes about as many passes as it has
levels above them, and one shuffle.

Gradients are summed as whole numbers (in 2 ** -24), so that trees depend neither on the order in
which tasks finish nor on how rows are dealt. Rows carry the sum of the trees of earlier rounds; every
few rounds they are checkpointed, which bounds what a lost executor makes the others do again.
"""

from __future__ import annotations

import json
import math
import sys
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark import RDD, StorageLevel, cloudpickle, keyword_only
from pyspark.ml import Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfunnel import settings
from wayfunnel.operators.quantiles import grouped_quantiles
from wayfunnel.operators.row_blocks import (
    BYTE,
    TASK_ROWS,
    Block,
    Packing,
    Tree,
    added,
    dealt_blocks,
    in_bins,
    margins,
    moved_by,
    stored_blocks,
)
from wayfunnel.settings import HistogramBoostingParams
from wayfunnel.sources.workarea import ensure_checkpoints, shared_folder

# functions that run in Python workers travel with the job: executors need not have this library
cloudpickle.register_pickle_by_value(sys.modules[__name__])
cloudpickle.register_pickle_by_value(settings)

SCALE = float(1 << 24)
LEAST_HESSIAN = 1e-3  # of a child
FEW_FILES = 64  # parts of the rows, whose tasks' sums the driver adds up itself
COUNT = 1 << 37  # over the hessians of a block's rows: both are added up at once


class HistogramTreesModel(Model, DefaultParamsReadable, DefaultParamsWritable):
    """Adds ``score``, the probability of the label; saved and loaded like any pipeline stage."""

    ensemble = Param(Params._dummy(), "ensemble", "the trees as JSON", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, ensemble: str = "{}"):
        super().__init__()
        self._set(ensemble=ensemble)

    @staticmethod
    def of(features: list[str], edges: list[np.ndarray], start: float, trees: list[Tree]):
        parts = {
            "features": features,
            "edges": [e.tolist() for e in edges],
            "start": start,
            "trees": [t.as_lists() for t in trees],
        }
        return HistogramTreesModel(ensemble=json.dumps(parts))

    @property
    def tree_count(self) -> int:
        return len(json.loads(self.getOrDefault(self.ensemble))["trees"])

    def _transform(self, dataset: DataFrame) -> DataFrame:
        parts = json.loads(self.getOrDefault(self.ensemble))
        edges = [np.array(e, np.float64) for e in parts["edges"]]
        trees = [(tree, tree.depth) for tree in map(Tree.from_lists, parts["trees"])]
        start = parts["start"]

        @F.pandas_udf("double")
        def score(*columns: pd.Series) -> pd.Series:
            values = [c.to_numpy(np.float64) for c in columns]
            total = margins(in_bins(values, edges), trees, start)
            return pd.Series(1.0 / (1.0 + np.exp(-total)))

        inputs = [F.col(name).cast("double") for name in parts["features"]]
        return dataset.withColumn("score", score(*inputs))


def bin_edges(rows: DataFrame, features: list[str], most: int) -> list[np.ndarray]:
    """Per feature the inner edges of at most `most` bins: the middle between neighbouring values
    where there are no more values than bins, exact quantiles otherwise.

    At most that many values per feature come to the driver.
    """
    long = rows.select(*[F.col(c).cast("double").alias(c) for c in features]).unpivot(
        [], features, "feature", "value"
    )
    counts = (
        long.where(F.col("value").isNotNull() & ~F.isnan("value"))
        .groupBy("feature", "value")
        .agg(F.count(F.lit(1)).alias("n"))
        .persist()  # else every use reads and prepares all rows again
    )
    try:
        return _edges(counts, features, most)
    finally:
        counts.unpersist()


def _edges(counts: DataFrame, features: list[str], most: int) -> list[np.ndarray]:
    sizes = counts.groupBy("feature").agg(F.count(F.lit(1)).alias("values"))
    few = [r["feature"] for r in sizes.where(F.col("values") <= most).collect()]
    found = {name: np.zeros(0) for name in features}
    if few:
        values = counts.where(F.col("feature").isin(few)).groupBy("feature")
        for row in values.agg(F.sort_array(F.collect_list("value")).alias("values")).collect():
            values = np.array(row["values"])
            found[row["feature"]] = values[:-1] + (values[1:] - values[:-1]) / 2
    many = [name for name in features if name not in few]
    if many:
        chances = [i / most for i in range(1, most)]
        cut = grouped_quantiles(counts.where(F.col("feature").isin(many)), "feature", chances)
        for row in cut.groupBy("feature").agg(F.collect_set("quantile").alias("cuts")).collect():
            found[row["feature"]] = np.unique(np.array(row["cuts"]))
    return [found[name] for name in features]


@dataclass
class _Node:
    """Sums of gradients, hessians and rows; once `known`, the best split and its gain."""

    g: int
    h: int
    n: int
    cells: np.ndarray | None = None  # sums by feature and bin
    known: bool = False
    gain: float = 0.0
    feature: int = -1
    bin: int = -1
    below: tuple[int, int] | None = None


@dataclass
class _Layout:
    """Where each feature's bins lie among all cells of a node."""

    widths: list[int]
    ends: np.ndarray = field(init=False)
    first: np.ndarray = field(init=False)  # of each cell, the first one of its feature
    packing: Packing = field(init=False)

    def __post_init__(self):
        self.ends = np.cumsum(self.widths)
        self.first = np.repeat(self.ends - self.widths, self.widths)
        self.packing = Packing(self.widths)

    @property
    def total(self) -> int:
        return len(self.first)


def best_split(
    node: _Node, layout: _Layout, params: HistogramBoostingParams
) -> tuple[float, int, int, np.ndarray]:
    """(gain, feature, last bin of the left child, its sums); ties go to the first feature and bin,
    gain 0 if no split is allowed."""
    whole = np.array([node.g, node.h, node.n])

    def worth(sums: np.ndarray) -> np.ndarray:
        g, h = sums[..., 0] / SCALE, sums[..., 1] / SCALE
        return g * g / (h + params.l2)

    ran = np.concatenate([np.zeros((1, 3), np.int64), np.cumsum(node.cells, axis=0)])
    left = ran[1:] - ran[layout.first]
    right = whole - left
    enough = np.minimum(left[:, 2], right[:, 2]) >= params.min_rows_per_leaf
    enough &= np.minimum(left[:, 1], right[:, 1]) >= LEAST_HESSIAN * SCALE  # not after a last bin
    with np.errstate(divide="ignore", invalid="ignore"):
        gains = np.where(enough, worth(left) + worth(right) - worth(whole), -np.inf)
    at = int(np.argmax(gains))
    if not gains[at] > 0:
        return 0.0, -1, -1, np.zeros(3, np.int64)
    feature = int(np.searchsorted(layout.ends, at, side="right"))
    return float(gains[at]), feature, at - int(layout.first[at]), left[at]


def _consider(nodes: list[_Node], number: int, layout: _Layout, params) -> None:
    """Finds the best split of a node with cells, and adds its children."""
    node = nodes[number]
    node.gain, node.feature, node.bin, left = best_split(node, layout, params)
    node.known = True
    if node.gain > 0:
        right = (node.g - left[0], node.h - left[1], node.n - left[2])
        nodes += [_Node(*left.tolist()), _Node(*map(int, right))]
        node.below = (len(nodes) - 2, len(nodes) - 1)


@dataclass
class _Grown:
    """A best-first tree as far as it is known. Leaves whose children must be known to go on count
    as split once, when it is their turn: what the whole tree splits besides them is among `split`."""

    split: set[int] = field(default_factory=set)
    open: list[int] = field(default_factory=list)  # leaves whose children must be known
    aside: dict[int, int] = field(default_factory=dict)  # leaves to be grown apart: most leaves


def _grown(nodes: list[_Node], most: int, apart: int = -1) -> _Grown:
    """The tree of at most so many leaves. Nodes of up to `apart` rows are put aside with the number
    of leaves that they can come to."""
    found, leaves, size = _Grown(), [0], 1
    while size < most and leaves:
        best = max(leaves, key=lambda i: (nodes[i].gain, -i))
        node = nodes[best]
        if node.gain <= 0:
            break
        leaves.remove(best)
        if node.n <= apart:
            found.aside[best] = most - size + 1
        elif size + 1 < most and not all(nodes[i].known for i in node.below):
            found.open.append(best)
        else:
            found.split.add(best)
            leaves.extend(node.below)
        size += 1
    return found


def grow_rows(
    values: np.ndarray, g: np.ndarray, h: np.ndarray, most: int, layout: _Layout, params
) -> list[_Node]:
    """The nodes of the best-first tree of at most so many leaves over these rows."""
    packing = layout.packing

    def cells(rows: np.ndarray) -> np.ndarray:
        found = np.empty((3, len(values), BYTE))
        weights = g[rows].astype(np.float64), h[rows].astype(np.float64)
        for i in range(len(values)):
            place = values[i][rows]
            for k, part in enumerate(weights):
                found[k, i] = np.bincount(place, part, BYTE)
            found[2, i] = np.bincount(place, minlength=BYTE)
        return packing.by_feature(found.astype(np.int64)).T

    every = np.arange(len(g))
    nodes = [_Node(int(g.sum(dtype=np.int64)), int(h.sum(dtype=np.int64)), len(g), cells(every))]
    held = {0: every}
    _consider(nodes, 0, layout, params)
    while open_ := _grown(nodes, most).open:
        parent = open_[0]
        rows, node = held.pop(parent), nodes[parent]
        column, stride, width = (
            part[node.feature] for part in (packing.column, packing.stride, packing.widths)
        )
        to_left = values[column][rows] // stride % width <= node.bin
        for child, chosen in zip(node.below, (to_left, ~to_left), strict=True):
            held[child] = rows[chosen]
        small, large = sorted(node.below, key=lambda child: nodes[child].n)
        nodes[small].cells = cells(held[small])
        nodes[large].cells = node.cells - nodes[small].cells
        for child in node.below:
            _consider(nodes, child, layout, params)
    return nodes


def grow(
    nodes: list[_Node],
    layout: _Layout,
    params: HistogramBoostingParams,
    add_up: Callable[[Tree, list[int]], dict[int, np.ndarray]],
    finish: Callable[[Tree, dict[int, int]], dict[int, list[_Node]]],
) -> Tree:
    """A tree, best leaf first, from its known root. add_up(tree so far, numbers) gives the sums of
    these nodes' cells, finish(tree so far, numbers with the most leaves) their subtrees.

    Nodes of many rows are split first. That takes in every one that the whole tree will split: which
    of them comes before which does not depend on what is not known yet or grown apart, and that can
    only leave fewer splits to the others.
    """
    most, small = params.max_leaves, params.local_rows

    def so_far() -> Tree:
        return _tree(nodes, {i for i, node in enumerate(nodes) if node.below}, params)

    while (found := _grown(nodes, most, small)).open:
        open_ = found.open
        smaller = [min(nodes[i].below, key=lambda child: nodes[child].n) for i in open_]
        sums = add_up(so_far(), smaller)
        for parent, child in zip(open_, smaller, strict=True):
            other = sum(nodes[parent].below) - child
            nodes[child].cells = sums[child]
            nodes[other].cells = nodes[parent].cells - sums[child]
        for child in [c for i in open_ for c in nodes[i].below]:
            _consider(nodes, child, layout, params)
    wanted = {i: leaves for i, leaves in found.aside.items() if leaves > 2}
    if wanted:
        kept = {i for i, node in enumerate(nodes) if node.below} - set(wanted)
        for number, subtree in finish(_tree(nodes, kept, params), wanted).items():
            _attach(nodes, number, subtree)
    return _tree(nodes, _grown(nodes, most).split, params)


def _attach(nodes: list[_Node], number: int, subtree: list[_Node]) -> None:
    """Puts the subtree in the place of a node."""
    places = [number, *range(len(nodes), len(nodes) + len(subtree) - 1)]
    for node in subtree:
        if node.below:
            node.below = (places[node.below[0]], places[node.below[1]])
    nodes[number] = subtree[0]
    nodes.extend(subtree[1:])


def _tree(nodes: list[_Node], split: set[int], params: HistogramBoostingParams) -> Tree:
    left = [n.below[0] if i in split else -1 for i, n in enumerate(nodes)]
    right = [n.below[1] if i in split else -1 for i, n in enumerate(nodes)]
    values = [-params.step_size * n.g / SCALE / (n.h / SCALE + params.l2) for n in nodes]
    return Tree(
        np.array([n.feature if i in split else -1 for i, n in enumerate(nodes)], np.int64),
        np.array([n.bin if i in split else -1 for i, n in enumerate(nodes)], np.int64),
        np.array(left, np.int64),
        np.array(right, np.int64),
        np.array(values),
    )


# per byte that is looked at on the way to a node, which of its values lead there
Box = list[tuple[int, np.ndarray]]


def _boxes(packing: Packing, tree: Tree, wanted: list[int]) -> list[Box]:
    column, after = packing.steps(tree)
    after = after.reshape(-1, BYTE)
    above = np.full(len(column), -1)
    split = np.flatnonzero(tree.left >= 0)
    above[tree.left[split]] = above[tree.right[split]] = split
    found = []
    for node in wanted:
        values: dict[int, np.ndarray] = {}
        while (parent := above[node]) >= 0:
            byte = int(column[parent])
            values[byte] = values.get(byte, True) & (after[parent] == node)
            node = parent
        found.append(sorted(values.items(), key=lambda item: item[1].sum()))
    return found


def _inside(box: Box, values: np.ndarray, fitted: int) -> np.ndarray | slice:
    """Which of the first rows of a block are in the box."""
    if not box:
        return slice(fitted)
    (byte, allowed), *others = box
    rows = np.flatnonzero(allowed[values[byte, :fitted]])
    for byte, allowed in others:
        rows = rows[allowed[values[byte][rows]]]
    return rows


def _gradients(sign: np.ndarray, margin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(gradients, hessians) in whole units, as doubles."""
    p = 1.0 / (1.0 + np.exp(-margin))
    return np.rint((p - (sign > 0)) * SCALE), np.rint(p * (1 - p) * SCALE)


def _sums(
    spark: SparkSession, blocks: RDD, layout: _Layout, tree: Tree, wanted: list[int]
) -> tuple[dict[int, np.ndarray], float | None]:
    """The cells of the wanted nodes over the rows to fit, and the mean loss of the held-out rows,
    which is added up with the root's cells only."""
    packing, boxes = layout.packing, _boxes(layout.packing, tree, wanted)

    def summed(part: Iterator[Block]) -> Iterator[tuple]:
        cells = np.zeros((3, len(boxes), len(packing.sizes), BYTE), np.int64)
        loss = held = 0
        for fitted, values, sign, margin in part:
            if wanted == [0]:
                out = margin[fitted:]
                error = np.logaddexp(0, out) - (sign[fitted:] > 0) * out
                loss += int(np.rint(error * SCALE).sum())
                held += len(out)
            for k, box in enumerate(boxes):
                rows = _inside(box, values, fitted)
                g, h = _gradients(sign[rows], margin[rows])
                h += COUNT
                for i, of_column in enumerate(values):
                    place = of_column[rows]
                    cells[0, k, i] += np.bincount(place, g, BYTE).astype(np.int64)
                    both = np.bincount(place, h, BYTE).astype(np.int64)
                    cells[1, k, i] += both % COUNT
                    cells[2, k, i] += both // COUNT
        by_node = packing.by_feature(cells.reshape(-1, len(packing.sizes), BYTE))
        yield by_node.reshape(3, len(boxes), -1), loss, held

    parts = blocks.mapPartitions(summed)
    if parts.getNumPartitions() <= FEW_FILES:
        found, loss, held = parts.reduce(added)
    else:
        found, loss, held = _shuffled_sums(spark, parts, (3, len(wanted), layout.total))
    cells = np.moveaxis(found, 0, 2)
    return dict(zip(wanted, cells, strict=True)), loss / SCALE / held if held else None


def _shuffled_sums(
    spark: SparkSession, parts: RDD, shape: tuple[int, int, int]
) -> tuple[np.ndarray, int, int]:
    """What many tasks have added up, by cell."""

    def lines(part: tuple) -> Iterator[tuple[int, int, int, int]]:
        found, loss, held = part
        flat = found.reshape(3, -1)
        filled = np.flatnonzero(flat[2])
        yield -1, loss, 0, held
        yield from zip(filled.tolist(), *flat[:, filled].tolist(), strict=True)

    schema = "cell long, g long, h long, n long"
    sent = spark.createDataFrame(parts.flatMap(lines), schema, verifySchema=False)
    summed = sent.groupBy("cell").agg(*[F.sum(c).alias(c) for c in ("g", "h", "n")]).toArrow()
    cell = summed.column("cell").to_numpy()
    values = np.stack([summed.column(c).to_numpy() for c in ("g", "h", "n")])
    found = np.zeros((3, shape[1] * shape[2]), np.int64)
    found[:, cell[cell >= 0]] = values[:, cell >= 0]
    loss, _, held = values[:, cell < 0].sum(axis=1).tolist()
    return found.reshape(shape), loss, held


def _subtrees(
    blocks: RDD,
    layout: _Layout,
    tree: Tree,
    wanted: dict[int, int],
    params: HistogramBoostingParams,
    sizes: dict[int, int],
) -> dict[int, list[_Node]]:
    """The subtrees of the wanted nodes, each of at most so many leaves and grown by the task that
    its rows are sent to; sizes: how many rows a node has."""
    boxes = dict(zip(wanted, _boxes(layout.packing, tree, list(wanted)), strict=True))
    tasks = blocks.getNumPartitions()
    load, to = [0] * tasks, {}
    for number in sorted(wanted, key=lambda i: -sizes[i]):
        to[number] = min(range(tasks), key=load.__getitem__)
        load[to[number]] += sizes[number]

    def routed(part: Iterator[Block]) -> Iterator[tuple[int, tuple]]:
        found: dict[int, list[tuple]] = {}
        for fitted, values, sign, margin in part:
            for i, box in boxes.items():
                rows = _inside(box, values, fitted)
                g, h = _gradients(sign[rows], margin[rows])
                chunk = values[:, rows], g.astype(np.int32), h.astype(np.int32)
                found.setdefault(i, []).append(chunk)
        for i, chunks in found.items():
            yield to[i], (i, *_joined(chunks))

    def grown(part: Iterator[tuple[int, tuple]]) -> Iterator[tuple[int, list[tuple]]]:
        found: dict[int, list[tuple]] = {}
        for _, (i, *chunk) in part:
            found.setdefault(i, []).append(chunk)
        while found:
            i, chunks = found.popitem()
            made = grow_rows(*_joined(chunks), wanted[i], layout, params)
            yield i, [(n.g, n.h, n.n, n.gain, n.feature, n.bin, n.below) for n in made]

    sent = blocks.mapPartitions(routed).partitionBy(tasks, lambda key: key)
    return {
        number: [
            _Node(g, h, n, None, True, gain, feature, bin_, below)
            for g, h, n, gain, feature, bin_, below in lines
        ]
        for number, lines in sent.mapPartitions(grown).collect()
    }


def _joined(chunks: list[tuple]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    values, g, h = zip(*chunks, strict=True)
    return np.concatenate(values, axis=1), np.concatenate(g), np.concatenate(h)


def _stopped(losses: list[float], params: HistogramBoostingParams) -> bool:
    """No loss of the last rounds is better than the one before them by more than the tolerance."""
    if len(losses) <= params.patience:
        return False
    return min(losses[-params.patience :]) >= losses[-params.patience - 1] - params.tolerance


def fit_trees(
    rows: DataFrame,
    features: list[str],
    label: str,
    held_out: Column,
    params: HistogramBoostingParams = HistogramBoostingParams(),
) -> HistogramTreesModel:
    """Boosted trees on numeric features without missing values, for a label of 0 and 1.

    Rows where ``held_out`` holds only decide when to stop; without any, all rounds are run. Where
    the rows to fit have one label only, or there are none, the model is a constant.
    """
    spark = rows.sparkSession
    area = f"{shared_folder(spark)}/wayfunnel-{spark.sparkContext.applicationId}/boosting-{uuid.uuid4().hex}"
    chosen = [
        *[F.col(c).cast("double").alias(f"f{i}") for i, c in enumerate(features)],
        F.col(label).cast("int").alias("label"),
        F.coalesce(held_out, F.lit(False)).alias("held_out"),
    ]
    rows = rows.select(*chosen)
    fitted = rows.where("not held_out")
    edges = bin_edges(fitted, [f"f{i}" for i in range(len(features))], params.max_bins)
    count = fitted.agg(F.count("label").alias("n"), F.sum("label").alias("ones")).first()
    share = (count["ones"] or 0) / count["n"] if count["n"] else 0.5
    start = math.log(max(share, 1e-15) / max(1 - share, 1e-15))
    layout, trees, losses = _Layout([len(e) + 1 for e in edges]), [], []
    if not 0 < share < 1 or not count["n"]:
        return HistogramTreesModel.of(features, edges, start, trees)

    ensure_checkpoints(spark)
    unlabelled = F.raise_error(F.lit("a row to fit trees on has no label"))
    labelled = rows.withColumn("label", F.coalesce("label", unlabelled.cast("int")))
    stored = stored_blocks(labelled, edges, layout.packing, f"{area}/blocks")
    total = stored.agg(F.sum(F.octet_length("sign"))).first()[0]
    tasks = max(spark.sparkContext.defaultParallelism, -(-total // TASK_ROWS))
    blocks = dealt_blocks(stored, tasks, start).persist(StorageLevel.MEMORY_AND_DISK_DESER)

    alone = Tree(*[np.array([i]) for i in (-1, -1, -1, -1)], np.zeros(1))
    for number in range(params.rounds):
        before = None
        if trees:
            before, blocks = blocks, moved_by(blocks, layout.packing, trees[-1], trees[-1].depth)
            blocks.persist(StorageLevel.MEMORY_AND_DISK_DESER)
            if number % params.rewrite_rounds == 0:
                blocks.checkpoint()
        cells, loss = _sums(spark, blocks, layout, alone, [0])
        if before:
            before.unpersist()
        if loss is not None:
            losses.append(loss)
            if _stopped(losses, params):
                break
        nodes = [_Node(*cells[0][: layout.widths[0]].sum(axis=0).tolist(), cells[0])]
        _consider(nodes, 0, layout, params)

        def add_up(tree: Tree, wanted: list[int], blocks=blocks) -> dict[int, np.ndarray]:
            return _sums(spark, blocks, layout, tree, wanted)[0]

        def finish(tree: Tree, wanted: dict[int, int], blocks=blocks, nodes=nodes):
            sizes = {i: nodes[i].n for i in wanted}
            return _subtrees(blocks, layout, tree, wanted, params, sizes)

        tree = grow(nodes, layout, params, add_up, finish)
        if tree.left[0] < 0:
            break
        trees.append(_compact(tree))
    blocks.unpersist()
    return HistogramTreesModel.of(features, edges, start, trees)


def _compact(tree: Tree) -> Tree:
    """Without the nodes that no row reaches."""
    kept, found = [0], 0
    while found < len(kept):
        node = kept[found]
        if tree.left[node] >= 0:
            kept += [int(tree.left[node]), int(tree.right[node])]
        found += 1
    number = np.full(len(tree.left) + 1, -1, np.int64)
    number[kept] = np.arange(len(kept))
    return Tree(
        tree.feature[kept],
        tree.bin[kept],
        number[tree.left[kept]],
        number[tree.right[kept]],
        tree.value[kept],
    )
