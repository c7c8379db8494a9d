"""Boosted trees grown level by level on first-order residuals, as Spark's ``GBTClassifier`` fits them.

Rows are binned once, by all of them, and held in blocks (``row_blocks.py``). A round is one
pass for each level and no shuffle: of the two children of a node only the smaller is added up, the
other is the difference. The pass for a root also moves the margins by the last tree and adds up the
held-out rows' loss. What a task sends is sums per (node, feature, bin), whatever its rows.

Blocks stay in memory or on executors' disks between passes; every few rounds they are checkpointed,
which bounds what a lost executor makes the others do again. Residuals are summed as whole numbers
(in 2 ** -24), so that trees depend neither on the order of tasks nor on how rows are dealt.
"""

from __future__ import annotations

import json
import sys
import uuid
from collections.abc import Callable, Iterator

import numpy as np
from pyspark import RDD, StorageLevel, cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayfunnel.operators.boosting import FEW_FILES, SCALE, HistogramTreesModel, bin_edges
from wayfunnel.operators.row_blocks import (
    BYTE,
    TASK_ROWS,
    Block,
    Packing,
    Tree,
    added,
    dealt_blocks,
    leaves,
    moved_by,
    stored_blocks,
)
from wayfunnel.settings import BoostingParams
from wayfunnel.sources.workarea import ensure_checkpoints, shared_folder

# functions that run in Python workers travel with the job: executors need not have this library
cloudpickle.register_pickle_by_value(sys.modules[__name__])

FEW_SPLITS = 64  # of all trees, up to which scoring is one expression that Spark compiles
CHECKPOINT_ROUNDS = 25

_Packing = Packing


def _sums(
    blocks: RDD, packing: Packing, tree: Tree, depth: int, wanted: list[int], first: bool
) -> tuple[np.ndarray, np.ndarray, float | None]:
    """(sums of residuals, numbers of rows) by wanted node and cell, and the mean loss of the
    held-out rows. Residuals of the first tree are the signs themselves."""

    def summed(part: Iterator[Block]) -> Iterator[tuple]:
        column, after = packing.steps(tree)
        slot = np.full(len(tree.left), -1, np.int64)
        slot[wanted] = np.arange(len(wanted)) * BYTE
        size = len(wanted) * BYTE
        totals = np.zeros((len(packing.sizes), size), np.int64)
        counts = np.zeros((len(packing.sizes), size), np.int64)
        loss = held = 0
        for fitted, values, sign, margin in part:
            if not depth:  # the loss is needed once a round
                error = np.logaddexp(0, -sign[fitted:] * margin[fitted:])
                loss += int(np.rint(2 * error * SCALE).sum())
                held += len(error)
            values, sign, margin, at = values[:, :fitted], sign[:fitted], margin[:fitted], 0
            if depth:
                values = np.ascontiguousarray(values)
                at = slot[leaves(values, column, after, depth)]
                used = np.flatnonzero(at >= 0)
                values, sign, margin, at = values[:, used], sign[used], margin[used], at[used]
            residual = sign.astype(np.float64)
            if not first:
                residual = 4 * residual / (1 + np.exp(residual * margin))
            residual = np.rint(residual * SCALE)
            for i in range(len(totals)):
                place = at + values[i].astype(np.int64)
                totals[i] += np.bincount(place, residual, size).astype(np.int64)
                counts[i] += np.bincount(place, minlength=size)
        by_node = (
            packing.by_feature(part.reshape(-1, len(wanted), BYTE).swapaxes(0, 1))
            for part in (totals, counts)
        )
        yield (*by_node, loss, held)

    parts = blocks.mapPartitions(summed)
    many = parts.getNumPartitions() > FEW_FILES
    totals, counts, loss, held = parts.treeReduce(added) if many else parts.reduce(added)
    return totals, counts, loss / SCALE / held if held else None


def _best_splits(
    totals: np.ndarray, counts: np.ndarray, widths: list[int], least: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Per node (gain in squared error, feature, last bin of the left child, that child's sum and
    number of rows); ties go to the first feature and bin, gain 0 if no split is allowed."""
    ends = np.cumsum(widths)
    first = np.repeat(ends - widths, widths)

    def below(cells: np.ndarray) -> np.ndarray:
        ran = np.cumsum(cells, axis=1)
        return ran - np.pad(ran, ((0, 0), (1, 0)))[:, first]

    left, n_left = below(totals), below(counts)
    whole, n = left[:, ends[:1] - 1], n_left[:, ends[:1] - 1]
    right, n_right = whole - left, n - n_left

    def worth(sums: np.ndarray, rows: np.ndarray) -> np.ndarray:
        return (sums / SCALE) ** 2 / np.maximum(rows, 1)

    gains = worth(left, n_left) + worth(right, n_right) - worth(whole, n)
    allowed = np.minimum(n_left, n_right) >= max(least, 1)
    gains = np.where(allowed, np.maximum(gains, 0), 0)
    at, node = gains.argmax(axis=1), np.arange(len(gains))
    feature = np.searchsorted(ends, at, side="right")
    return gains[node, at], feature, at - first[at], left[node, at], n_left[node, at]


def _grown(
    totals: np.ndarray,
    counts: np.ndarray,
    packing: Packing,
    params: BoostingParams,
    step: float,
    add_up: Callable[[Tree, int, list[int]], tuple[np.ndarray, np.ndarray]],
) -> Tree:
    """A tree from the sums of its root. add_up(tree so far, its depth, nodes) gives those of more
    nodes."""
    width = packing.widths[0]
    nodes = [[-1, -1, -1, -1, int(totals[0, :width].sum()), int(counts[0, :width].sum())]]

    def tree() -> Tree:
        feature, bin_, left, right, sums, rows = (np.array(c) for c in zip(*nodes, strict=True))
        return Tree(feature, bin_, left, right, step * sums / SCALE / np.maximum(rows, 1))

    open_ = [0]
    for depth in range(params.max_depth):
        found = _best_splits(totals, counts, packing.widths, params.min_rows_per_leaf)
        asked, place = [], {}
        for i, (gain, feature, bin_, left, n_left) in enumerate(zip(*found, strict=True)):
            if gain <= 0:
                continue
            node = nodes[open_[i]]
            node[:4] = int(feature), int(bin_), len(nodes), len(nodes) + 1
            nodes.append([-1, -1, -1, -1, int(left), int(n_left)])
            nodes.append([-1, -1, -1, -1, node[4] - int(left), node[5] - int(n_left)])
            children = sorted(node[2:4], key=lambda child: nodes[child][5])
            if nodes[children[1]][5] >= 2 * params.min_rows_per_leaf:  # else neither can be split
                place[len(asked)] = (i, children[1])
                asked.append(children[0])
        if not asked or depth + 1 == params.max_depth:
            break
        smaller = add_up(tree(), depth + 1, asked)
        parents = [place[i][0] for i in range(len(asked))]
        totals, counts = (
            np.concatenate([part, whole[parents] - part])
            for part, whole in zip(smaller, (totals, counts), strict=True)
        )
        open_ = asked + [place[i][1] for i in range(len(asked))]
    return tree()


class LevelTreesModel(HistogramTreesModel):
    """Scores with an SQL expression where the trees are small, else on Arrow batches."""

    @staticmethod
    def of(features: list[str], edges: list[np.ndarray], start: float, trees: list[Tree]):
        made = HistogramTreesModel.of(features, edges, start, trees)
        return LevelTreesModel(ensemble=made.getOrDefault("ensemble"))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        parts = json.loads(self.getOrDefault(self.ensemble))
        trees, edges = parts["trees"], parts["edges"]
        if sum(child >= 0 for tree in trees for child in tree["left"]) > FEW_SPLITS:
            return super()._transform(dataset)

        def value(tree: dict[str, list], node: int) -> Column:
            if tree["left"][node] < 0:
                return F.lit(tree["value"][node])
            feature = tree["feature"][node]
            number = F.col(parts["features"][feature]).cast("double")
            goes_left = number <= F.lit(edges[feature][tree["bin"][node]])  # missing values do not
            left, right = (value(tree, tree[side][node]) for side in ("left", "right"))
            return F.when(goes_left, left).otherwise(right)

        total = sum((value(tree, 0) for tree in trees), F.lit(parts["start"]))
        return dataset.withColumn("score", 1 / (1 + F.exp(-total)))


def fit_level_trees(
    rows: DataFrame,
    features: list[str],
    label: str,
    held_out: Column,
    params: BoostingParams = BoostingParams(),
) -> LevelTreesModel:
    """Boosted trees on numeric features without missing values, for a label of 0 and 1.

    Rows where ``held_out`` holds only decide when to stop: after the first round that does not
    lower their mean loss by more than the tolerance, whose tree is dropped. Without any, all rounds
    are run. The first tree counts in full, later ones by the step size.
    """
    if params.max_bins > BYTE:
        raise ValueError(f"max_bins is {params.max_bins}, at most {BYTE} are possible")
    spark = rows.sparkSession
    context = spark.sparkContext
    ensure_checkpoints(spark)
    names = [f"f{i}" for i in range(len(features))]
    rows = rows.select(
        *[F.col(c).cast("double").alias(n) for c, n in zip(features, names, strict=True)],
        F.col(label).cast("int").alias("label"),
        F.coalesce(held_out, F.lit(False)).alias("held_out"),
    )
    edges = bin_edges(rows.where("not held_out"), names, params.max_bins)
    packing = Packing([len(e) + 1 for e in edges])

    path = f"{shared_folder(spark)}/wayfunnel-{context.applicationId}/levels-{uuid.uuid4().hex}"
    stored = stored_blocks(rows, edges, packing, path)
    sizes = stored.agg(F.sum(F.octet_length("sign")), F.sum("fitted")).first()
    if not sizes[1]:
        return LevelTreesModel.of(features, edges, 0.0, [])
    tasks = max(context.defaultParallelism, -(-sizes[0] // TASK_ROWS))
    blocks = dealt_blocks(stored, tasks, 0.0).persist(StorageLevel.MEMORY_AND_DISK)

    alone = Tree(*[np.array([-1])] * 4, np.zeros(1))
    trees: list[Tree] = []
    best = None
    totals, counts, _ = _sums(blocks, packing, alone, 0, [0], first=True)
    for number in range(params.rounds):
        step = 2 * (params.step_size if number else 1.0)  # log-odds are twice Spark's margin

        def add_up(tree: Tree, depth: int, wanted: list[int], blocks=blocks, first=not number):
            return _sums(blocks, packing, tree, depth, wanted, first)[:2]

        trees.append(_grown(totals, counts, packing, params, step, add_up))
        before, blocks = blocks, moved_by(blocks, packing, trees[-1], params.max_depth)
        blocks.persist(StorageLevel.MEMORY_AND_DISK)
        if (number + 1) % CHECKPOINT_ROUNDS == 0:
            blocks.checkpoint()
        totals, counts, loss = _sums(blocks, packing, alone, 0, [0], first=False)
        before.unpersist()
        if loss is None:
            continue
        if number and best - loss < params.validation_tolerance * max(loss, 0.01):
            trees.pop()
            break
        best = loss
    blocks.unpersist()
    return LevelTreesModel.of(features, edges, 0.0, trees)
