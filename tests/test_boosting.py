"""Histogram boosting against a plain implementation, and its parts on awkward inputs."""

import json
import subprocess
import sys
from dataclasses import replace

import numpy as np
import pytest
from pyspark import cloudpickle
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from fixtures.derive import SPLIT
from fixtures.registry import two_feature_fit
from wayfunnel.operators import boosting, evaluation, features, models, row_blocks
from wayfunnel.settings import CATEGORICAL_FEATURES, TARGET, HistogramBoostingParams, ModelParams

SMALL = HistogramBoostingParams(rounds=3, max_leaves=6, min_rows_per_leaf=5, step_size=0.5)


def made_up(n=600, seed=1):
    draw = np.random.default_rng(seed)
    x = np.column_stack([draw.integers(0, 4, n), draw.integers(0, 30, n), draw.integers(0, 2, n)])
    chance = 0.15 + 0.3 * (x[:, 0] >= 2) * x[:, 2] + 0.3 * (x[:, 1] > 17)
    return x.astype(float), (draw.random(n) < chance).astype(int)


def frame(spark, x, y):
    rows = [(i, *map(float, a), int(b)) for i, (a, b) in enumerate(zip(x, y, strict=True))]
    columns = ", ".join(f"x{i} double" for i in range(x.shape[1]))
    return spark.createDataFrame(rows, f"id long, {columns}, y int").repartition(5)


def plain(x, y, params):
    """Scores by boosting with every split tried on the rows themselves."""
    margin = np.full(len(y), np.log(y.mean() / (1 - y.mean())))
    for _ in range(params.rounds):
        p = 1 / (1 + np.exp(-margin))
        g, h = p - y, p * (1 - p)

        def worth(rows):
            return g[rows].sum() ** 2 / (h[rows].sum() + params.l2)

        def best(rows):
            found = (0.0, None)
            for f in range(x.shape[1]):
                for v in np.unique(x[rows, f])[:-1]:
                    left, right = rows[x[rows, f] <= v], rows[x[rows, f] > v]
                    if min(len(left), len(right)) < params.min_rows_per_leaf:
                        continue
                    gain = worth(left) + worth(right) - worth(rows)
                    if gain > found[0] + 1e-9:
                        found = (gain, (left, right))
            return found

        leaves = [(np.arange(len(y)), best(np.arange(len(y))))]
        while len(leaves) < params.max_leaves:
            at = max(range(len(leaves)), key=lambda i: leaves[i][1][0])
            _, (gain, parts) = leaves[at]
            if gain <= 0:
                break
            leaves[at : at + 1] = [(part, best(part)) for part in parts]
        step = np.zeros(len(y))
        for rows, _ in leaves:
            step[rows] = -params.step_size * g[rows].sum() / (h[rows].sum() + params.l2)
        margin = margin + step
    return 1 / (1 + np.exp(-margin))


def fit(rows, params, held_out=None):
    names = [c for c in rows.columns if c.startswith("x")]
    return boosting.fit_trees(rows, names, "y", F.lit(False) if held_out is None else held_out, params)


def scores(model, rows):
    return np.array([r["score"] for r in model.transform(rows).orderBy("id").collect()])


@pytest.mark.parametrize("local_rows", [100_000, 150, 0])
def test_trees_are_those_of_the_plain_implementation(spark, local_rows):
    x, y = made_up()
    rows = frame(spark, x, y)
    model = fit(rows, replace(SMALL, local_rows=local_rows))
    assert np.abs(scores(model, rows) - plain(x, y, SMALL)).max() < 1e-5
    assert model.tree_count == 3
    trees = json.loads(model.getOrDefault(model.ensemble))["trees"]
    assert all(sum(child < 0 for child in tree["left"]) <= 6 for tree in trees)


def test_trees_do_not_depend_on_how_rows_are_dealt_or_grown(spark):
    x, y = made_up(900, 2)
    rows = frame(spark, x, y)
    params = replace(SMALL, rounds=4, rewrite_rounds=2, max_leaves=12)
    held_out = F.col("id") % 7 == 0
    made = {
        fit(rows.repartition(n), replace(params, local_rows=local), held_out).getOrDefault("ensemble")
        for n, local in ((1, 100_000), (6, 0), (3, 200))
    }
    assert len(made) == 1


def test_many_values_are_binned_by_quantiles(spark):
    draw = np.random.default_rng(5)
    x = draw.normal(size=(4000, 1))
    rows = frame(spark, x, (x[:, 0] > 0.3).astype(int))
    (edges,) = boosting.bin_edges(rows, ["x0"], 16)
    assert np.allclose(edges, np.quantile(x[:, 0], np.arange(1, 16) / 16))
    few = boosting.bin_edges(rows.withColumn("x0", F.floor("x0")), ["x0"], 16)[0]
    assert set(few % 1) == {0.5}


def test_stopping(spark):
    x, y = made_up(800, 3)
    noise = np.random.default_rng(9).integers(0, 2, 800)
    rows = frame(spark, x, noise)
    params = replace(SMALL, rounds=40, patience=3, max_leaves=20)
    assert fit(rows, params, F.col("id") % 3 == 0).tree_count < 15
    assert boosting._stopped([3.0, 2.0, 2.0, 2.0, 2.0], replace(params, tolerance=0.0))
    assert not boosting._stopped([3.0, 2.0, 2.0, 2.0], replace(params, tolerance=0.0))


def test_rows_that_teach_nothing(spark):
    x, y = made_up(50, 4)
    rows = frame(spark, x, y)
    assert (scores(fit(rows.withColumn("y", F.lit(1)), SMALL), rows) > 0.999).all()
    assert (scores(fit(rows.where("false"), SMALL), rows) == 0.5).all()
    same = fit(rows.withColumns({c: F.lit(1.0) for c in ("x0", "x1", "x2")}), SMALL)
    assert np.allclose(scores(same, rows), y.mean()) and same.tree_count == 0
    assert fit(rows, SMALL).transform(rows.where("false")).count() == 0


@pytest.fixture(scope="module")
def parts(j):
    draw = F.abs(F.xxhash64("search_id")) % 100
    chance = F.when(F.col("results_count") > 0, 20 + 40 * F.col("railcard_used")).otherwise(0)
    planted = j.dataset.withColumn(TARGET, F.when(draw < chance, 1).otherwise(0))
    return features.temporal_split(planted, SPLIT)


def test_the_candidate_learns_is_saved_and_scores_unseen_values(parts, tmp_path):
    train, holdout, test = parts
    params = ModelParams(histogram=HistogramBoostingParams(rounds=12))
    fitted = models.fit_candidate(models.HISTOGRAM, train, params).model
    models.save_model(fitted, str(tmp_path / "model"))
    loaded = models.load_model(str(tmp_path / "model"))
    assert isinstance(loaded, PipelineModel)
    ours, theirs = (models.probability(m, holdout) for m in (loaded, fitted))
    assert ours.exceptAll(theirs).count() == 0
    metrics = evaluation.model_metrics(ours, label=TARGET).first()
    assert metrics["roc_auc"] > 0.65
    strange = test.limit(20).withColumns({c: F.lit("never seen") for c in CATEGORICAL_FEATURES})
    found = [r["score"] for r in models.probability(loaded, strange).collect()]
    assert len(found) == 20 and all(0 < s < 1 for s in found)


def test_the_two_feature_tree_has_three_leaves(j):
    model = two_feature_fit(j).stages[-1]
    (tree,) = json.loads(model.getOrDefault(model.ensemble))["trees"]
    assert tree["left"].count(-1) == 3


@pytest.mark.parametrize("few_files", [0, 64])
def test_sums_are_shuffled_only_from_many_files(spark, monkeypatch, few_files):
    x, y = made_up(900, 2)
    rows = frame(spark, x, y)
    monkeypatch.setattr(boosting, "FEW_FILES", few_files)
    params = replace(SMALL, local_rows=0)
    grouped = []
    real = type(rows).groupBy
    with monkeypatch.context() as patch:
        patch.setattr(
            type(rows), "groupBy", lambda f, *c: (grouped.append(c), real(f, *c))[1]
        )
        model = fit(rows, params)
    assert (("cell",) in grouped) == (few_files == 0)
    assert np.abs(scores(model, rows) - plain(x, y, params)).max() < 1e-5


def test_workers_need_not_have_the_library():
    made = cloudpickle.dumps(replace(SMALL, rounds=7))
    code = "import pickle, sys; print(pickle.load(sys.stdin.buffer).rounds)"
    alone = [sys.executable, "-I", "-c", code]
    done = subprocess.run(alone, input=made, capture_output=True, cwd="/")
    assert done.stdout.split() == [b"7"], done.stderr.decode()


@pytest.mark.parametrize("local_rows", [0, 500])
def test_a_tree_takes_a_pass_a_level_and_one_shuffle_for_the_subtrees(spark, monkeypatch, local_rows):
    x, y = made_up(4000, 6)
    calls = []
    for name in ("_sums", "_subtrees"):
        real = getattr(boosting, name)
        counted = lambda *a, real=real, name=name: (calls.append(name), real(*a))[1]
        monkeypatch.setattr(boosting, name, counted)
    params = replace(SMALL, rounds=1, max_leaves=15, local_rows=local_rows)
    model = fit(frame(spark, x, y), params)
    (tree,) = json.loads(model.getOrDefault("ensemble"))["trees"]
    assert tree["left"].count(-1) == 15
    assert calls.count("_subtrees") == (local_rows > 0)
    assert calls.count("_sums") <= boosting.Tree.from_lists(tree).depth + (local_rows == 0)
    assert np.abs(scores(model, frame(spark, x, y)) - plain(x, y, params)).max() < 1e-5


def test_boxes_hold_the_rows_of_their_nodes():
    draw = np.random.default_rng(3)
    widths = [4, 200, 2, 5]
    packing = boosting.Packing(widths)
    bins = np.stack([draw.integers(0, w, 3000) for w in widths]).astype(np.uint8)
    tree = boosting.Tree(
        *map(
            np.array,
            (
                [1, 0, 3, -1, 1, -1, -1, -1, -1],
                [90, 1, 2, -1, 40, -1, -1, -1, -1],
                [1, 3, 5, -1, 7, -1, -1, -1, -1],
                [2, 4, 6, -1, 8, -1, -1, -1, -1],
                [0.0, 0, 0, 1, 0, 2, 3, 4, 5],
            ),
        )
    )
    assert tree.depth == 3
    at = []
    for row in bins.T:
        node = 0
        while tree.left[node] >= 0:
            goes_left = row[tree.feature[node]] <= tree.bin[node]
            node = (tree.left if goes_left else tree.right)[node]
        at.append(node)
    assert np.allclose(boosting.margins(bins, [(tree, 3)], 0.5), 0.5 + tree.value[at])
    values = packing.packed(bins.T)
    for node, box in zip((3, 7, 8, 5, 6), boosting._boxes(packing, tree, [3, 7, 8, 5, 6]), strict=True):
        rows = boosting._inside(box, values, 2500)
        assert rows.tolist() == np.flatnonzero(np.array(at[:2500]) == node).tolist()


def test_rows_are_cut_into_blocks_whatever_the_batches(spark, monkeypatch):
    x, y = made_up(700, 8)
    rows = frame(spark, x, y)
    whole = fit(rows, SMALL, F.col("id") % 5 == 0).getOrDefault("ensemble")
    monkeypatch.setattr(row_blocks, "BLOCK_ROWS", 33)
    assert fit(rows, SMALL, F.col("id") % 5 == 0).getOrDefault("ensemble") == whole


def test_a_row_without_a_label_is_an_error(spark):
    rows = frame(spark, *made_up(60, 4)).withColumn("y", F.expr("if(id = 7, null, y)"))
    with pytest.raises(Exception, match="no label"):
        fit(rows, SMALL)
