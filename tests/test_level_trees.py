"""Level-wise boosting against Spark's own trees, its passes, and awkward inputs."""

from dataclasses import replace

import numpy as np
import pytest
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F
from test_boosting import frame, made_up, scores

from wayfunnel.operators import level_trees
from wayfunnel.settings import BoostingParams

SMALL = BoostingParams(rounds=6, max_depth=3, min_rows_per_leaf=5, step_size=0.3)
HELD_OUT = "id % 7 = 0"


def fit(rows, params, held_out=HELD_OUT):
    names = [c for c in rows.columns if c.startswith("x")]
    return level_trees.fit_level_trees(rows, names, "y", F.expr(held_out), params)


def sparks_own(rows, params):
    """(trees, scores) of ``GBTClassifier`` on the same rows."""
    names = [c for c in rows.columns if c.startswith("x")]
    inputs = VectorAssembler(inputCols=names, outputCol="features").transform(rows)
    model = GBTClassifier(
        featuresCol="features",
        labelCol="y",
        stepSize=params.step_size,
        maxIter=params.rounds,
        maxDepth=params.max_depth,
        minInstancesPerNode=params.min_rows_per_leaf,
        maxBins=params.max_bins,
        validationIndicatorCol="held_out",
        validationTol=params.validation_tolerance,
        seed=42,
    ).fit(inputs.withColumn("held_out", F.expr(HELD_OUT)))
    chance = vector_to_array("probability")[1].alias("score")
    found = model.transform(inputs).select("id", chance).orderBy("id").collect()
    return model.getNumTrees, np.array([r["score"] for r in found])


@pytest.mark.parametrize(
    "params",
    [SMALL, replace(SMALL, rounds=12, max_depth=5, min_rows_per_leaf=40), replace(SMALL, rounds=1)],
)
def test_trees_are_those_of_spark(spark, params):
    rows = frame(spark, *made_up(3000, 3))
    model = fit(rows, params)
    trees, expected = sparks_own(rows, params)
    assert model.tree_count == trees
    assert np.abs(scores(model, rows) - expected).max() < 1e-6


def test_it_stops_when_sparks_own_does(spark):
    x, _ = made_up(1500, 3)
    rows = frame(spark, x, np.random.default_rng(9).integers(0, 2, 1500))
    params = replace(SMALL, rounds=40)
    model = fit(rows, params)
    trees, expected = sparks_own(rows, params)
    assert model.tree_count == trees < 40
    assert np.abs(scores(model, rows) - expected).max() < 1e-6


def test_trees_do_not_depend_on_how_rows_are_dealt(spark, monkeypatch):
    rows = frame(spark, *made_up(2000, 2))
    made = set()
    for parts, task_rows, few, cut in ((1, 4_000_000, 64, 25), (6, 300, 0, 2), (3, 900, 64, 1)):
        monkeypatch.setattr(level_trees, "TASK_ROWS", task_rows)
        monkeypatch.setattr(level_trees, "FEW_FILES", few)
        monkeypatch.setattr(level_trees, "CHECKPOINT_ROUNDS", cut)
        made.add(fit(rows.repartition(parts), SMALL).getOrDefault("ensemble"))
    assert len(made) == 1


def test_a_round_is_one_pass_a_level_without_a_shuffle(spark):
    """Stages that six more rounds add; Spark's own trees take two a level and more for the rest."""
    rows = frame(spark, *made_up(3000, 3))
    context = spark.sparkContext

    def stages(rounds):
        group = f"rounds-{rounds}"
        context.setJobGroup(group, group)
        assert fit(rows, replace(SMALL, rounds=rounds, validation_tolerance=-9.0)).tree_count == rounds
        status = context.statusTracker()
        jobs = [status.getJobInfo(job) for job in status.getJobIdsForGroup(group)]
        found = [status.getStageInfo(stage) for job in jobs for stage in job.stageIds]
        return sum(stage is not None and stage.numCompletedTasks > 0 for stage in found)

    try:
        assert stages(8) - stages(2) <= 6 * SMALL.max_depth
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)


def test_features_of_few_bins_share_bytes():
    widths = [4, 256, 1, 25, 2, 61, 5, 7]
    packing = level_trees._Packing(widths)
    draw = np.random.default_rng(1)
    bins = np.column_stack([draw.integers(0, w, 5000) for w in widths]).astype(np.uint8)
    values = packing.packed(bins)
    assert len(values) == 4 and max(packing.sizes) <= 256
    joint = np.stack([np.bincount(row, minlength=256) for row in values])[None]
    counted = [np.bincount(bins[:, i], minlength=w) for i, w in enumerate(widths)]
    assert (packing.by_feature(joint)[0] == np.concatenate(counted)).all()


def test_both_ways_of_scoring_agree_also_when_loaded(spark, monkeypatch, tmp_path):
    rows = frame(spark, *made_up(600, 4))
    model = fit(rows, SMALL)
    model.write().overwrite().save(str(tmp_path / "model"))
    loaded = level_trees.LevelTreesModel.load(str(tmp_path / "model"))
    gaps = rows.withColumn("x1", F.expr("nullif(x1, 20)")).withColumn(
        "x0", F.expr("if(id % 5 = 0, double('nan'), x0)")
    )
    found = []
    for few, planned in ((1000, False), (0, True)):
        monkeypatch.setattr(level_trees, "FEW_SPLITS", few)
        plan = loaded.transform(gaps)._jdf.queryExecution().executedPlan().toString()
        assert ("EvalPython" in plan) == planned
        found.append(scores(loaded, gaps))
    assert np.abs(found[0] - found[1]).max() < 1e-12


def test_rows_that_teach_nothing(spark):
    rows = frame(spark, *made_up(300, 4))
    ones = scores(fit(rows.withColumn("y", F.lit(1)), SMALL), rows)
    assert (ones > 0.85).all() and len(set(ones)) == 1
    assert (scores(fit(rows.where("false"), SMALL), rows) == 0.5).all()
    assert fit(rows, SMALL, "false").tree_count == SMALL.rounds
    with pytest.raises(ValueError, match="max_bins"):
        fit(rows, replace(SMALL, max_bins=300))
