import numpy as np
import pytest
from conftest import one
from pyspark.sql import functions as F

from fixtures.derive import SPLIT
from wayfunnel.operators import evaluation, features, models
from wayfunnel.settings import CATEGORICAL_FEATURES, FEATURES, NUMERIC_FEATURES, TARGET
from wayfunnel.settings import BoostingParams, ModelParams

PARAMS = ModelParams(boosting=BoostingParams(rounds=5))


@pytest.fixture(scope="module")
def parts(j):
    """Splits with a label that depends on two features; the given data's label is mere noise."""
    draw = F.abs(F.xxhash64("search_id")) % 100
    chance = F.when(F.col("results_count") > 0, 20 + 40 * F.col("railcard_used")).otherwise(0)
    planted = j.dataset.withColumn(TARGET, F.when(draw < chance, 1).otherwise(0))
    return features.temporal_split(planted, SPLIT)


@pytest.fixture(scope="module")
def logistic(parts):
    return models.fit_logistic(parts[0], PARAMS)


def newton(train, test):
    """L2 logistic regression on summed losses, unpenalised intercept, by Newton steps."""
    levels = {c: sorted(train[c].unique()) for c in CATEGORICAL_FEATURES}

    def design(rows):
        onehot = [
            (rows[c].to_numpy() == level).astype(float)
            for c in CATEGORICAL_FEATURES
            for level in levels[c]
        ]
        numbers = [
            (rows[c] - train[c].mean()) / (train[c].std(ddof=1) or 1.0)
            for c in NUMERIC_FEATURES
        ]
        return np.column_stack([np.ones(len(rows)), *onehot, *numbers])

    x, y = design(train), train[TARGET].to_numpy()
    penalty = np.eye(x.shape[1])
    penalty[0, 0] = 0
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-x @ w))
        gradient = x.T @ (p - y) + penalty @ w
        hessian = (x * (p * (1 - p))[:, None]).T @ x + penalty
        w -= np.linalg.solve(hessian + 1e-9 * np.eye(len(w)), gradient)
    return 1 / (1 + np.exp(-design(test) @ w))


def test_logistic_solves_the_summed_loss_objective(parts, logistic):
    train, _, test = (part.toPandas() for part in parts)
    scored = models.probability(logistic, parts[2]).toPandas().set_index("search_id")["score"]
    expected = newton(train, test)
    assert np.abs(scored.loc[test["search_id"]].to_numpy() - expected).max() < 2e-5


def test_logistic_beats_the_prior_and_knows_empty_results(parts, logistic):
    train, holdout, _ = parts
    scored = models.probability(logistic, holdout)
    prior = models.probability(models.fit_prior(train), holdout)
    better = one(evaluation.model_metrics(scored, label=TARGET))["pr_auc"]
    base = one(evaluation.model_metrics(prior, label=TARGET))
    assert better > base["pr_auc"] and base["roc_auc"] == 0.5
    means = {r[0]: r[1] for r in scored.groupBy("zero_results_flag").agg(F.avg("score")).collect()}
    assert means[1] < means[0]
    bounds = one(scored.agg(F.min("score").alias("low"), F.max("score").alias("high")))
    assert 0 <= bounds["low"] and bounds["high"] <= 1


def test_unseen_and_missing_values_are_scored(parts, logistic):
    rows = parts[2].limit(20)
    strange = rows.withColumns(
        {c: F.lit("never seen") for c in CATEGORICAL_FEATURES}
        | {"passengers": F.lit(None).cast("int")}
    )
    scores = [r[0] for r in models.probability(logistic, strange).select("score").collect()]
    assert len(scores) == 20 and all(0 < s < 1 for s in scores)


def test_fill_values_may_contain_quotes(parts):
    name = "St. John's \\ \"North\""
    train = parts[0].withColumn("origin_station", F.lit(name))
    rows = parts[2].limit(1).withColumns(
        {"origin_station": F.lit(None).cast("string"), "results_count": F.lit(None).cast("int")}
    )
    filled = models._imputer(train).transform(rows).first()
    assert filled["origin_station_filled"] == name
    median = np.median([r[0] for r in train.select("results_count").collect()])
    assert filled["results_count_filled"] == median


def test_prior_is_the_training_rate(parts):
    rate = one(parts[0].agg(F.avg(TARGET).alias("rate")))["rate"]
    lazy = models.prior_scores(parts[0], parts[1]).select("score").distinct().collect()
    assert [r[0] for r in lazy] == [rate]


def test_comparison_refit_save_load_and_batch_scores(parts, logistic, tmp_path):
    train, holdout, test = parts
    candidates = [
        models.fit_candidate(models.PRIOR, train),
        models.Candidate(models.LOGISTIC, logistic),
        models.fit_candidate(models.BOOSTED, train, PARAMS),
    ]
    comparison = models.model_comparison(candidates, holdout)
    table = comparison.toPandas()
    assert list(table["pr_auc"]) == sorted(table["pr_auc"], reverse=True)
    name = models.champion_name(comparison)
    assert name == table["model"][0] != models.PRIOR

    champion = models.refit(models.PRIOR, train, holdout)
    models.save_model(champion.model, str(tmp_path / "prior"))
    models.save_model(logistic, str(tmp_path / "model"))
    loaded = models.probability(models.load_model(str(tmp_path / "prior")), test)
    both = one(train.unionByName(holdout).agg(F.avg(TARGET).alias("rate")))["rate"]
    assert one(loaded.select("score").distinct())["score"] == pytest.approx(both)

    scored = models.probability(models.load_model(str(tmp_path / "model")), test)
    batch = models.batch_scores(scored, models.LOGISTIC, 0.25).toPandas()
    assert len(batch) == test.count()
    assert ((batch["booking_probability"] >= 0.25) == (batch["predicted_booking"] == 1)).all()
    assert set(batch["model_name"]) == {models.LOGISTIC}
    sink = models.predictions(scored)
    assert sink.columns == [
        "search_id",
        "searched_at",
        TARGET,
        "booking_probability",
        "predicted_booking_050",
    ]


def test_model_info(parts, logistic):
    metrics = evaluation.model_metrics(models.probability(logistic, parts[2]), label=TARGET)
    info = one(models.model_info(models.LOGISTIC, metrics, 0.25))
    assert info["feature_count"] == 18 == len(info["features"])
    assert info["features"] == list(FEATURES) and 0 < info["threshold"] <= 1
    assert set(info["test_metrics"]) == set(evaluation.METRICS)
