"""Evaluation operators against NumPy brute force: spread scores, heavy ties, small inputs."""

import hashlib
import math

import numpy as np
import pytest
from conftest import one
from hypothesis import given, settings
from hypothesis import strategies as st

from wayfunnel.operators import evaluation as e
from wayfunnel.operators import quantiles
from wayfunnel.operators.curves import score_counts, score_curve

SCHEMA = "search_id string, score double, label int"


def frame(spark, scores, labels):
    rows = [(f"Q{i}", float(s), int(y)) for i, (s, y) in enumerate(zip(scores, labels))]
    return spark.createDataFrame(rows, SCHEMA)


def samples(n=700, seed=3):
    """(name, scores, labels): continuous, a third of the rows on one score, few values, one."""
    random = np.random.default_rng(seed)
    labels = random.integers(0, 2, n)
    spread = np.clip(0.3 + 0.05 * labels + 0.1 * random.standard_normal(n), 0, 1)
    hot = np.where(random.random(n) < 0.4, 0.3, spread)
    few = np.round(spread, 1)
    return [
        ("spread", spread, labels),
        ("hot", hot, labels),
        ("few", few, labels),
        ("constant", np.full(n, 0.25), labels),
        ("bunched", 0.5 + spread * 1e-7, labels),
        ("rare", spread * 1e-5, labels),
    ]


def ranked(scores, ids):
    """Row order: score descending, then md5 of the id, then the id."""
    def tie(i):
        return (-scores[i], hashlib.md5(ids[i].encode()).hexdigest(), ids[i])

    return sorted(range(len(scores)), key=tie)


def brute_metrics(p, y):
    values = np.unique(p)[::-1]
    cum_n = np.array([(p >= v).sum() for v in values])
    cum_tp = np.array([y[p >= v].sum() for v in values])
    tp = np.diff(np.concatenate([[0], cum_tp]))
    ap = float((tp / y.sum() * cum_tp / cum_n).sum())
    positive, negative = p[y == 1], p[y == 0]
    pairs = (positive[:, None] > negative).sum() + 0.5 * (positive[:, None] == negative).sum()
    chosen = p >= 0.5
    hits = int((chosen & (y == 1)).sum())
    precision = hits / chosen.sum() if chosen.any() else 0.0
    recall = hits / y.sum()
    return {
        "roc_auc": pairs / (len(positive) * len(negative)),
        "pr_auc": ap,
        "log_loss": float(-(y * np.log(p) + (1 - y) * np.log(1 - p)).mean()),
        "brier_score": float(((p - y) ** 2).mean()),
        "accuracy": float((chosen == (y == 1)).mean()),
        "precision_050": precision,
        "recall_050": recall,
        "f1_050": 2 * precision * recall / (precision + recall) if hits else 0.0,
    }


@pytest.mark.parametrize("name,p,y", samples(), ids=[s[0] for s in samples()])
def test_metrics_against_brute_force(spark, name, p, y):
    p = np.clip(p, 1e-6, 1 - 1e-6)
    assert one(e.model_metrics(frame(spark, p, y))) == pytest.approx(brute_metrics(p, y))


def test_metric_edge_cases(spark):
    perfect = one(e.model_metrics(frame(spark, [1.0, 0.0], [1, 0])))
    assert perfect["roc_auc"] == 1 and perfect["log_loss"] == pytest.approx(0, abs=1e-12)
    negatives = one(e.model_metrics(frame(spark, [0.6, 0.2], [0, 0])))
    assert negatives["roc_auc"] is None and negatives["pr_auc"] is None
    assert (negatives["precision_050"], negatives["recall_050"], negatives["f1_050"]) == (0, 0, 0)
    assert math.isfinite(one(e.model_metrics(frame(spark, [0.0, 1.0], [1, 0])))["log_loss"])
    rows = e.as_metric_rows(e.model_metrics(frame(spark, [0.4, 0.6], [0, 1]))).collect()
    assert [r["metric"] for r in rows] == list(e.METRICS)


def test_cells_keep_the_order_of_scores_and_spread_rare_ones(spark):
    from pyspark.sql import functions as F

    from wayfunnel.operators.curves import CELLS, _grid

    p = np.sort(np.concatenate([np.random.default_rng(5).random(2000) ** 6, [0.0, 1.0, 1e-300]]))
    rows = spark.createDataFrame([(float(v),) for v in p], "score double")
    cells = [r[0] for r in rows.select(_grid(F.col("score"), CELLS)).coalesce(1).collect()]
    assert cells == sorted(cells) and min(cells) == 0 and max(cells) == CELLS - 1
    rare = rows.where("score between 1e-6 and 1e-4").select(_grid(F.col("score"), CELLS))
    assert rare.distinct().count() > 0.9 * rare.count() > 50


def test_cells_follow_narrow_bands_and_outliers(spark):
    from pyspark.sql import functions as F

    from wayfunnel.operators.curves import score_cells

    band = [(0.3 + 1e-4 * i / 20_000, 1, i % 2) for i in range(20_000)]
    counts = spark.createDataFrame([*band, (-5.0, 1, 0), (9.0, 1, 1)], "score double, n long, pos long")
    cells = score_cells(counts)
    assert cells.agg(F.count_distinct("cell")).first()[0] > 10_000
    assert cells.groupBy("cell").count().agg(F.max("count")).first()[0] < 20
    ordered = [r["cell"] for r in cells.orderBy("score").collect()]
    assert ordered == sorted(ordered)

    values = [("f", 1e-4 * i / 20_000, 1) for i in range(20_000)] + [("f", 1e9, 1)]
    counted = spark.createDataFrame(values, "feature string, value double, n long")
    spread = quantiles.value_cells(counted, "feature")
    assert spread.agg(F.count_distinct("cell")).first()[0] > 10_000
    median = quantiles.grouped_quantiles(counted, "feature", [0.5]).first()["quantile"]
    assert median == pytest.approx(float(np.median([v for _, v, _ in values])), rel=1e-12)


def test_scores_outside_the_unit_interval_stay_exact(spark):
    p, y = np.array([-3.0, 7.0, 7.5, 0.5, 2.0, -9.0]), np.array([0, 1, 0, 1, 1, 0])
    curve = score_curve(score_counts(frame(spark, p, y))).orderBy("score").collect()
    assert [r["cum_n"] for r in curve] == [6, 5, 4, 3, 2, 1]
    assert [r["cum_pos"] for r in curve] == [3, 3, 3, 2, 1, 0]


@pytest.mark.parametrize("name,p,y", samples(), ids=[s[0] for s in samples()])
def test_deciles_and_lift_against_a_full_sort(spark, name, p, y):
    n, scored = len(p), frame(spark, p, y)
    order = ranked(p, [f"Q{i}" for i in range(n)])
    cuts = np.quantile(np.arange(n), np.linspace(0, 1, 11))
    decile = np.clip(np.searchsorted(cuts, np.arange(n), side="left"), 1, 10)
    table = {r["decile"]: r for r in e.decile_analysis(scored).collect()}
    assert sorted(table) == list(range(1, 11))
    for d, row in table.items():
        members = [order[i] for i in np.flatnonzero(decile == d)]
        assert row["searches"] == len(members)
        assert row["bookings"] == y[members].sum()
        assert row["avg_predicted_probability"] == pytest.approx(p[members].mean())
    top = [order[i] for i in range(max(1, int(n * 0.10)))]
    lift = one(e.top_decile_lift(scored))
    assert lift["top_decile_lift"] == pytest.approx(y[top].mean() / y.mean(), abs=6e-4)


def test_decile_sizes_of_an_uneven_total(spark):
    from pyspark.sql import functions as F

    ranks = spark.range(43352).select(
        e._quantile_cut(10)(F.col("id"), F.lit(43352)).alias("decile")
    )
    sizes = {r["decile"]: r["count"] for r in ranks.groupBy("decile").count().collect()}
    assert [sizes[d] for d in range(1, 11)] == [4336] + [4335] * 8 + [4336]


@pytest.mark.parametrize("n", [1, 2, 5])
def test_fewer_rows_than_deciles(spark, n):
    scored = frame(spark, np.linspace(0.1, 0.9, n), [1] * n)
    assert sum(r["searches"] for r in e.decile_analysis(scored).collect()) == n
    assert one(e.top_decile_lift(scored))["top_decile_lift"] == 1.0


def test_lift_without_positives_is_zero(spark):
    assert one(e.top_decile_lift(frame(spark, [0.1, 0.9], [0, 0])))["top_decile_lift"] == 0.0


def test_thresholds_are_compared_unrounded(spark):
    # 0.15 is below the second threshold, 0.15000000000000002
    table = e.threshold_analysis(frame(spark, [0.15, 0.9], [1, 0])).orderBy("threshold").collect()
    assert len(table) == 15
    assert (table[0]["threshold"], table[0]["recall"]) == (0.1, 1.0)
    assert (table[1]["threshold"], table[1]["recall"]) == (0.15, 0.0)
    assert table[-1]["predicted_positive_rate_pct"] == 50.0


def test_threshold_table_and_best_threshold(spark):
    _, p, y = samples()[0]
    table = e.threshold_analysis(frame(spark, p, y))
    for row in table.collect():
        exact = 0.1 + round((row["threshold"] - 0.1) / 0.05) * ((0.1 + 0.05) - 0.1)
        chosen = p >= exact
        hits = (chosen & (y == 1)).sum()
        assert row["precision"] == pytest.approx(hits / chosen.sum() if chosen.any() else 0)
        assert row["recall"] == pytest.approx(hits / y.sum())
    best = max(r["f1"] for r in table.collect())
    lowest = min(r["threshold"] for r in table.collect() if r["f1"] == best)
    assert one(e.best_threshold(table))["threshold"] == lowest


@pytest.mark.parametrize("name,p,y", samples(), ids=[s[0] for s in samples()])
def test_calibration_against_numpy(spark, name, p, y):
    edges = np.percentile(p, np.linspace(0, 1, 11) * 100)
    bins = np.searchsorted(edges[1:-1], p)
    rows = {r["bin"]: r for r in e.calibration(frame(spark, p, y)).collect()}
    assert sorted(rows) == sorted(set(bins.tolist()))
    for b, row in rows.items():
        assert row["mean_predicted_probability"] == pytest.approx(p[bins == b].mean())
        assert row["observed_booking_rate"] == pytest.approx(y[bins == b].mean())


def test_curve_points(spark):
    _, p, y = samples()[2]
    for row in e.roc_curve(frame(spark, p, y)).collect():
        chosen = p >= row["threshold"]
        assert row["tpr"] == pytest.approx(y[chosen].sum() / y.sum())
        assert row["fpr"] == pytest.approx((1 - y[chosen]).sum() / (1 - y).sum())
    for row in e.pr_curve(frame(spark, p, y)).collect():
        chosen = p >= row["threshold"]
        assert row["precision"] == pytest.approx(y[chosen].mean())


@settings(max_examples=12, deadline=None)
@given(
    st.lists(
        st.one_of(st.integers(-5, 5).map(float), st.floats(-1e6, 1e6, allow_nan=False)),
        min_size=1,
        max_size=60,
    ),
    st.sampled_from([4, 64, 65_536]),
)
def test_quantiles_against_numpy(spark, values, cells):
    counts = (
        spark.createDataFrame([("f", v) for v in values], "feature string, value double")
        .groupBy("feature", "value")
        .count()
        .withColumnRenamed("count", "n")
    )
    wanted = [0.0, 0.1, 0.5, 0.9, 1.0]
    rows = quantiles.grouped_quantiles(counts, "feature", wanted, cells).collect()
    found = {r["probability"]: r["quantile"] for r in rows}
    for q in wanted:
        assert found[q] == pytest.approx(float(np.quantile(values, q)), rel=1e-9, abs=1e-9)


def test_a_band_beside_an_outlier_is_cut_again(spark):
    from pyspark.sql import functions as F

    from wayfunnel.operators.curves import score_cells

    step = np.spacing(0.3)
    band = spark.range(200_000).select((F.lit(0.3) + F.col("id") * 9 * step).alias("score"))
    counts = band.union(spark.createDataFrame([(0.30001,)], "score double"))
    assert band.agg(F.max("score") - F.min("score")).first()[0] < 1.1e-10
    counts = counts.select("score", F.lit(1).alias("n"), F.lit(0).alias("pos"))
    cells = score_cells(counts)
    assert cells.agg(F.count_distinct("cell")).first()[0] > 1000
    assert cells.groupBy("cell").count().agg(F.max("count")).first()[0] < 100
    ordered = [r["cell"] for r in cells.orderBy("score").collect()]
    assert ordered == sorted(ordered)
