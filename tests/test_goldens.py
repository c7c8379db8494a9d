"""Published results that can be recomputed from published counts."""

from pyspark.sql import functions as F

from wayfunnel.functions.measures import rate_pct, round_to
from wayfunnel.operators import evaluation, models
from wayfunnel.schemas import CONTRACT

# Device, customer type, logged in, searches, bookings, conversion %.
SEGMENTS = [
    ("Mobile Web", "New", 0, 15238, 3900, 25.59),
    ("iOS App", "New", 0, 21288, 5744, 26.98),
    ("Android App", "New", 0, 17633, 4789, 27.16),
    ("Desktop Web", "New", 0, 17220, 4757, 27.62),
    ("Mobile Web", "New", 1, 5874, 1641, 27.94),
    ("Desktop Web", "New", 1, 6806, 1938, 28.47),
    ("Mobile Web", "Returning", 0, 6115, 1785, 29.19),
    ("Android App", "Returning", 0, 7332, 2175, 29.66),
    ("Desktop Web", "Returning", 0, 6880, 2043, 29.69),
    ("Android App", "New", 1, 6841, 2044, 29.88),
    ("iOS App", "Returning", 0, 8841, 2674, 30.25),
    ("iOS App", "New", 1, 8422, 2549, 30.27),
    ("Mobile Web", "Returning", 1, 27491, 8380, 30.48),
    ("iOS App", "Returning", 1, 39789, 12612, 31.7),
    ("Android App", "Returning", 1, 33333, 10613, 31.84),
    ("Desktop Web", "Returning", 1, 31621, 10115, 31.99),
]

# Numerator, denominator, published percentage.
RATES = [
    (245731, 260724, 94.25),
    (121427, 245731, 49.41),
    (77759, 121427, 64.04),
    (77759, 260724, 29.82),
    (14993, 260724, 5.75),
    (396, 1454, 27.24),
    (422, 1466, 28.79),
    (381, 1370, 27.81),
    (414, 1454, 28.47),
    (415, 1488, 27.89),
    (355, 1308, 27.14),
    (358, 1357, 26.38),
    (384, 1476, 26.02),
    (10, 38, 26.32),
]

# Threshold and F1 of the published threshold table.
THRESHOLDS = [
    (0.10, 0.48152894634200705),
    (0.15, 0.48152894634200705),
    (0.20, 0.48152894634200705),
    (0.25, 0.48209110930798654),
    (0.30, 0.43855193999881886),
    (0.35, 0.3637190082644628),
    (0.40, 0.21616701746401956),
    (0.45, 0.000616617851086789),
    *[(t / 100, 0.0) for t in range(50, 85, 5)],
]

# Model, ROC-AUC and average precision on the validation rows.
COMPARISON = [
    ("Dummy Baseline", 0.5, 0.30107238605898123),
    ("Histogram Gradient Boosting", 0.597950244618865, 0.37058385082277023),
    ("Logistic Regression", 0.6013572258612668, 0.37145246962460443),
]


def test_published_rates(spark):
    rows = RATES + [(b, s, pct) for *_, s, b, pct in SEGMENTS]
    frame = spark.createDataFrame(rows, "a bigint, b bigint, published double")
    wrong = frame.where(rate_pct(F.col("a"), F.col("b")) != F.col("published"))
    assert wrong.collect() == []


def test_published_totals():
    assert sum(s for *_, s, _, _ in SEGMENTS) == 260724
    assert sum(b for *_, b, _ in SEGMENTS) == 77759


def test_published_order_value(spark):
    value = spark.range(1).select(round_to(F.lit(5119154.52) / 77759)).first()[0]
    assert value == 65.83


def test_published_best_threshold(spark):
    table = spark.createDataFrame(THRESHOLDS, "threshold double, f1 double").repartition(4)
    assert evaluation.best_threshold(table).first()["threshold"] == 0.25
    ties = table.where("threshold < 0.25")
    assert evaluation.best_threshold(ties).first()["threshold"] == 0.10


def test_published_champion(spark):
    table = spark.createDataFrame(COMPARISON, "model string, roc_auc double, pr_auc double")
    assert models.champion_name(table) == models.LOGISTIC


def test_contract_has_six_datasets_with_keys():
    assert set(CONTRACT) == {
        "sessions",
        "searches",
        "journey_results",
        "checkout",
        "bookings",
        "station_reference",
    }
    for dataset in CONTRACT.values():
        columns = [name for name, _ in dataset.columns]
        assert dataset.primary_key in columns and dataset.grain
        for key in dataset.foreign_keys:
            assert key.column in columns and CONTRACT[key.parent].primary_key == key.column
