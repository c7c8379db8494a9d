from datetime import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wayfunnel.operators import features, importance, models, validation
from wayfunnel.settings import CATEGORICAL_FEATURES, FEATURES, NUMERIC_FEATURES, TARGET

VALID = {
    "device_type": "iOS App",
    "operating_system": "iOS",
    "acquisition_channel": "Direct",
    "customer_type": "Returning",
    "country": "United Kingdom",
    "origin_station": "London Euston",
    "destination_station": "Manchester Piccadilly",
    "journey_type": "Single",
    "is_logged_in": 1,
    "passengers": 1,
    "railcard_used": 0,
    "results_count": 5,
    "search_latency_ms": 720.0,
    "zero_results_flag": 0,
    "days_before_travel": 10,
    "search_hour": 9,
    "day_of_week": 2,
    "search_month": 6,
}
SCHEMA = "search_id string, " + ", ".join(
    f"{f} {'string' if f in CATEGORICAL_FEATURES else 'double' if 'latency' in f else 'int'}"
    for f in FEATURES
)


def records(spark, *changes):
    rows = [
        (f"q{i}", *[change.get(f, VALID[f]) for f in FEATURES]) for i, change in enumerate(changes)
    ]
    return spark.createDataFrame(rows, SCHEMA)


def errors(spark, **change):
    frame = validation.validate_records(records(spark, change), keys=("search_id",))
    return frame.first()["errors"]


def test_model_dataset_has_no_column_from_after_the_results(j):
    assert j.dataset.columns == ["search_id", "searched_at", TARGET, *FEATURES]
    assert j.dataset.count() == j.raw("searches").count()


def test_day_of_week_starts_at_sunday(spark, j):
    sunday = j.dataset.where(F.date_format(F.col("searched_at"), "E") == "Sun")
    assert [r[0] for r in sunday.select("day_of_week").distinct().collect()] == [0]


def test_split_boundaries(spark):
    rows = spark.createDataFrame(
        [(datetime(2026, 4, 30, 23, 59, 59),), (datetime(2026, 5, 1),), (datetime(2026, 6, 1),)],
        "searched_at timestamp_ntz",
    )
    labels = [r["split"] for r in features.label_split(rows).orderBy("searched_at").collect()]
    assert labels == ["train", "validation", "test"]
    assert [part.count() for part in features.temporal_split(rows)] == [1, 1, 1]


def test_imputation_ignores_nulls_and_breaks_ties_downwards(spark):
    train = records(
        spark,
        {"country": "b", "passengers": 1},
        {"country": "a", "passengers": 4},
        {"country": None, "passengers": None},
        {"country": None, "passengers": 7},
        {"country": None, "passengers": 8},
    )
    rows = {r["feature"]: r for r in features.imputation_values(train).collect()}
    assert set(rows) == set(FEATURES)
    assert rows["country"]["text_value"] == "a"
    assert rows["passengers"]["number_value"] == 5.5
    assert rows["search_latency_ms"]["number_value"] == 720.0


def test_medians_of_given_data(j):
    rows = j.dataset.select(*NUMERIC_FEATURES).toPandas()
    for row in features.medians(j.dataset, NUMERIC_FEATURES).collect():
        assert row["number_value"] == np.median(rows[row["feature"]])


def test_valid_record(spark):
    assert errors(spark) == []


@pytest.mark.parametrize("field,low,high", [
    ("is_logged_in", 0, 1),
    ("passengers", 1, 20),
    ("railcard_used", 0, 1),
    ("days_before_travel", 0, 365),
    ("search_hour", 0, 23),
    ("day_of_week", 0, 6),
    ("search_month", 1, 12),
])
def test_range_edges(spark, field, low, high):
    changes = [{field: v} for v in (low - 1, low, high, high + 1)]
    frame = validation.validate_records(records(spark, *changes), keys=("search_id",))
    found = [r["errors"] for r in frame.orderBy("search_id").collect()]
    assert found == [[f"{field}: out of range"], [], [], [f"{field}: out of range"]]


def test_zero_flag_must_agree_with_the_count(spark):
    assert errors(spark, zero_results_flag=1) == [
        "results_count: above 0 in a search flagged empty"
    ]
    assert errors(spark, results_count=0) == [
        "results_count: 0 in a search not flagged empty"
    ]
    assert errors(spark, results_count=0, zero_results_flag=1) == []


def test_missing_values_and_several_errors(spark):
    assert errors(spark, country=None, search_hour=99) == [
        "country: missing value",
        "search_hour: out of range",
    ]
    assert errors(spark, search_latency_ms=-1.0) == ["search_latency_ms: out of range"]


def test_fields_are_checked(spark):
    frame = records(spark, {})
    with pytest.raises(validation.RecordSchemaError, match="passengers"):
        validation.validate_records(frame.drop("passengers"), keys=("search_id",))
    with pytest.raises(validation.RecordSchemaError, match="search_id"):
        validation.validate_records(frame)


def test_quarantine_keeps_every_record(spark):
    frame = records(spark, {}, {"passengers": 0}, {})
    valid, rejected = validation.split_valid(
        validation.validate_records(frame, keys=("search_id",))
    )
    assert (valid.count(), rejected.count()) == (2, 1)
    assert valid.columns == frame.columns


def brute_precision(p, y):
    values = np.unique(p)[::-1]
    total, before = 0.0, 0
    for v in values:
        hits, n = y[p >= v].sum(), (p >= v).sum()
        total += (hits - before) * hits / n
        before = hits
    return total / y.sum()


def test_grouped_average_precision(spark):
    random = np.random.default_rng(1)
    p, y = np.round(random.random(200), 1), random.integers(0, 2, 200)
    rows = [("g" if i % 2 else "h", float(p[i]), int(y[i])) for i in range(200)]
    frame = spark.createDataFrame(rows, f"part string, score double, {TARGET} int")
    found = importance.grouped_average_precision(frame, ("part",)).collect()
    for row in found:
        mask = np.array([r[0] == row["part"] for r in rows])
        assert row["average_precision"] == pytest.approx(brute_precision(p[mask], y[mask]))


def test_permutation_keeps_the_values_of_each_feature(j):
    sample = j.dataset.orderBy("search_id").limit(200)
    permuted = importance.permuted_rows(sample, repeats=2, seed=7)
    assert permuted.count() == 200 * (len(FEATURES) * 2 + 1)
    one = permuted.where("feature = 'search_latency_ms' and repeat = 1")
    assert sorted(r[0] for r in one.select("search_latency_ms").collect()) == sorted(
        r[0] for r in sample.select("search_latency_ms").collect()
    )
    changed = one.alias("a").join(sample.alias("b"), "search_id")
    assert changed.where("a.search_latency_ms <> b.search_latency_ms").count() > 150
    assert changed.where("a.country <> b.country").count() == 0


def test_importance_finds_the_only_feature_that_counts(j):
    def by_railcard(rows):
        return rows.withColumn("score", 0.2 + 0.5 * F.col("railcard_used"))

    labelled = j.dataset.withColumn(TARGET, F.col("railcard_used"))
    table = importance.permutation_importance(labelled, by_railcard)
    rows = {r["feature"]: r for r in table.collect()}
    assert rows["railcard_used"]["importance_mean"] > 0.3
    others = [r["importance_mean"] for f, r in rows.items() if f != "railcard_used"]
    assert len(others) == 17 and max(map(abs, others)) < 1e-12


def test_all_rows_are_permuted_without_a_cap(spark):
    columns = [F.col("id").cast("double").alias(f) for f in FEATURES]
    rows = spark.range(30_000).select(
        F.col("id").cast("string").alias("search_id"), F.lit(1).alias(TARGET), *columns
    )
    one = importance.permuted_rows(rows, repeats=1, seed=3).where("feature = 'passengers'")
    assert one.count() == 30_000
    assert one.select("passengers").distinct().count() == 30_000
    assert one.where("passengers <> search_hour").count() > 29_900


def test_positions_follow_the_hash_in_every_round(j):
    rows = j.dataset.select("search_id")
    placed = importance.shuffled_positions(rows, repeats=2, seed=3, key="search_id")
    order = Window.partitionBy("repeat").orderBy("h", "search_id")
    salted = F.when(F.col("repeat") < 0, F.concat_ws(":", F.lit("3"), "search_id")).otherwise(
        F.concat_ws(":", F.lit("3"), "repeat", "search_id")
    )
    checked = placed.withColumn("h", F.md5(salted.cast("binary"))).withColumn(
        "expected", F.row_number().over(order)
    )
    assert checked.count() == 3 * rows.count()
    assert checked.where("position <> expected").count() == 0


def test_ranking_the_passes_does_not_plan_them_again(j):
    sample = j.dataset.orderBy("search_id").limit(50)
    scored = lambda rows: rows.withColumn("score", 0.2 + 0.5 * F.col("railcard_used"))
    table = importance.permutation_importance(sample, scored, repeats=1)
    plan = table._jdf.queryExecution().optimizedPlan().toString()
    assert "part" in plan and "Union" not in plan and "donors" not in plan


def test_a_pass_reads_one_feature_of_the_donors(j, tmp_path):
    sample = j.dataset.orderBy("search_id").limit(50)
    importance.with_donors(sample, repeats=2, seed=7).write.parquet(str(tmp_path / "paired"))
    paired = sample.sparkSession.read.parquet(str(tmp_path / "paired"))
    swapped = importance.swapped_rows(paired, "results_count").select("repeat", "results_count")
    plan = swapped._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<donors:array<struct<results_count:int>>>" in plan


def test_donors_are_found_block_by_block(j, monkeypatch):
    """Blocks far smaller than a cell, and rows that are there twice."""
    monkeypatch.setattr(importance, "BLOCK_ROWS", 3)
    monkeypatch.setattr(importance, "TASK_ROWS", 20)
    monkeypatch.setattr(importance, "RANK_DIGITS", 1)
    sample = j.dataset.orderBy("search_id").limit(150)
    rows = sample.unionByName(sample.where("results_count = 2"))
    placed = importance.shuffled_positions(rows, repeats=2, seed=7, key="search_id").cache()
    expected = placed.where("repeat = -1").select("search_id", "position")
    for r in range(2):
        donor = placed.where(F.col("repeat") == r)
        donor = donor.select("position", F.struct(*FEATURES).alias(f"donor_{r}"))
        expected = expected.join(donor, "position")
    found = importance.with_donors(rows, repeats=2, seed=7)
    columns = ["search_id", "donors[0]", "donors[1]"]
    pairs = found.select("search_id", F.col("donors")[0], F.col("donors")[1]).toDF(*columns)
    assert sorted(map(repr, pairs.collect())) == sorted(
        map(repr, expected.drop("position").toDF(*columns).collect())
    )


def test_nan_and_fractions_are_rejected(spark):
    assert errors(spark, search_latency_ms=float("nan")) == ["search_latency_ms: out of range"]
    assert errors(spark, search_latency_ms=0.5) == []
    whole = records(spark, {}).withColumn("passengers", F.lit(1.5))
    frame = validation.validate_records(whole, keys=("search_id",))
    assert frame.first()["errors"] == ["passengers: not a whole number"]
    text = records(spark, {}).withColumn("passengers", F.lit("2"))
    with pytest.raises(validation.RecordSchemaError, match="passengers"):
        validation.validate_records(text, keys=("search_id",))


def test_text_fields_must_be_text(spark):
    number = records(spark, {}).withColumn("device_type", F.lit(3))
    with pytest.raises(validation.RecordSchemaError, match="not text.*device_type"):
        validation.validate_records(number, keys=("search_id",))
    with pytest.raises(validation.RecordSchemaError, match="device_type"):
        validation.count_violations(number, keys=("search_id",))


def test_rules_are_counted_in_one_pass(spark):
    frame = records(
        spark, {}, {"passengers": 0, "country": None}, {"passengers": 99}, {"search_hour": 24}
    )
    counted = validation.count_violations(frame, keys=("search_id",))
    listed = validation.violation_counts(validation.validate_records(frame, keys=("search_id",)))
    assert sorted(counted.collect()) == sorted(listed.collect()) and counted.count() == 3
    assert validation.count_violations(frame.limit(0), keys=("search_id",)).count() == 0


def test_nan_is_a_missing_value(spark):
    nan = float("nan")
    frame = records(spark, *[{"search_latency_ms": v} for v in (1.0, 2.0, 3.0, nan, nan, None)])
    found = features.medians(frame, ("search_latency_ms", "passengers"))
    assert {r["feature"]: r["number_value"] for r in found.collect()} == {
        "search_latency_ms": 2.0,
        "passengers": 1.0,
    }
    filled = models._imputer(frame).transform(frame).select("search_latency_ms_filled").collect()
    assert [r[0] for r in filled] == [1.0, 2.0, 3.0, 2.0, 2.0, 2.0]


def test_a_fit_on_nan_finishes(spark):
    changes = [
        {"search_latency_ms": float("nan") if i % 3 else 100.0 + i, "railcard_used": i % 2}
        for i in range(40)
    ]
    train = records(spark, *changes).withColumn(TARGET, F.col("railcard_used"))
    for fit in (models.fit_logistic, models.fit_histogram):
        scores = models.probability(fit(train), train).select("score").collect()
        assert len(scores) == 40 and all(0 <= r[0] <= 1 for r in scores)
