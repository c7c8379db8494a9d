"""Leakage-safe modelling rows, temporal split and imputation values."""

from __future__ import annotations

from datetime import datetime, time, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayfunnel.functions.measures import round_to, rows
from wayfunnel.operators.quantiles import grouped_quantiles
from wayfunnel.settings import CATEGORICAL_FEATURES, NUMERIC_FEATURES, TARGET, SplitDates


def model_dataset(funnel: DataFrame, searches: DataFrame, sessions: DataFrame) -> DataFrame:
    """Label from the funnel, features from what is known once results are shown."""
    labels = funnel.select("search_id", F.col(TARGET).cast("int").alias(TARGET))
    at = F.col("searched_at")
    search_features = searches.select(
        "search_id",
        "session_id",
        "searched_at",
        "origin_station",
        "destination_station",
        "journey_type",
        "passengers",
        "railcard_used",
        "results_count",
        F.col("search_latency_ms").cast("double").alias("search_latency_ms"),
        "zero_results_flag",
        F.datediff(F.col("travel_date"), at.cast("date")).alias("days_before_travel"),
        F.hour(at).alias("search_hour"),
        (F.dayofweek(at) - 1).alias("day_of_week"),
        F.month(at).alias("search_month"),
    )
    session_features = sessions.select(
        "session_id",
        "device_type",
        "operating_system",
        "acquisition_channel",
        "customer_type",
        "country",
        "is_logged_in",
    )
    return (
        search_features.join(session_features, "session_id")
        .join(labels, "search_id")
        .select("search_id", "searched_at", TARGET, *CATEGORICAL_FEATURES, *NUMERIC_FEATURES)
    )


DAY = "search_date"


def model_rows(funnel: DataFrame, with_day: bool = False) -> DataFrame:
    """The same rows as ``model_dataset`` from a funnel whose build passed its checks.

    Unique keys and no orphans make the joins no-ops, and the funnel carries every feature: a
    projection of one scan, without a shuffle. ``with_day`` keeps the column that the funnel is
    partitioned by, for ``temporal_split``.
    """
    at = F.col("searched_at")
    features = {name: F.col(name) for name in (*CATEGORICAL_FEATURES, *NUMERIC_FEATURES[:7])}
    features["search_latency_ms"] = F.col("search_latency_ms").cast("double")
    features["search_hour"] = F.hour(at)
    features["day_of_week"] = F.dayofweek(at) - 1
    features["search_month"] = F.month(at)
    return funnel.select(
        "search_id",
        "searched_at",
        *([DAY] if with_day else []),
        F.col(TARGET).cast("int").alias(TARGET),
        *[column.alias(name) for name, column in features.items()],
    )


def label_split(dataset: DataFrame, dates: SplitDates = SplitDates()) -> DataFrame:
    at = F.col("searched_at")
    return dataset.withColumn(
        "split",
        F.when(at < _ntz(dates.validation_from), "train")
        .when(at < _ntz(dates.test_from), "validation")
        .otherwise("test"),
    )


def temporal_split(
    dataset: DataFrame, dates: SplitDates = SplitDates()
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Train, validation and test rows as three filters that reach the scan.

    Where the rows carry their day, it is bounded as well, so that each split reads only the
    partitions of its days.
    """
    at, by_day = F.col("searched_at"), DAY in dataset.columns

    def before(moment: datetime) -> Column:
        if not by_day:
            return at < _ntz(moment)
        # a boundary inside a day leaves that day to both sides
        last = moment.date() - timedelta(days=1) if moment.time() == time() else moment.date()
        return (F.col(DAY) <= F.lit(last)) & (at < _ntz(moment))

    def since(moment: datetime) -> Column:
        later = at >= _ntz(moment)
        return (F.col(DAY) >= F.lit(moment.date())) & later if by_day else later

    first, second = dates.validation_from, dates.test_from
    return (
        dataset.where(before(first)),
        dataset.where(since(first) & before(second)),
        dataset.where(since(second)),
    )


def _ntz(moment) -> Column:
    return F.lit(moment.isoformat(sep=" ")).cast("timestamp_ntz")


def split_profile(labelled: DataFrame) -> DataFrame:
    return labelled.groupBy("split").agg(
        rows("row_count"), round_to(F.avg(TARGET) * 100.0).alias("booking_rate_pct")
    )


def most_frequent(frame: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """Most frequent value per column, the smallest on ties: (feature, text_value)."""
    long = frame.select(*[F.col(c).cast("string").alias(c) for c in columns]).unpivot(
        [], list(columns), "feature", "value"
    )
    counts = long.where(F.col("value").isNotNull()).groupBy("feature", "value").count()
    return counts.groupBy("feature").agg(
        F.min_by("value", F.struct(-F.col("count"), F.col("value"))).alias("text_value")
    )


def medians(frame: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """Exact median per column: (feature, number_value). NULL and NaN are missing values."""
    long = frame.select(*[F.col(c).cast("double").alias(c) for c in columns]).unpivot(
        [], list(columns), "feature", "value"
    )
    counts = (
        long.where(F.col("value").isNotNull() & ~F.isnan("value"))
        .groupBy("feature", "value")
        .agg(rows("n"))
    )
    middle = grouped_quantiles(counts, "feature", [0.5])
    return middle.select("feature", F.col("quantile").alias("number_value"))


def imputation_values(train: DataFrame) -> DataFrame:
    """Fill value per feature, fitted on the training rows only."""
    text = most_frequent(train, CATEGORICAL_FEATURES)
    numbers = medians(train, NUMERIC_FEATURES)
    return text.withColumn("number_value", F.lit(None).cast("double")).unionByName(
        numbers.withColumn("text_value", F.lit(None).cast("string"))
    )

