"""Model evaluation on scored rows: metrics, thresholds, deciles, lift, calibration, curves.

Input: one row per scored search with a key, a probability and a 0/1 label. Everything except
boundary ties (see ``ranked_buckets``) is computed from counts per distinct score.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayfunnel.functions.measures import ratio, round_to
from wayfunnel.operators.curves import ranked_buckets, score_counts, score_curve

# Name and order of the metrics.
METRICS = (
    "roc_auc",
    "pr_auc",
    "log_loss",
    "brier_score",
    "accuracy",
    "precision_050",
    "recall_050",
    "f1_050",
)

# 0.10 to 0.80 in steps of 0.05, compared unrounded (the third is
# 0.20000000000000004): the step is the difference of the first two thresholds in floating point.
_STEP = (0.1 + 0.05) - 0.1
THRESHOLDS = tuple(0.1 + i * _STEP for i in range(15))


def _or_zero(value: Column) -> Column:
    return F.coalesce(value, F.lit(0.0))


def _precision_recall_f1(hits: Column, predicted: Column, positives: Column) -> tuple[Column, ...]:
    """0 where the quotient is undefined."""
    return (
        _or_zero(ratio(hits, predicted)),
        _or_zero(ratio(hits, positives)),
        _or_zero(ratio(2 * hits, predicted + positives)),
    )


def model_metrics(scored: DataFrame, score: str = "score", label: str = "label") -> DataFrame:
    """One row with the eight metrics.

    Average precision is the step-wise sum over distinct scores, not the trapezoid area.
    """
    curve = score_curve(score_counts(scored, score, label))
    p, n, pos = F.col("score"), F.col("n"), F.col("pos")
    neg = n - pos
    tiny = 2.220446049250313e-16  # fixed value: double epsilon, keeps the logarithm finite
    safe = F.least(F.greatest(p, F.lit(tiny)), F.lit(1 - tiny))
    chosen = p >= 0.5
    sums = curve.agg(
        F.sum(n).alias("n"),
        F.sum(pos).alias("positives"),
        F.sum(neg).alias("negatives"),
        F.sum(neg * (F.col("cum_pos") - pos / 2)).alias("pairs"),
        F.sum(pos * (F.col("cum_pos") / F.col("cum_n"))).alias("precision_steps"),
        F.sum(-(pos * F.log(safe) + neg * F.log(1 - safe))).alias("losses"),
        F.sum(pos * (1 - p) * (1 - p) + neg * p * p).alias("squares"),
        F.sum(F.when(chosen, n).otherwise(0)).alias("predicted"),
        F.sum(F.when(chosen, pos).otherwise(0)).alias("hits"),
    )
    hits, predicted, positives = F.col("hits"), F.col("predicted"), F.col("positives")
    precision, recall, f1 = _precision_recall_f1(hits, predicted, positives)
    correct = hits + F.col("negatives") - (predicted - hits)
    return sums.select(
        ratio(F.col("pairs"), positives.cast("double") * F.col("negatives")).alias("roc_auc"),
        ratio(F.col("precision_steps"), positives).alias("pr_auc"),
        ratio(F.col("losses"), F.col("n")).alias("log_loss"),
        ratio(F.col("squares"), F.col("n")).alias("brier_score"),
        ratio(correct, F.col("n")).alias("accuracy"),
        precision.alias("precision_050"),
        recall.alias("recall_050"),
        f1.alias("f1_050"),
    )


def as_metric_rows(metrics: DataFrame) -> DataFrame:
    """One wide row to (metric, value) rows."""
    pairs = [F.struct(F.lit(m).alias("metric"), F.col(m).alias("value")) for m in METRICS]
    return metrics.select(F.inline(F.array(*pairs)))


def threshold_analysis(
    scored: DataFrame, score: str = "score", label: str = "label"
) -> DataFrame:
    """Predicted share, precision, recall and F1 at each threshold; one pass, no row shuffle."""
    p, y = F.col(score), F.col(label)
    sums = [F.count(F.lit(1)).alias("n"), F.sum(y).alias("positives")]
    for i, threshold in enumerate(THRESHOLDS):
        chosen = p >= F.lit(threshold)
        sums.append(F.count_if(chosen).alias(f"predicted_{i}"))
        sums.append(F.coalesce(F.sum(F.when(chosen, y)), F.lit(0)).alias(f"hits_{i}"))
    lines = F.array(
        *[
            F.struct(
                F.lit(round(threshold, 2)).alias("threshold"),
                F.col(f"predicted_{i}").alias("predicted"),
                F.col(f"hits_{i}").alias("hits"),
            )
            for i, threshold in enumerate(THRESHOLDS)
        ]
    )
    table = scored.agg(*sums).select("n", "positives", F.inline(lines))
    precision, recall, f1 = _precision_recall_f1(
        F.col("hits"), F.col("predicted"), F.col("positives")
    )
    return table.select(
        "threshold",
        round_to(ratio(F.lit(100.0) * F.col("predicted"), F.col("n"))).alias(
            "predicted_positive_rate_pct"
        ),
        precision.alias("precision"),
        recall.alias("recall"),
        f1.alias("f1"),
    )


def best_threshold(thresholds: DataFrame) -> DataFrame:
    """Row with the highest F1, the lowest threshold on ties."""
    return thresholds.orderBy(F.desc("f1"), F.asc("threshold")).limit(1)


def _quantile_cut(parts: int):
    """Bucket of a 0-based rank when the ranks 0..n-1 are cut at their interpolated quantiles."""

    def bucket(rank: Column, total: Column) -> Column:
        steps = F.greatest(total - 1, F.lit(1))
        cut = F.floor((rank * parts + steps - 1) / steps)
        return F.greatest(cut, F.lit(1)).cast("int")

    return bucket


def decile_analysis(
    scored: DataFrame, score: str = "score", label: str = "label", key: str = "search_id"
) -> DataFrame:
    """Rows, bookings, actual and mean predicted rate per score decile, highest scores first."""
    buckets = ranked_buckets(scored, _quantile_cut(10), score, label, key)
    actual, predicted = F.col("pos") / F.col("n"), F.col("score_sum") / F.col("n")
    return buckets.select(
        F.col("bucket").alias("decile"),
        F.col("n").alias("searches"),
        F.col("pos").alias("bookings"),
        actual.alias("actual_booking_rate"),
        predicted.alias("avg_predicted_probability"),
        (actual * 100).alias("actual_booking_rate_pct"),
        (predicted * 100).alias("avg_predicted_probability_pct"),
    )


def top_decile_lift(
    scored: DataFrame, score: str = "score", label: str = "label", key: str = "search_id"
) -> DataFrame:
    """Booking rate of the top tenth of the rows (rounded down, at least one) against all rows."""

    def in_top(rank: Column, total: Column) -> Column:
        size = F.greatest(F.floor(total * F.lit(0.10)), F.lit(1))
        return F.when(rank < size, 1).otherwise(2)

    buckets = ranked_buckets(scored, in_top, score, label, key)
    top = F.col("bucket") == 1
    sums = buckets.agg(
        (F.sum("pos") / F.sum("n")).alias("overall"),
        (F.sum(F.when(top, F.col("pos"))) / F.sum(F.when(top, F.col("n")))).alias("top"),
    )
    lift = _or_zero(ratio(F.col("top"), F.col("overall")))
    return sums.select(
        round_to(F.col("overall") * 100).alias("overall_test_booking_rate_pct"),
        round_to(F.col("top") * 100).alias("top_decile_booking_rate_pct"),
        round_to(lift, 3).alias("top_decile_lift"),
    )


def calibration(
    scored: DataFrame, score: str = "score", label: str = "label", bins: int = 10
) -> DataFrame:
    """Mean predicted and observed rate per quantile bin of the score; empty bins are absent.

    The bin edges are exact interpolated quantiles, read off the running totals.
    """
    counts = score_counts(scored, score, label)
    curve = score_curve(counts)
    last = F.col("total_n") - 1
    lowest = F.col("total_n") - F.col("cum_n")  # ascending 0-based rank of the first row
    highest = lowest + F.col("n") - 1

    def value_at(position: Column) -> Column:
        return F.max(F.when((position >= lowest) & (position <= highest), F.col("score")))

    edges = []
    for i in range(1, bins):
        share = i * (1.0 / bins) * 100 / 100  # as a percentage and back, for equal rounding
        at = F.lit(share) * last
        weight = F.max(at - F.floor(at))
        low, high = value_at(F.floor(at)), value_at(F.ceil(at))
        edges.append(
            F.when(weight >= 0.5, high - (high - low) * (1 - weight)).otherwise(
                low + (high - low) * weight
            )
        )
    edge_row = curve.agg(F.array(*edges).alias("edges")).scalar()
    with_edges = counts.withColumn("edges", edge_row)
    below = [
        F.when(F.col("edges")[i] < F.col("score"), 1).otherwise(0) for i in range(bins - 1)
    ]
    placed = with_edges.withColumn("bin", sum(below, F.lit(0)))
    return (
        placed.groupBy("bin")
        .agg(
            (F.sum(F.col("score") * F.col("n")) / F.sum("n")).alias("mean_predicted_probability"),
            (F.sum("pos") / F.sum("n")).alias("observed_booking_rate"),
        )
        .select("bin", "mean_predicted_probability", "observed_booking_rate")
    )


def roc_curve(scored: DataFrame, score: str = "score", label: str = "label") -> DataFrame:
    """(threshold, fpr, tpr) at every distinct score."""
    curve = score_curve(score_counts(scored, score, label))
    false_positives = F.col("cum_n") - F.col("cum_pos")
    return curve.select(
        F.col("score").alias("threshold"),
        ratio(false_positives, F.col("total_n") - F.col("total_pos")).alias("fpr"),
        ratio(F.col("cum_pos"), F.col("total_pos")).alias("tpr"),
    )


def pr_curve(scored: DataFrame, score: str = "score", label: str = "label") -> DataFrame:
    """(threshold, precision, recall) at every distinct score."""
    curve = score_curve(score_counts(scored, score, label))
    return curve.select(
        F.col("score").alias("threshold"),
        (F.col("cum_pos") / F.col("cum_n")).alias("precision"),
        ratio(F.col("cum_pos"), F.col("total_pos")).alias("recall"),
    )
