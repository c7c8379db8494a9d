"""Rolling baselines, z-scores and alerts on daily metrics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wayfunnel.functions.measures import round_to
from wayfunnel.settings import AlertRule

# metric -> rate column of the daily funnel
WATCHED = {
    "conversion": "search_to_book_conversion_pct",
    "zero_result": "zero_result_rate_pct",
    "checkout_error": "checkout_error_rate_pct",
}


def rolling_baseline(
    daily: DataFrame, rule: AlertRule = AlertRule(), partition_by: Sequence[str] = ()
) -> DataFrame:
    """Count, mean and sample deviation of the preceding rows, the current day excluded.

    The frame counts rows, not calendar days. The input has one row per day (and per
    ``partition_by`` value), so a window group is bounded by the calendar however large the
    funnel behind it is.
    """
    window = (
        Window.partitionBy(*partition_by)
        .orderBy("metric_date")
        .rowsBetween(-rule.baseline_rows, Window.currentRow - 1)
    )
    days = rule.baseline_rows
    columns: dict[str, Column] = {"baseline_days": F.count(F.lit(1)).over(window)}
    for metric, rate in WATCHED.items():
        columns[f"{metric}_avg_{days}d"] = F.avg(rate).over(window)
        columns[f"{metric}_sd_{days}d"] = F.stddev_samp(rate).over(window)
    return daily.withColumns(columns)


def zscores(baseline: DataFrame, rule: AlertRule = AlertRule()) -> DataFrame:
    days = rule.baseline_rows

    def score(metric: str, rate: str) -> Column:
        mean, deviation = F.col(f"{metric}_avg_{days}d"), F.col(f"{metric}_sd_{days}d")
        return F.when(deviation > 0, (F.col(rate) - mean) / F.nullif(deviation, F.lit(0.0)))

    return baseline.withColumns(
        {f"{metric}_zscore": score(metric, rate) for metric, rate in WATCHED.items()}
    )


def daily_anomaly_alerts(
    daily: DataFrame, rule: AlertRule = AlertRule(), partition_by: Sequence[str] = ()
) -> DataFrame:
    """Alert flag and reason per day. The reason is not held back by the minimum baseline."""
    scored = zscores(rolling_baseline(daily, rule, partition_by), rule)
    drop = F.col("conversion_zscore") <= -rule.z_limit
    no_results = F.col("zero_result_zscore") >= rule.z_limit
    errors = F.col("checkout_error_zscore") >= rule.z_limit
    alert = (F.col("baseline_days") >= rule.min_rows) & (drop | no_results | errors)
    return scored.withColumns(
        {
            "alert_flag": F.when(alert, 1).otherwise(0),
            "alert_reason": F.concat_ws(
                "; ",
                F.when(drop, "Conversion decline"),
                F.when(no_results, "Zero-result spike"),
                F.when(errors, "Checkout-error spike"),
            ),
        }
    )


def anomaly_alert_days(alerts: DataFrame) -> DataFrame:
    return alerts.where(F.col("alert_flag") == 1).select(
        "metric_date",
        "searches",
        "bookings",
        "revenue",
        "zero_result_rate_pct",
        "checkout_error_rate_pct",
        "search_to_book_conversion_pct",
        *[round_to(F.col(f"{m}_zscore")).alias(f"{m}_zscore") for m in WATCHED],
        "alert_reason",
    )


def daily_metrics(daily: DataFrame) -> DataFrame:
    """The three watched rates by day, the series behind the charts."""
    return daily.select("metric_date", *WATCHED.values())
