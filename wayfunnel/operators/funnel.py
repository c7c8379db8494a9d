"""The search-level funnel: one row per search with its furthest step to a booking."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _option_columns(flagged: Column) -> list[Column]:
    """Maxima per column over the selected options; independent, not one option's values."""
    sources = {
        "selected_result_id": "result_id",
        "selected_operator": "operator",
        "selected_fare": "fare",
        "selected_duration_minutes": "duration_minutes",
        "selected_changes": "changes",
    }
    return [F.max(F.when(flagged, F.col(src))).alias(alias) for alias, src in sources.items()]


def selected_results(results: DataFrame) -> DataFrame:
    return results.groupBy("search_id").agg(
        F.max("selected_flag").alias("selected_flag"), *_option_columns(F.col("selected_flag") == 1)
    )


def checkout_summary(checkout: DataFrame) -> DataFrame:
    return checkout.groupBy("search_id").agg(
        F.lit(1).alias("checkout_started_flag"),
        *[
            F.max(name).alias(name)
            for name in (
                "checkout_id",
                "payment_method",
                "checkout_error_flag",
                "error_type",
                "payment_failure_flag",
                "checkout_completed_flag",
            )
        ],
    )


def booking_summary(bookings: DataFrame) -> DataFrame:
    return bookings.groupBy("search_id").agg(
        F.lit(1).alias("booked_flag"),
        F.max("booking_id").alias("booking_id"),
        F.sum("total_revenue").alias("revenue"),
    )


def _or_zero(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(0)).alias(name)


def search_funnel(
    sessions: DataFrame,
    searches: DataFrame,
    results: DataFrame,
    checkout: DataFrame,
    bookings: DataFrame,
) -> DataFrame:
    """Left-join the session and the per-search summaries onto every search.

    Options that were shown but not selected add nothing here (their flag becomes 0 either way),
    so they are filtered in the scan and never reach a shuffle. The session join goes first, while
    the search rows are narrow; a session that holds a large share of the searches is split by
    adaptive skew-join handling, and the three summaries are unique on ``search_id``, the key the
    joined rows are then partitioned by once.
    """
    chosen = selected_results(results.where(F.col("selected_flag") > 0))
    session_columns = sessions.select(
        "session_id",
        "customer_id",
        "device_type",
        "operating_system",
        "acquisition_channel",
        "customer_type",
        "country",
        "is_logged_in",
    )
    joined = (
        searches.join(session_columns, "session_id", "left")
        .join(chosen, "search_id", "left")
        .join(checkout_summary(checkout), "search_id", "left")
        .join(booking_summary(bookings), "search_id", "left")
    )

    has_results = F.col("results_count") > 0
    started = F.coalesce("checkout_started_flag", F.lit(0)) == 1
    failed_or_done = F.greatest(
        F.coalesce("checkout_error_flag", F.lit(0)),
        F.coalesce("payment_failure_flag", F.lit(0)),
        F.coalesce("checkout_completed_flag", F.lit(0)),
    )
    stage = (
        F.when(F.col("booked_flag") == 1, "Booked")
        .when(started, "Checkout")
        .when(F.col("selected_flag") == 1, "Selected")
        .when(has_results, "Results")
        .otherwise("Search")
    )
    return joined.select(
        "search_id",
        "session_id",
        "customer_id",
        "search_date",
        "searched_at",
        "search_hour",
        "device_type",
        "operating_system",
        "acquisition_channel",
        "customer_type",
        "country",
        "is_logged_in",
        "origin_station",
        "destination_station",
        "route",
        "travel_date",
        "days_before_travel",
        "passengers",
        "journey_type",
        "railcard_used",
        "results_count",
        "search_latency_ms",
        "zero_results_flag",
        F.when(has_results, 1).otherwise(0).alias("results_available_flag"),
        _or_zero("selected_flag"),
        "selected_result_id",
        "selected_operator",
        "selected_fare",
        "selected_duration_minutes",
        "selected_changes",
        _or_zero("checkout_started_flag"),
        "checkout_id",
        "payment_method",
        _or_zero("checkout_error_flag"),
        "error_type",
        _or_zero("payment_failure_flag"),
        _or_zero("checkout_completed_flag"),
        F.when(started & (failed_or_done == 0), 1).otherwise(0).alias("checkout_abandoned_flag"),
        _or_zero("booked_flag"),
        "booking_id",
        F.coalesce("revenue", F.lit(0.0)).alias("revenue"),
        stage.alias("furthest_funnel_stage"),
    )
