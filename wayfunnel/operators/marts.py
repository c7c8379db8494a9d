"""KPI, daily, segment, route, failure and revenue-at-risk marts over the search funnel.

Each mart is one aggregation of sums (combined map-side, so a hot group costs one row per task)
followed by a projection of rates. Stored marts are unordered; ``REPORT_ORDER`` has the order in
which they are read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayfunnel.functions.measures import (
    average,
    booked_revenue,
    rate_pct,
    ratio,
    round_to,
    rows,
    steady,
    total,
)

# alias -> funnel flag
FLAG_TOTALS = {
    "zero_result_searches": "zero_results_flag",
    "searches_with_results": "results_available_flag",
    "selected_searches": "selected_flag",
    "checkout_attempts": "checkout_started_flag",
    "checkout_errors": "checkout_error_flag",
    "payment_failures": "payment_failure_flag",
    "checkout_abandonments": "checkout_abandoned_flag",
    "bookings": "booked_flag",
}

# rate -> (numerator, denominator), both totals
RATES = {
    "zero_result_rate_pct": ("zero_result_searches", "searches"),
    "results_available_rate_pct": ("searches_with_results", "searches"),
    "result_selection_rate_pct": ("selected_searches", "searches_with_results"),
    "selection_rate_pct": ("selected_searches", "searches_with_results"),
    "checkout_error_rate_pct": ("checkout_errors", "checkout_attempts"),
    "payment_failure_rate_pct": ("payment_failures", "checkout_attempts"),
    "checkout_to_booking_rate_pct": ("bookings", "checkout_attempts"),
    "search_to_book_conversion_pct": ("bookings", "searches"),
    "search_to_book_rate_pct": ("bookings", "searches"),
    "conversion_rate_pct": ("bookings", "searches"),
}


def flag_totals(*aliases: str) -> list[Column]:
    return [total(FLAG_TOTALS[alias], alias) for alias in aliases]


def rates(*names: str) -> list[Column]:
    return [rate_pct(*map(F.col, RATES[name])).alias(name) for name in names]


def _money(name: str = "revenue", alias: str | None = None) -> Column:
    return round_to(F.col(name)).alias(alias or name)


def kpi_summary(funnel: DataFrame) -> DataFrame:
    """One row. Aggregates by session first: that one shuffle serves the distinct count, the
    session conversion and every total, where COUNT(DISTINCT) next to a second per-session
    aggregate would scan the funnel twice."""
    by_session = funnel.groupBy("session_id").agg(
        rows("searches"),
        *flag_totals(*FLAG_TOTALS),
        F.max("booked_flag").alias("converted"),
        F.sum("revenue").alias("revenue"),
        F.sum(booked_revenue()).alias("order_value"),
        F.count(booked_revenue()).alias("orders"),
    )
    totals = by_session.agg(
        F.coalesce(F.sum("searches"), F.lit(0)).alias("searches"),
        F.count("session_id").alias("sessions"),
        *[F.sum(alias).alias(alias) for alias in FLAG_TOTALS],
        F.sum("revenue").alias("revenue"),
        F.sum("order_value").alias("order_value"),
        F.sum("orders").alias("orders"),
        F.avg("converted").alias("converted"),
    )
    return totals.select(
        "searches",
        "sessions",
        *FLAG_TOTALS,
        _money("revenue", "total_revenue"),
        round_to(ratio(steady(F.col("order_value")), F.col("orders"))).alias("average_order_value"),
        *rates(
            "zero_result_rate_pct", "result_selection_rate_pct", "search_to_book_conversion_pct"
        ),
        round_to(F.col("converted") * 100.0).alias("session_conversion_rate_pct"),
    )


def daily_funnel(funnel: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Totals and rates per day that has searches; ``by`` adds grouping columns such as route."""
    return (
        funnel.groupBy(F.col("search_date").alias("metric_date"), *by)
        .agg(
            rows("searches"),
            F.countDistinct("session_id").alias("sessions"),
            *flag_totals(*FLAG_TOTALS),
            F.sum("revenue").alias("revenue"),
        )
        .select(
            "metric_date",
            *by,
            "searches",
            "sessions",
            *FLAG_TOTALS,
            _money(),
            *rates(
                "zero_result_rate_pct",
                "result_selection_rate_pct",
                "checkout_error_rate_pct",
                "payment_failure_rate_pct",
                "search_to_book_conversion_pct",
            ),
        )
    )


def device_performance(funnel: DataFrame) -> DataFrame:
    counts = (
        "zero_result_searches",
        "checkout_attempts",
        "checkout_errors",
        "payment_failures",
        "bookings",
    )
    return (
        funnel.groupBy("device_type")
        .agg(
            rows("searches"),
            F.countDistinct("session_id").alias("sessions"),
            *flag_totals(*counts),
            F.sum("revenue").alias("revenue"),
        )
        .select(
            "device_type",
            "searches",
            "sessions",
            *counts,
            _money(),
            *rates("conversion_rate_pct", "checkout_error_rate_pct"),
        )
    )


def channel_performance(funnel: DataFrame) -> DataFrame:
    return (
        funnel.groupBy("acquisition_channel")
        .agg(
            rows("searches"),
            F.countDistinct("session_id").alias("sessions"),
            *flag_totals("bookings"),
            F.sum("revenue").alias("revenue"),
        )
        .select(
            "acquisition_channel",
            "searches",
            "sessions",
            "bookings",
            _money(),
            *rates("conversion_rate_pct"),
            round_to(ratio(steady(F.col("revenue")), F.col("sessions"))).alias("revenue_per_session"),
        )
    )


def route_performance(funnel: DataFrame, min_searches: int = 100) -> DataFrame:
    return (
        funnel.groupBy("route", "origin_station", "destination_station")
        .agg(
            rows("searches"),
            *flag_totals("zero_result_searches", "bookings"),
            F.sum("revenue").alias("revenue"),
            F.avg("search_latency_ms").alias("latency"),
        )
        .where(F.col("searches") >= min_searches)
        .select(
            "route",
            "origin_station",
            "destination_station",
            "searches",
            "zero_result_searches",
            "bookings",
            _money(),
            _money("latency", "avg_search_latency_ms"),
            *rates("zero_result_rate_pct", "conversion_rate_pct"),
        )
    )


def zero_result_analysis(funnel: DataFrame, min_searches: int = 100) -> DataFrame:
    return (
        funnel.groupBy("route")
        .agg(
            rows("searches"),
            *flag_totals("zero_result_searches"),
            F.avg("search_latency_ms").alias("latency"),
            F.avg("days_before_travel").alias("lead_time"),
        )
        .where(F.col("searches") >= min_searches)
        .select(
            "route",
            "searches",
            "zero_result_searches",
            *rates("zero_result_rate_pct"),
            _money("latency", "avg_search_latency_ms"),
            _money("lead_time", "avg_days_before_travel"),
        )
    )


def checkout_failure_analysis(funnel: DataFrame) -> DataFrame:
    counts = ("checkout_errors", "payment_failures", "checkout_abandonments", "bookings")
    keys = ("device_type", "payment_method", "error_type")
    return (
        funnel.where(F.col("checkout_started_flag") == 1)
        .withColumn("error_type", F.coalesce("error_type", F.lit("None")))
        .groupBy(*keys)
        .agg(rows("checkout_attempts"), *flag_totals(*counts))
        .select(
            *keys,
            "checkout_attempts",
            *counts,
            *rates(
                "checkout_error_rate_pct",
                "payment_failure_rate_pct",
                "checkout_to_booking_rate_pct",
            ),
        )
    )


# Issue label -> total
ISSUES = {
    "Zero-result searches": "zero_result_searches",
    "Checkout errors": "checkout_errors",
    "Payment failures": "payment_failures",
    "Checkout abandonment": "checkout_abandonments",
}


def commercial_impact(funnel: DataFrame, bookings: DataFrame) -> DataFrame:
    """Revenue at risk per issue. Issues overlap by design: a gross estimate.

    One scan of the funnel for the four totals, unpivoted afterwards.
    """
    order_value = bookings.agg(average(F.col("total_revenue"))).scalar()
    totals = funnel.agg(*flag_totals(*ISSUES.values())).withColumn("order_value", order_value)
    issues = F.array(
        *[
            F.struct(F.lit(label).alias("issue_type"), F.col(alias).alias("affected_searches"))
            for label, alias in ISSUES.items()
        ]
    )
    return totals.select("order_value", F.inline(issues)).select(
        "issue_type",
        "affected_searches",
        _money("order_value", "benchmark_avg_order_value"),
        round_to(F.col("affected_searches") * F.col("order_value")).alias(
            "estimated_revenue_at_risk"
        ),
    )


def overall_funnel(funnel: DataFrame) -> DataFrame:
    counts = ("searches_with_results", "selected_searches", "checkout_attempts", "bookings")
    return funnel.agg(
        rows("searches"), *flag_totals(*counts), F.sum("revenue").alias("revenue")
    ).select(
        "searches",
        *counts,
        *rates(
            "results_available_rate_pct",
            "selection_rate_pct",
            "checkout_to_booking_rate_pct",
            "search_to_book_rate_pct",
        ),
        _money(),
    )


def segment_performance(funnel: DataFrame) -> DataFrame:
    keys = ("device_type", "customer_type", "is_logged_in")
    return (
        funnel.groupBy(*keys)
        .agg(
            rows("searches"),
            *flag_totals(
                "bookings", "zero_result_searches", "checkout_errors", "checkout_attempts"
            ),
            F.sum("revenue").alias("revenue"),
        )
        .select(
            *keys,
            "searches",
            "bookings",
            *rates("conversion_rate_pct", "zero_result_rate_pct", "checkout_error_rate_pct"),
            _money(),
        )
    )


def route_opportunities(routes: DataFrame, min_searches: int = 200, top: int = 20) -> DataFrame:
    """Top routes by zero-result rate from ``route_performance``; the route breaks ties."""
    return (
        routes.where(F.col("searches") >= min_searches)
        .orderBy(F.desc_nulls_last("zero_result_rate_pct"), F.desc("searches"), "route")
        .limit(top)
        .select(
            "route",
            "searches",
            "zero_result_searches",
            "zero_result_rate_pct",
            "conversion_rate_pct",
            "revenue",
            "avg_search_latency_ms",
        )
    )


def _with_sessions(funnel: DataFrame, sessions: DataFrame | None) -> tuple[DataFrame, Column]:
    """The funnel rows, below a row without a search for each session, and whether a group of them
    is a known session. Stacked and grouped once, a session of any weight needs no join."""
    if sessions is None:
        return funnel, F.lit(True)
    used = ["search_id", "session_id", "customer_id", "zero_results_flag", "selected_flag"]
    used += ["checkout_started_flag", "checkout_completed_flag", "booked_flag", "revenue"]
    known = sessions.select("session_id", "customer_id", F.lit(1).alias("known"))
    stacked = funnel.select(*used).unionByName(known, allowMissingColumns=True)
    return stacked, F.max("known") == 1


def session_features(funnel: DataFrame, sessions: DataFrame | None = None) -> DataFrame:
    """Per-session rollup of the funnel; with ``sessions``, of each of them, searches or none."""
    stacked, is_known = _with_sessions(funnel, sessions)
    totals = flag_totals(
        "zero_result_searches", "selected_searches", "checkout_attempts", "bookings"
    )
    if sessions is None:
        measures = [rows("searches"), *totals]
        revenue = F.sum("revenue")
    else:
        measures = [F.count("search_id").alias("searches")]
        measures += [
            F.coalesce(F.sum(flag), F.lit(0)).cast("bigint").alias(name)
            for flag, name in (
                ("zero_results_flag", "zero_result_searches"),
                ("selected_flag", "selected_searches"),
                ("checkout_started_flag", "checkout_attempts"),
                ("booked_flag", "bookings"),
            )
        ]
        revenue = F.coalesce(F.sum("revenue"), F.lit(0.0))
    grouped = stacked.groupBy("session_id", "customer_id").agg(
        *measures, round_to(revenue).alias("revenue"), is_known.alias("is_known")
    )
    return grouped.where("is_known").drop("is_known")


def documented_metrics(funnel: DataFrame, sessions: DataFrame | None = None) -> DataFrame:
    """Metrics defined per session: checkout start, checkout completion, abandonment, revenue.

    With ``sessions`` every one of them is eligible, also those without a search.
    """
    stacked, is_known = _with_sessions(funnel, sessions)
    by_session = stacked.groupBy("session_id").agg(
        F.coalesce(F.max("checkout_started_flag"), F.lit(0)).alias("started"),
        F.coalesce(F.max("booked_flag"), F.lit(0)).alias("booked"),
        F.sum("checkout_started_flag").alias("attempts"),
        F.sum("checkout_completed_flag").alias("completed"),
        F.sum("revenue").alias("revenue"),
        is_known.alias("is_known"),
    )
    sums = by_session.where(F.col("session_id").isNotNull() & F.col("is_known")).agg(
        rows("sessions"),
        F.sum("started").alias("checkout_sessions"),
        F.sum(1 - F.col("booked")).alias("abandoned_sessions"),
        F.sum("attempts").alias("attempts"),
        F.sum("completed").alias("completed"),
        F.sum("revenue").alias("revenue"),
    )
    return sums.select(
        "sessions",
        rate_pct(F.col("checkout_sessions"), F.col("sessions")).alias("checkout_start_rate_pct"),
        rate_pct(F.col("completed"), F.col("attempts")).alias("checkout_completion_rate_pct"),
        rate_pct(F.col("abandoned_sessions"), F.col("sessions")).alias(
            "funnel_abandonment_rate_pct"
        ),
        round_to(ratio(steady(F.col("revenue")), F.col("sessions"))).alias("revenue_per_session"),
    )


def source_profile(
    sessions: DataFrame,
    searches: DataFrame,
    results: DataFrame,
    checkout: DataFrame,
    bookings: DataFrame,
) -> DataFrame:
    """Row counts, conversion and mean flags of the input tables, one row."""
    search = searches.agg(
        F.struct(rows("n"), F.avg("zero_results_flag").alias("zero")).alias("search")
    )
    attempt = checkout.agg(
        F.struct(
            rows("n"),
            F.avg("checkout_error_flag").alias("error"),
            F.avg("payment_failure_flag").alias("failure"),
        ).alias("attempt")
    )
    booked = bookings.agg(
        F.struct(
            rows("n"),
            F.countDistinct("session_id").alias("sessions"),
            F.sum("total_revenue").alias("revenue"),
        ).alias("booked")
    )
    base = sessions.agg(rows("sessions"), F.countDistinct("session_id").alias("distinct_sessions"))
    wide = base.select(
        "*",
        search.scalar().alias("search"),
        results.agg(rows("n")).scalar().alias("journey_results"),
        attempt.scalar().alias("attempt"),
        booked.scalar().alias("booked"),
    )
    return wide.select(
        "sessions",
        F.col("search.n").alias("searches"),
        "journey_results",
        F.col("attempt.n").alias("checkout_attempts"),
        F.col("booked.n").alias("bookings"),
        round_to(ratio(F.col("booked.sessions"), F.col("distinct_sessions")), 6).alias(
            "session_conversion_rate"
        ),
        round_to(ratio(F.col("booked.n"), F.col("search.n")), 6).alias(
            "search_to_book_conversion_rate"
        ),
        round_to(F.col("search.zero"), 6).alias("zero_result_rate"),
        round_to(F.col("attempt.error"), 6).alias("checkout_error_rate"),
        round_to(F.col("attempt.failure"), 6).alias("payment_failure_rate"),
        round_to(F.col("booked.revenue")).alias("total_revenue"),
    )


def warehouse_summary(kpis: DataFrame, alerts: DataFrame) -> DataFrame:
    """The KPI row plus the number of alert days."""
    alert_days = alerts.where(F.col("alert_flag") == 1).agg(rows("n")).scalar()
    return kpis.withColumn("anomaly_alert_days", alert_days)


# Read order of the stored marts: column -> ascending.
REPORT_ORDER: dict[str, tuple[str, bool]] = {
    "daily_funnel": ("metric_date", True),
    "device_performance": ("searches", False),
    "channel_performance": ("revenue", False),
    "route_performance": ("searches", False),
    "zero_result_analysis": ("zero_result_rate_pct", False),
    "checkout_failure_analysis": ("checkout_attempts", False),
    "commercial_impact": ("estimated_revenue_at_risk", False),
    "segment_performance": ("conversion_rate_pct", True),
    "supply_incident": ("period", True),
    "checkout_incident": ("period", True),
    "daily_anomaly_alerts": ("metric_date", True),
    "anomaly_alert_days": ("metric_date", True),
}


def report_order(name: str) -> list[Column]:
    """Sort columns of a mart, NULLs last in both directions; empty for unordered marts."""
    if name not in REPORT_ORDER:
        return []
    column, ascending = REPORT_ORDER[name]
    return [F.asc_nulls_last(column) if ascending else F.desc_nulls_last(column)]


def in_report_order(name: str, mart: DataFrame) -> DataFrame:
    """A mart ordered for reading."""
    order = report_order(name)
    return mart.orderBy(*order) if order else mart
