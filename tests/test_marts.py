from conftest import one
from pyspark.sql import functions as F

from wayfunnel.functions.measures import pct, rate_pct, round_to
from wayfunnel.operators import marts, staging


def test_round_is_half_away_on_the_binary_value(spark):
    row = one(
        spark.range(1).select(
            round_to(F.lit(0.285)).alias("a"),
            round_to(F.lit(-2.5), 0).alias("b"),
            round_to(F.lit(1.005)).alias("c"),
            rate_pct(F.lit(1), F.lit(0)).alias("none"),
            pct(F.lit(1), F.lit(0)).alias("zero"),
            pct(F.lit(1), F.lit(4)).alias("quarter"),
        )
    )
    assert row == {"a": 0.28, "b": -3.0, "c": 1.0, "none": None, "zero": 0.0, "quarter": 25.0}


def test_kpi_summary(small_funnel):
    row = one(marts.kpi_summary(small_funnel))
    assert (row["searches"], row["sessions"], row["bookings"]) == (5, 3, 1)
    assert row["average_order_value"] == 12.75
    assert row["session_conversion_rate_pct"] == 33.33
    assert row["result_selection_rate_pct"] == 75.0


def test_daily_funnel_without_checkout_has_no_error_rate(small_funnel):
    calm = small_funnel.where("search_id = 'q3'")
    row = one(marts.daily_funnel(calm))
    assert row["checkout_error_rate_pct"] is None
    assert row["result_selection_rate_pct"] is None
    assert row["zero_result_rate_pct"] == 100.0


def test_checkout_failures_cover_checkout_rows_only(small_funnel):
    rows = marts.checkout_failure_analysis(small_funnel).collect()
    assert sum(r["checkout_attempts"] for r in rows) == 2
    assert {r["error_type"] for r in rows} == {"None"}


def test_commercial_impact_uses_the_unrounded_order_value(small, small_funnel):
    bookings = staging.stage_bookings(small["bookings"])
    rows = {
        r["issue_type"]: r.asDict()
        for r in marts.commercial_impact(small_funnel, bookings).collect()
    }
    assert len(rows) == 4
    abandoned = rows["Checkout abandonment"]
    assert abandoned["affected_searches"] == 1
    assert abandoned["estimated_revenue_at_risk"] == 6.38  # 6.375


def test_route_floor_and_tie_break(spark):
    routes = spark.createDataFrame(
        [(f"r{i}", "o", "d", 200 + i % 2, 1, 0, 0.0, 1.0, 5.0, 0.0) for i in range(30)]
        + [("tiny", "o", "d", 199, 1, 0, 0.0, 1.0, 99.0, 0.0)],
        "route string, origin_station string, destination_station string, searches bigint, "
        "zero_result_searches bigint, bookings bigint, revenue double, "
        "avg_search_latency_ms double, zero_result_rate_pct double, conversion_rate_pct double",
    )
    top = [r["route"] for r in marts.route_opportunities(routes).collect()]
    assert len(top) == 20 and "tiny" not in top
    odd = sorted(f"r{i}" for i in range(30) if i % 2)
    even = sorted(f"r{i}" for i in range(30) if not i % 2)
    assert top == odd + even[:5]


def test_documented_metrics(small_funnel):
    row = one(marts.documented_metrics(small_funnel))
    assert row["sessions"] == 3
    assert row["checkout_start_rate_pct"] == 33.33
    assert row["checkout_completion_rate_pct"] == 50.0
    assert row["funnel_abandonment_rate_pct"] == 66.67


def test_report_order_puts_nulls_last(spark):
    mart = spark.createDataFrame([(None,), (1.0,), (2.0,)], "zero_result_rate_pct double")
    ordered = marts.in_report_order("zero_result_analysis", mart).collect()
    assert [r[0] for r in ordered] == [2.0, 1.0, None]
    ascending = mart.withColumnRenamed("zero_result_rate_pct", "conversion_rate_pct")
    ordered = marts.in_report_order("segment_performance", ascending).collect()
    assert [r[0] for r in ordered] == [1.0, 2.0, None]
    assert marts.in_report_order("kpi_summary", mart) is mart


def test_source_profile(small):
    names = ("sessions", "searches", "journey_results", "checkout", "bookings")
    row = one(marts.source_profile(*[staging.STAGERS[n](small[n]) for n in names]))
    assert (row["sessions"], row["searches"], row["bookings"]) == (2, 5, 2)
    assert row["zero_result_rate"] == 0.2
    assert row["checkout_error_rate"] == 0.333333
    assert row["total_revenue"] == 12.75
