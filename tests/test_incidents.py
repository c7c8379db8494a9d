import math
from datetime import date

import pytest
from conftest import one
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from wayfunnel.functions.stats import cohen_h, two_proportion_z, two_sided_p
from wayfunnel.operators import incidents
from wayfunnel.settings import Incident, Period, Scope


def supply_rows(spark):
    """Published comparison of the supply incident."""
    return spark.createDataFrame(
        [
            ("Baseline", 5303, 309, 1606, 5.83, 30.28, 815.02, 63.71, 102315.64),
            ("Incident", 1306, 264, 316, 20.21, 24.2, 1121.15, 60.49, 19114.39),
        ],
        "period string, searches bigint, zero_result_searches bigint, bookings bigint, "
        "zero_result_rate_pct double, conversion_rate_pct double, avg_search_latency_ms double, "
        "average_order_value double, revenue double",
    )


def checkout_rows(spark):
    """Published comparison of the checkout incident."""
    return spark.createDataFrame(
        [
            ("Baseline", 18438, 8675, 494, 324, 2348, 5509, 5.69, 3.73, 63.5, 66.82, 368127.83),
            ("Incident", 4417, 2047, 423, 78, 434, 1112, 20.66, 3.81, 54.32, 64.38, 71591.12),
        ],
        "period string, searches bigint, checkout_attempts bigint, checkout_errors bigint, "
        "payment_failures bigint, checkout_abandonments bigint, bookings bigint, "
        "checkout_error_rate_pct double, payment_failure_rate_pct double, "
        "checkout_to_booking_rate_pct double, average_order_value double, revenue double",
    )


def test_supply_impact_matches_the_published_values(spark):
    assert one(incidents.incident_impact(supply_rows(spark), incidents.SUPPLY)) == {
        "baseline_zero_result_rate_pct": 5.83,
        "incident_zero_result_rate_pct": 20.21,
        "zero_result_rate_change_pp": 14.38,
        "baseline_conversion_rate_pct": 30.28,
        "incident_conversion_rate_pct": 24.2,
        "conversion_change_pp": -6.08,
        "baseline_latency_ms": 815.02,
        "incident_latency_ms": 1121.15,
        "estimated_lost_bookings": 79.5,
        "estimated_revenue_impact": 5066.14,
        "zero_result_test_p_value": 0.0,
        "zero_result_effect_size_cohen_h": 0.445,
        "significant": True,
    }


def test_checkout_impact_matches_the_published_values(spark):
    assert one(incidents.incident_impact(checkout_rows(spark), incidents.CHECKOUT)) == {
        "baseline_checkout_error_rate_pct": 5.69,
        "incident_checkout_error_rate_pct": 20.66,
        "checkout_error_change_pp": 14.97,
        "baseline_checkout_conversion_pct": 63.5,
        "incident_checkout_conversion_pct": 54.32,
        "checkout_conversion_change_pp": -9.18,
        "estimated_lost_bookings": 187.9,
        "estimated_revenue_impact": 12557.72,
        "checkout_error_test_p_value": 0.0,
        "checkout_error_effect_size_cohen_h": 0.4619,
        "significant": True,
    }


def test_z_statistics(spark):
    z = one(incidents.proportion_test(supply_rows(spark), incidents.SUPPLY))["z_statistic"]
    assert z == pytest.approx(16.551366, abs=1e-6)
    z = one(incidents.proportion_test(checkout_rows(spark), incidents.CHECKOUT))["z_statistic"]
    assert z == pytest.approx(21.784164, abs=1e-6)


def test_p_value_is_the_normal_tail(spark):
    zs = [0.0, 0.1, -0.7, 1.0, 1.959964, -2.5, 4.0, 8.0, 16.55, 40.0]
    frame = spark.createDataFrame([(z,) for z in zs], "z double")
    for z, p in frame.select("z", two_sided_p(F.col("z"))).collect():
        assert p == pytest.approx(math.erfc(abs(z) / math.sqrt(2)), rel=1e-11)


@settings(max_examples=15, deadline=None)
@given(
    st.tuples(st.integers(0, 50), st.integers(50, 90), st.integers(0, 50), st.integers(50, 90))
)
def test_z_and_h_against_plain_arithmetic(spark, counts):
    a, n, b, m = counts
    columns = [F.lit(value) for value in counts]
    row = one(
        spark.range(1).select(
            two_proportion_z(*columns).alias("z"),
            cohen_h(F.lit(a / n), F.lit(b / m)).alias("h"),
        )
    )
    pooled = (a + b) / (n + m)
    variance = pooled * (1 - pooled) * (1 / n + 1 / m)
    expected = (a / n - b / m) / math.sqrt(variance) if variance > 0 else None
    assert row["z"] == pytest.approx(expected) if expected is not None else row["z"] is None
    h = 2 * math.asin(math.sqrt(a / n)) - 2 * math.asin(math.sqrt(b / m))
    assert row["h"] == pytest.approx(h)


def test_undefined_tests_are_null(spark):
    zero = F.lit(0)
    row = one(
        spark.range(1).select(
            two_proportion_z(zero, zero, F.lit(1), F.lit(2)).alias("z"),
            cohen_h(F.lit(None).cast("double"), F.lit(0.5)).alias("h"),
            cohen_h(F.lit(1.7), F.lit(-3.0)).alias("clamped"),
        )
    )
    assert row["z"] is None and row["h"] is None
    assert row["clamped"] == pytest.approx(math.pi)


def test_scope_and_periods(small_funnel):
    day = date(2026, 1, 5)
    before = Period(date(2025, 12, 1), date(2025, 12, 31))
    touched = Incident(Scope(device_types=("Mobile Web",)), before, Period(day, day))
    rows = incidents.in_period(small_funnel, touched).collect()
    assert {(r["search_id"], r["period"]) for r in rows} == {
        ("q1", "Incident"),
        ("q2", "Incident"),
    }
    either_end = Incident(Scope(stations=("x",)), before, Period(day, day))
    assert incidents.in_period(small_funnel, either_end).count() == 5
    elsewhere = Incident(Scope(stations=("y",)), before, Period(day, day))
    assert incidents.in_period(small_funnel, elsewhere).count() == 0


def test_impact_needs_both_periods_and_is_never_negative(spark):
    rows = supply_rows(spark)
    only = rows.where("period = 'Incident'")
    assert incidents.incident_impact(only, incidents.SUPPLY).count() == 0
    better = rows.withColumn("bookings", F.when(F.col("period") == "Incident", 9999).otherwise(1))
    assert one(incidents.incident_impact(better, incidents.SUPPLY))["estimated_lost_bookings"] == 0


def test_impact_without_a_baseline_is_undefined(spark):
    rows = checkout_rows(spark).where("period = 'Incident'")
    columns = rows.columns
    empty = checkout_rows(spark).where("period <> 'Incident'").select(
        *[
            F.col(c) if c == "period" else F.lit(None).cast(dict(rows.dtypes)[c]).alias(c)
            for c in columns
        ]
    )
    row = one(incidents.incident_impact(rows.unionByName(empty), incidents.CHECKOUT))
    assert row["estimated_lost_bookings"] is None and row["estimated_revenue_impact"] is None
