import statistics
from datetime import date, timedelta

from wayfunnel.operators import alerts
from wayfunnel.settings import AlertRule


def daily(spark, conversion, zero=None, error=None, route=None):
    zero = zero or [5.0] * len(conversion)
    error = error or [4.0] * len(conversion)
    rows = [
        (date(2026, 1, 1) + timedelta(days=2 * i), c, z, e, 100, 10, 1.0)
        for i, (c, z, e) in enumerate(zip(conversion, zero, error))
    ]
    return spark.createDataFrame(
        rows,
        "metric_date date, search_to_book_conversion_pct double, zero_result_rate_pct double, "
        "checkout_error_rate_pct double, searches bigint, bookings bigint, revenue double",
    )


def run(frame):
    return alerts.daily_anomaly_alerts(frame).orderBy("metric_date").collect()


def test_baseline_counts_rows_and_leaves_out_today(spark):
    values = [30.0 + (i % 5) for i in range(40)]
    rows = alerts.rolling_baseline(daily(spark, values)).orderBy("metric_date").collect()
    assert [r["baseline_days"] for r in rows[:3]] == [0, 1, 2]
    assert rows[-1]["baseline_days"] == 28
    window = values[11:39]
    assert abs(rows[-1]["conversion_avg_28d"] - statistics.mean(window)) < 1e-9
    assert abs(rows[-1]["conversion_sd_28d"] - statistics.stdev(window)) < 1e-9


def test_constant_baseline_has_no_score(spark):
    rows = run(daily(spark, [5.83] * 20 + [0.0]))
    assert rows[-1]["conversion_zscore"] is None
    assert (rows[-1]["alert_flag"], rows[-1]["alert_reason"]) == (0, "")


def test_alert_needs_fourteen_rows_but_the_reason_does_not(spark):
    noise = [30.0, 31.0] * 20
    early = run(daily(spark, noise[:13] + [10.0]))[-1]
    assert (early["baseline_days"], early["alert_flag"]) == (13, 0)
    assert early["alert_reason"] == "Conversion decline"
    due = run(daily(spark, noise[:14] + [10.0]))[-1]
    assert (due["baseline_days"], due["alert_flag"]) == (14, 1)


def test_reasons_are_joined(spark):
    noise = [30.0, 31.0] * 10
    row = run(daily(spark, noise + [10.0], noise + [90.0], noise + [90.0]))[-1]
    assert row["alert_reason"] == "Conversion decline; Zero-result spike; Checkout-error spike"


def test_missing_error_rate_is_not_an_alert_and_is_skipped_by_the_mean(spark):
    noise = [30.0, 31.0] * 10
    error = [4.0, 5.0] * 9 + [None, 4.0, None]
    rows = run(daily(spark, noise + [30.0], noise + [30.0], error))
    assert rows[-1]["checkout_error_zscore"] is None and rows[-1]["alert_flag"] == 0
    assert rows[-1]["baseline_days"] == 20
    known = [v for v in error[:-1] if v is not None]
    assert abs(rows[-1]["checkout_error_avg_28d"] - statistics.mean(known)) < 1e-9


def test_report_has_alert_days_only(spark):
    frame = daily(spark, [30.0, 31.0] * 10 + [10.0])
    report = alerts.anomaly_alert_days(alerts.daily_anomaly_alerts(frame)).collect()
    expected = (10.0 - 30.5) / statistics.stdev([30.0, 31.0] * 10)
    assert len(report) == 1 and report[0]["conversion_zscore"] == round(expected, 2)


def test_rule_parameters(spark):
    frame = daily(spark, [30.0, 31.0] * 3 + [10.0])
    rule = AlertRule(baseline_rows=28, min_rows=4, z_limit=2.0)
    rows = alerts.daily_anomaly_alerts(frame, rule).where("alert_flag = 1").collect()
    assert len(rows) == 1
