from datetime import datetime

import pytest
from conftest import one, table
from pyspark.sql import functions as F

from wayfunnel.operators import features, quality, staging
from wayfunnel.plans.warehouse import build_funnel
from wayfunnel.schemas import CONTRACT
from wayfunnel.settings import SplitDates


def counts(report):
    return {row["check"]: row["violations"] for row in report.collect()}


def test_clean_given_data_passes(j):
    report = quality.dq_report(j.staged_tables(), j.funnel)
    assert set(counts(report).values()) == {0} and report.count() == 13
    quality.run_checks(report)


def test_findings_of_the_awkward_journey(small, small_funnel):
    found = counts(quality.dq_report(staging.stage_all(small), small_funnel))
    found = {check: n for check, n in found.items() if n}
    # q4 has no session; q1 has two selected options
    assert found == {"orphan_searches": 1, "one_selection_per_search": 1}
    with pytest.raises(quality.QualityError, match="orphan_searches"):
        quality.run_checks(quality.dq_report(staging.stage_all(small), small_funnel))


def test_null_and_repeated_keys(spark, small):
    sessions = table(
        spark, "sessions", {"session_id": "s"}, {"session_id": "s"}, {"session_id": None}
    )
    searches = table(
        spark,
        "searches",
        {"search_id": "q1", "session_id": None},
        {"search_id": "q2", "session_id": "s"},
        {"search_id": "q3", "session_id": "s"},
    )
    # a NULL reference is an orphan even next to a NULL key
    assert counts(quality.session_checks(sessions, searches)) == {
        "duplicate_sessions": 1,
        "orphan_searches": 1,
    }


def test_zero_flag_and_funnel_order(spark, small):
    searches = staging.stage_searches(
        table(
            spark,
            "searches",
            {"search_id": "q1", "results_count": 0, "zero_results_flag": 0},
            {"search_id": "q2", "results_count": 2, "zero_results_flag": 1},
            {"search_id": "q3", "results_count": 2},
        )
    )
    staged = staging.stage_all(small) | {"searches": searches}
    report = counts(
        quality.search_checks(searches, staged["journey_results"], staged["checkout"])
    )
    assert report["zero_flag_consistency"] == 2
    funnel = build_funnel(staged)
    found = counts(quality.funnel_checks(funnel))
    # q1 is selected without results
    assert found["invalid_funnel_order"] == 1 and found["zero_result_selected"] == 1


def test_empty_tables_have_no_violations(small, small_funnel):
    empty = {name: frame.limit(0) for name, frame in staging.stage_all(small).items()}
    assert set(counts(quality.dq_report(empty, small_funnel.limit(0))).values()) == {0}


def test_contract_check(spark, small):
    broken = dict(small)
    broken["checkout"] = small["checkout"].drop("error_type").withColumn(
        "checkout_error_flag", F.col("checkout_error_flag").cast("bigint")
    )
    broken["bookings"] = small["bookings"].union(small["bookings"])
    broken["sessions"] = small["sessions"].withColumn(
        "session_id", F.when(F.col("session_id") != "s2", F.col("session_id"))
    )
    rows = {r["table_name"]: r.asDict() for r in quality.contract_check(broken).collect()}
    assert rows["checkout"]["missing_columns"] == "error_type"
    assert rows["checkout"]["mistyped_columns"] == "checkout_error_flag"
    assert (rows["bookings"]["duplicate_keys"], rows["bookings"]["row_count"]) == (2, 4)
    assert (rows["sessions"]["null_keys"], rows["sessions"]["duplicate_keys"]) == (1, 0)
    assert rows["searches"]["missing_columns"] == ""
    found = quality.contract_violations(quality.contract_check(broken)).collect()
    assert {tuple(r) for r in found} == {
        ("checkout", "error_type", "missing column"),
        ("checkout", "checkout_error_flag", "wrong type"),
        ("bookings", "booking_id", "repeated key"),
        ("sessions", "session_id", "NULL key"),
    }
    assert quality.contract_violations(quality.contract_check(small)).count() == 0
    quality.enforce_columns(small)
    with pytest.raises(quality.QualityError, match="checkout.error_type"):
        quality.enforce_columns(broken)
    with pytest.raises(quality.QualityError, match="bookings"):
        quality.enforce_columns({n: f for n, f in small.items() if n != "bookings"})


def test_model_dataset_and_split_checks(spark):
    at = datetime(2026, 4, 1), datetime(2026, 5, 2), datetime(2026, 6, 3)
    rows = spark.createDataFrame(
        [("a", at[0], 0), ("a", at[1], 1), ("b", at[2], 2)],
        "search_id string, searched_at timestamp_ntz, booked_flag int",
    )
    assert counts(quality.model_dataset_checks(rows)) == {
        "duplicate_search_ids": 1,
        "target_not_binary": 1,
    }
    labelled = features.label_split(rows)
    assert set(counts(quality.split_checks(labelled)).values()) == {0}
    late = features.label_split(rows, SplitDates(datetime(2026, 7, 1), datetime(2026, 8, 1)))
    assert counts(quality.split_checks(late))["test_empty"] == 1
    overlapping = rows.withColumn(
        "split", F.when(F.col("booked_flag") == 2, "train").otherwise("validation")
    )
    assert counts(quality.split_checks(overlapping))["train_overlaps_validation"] == 1
    with pytest.raises(quality.QualityError, match="passengers"):
        quality.require_columns(rows, ["search_id", "passengers"], "dataset")


def test_alert_reconciliation(spark):
    summary = spark.createDataFrame([(2,)], "anomaly_alert_days bigint")
    days = spark.range(2)
    assert one(quality.alert_reconciliation(summary, days))["violations"] == 0
    assert one(quality.alert_reconciliation(summary, days.limit(1)))["violations"] == 1


def test_every_declared_foreign_key_is_checked(small):
    raw = staging.stage_all(small)
    report = {
        (r["table_name"], r["column_name"]): (r["parent_table"], r["row_count"], r["null_keys"], r["orphans"])
        for r in quality.foreign_key_report(raw).collect()
    }
    assert len(report) == sum(len(d.foreign_keys) for d in CONTRACT.values()) == 7
    assert report["searches", "session_id"] == ("sessions", 5, 0, 1)
    assert report["checkout", "session_id"] == ("sessions", 3, 0, 0)
    # the bookings carry a session that is not there
    assert report["bookings", "session_id"] == ("sessions", 2, 0, 2)
    lost = raw | {"bookings": raw["bookings"].withColumn("checkout_id", F.lit(None).cast("string"))}
    checks = {r["check"]: r["violations"] for r in quality.foreign_key_checks(lost).collect()}
    assert checks["orphan_bookings_checkout_id"] == 2 and checks["orphan_bookings_search_id"] == 0
    with pytest.raises(quality.QualityError, match="orphan_searches_session_id"):
        quality.run_checks(quality.foreign_key_checks(raw))
