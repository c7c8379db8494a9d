from datetime import date, datetime

import pytest
from conftest import one, table

from wayfunnel.operators import funnel, joins, marts, staging
from wayfunnel.plans.warehouse import build_funnel


def by_id(frame):
    return {row["search_id"]: row.asDict() for row in frame.collect()}


def test_staging_derives_day_hour_route_and_lead_time(spark):
    raw = table(
        spark,
        "searches",
        {
            "search_id": "q1",
            "searched_at": datetime(2026, 3, 1, 23, 59),
            "travel_date": date(2026, 3, 11),
            "origin_station": "A",
            "destination_station": "B",
        },
    )
    row = one(staging.stage_searches(raw))
    assert (row["search_date"], row["search_hour"]) == (date(2026, 3, 1), 23)
    assert row["route"] == "A → B" and row["days_before_travel"] == 10


def test_staging_types_follow_the_contract(small):
    for name, stage in staging.STAGERS.items():
        narrow = small[name].select(
            *[
                c if k != "int" else small[name][c].cast("smallint").alias(c)
                for c, k in small[name].dtypes
            ]
        )
        assert stage(narrow).dtypes == stage(small[name]).dtypes


def test_selected_options_take_independent_maxima(small_funnel):
    row = by_id(small_funnel)["q1"]
    assert row["selected_result_id"] == "r2"
    assert (row["selected_fare"], row["selected_changes"]) == (9.0, 2)


def test_lexical_maximum_hides_an_earlier_error(small_funnel):
    row = by_id(small_funnel)["q1"]
    assert (row["error_type"], row["checkout_error_flag"]) == ("None", 1)
    assert row["revenue"] == 12.75 and row["booking_id"] == "b2"


def test_stage_precedence_and_abandonment(small_funnel):
    rows = by_id(small_funnel)
    stages = {key: row["furthest_funnel_stage"] for key, row in rows.items()}
    assert stages == {
        "q1": "Booked",
        "q2": "Checkout",
        "q3": "Search",
        "q4": "Results",
        "q5": "Selected",
    }
    assert [rows[q]["checkout_abandoned_flag"] for q in sorted(rows)] == [0, 1, 0, 0, 0]


def test_search_without_session_or_checkout_keeps_nulls(small_funnel):
    row = by_id(small_funnel)["q4"]
    assert row["customer_id"] is None and row["error_type"] is None
    assert row["revenue"] == 0.0 and row["selected_flag"] == 0


def test_dropping_unselected_options_changes_nothing(small, small_funnel):
    staged = staging.stage_all(small)
    kept = funnel.selected_results(staged["journey_results"])
    assert by_id(kept)["q4"]["selected_flag"] == 0  # the mart itself keeps such searches
    assert small_funnel.count() == staged["searches"].count()


def test_empty_funnel(spark, small):
    empty = {name: frame.limit(0) for name, frame in small.items()}
    result = build_funnel(staging.stage_all(empty))
    kpi = one(marts.kpi_summary(result))
    assert kpi["searches"] == 0 and kpi["zero_result_rate_pct"] is None
    assert one(marts.overall_funnel(result))["search_to_book_rate_pct"] is None
    assert marts.daily_funnel(result).count() == 0


def test_checked_join_accepts_unique_and_rejects_repeated_keys(spark):
    left = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "k int, l string")
    right = spark.createDataFrame([(1, "x")], "k int, r string")
    rows = joins.checked_join(left, right, ["k"]).orderBy("l").collect()
    assert [r["r"] for r in rows] == ["x", "x", None]
    with pytest.raises(Exception, match="left key"):
        joins.checked_join(left, right, ["k"], validate="one_to_one").collect()
    with pytest.raises(Exception, match="right key"):
        joins.checked_join(left, right.union(right), ["k"]).collect()
    # also when only a count is asked for, or the right columns are not used
    with pytest.raises(Exception, match="right key"):
        joins.checked_join(left, right.union(right), ["k"]).select("l").collect()
    with pytest.raises(ValueError):
        joins.checked_join(left, right, ["k"], validate="many_to_many")
