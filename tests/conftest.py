from __future__ import annotations

import sys
from datetime import date, datetime
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from bench import session  # noqa: E402
from wayfunnel.operators import staging  # noqa: E402
from wayfunnel.plans.warehouse import build_funnel  # noqa: E402
from wayfunnel.schemas import CONTRACT  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    spark = session(8)
    yield spark
    spark.stop()


@pytest.fixture(scope="session")
def j(spark):
    from fixtures.derive import journey

    return journey(spark, SF)


def table(spark, name: str, *rows: dict):
    """Rows of a contract table; columns left out are filled with a plain value."""
    plain = {
        "string": "x",
        "int": 0,
        "bigint": 0,
        "double": 0.0,
        "timestamp_ntz": datetime(2026, 1, 5, 10, 30),
        "date": date(2026, 1, 15),
    }
    schema = CONTRACT[name].schema
    data = [
        tuple(row.get(f.name, plain[f.dataType.simpleString()]) for f in schema) for row in rows
    ]
    return spark.createDataFrame(data, schema)


@pytest.fixture(scope="session")
def small(spark):
    """A journey with the awkward cases: see the comments."""
    raw = {
        "sessions": table(
            spark,
            "sessions",
            {"session_id": "s1", "customer_id": "c1", "device_type": "Mobile Web"},
            {"session_id": "s2", "customer_id": "c2", "device_type": "iOS App"},
        ),
        "searches": table(
            spark,
            "searches",
            {"search_id": "q1", "session_id": "s1", "results_count": 3},
            {"search_id": "q2", "session_id": "s1", "results_count": 2},
            {"search_id": "q3", "session_id": "s2", "zero_results_flag": 1},
            # no such session
            {"search_id": "q4", "session_id": "s9", "results_count": 1},
            {"search_id": "q5", "session_id": "s2", "results_count": 2},
        ),
        "journey_results": table(
            spark,
            "journey_results",
            # two selected options: the maxima are taken column by column
            {"result_id": "r1", "search_id": "q1", "selected_flag": 1, "fare": 9.0, "changes": 0},
            {"result_id": "r2", "search_id": "q1", "selected_flag": 1, "fare": 5.0, "changes": 2},
            {"result_id": "r3", "search_id": "q1", "fare": 99.0},
            {"result_id": "r4", "search_id": "q2", "selected_flag": 1, "fare": 7.0},
            {"result_id": "r5", "search_id": "q4"},
            {"result_id": "r6", "search_id": "q5", "selected_flag": 1},
        ),
        "checkout": table(
            spark,
            "checkout",
            # two attempts: 'None' is the lexical maximum
            {
                "checkout_id": "h1",
                "session_id": "s1",
                "search_id": "q1",
                "checkout_error_flag": 1,
                "error_type": "Fare Changed",
            },
            {
                "checkout_id": "h2",
                "session_id": "s1",
                "search_id": "q1",
                "error_type": "None",
                "checkout_completed_flag": 1,
            },
            {
                "checkout_id": "h3",
                "session_id": "s1",
                "search_id": "q2",
                "error_type": "None",
            },
        ),
        "bookings": table(
            spark,
            "bookings",
            {"booking_id": "b1", "search_id": "q1", "checkout_id": "h2", "total_revenue": 10.25},
            {"booking_id": "b2", "search_id": "q1", "checkout_id": "h2", "total_revenue": 2.5},
        ),
        "station_reference": table(spark, "station_reference", {"station_code": "RS1"}),
    }
    return raw


@pytest.fixture(scope="session")
def small_funnel(small):
    return build_funnel(staging.stage_all(small))


def one(frame) -> dict:
    rows = frame.collect()
    assert len(rows) == 1
    return rows[0].asDict(recursive=True)
