"""Typed staging projections. All narrow: no shuffle, columns prune down to the scan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayfunnel.schemas import BOOKINGS, CHECKOUT, CONTRACT, JOURNEY_RESULTS, SEARCHES, SESSIONS
from wayfunnel.schemas import STATION_REFERENCE, Dataset


def _typed(dataset: Dataset, derived: dict[str, tuple[tuple[str, Column], ...]]) -> list[Column]:
    """Cast every contract column; ``derived`` adds columns right after the named one."""
    columns = []
    for name, kind in dataset.columns:
        columns.append(F.col(name).cast(kind).alias(name))
        columns.extend(value.alias(alias) for alias, value in derived.get(name, ()))
    return columns


def _day(column: str) -> Column:
    return F.col(column).cast("date")


def stage_sessions(raw: DataFrame) -> DataFrame:
    at = "session_started_at"
    return raw.select(
        _typed(SESSIONS, {at: (("session_date", _day(at)), ("session_hour", F.hour(at)))})
    )


def stage_searches(raw: DataFrame) -> DataFrame:
    at = "searched_at"
    route = F.concat("origin_station", F.lit(" → "), "destination_station")
    lead_time = F.datediff(_day("travel_date"), _day(at))
    return raw.select(
        _typed(
            SEARCHES,
            {
                at: (("search_date", _day(at)), ("search_hour", F.hour(at))),
                "destination_station": (("route", route),),
                "travel_date": (("days_before_travel", lead_time),),
            },
        )
    )


def stage_journey_results(raw: DataFrame) -> DataFrame:
    return raw.select(_typed(JOURNEY_RESULTS, {}))


def stage_checkout(raw: DataFrame) -> DataFrame:
    at = "checkout_started_at"
    return raw.select(_typed(CHECKOUT, {at: (("checkout_date", _day(at)),)}))


def stage_bookings(raw: DataFrame) -> DataFrame:
    at = "booked_at"
    return raw.select(_typed(BOOKINGS, {at: (("booking_date", _day(at)),)}))


def stage_station_reference(raw: DataFrame) -> DataFrame:
    return raw.select(_typed(STATION_REFERENCE, {}))


STAGERS = {
    "sessions": stage_sessions,
    "searches": stage_searches,
    "journey_results": stage_journey_results,
    "checkout": stage_checkout,
    "bookings": stage_bookings,
    "station_reference": stage_station_reference,
}


def stage_all(raw: dict[str, DataFrame]) -> dict[str, DataFrame]:
    return {name: STAGERS[name](raw[name]) for name in CONTRACT}
