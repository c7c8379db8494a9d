"""Contract of the six input tables: grain, keys, columns and staged types."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

_STRING = T.StringType()
_INT = T.IntegerType()
_LONG = T.LongType()
_DOUBLE = T.DoubleType()
_TIME = T.TimestampNTZType()
_DATE = T.DateType()


@dataclass(frozen=True)
class ForeignKey:
    column: str
    parent: str


@dataclass(frozen=True)
class Dataset:
    name: str
    grain: str
    primary_key: str
    columns: tuple[tuple[str, T.DataType], ...]
    foreign_keys: tuple[ForeignKey, ...] = ()

    @property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(name, kind) for name, kind in self.columns])


SESSIONS = Dataset(
    "sessions",
    "one row per customer session",
    "session_id",
    (
        ("session_id", _STRING),
        ("customer_id", _STRING),
        ("session_started_at", _TIME),
        ("device_type", _STRING),
        ("operating_system", _STRING),
        ("acquisition_channel", _STRING),
        ("customer_type", _STRING),
        ("country", _STRING),
        ("is_logged_in", _INT),
    ),
)

SEARCHES = Dataset(
    "searches",
    "one row per journey search",
    "search_id",
    (
        ("search_id", _STRING),
        ("session_id", _STRING),
        ("searched_at", _TIME),
        ("origin_station", _STRING),
        ("destination_station", _STRING),
        ("travel_date", _DATE),
        ("passengers", _INT),
        ("journey_type", _STRING),
        ("railcard_used", _INT),
        ("results_count", _INT),
        ("search_latency_ms", _INT),
        ("zero_results_flag", _INT),
    ),
    (ForeignKey("session_id", "sessions"),),
)

JOURNEY_RESULTS = Dataset(
    "journey_results",
    "one row per journey option displayed",
    "result_id",
    (
        ("result_id", _STRING),
        ("search_id", _STRING),
        ("operator", _STRING),
        ("departure_time", _TIME),
        ("arrival_time", _TIME),
        ("duration_minutes", _INT),
        ("changes", _INT),
        ("fare", _DOUBLE),
        ("fare_type", _STRING),
        ("result_position", _INT),
        ("selected_flag", _INT),
    ),
    (ForeignKey("search_id", "searches"),),
)

CHECKOUT = Dataset(
    "checkout",
    "one row per checkout attempt",
    "checkout_id",
    (
        ("checkout_id", _STRING),
        ("session_id", _STRING),
        ("search_id", _STRING),
        ("checkout_started_at", _TIME),
        ("device_type", _STRING),
        ("payment_method", _STRING),
        ("checkout_error_flag", _INT),
        ("error_type", _STRING),
        ("payment_failure_flag", _INT),
        ("checkout_completed_flag", _INT),
    ),
    (ForeignKey("session_id", "sessions"), ForeignKey("search_id", "searches")),
)

BOOKINGS = Dataset(
    "bookings",
    "one row per completed booking",
    "booking_id",
    (
        ("booking_id", _STRING),
        ("session_id", _STRING),
        ("search_id", _STRING),
        ("checkout_id", _STRING),
        ("booked_at", _TIME),
        ("ticket_value", _DOUBLE),
        ("booking_fee", _DOUBLE),
        ("total_revenue", _DOUBLE),
        ("passengers", _INT),
        ("operator", _STRING),
        ("origin_station", _STRING),
        ("destination_station", _STRING),
    ),
    (
        ForeignKey("session_id", "sessions"),
        ForeignKey("search_id", "searches"),
        ForeignKey("checkout_id", "checkout"),
    ),
)

STATION_REFERENCE = Dataset(
    "station_reference",
    "one row per railway station",
    "station_code",
    (
        ("station_code", _STRING),
        ("station_name", _STRING),
        ("region", _STRING),
        ("annual_entries_exits", _LONG),
        ("interchange_volume", _LONG),
    ),
)

CONTRACT: dict[str, Dataset] = {
    d.name: d
    for d in (SESSIONS, SEARCHES, JOURNEY_RESULTS, CHECKOUT, BOOKINGS, STATION_REFERENCE)
}
