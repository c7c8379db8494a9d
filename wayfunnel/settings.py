"""Parameters of the operators, with the standard values as defaults."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class AlertRule:
    """Rolling baseline of the last rows before a day, and the z limit for an alert."""

    baseline_rows: int = 28
    min_rows: int = 14
    z_limit: float = 2.5


@dataclass(frozen=True)
class Period:
    """Inclusive date range."""

    first: date
    last: date

    def contains(self, day: Column) -> Column:
        return day.between(F.lit(self.first), F.lit(self.last))


@dataclass(frozen=True)
class Scope:
    """Which searches an incident touches; an empty tuple leaves that side open."""

    stations: tuple[str, ...] = ()
    device_types: tuple[str, ...] = ()

    def matches(self) -> Column:
        condition = F.lit(True)
        if self.stations:
            condition = F.col("origin_station").isin(*self.stations) | F.col(
                "destination_station"
            ).isin(*self.stations)
        if self.device_types:
            condition = condition & F.col("device_type").isin(*self.device_types)
        return condition


@dataclass(frozen=True)
class Incident:
    scope: Scope
    baseline: Period
    incident: Period


SUPPLY_INCIDENT = Incident(
    Scope(stations=("London Euston", "Manchester Piccadilly")),
    baseline=Period(date(2026, 2, 9), date(2026, 3, 8)),
    incident=Period(date(2026, 3, 9), date(2026, 3, 15)),
)

CHECKOUT_INCIDENT = Incident(
    Scope(device_types=("Mobile Web", "Android App")),
    baseline=Period(date(2026, 3, 16), date(2026, 4, 12)),
    incident=Period(date(2026, 4, 13), date(2026, 4, 19)),
)


@dataclass(frozen=True)
class SplitDates:
    """Train ends before the first boundary, test starts at the second."""

    validation_from: datetime = datetime(2026, 5, 1)
    test_from: datetime = datetime(2026, 6, 1)


# Feature names and order, target, prediction point.
CATEGORICAL_FEATURES = (
    "device_type",
    "operating_system",
    "acquisition_channel",
    "customer_type",
    "country",
    "origin_station",
    "destination_station",
    "journey_type",
)
NUMERIC_FEATURES = (
    "is_logged_in",
    "passengers",
    "railcard_used",
    "results_count",
    "search_latency_ms",
    "zero_results_flag",
    "days_before_travel",
    "search_hour",
    "day_of_week",
    "search_month",
)
FEATURES = CATEGORICAL_FEATURES + NUMERIC_FEATURES
TARGET = "booked_flag"
PREDICTION_POINT = "after search results and before journey selection"
DEFAULT_THRESHOLD = 0.50


@dataclass(frozen=True)
class BoostingParams:
    step_size: float = 0.08
    rounds: int = 250
    max_depth: int = 5
    min_rows_per_leaf: int = 40
    max_bins: int = 256
    validation_tolerance: float = 1e-7
    holdout_percent: int = 10


@dataclass(frozen=True)
class HistogramBoostingParams:
    """Boosting with trees grown best leaf first. It stops early when none of the last `patience`
    rounds lowers the held-out loss by more than the tolerance. A subtree of up to `local_rows` rows
    is grown by one task."""

    step_size: float = 0.08
    rounds: int = 250
    max_leaves: int = 31
    min_rows_per_leaf: int = 40
    l2: float = 0.5
    max_bins: int = 255
    patience: int = 10
    tolerance: float = 1e-7
    holdout_percent: int = 10
    rewrite_rounds: int = 10
    local_rows: int = 262_144


@dataclass(frozen=True)
class ModelParams:
    seed: int = 42
    logistic_iterations: int = 1000
    inverse_regularisation: float = 1.0
    boosting: BoostingParams = field(default_factory=BoostingParams)
    histogram: HistogramBoostingParams = field(default_factory=HistogramBoostingParams)
