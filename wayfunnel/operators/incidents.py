"""Baseline against incident: comparison marts, tests and counterfactual revenue impact."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayfunnel.functions.measures import average, booked_revenue, round_to, rows
from wayfunnel.functions.stats import cohen_h, significant, two_proportion_z, two_sided_p
from wayfunnel.operators.marts import flag_totals, rates
from wayfunnel.settings import Incident

BASELINE, INCIDENT = "Baseline", "Incident"


@dataclass(frozen=True)
class Comparison:
    """Measures of a comparison, and which of them the impact is computed from."""

    counts: tuple[str, ...]
    rates: tuple[str, ...]
    base: str
    events: str
    event_rate: str
    conversion_rate: str
    event_label: str
    event_change: str
    conversion_label: str
    conversion_change: str
    with_latency: bool = False


SUPPLY = Comparison(
    counts=("zero_result_searches", "bookings"),
    rates=("zero_result_rate_pct", "conversion_rate_pct"),
    base="searches",
    events="zero_result_searches",
    event_rate="zero_result_rate_pct",
    conversion_rate="conversion_rate_pct",
    event_label="zero_result",
    event_change="zero_result_rate_change_pp",
    conversion_label="conversion_rate_pct",
    conversion_change="conversion_change_pp",
    with_latency=True,
)

CHECKOUT = Comparison(
    counts=(
        "checkout_attempts",
        "checkout_errors",
        "payment_failures",
        "checkout_abandonments",
        "bookings",
    ),
    rates=("checkout_error_rate_pct", "payment_failure_rate_pct", "checkout_to_booking_rate_pct"),
    base="checkout_attempts",
    events="checkout_errors",
    event_rate="checkout_error_rate_pct",
    conversion_rate="checkout_to_booking_rate_pct",
    event_label="checkout_error",
    event_change="checkout_error_change_pp",
    conversion_label="checkout_conversion_pct",
    conversion_change="checkout_conversion_change_pp",
)


def in_period(funnel: DataFrame, incident: Incident) -> DataFrame:
    """Scoped rows of both periods with a ``period`` label; the filter reaches the scan."""
    day = F.col("search_date")
    label = F.when(incident.incident.contains(day), INCIDENT).when(
        incident.baseline.contains(day), BASELINE
    )
    either = incident.incident.contains(day) | incident.baseline.contains(day)
    return funnel.where(incident.scope.matches() & either).withColumn("period", label)


def incident_comparison(
    funnel: DataFrame, incident: Incident, comparison: Comparison
) -> DataFrame:
    grouped = (
        in_period(funnel, incident)
        .groupBy("period")
        .agg(
            rows("searches"),
            *flag_totals(*comparison.counts),
            F.avg("search_latency_ms").alias("latency"),
            average(booked_revenue()).alias("order_value"),
            F.sum("revenue").alias("revenue"),
        )
    )
    latency = [round_to(F.col("latency")).alias("avg_search_latency_ms")]
    return grouped.select(
        "period",
        "searches",
        *comparison.counts,
        *rates(*comparison.rates),
        *(latency if comparison.with_latency else []),
        round_to(F.col("order_value")).alias("average_order_value"),
        round_to(F.col("revenue")).alias("revenue"),
    )


def _sides(compared: DataFrame) -> DataFrame:
    """Two rows to one: a struct per period, named ``b`` (baseline) and ``i`` (incident)."""
    row = F.struct(*[c for c in compared.columns if c != "period"])

    def side(name: str) -> Column:
        return F.max(F.when(F.col("period") == name, row))

    return compared.agg(side(BASELINE).alias("b"), side(INCIDENT).alias("i")).where(
        F.col("b").isNotNull() & F.col("i").isNotNull()
    )


def _z(comparison: Comparison) -> Column:
    """Incident first, so that z is positive when the incident has the higher rate."""
    return two_proportion_z(
        F.col(f"i.{comparison.events}"),
        F.col(f"i.{comparison.base}"),
        F.col(f"b.{comparison.events}"),
        F.col(f"b.{comparison.base}"),
    )


def _share(side: str, comparison: Comparison, measure: str) -> Column:
    base = F.col(f"{side}.{comparison.base}")
    return F.col(f"{side}.{measure}").cast("double") / F.nullif(base, F.lit(0))


def _effect(comparison: Comparison) -> Column:
    return cohen_h(
        _share("i", comparison, comparison.events), _share("b", comparison, comparison.events)
    )


def proportion_test(compared: DataFrame, comparison: Comparison) -> DataFrame:
    """z and p of the incident rate against the baseline rate, unrounded, one row."""
    z = _sides(compared).select(_z(comparison).alias("z_statistic"))
    return z.withColumn("p_value", two_sided_p(F.col("z_statistic")))


def effect_size(compared: DataFrame, comparison: Comparison) -> DataFrame:
    return _sides(compared).select(_effect(comparison).alias("cohen_h"))


def incident_impact(compared: DataFrame, comparison: Comparison) -> DataFrame:
    """One row: rate changes, lost bookings against the baseline conversion, revenue, test.

    Revenue uses the baseline order value as the comparison mart shows it, rounded.
    """
    expected = F.col(f"i.{comparison.base}") * _share("b", comparison, "bookings")
    # greatest skips NULLs: without a baseline the loss is undefined, not zero
    missing = expected - F.col("i.bookings")
    lost = F.when(missing.isNotNull(), F.greatest(missing, F.lit(0.0)))

    def before_after(measure: str, label: str, change: str | None) -> list[Column]:
        before, after = F.col(f"b.{measure}"), F.col(f"i.{measure}")
        columns = [before.alias(f"baseline_{label}"), after.alias(f"incident_{label}")]
        return columns + ([round_to(after - before).alias(change)] if change else [])

    event = comparison.event_label
    latency = before_after("avg_search_latency_ms", "latency_ms", None)
    impact = (
        _sides(compared)
        .withColumn("p", two_sided_p(_z(comparison)))
        .select(
            *before_after(comparison.event_rate, f"{event}_rate_pct", comparison.event_change),
            *before_after(
                comparison.conversion_rate,
                comparison.conversion_label,
                comparison.conversion_change,
            ),
            *(latency if comparison.with_latency else []),
            round_to(lost, 1).alias("estimated_lost_bookings"),
            round_to(lost * F.col("b.average_order_value")).alias("estimated_revenue_impact"),
            round_to(F.col("p"), 8).alias(f"{event}_test_p_value"),
            round_to(_effect(comparison), 4).alias(f"{event}_effect_size_cohen_h"),
        )
    )
    return impact.withColumn("significant", significant(F.col(f"{event}_test_p_value")))


def investigation_summary(
    overall: DataFrame, supply: DataFrame, checkout: DataFrame, alert_days: DataFrame
) -> DataFrame:
    """One nested row with the overall funnel, both impacts and the number of alert days."""

    def packed(frame: DataFrame) -> Column:
        return frame.select(F.struct(*frame.columns)).scalar()

    return overall.select(
        F.struct(*overall.columns).alias("overall"),
        packed(supply).alias("supply_incident"),
        packed(checkout).alias("checkout_incident"),
        alert_days.agg(rows("n")).scalar().alias("anomaly_alert_days"),
    )
