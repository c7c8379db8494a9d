"""Warehouse build: stage, join, check, derive marts, export, summarise."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import cached_property, partial

from pyspark.sql import DataFrame, SparkSession

from wayfunnel.operators import alerts, funnel, marts, quality, staging
from wayfunnel.settings import AlertRule
from wayfunnel.sources import exports, raw, warehouse
from wayfunnel.sources.together import run_together


@dataclass
class Marts:
    """All marts as lazy DataFrames over one (written) funnel."""

    search_funnel: DataFrame
    bookings: DataFrame
    rule: AlertRule = AlertRule()

    @cached_property
    def kpi_summary(self) -> DataFrame:
        return marts.kpi_summary(self.search_funnel)

    @cached_property
    def daily_funnel(self) -> DataFrame:
        return marts.daily_funnel(self.search_funnel)

    def named(self) -> dict[str, DataFrame]:
        f = self.search_funnel
        return {
            "analytics.search_funnel": f,
            "analytics.kpi_summary": self.kpi_summary,
            "analytics.daily_funnel": self.daily_funnel,
            "analytics.device_performance": marts.device_performance(f),
            "analytics.channel_performance": marts.channel_performance(f),
            "analytics.route_performance": marts.route_performance(f),
            "analytics.zero_result_analysis": marts.zero_result_analysis(f),
            "analytics.checkout_failure_analysis": marts.checkout_failure_analysis(f),
            "analytics.commercial_impact": marts.commercial_impact(f, self.bookings),
            "product.daily_anomaly_alerts": alerts.daily_anomaly_alerts(
                self.daily_funnel, self.rule
            ),
        }


def build_funnel(staged: dict[str, DataFrame]) -> DataFrame:
    return funnel.search_funnel(
        staged["sessions"],
        staged["searches"],
        staged["journey_results"],
        staged["checkout"],
        staged["bookings"],
    )


def build_warehouse(
    spark: SparkSession,
    raw_directory: str,
    export_directory: str,
    prefix: str = "",
    rule: AlertRule = AlertRule(),
    partition_funnel_by: Sequence[str] = ("search_date",),
) -> dict[str, DataFrame]:
    """Run the whole stage and return the written marts by name.

    The staged tables are written first, typed, under their names in the staging layer; everything
    after reads those. A row without its key, or whose declared foreign key has no parent, stops the
    build there. The funnel and the daily funnel are written before anything reads them. Checks run
    before any export and stop the build. The funnel is partitioned by day, which prunes the scans of incident
    and date ranges; pass ``()`` for a few days of data.
    """
    tables = raw.read_raw(spark, raw_directory)
    quality.enforce_columns(tables)
    raw.register_raw_views(tables)
    warehouse.create_layers(spark, prefix)
    staged = run_together(
        spark,
        {
            name: partial(warehouse.save_table, frame, f"staging.{name}", prefix)
            for name, frame in staging.stage_all(tables).items()
        },
    )
    quality.run_checks(quality.null_key_checks(staged))
    quality.run_checks(quality.foreign_key_checks(staged))

    search_funnel = warehouse.save_table(
        build_funnel(staged), "analytics.search_funnel", prefix, partition_funnel_by
    )
    quality.run_checks(quality.dq_report(staged, search_funnel))

    layers = Marts(search_funnel, staged["bookings"], rule)
    layers.daily_funnel = warehouse.save_table(
        layers.daily_funnel, "analytics.daily_funnel", prefix
    )
    written = {
        "analytics.search_funnel": search_funnel,
        "analytics.daily_funnel": layers.daily_funnel,
    }
    remaining = {name: mart for name, mart in layers.named().items() if name not in written}
    written |= run_together(
        spark,
        {
            name: partial(warehouse.save_table, mart, name, prefix)
            for name, mart in remaining.items()
        },
    )
    exports.export_marts(written, export_directory)

    summary = marts.warehouse_summary(
        written["analytics.kpi_summary"], written["product.daily_anomaly_alerts"]
    )
    report = alerts.anomaly_alert_days(written["product.daily_anomaly_alerts"])
    quality.run_checks(quality.alert_reconciliation(summary, report))
    exports.export_json(summary, f"{export_directory.rstrip('/')}/warehouse_summary.json")
    return written
