"""Investigation: segments, incidents, alert days and opportunities from the written warehouse."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfunnel.operators import alerts, incidents, marts
from wayfunnel.settings import CHECKOUT_INCIDENT, SUPPLY_INCIDENT, Incident
from wayfunnel.sources import exports, warehouse
from wayfunnel.sources.together import run_together


def investigate(
    spark: SparkSession,
    report_directory: str,
    prefix: str = "",
    supply: Incident = SUPPLY_INCIDENT,
    checkout: Incident = CHECKOUT_INCIDENT,
) -> dict[str, DataFrame]:
    """Write six CSV tables and the summary document; return all results, still lazy."""
    funnel = warehouse.open_table(spark, "analytics.search_funnel", prefix)
    daily = warehouse.open_table(spark, "analytics.daily_funnel", prefix)
    alerting = warehouse.open_table(spark, "product.daily_anomaly_alerts", prefix)
    routes = warehouse.open_table(spark, "analytics.route_performance", prefix)

    supply_rows = incidents.incident_comparison(funnel, supply, incidents.SUPPLY)
    checkout_rows = incidents.incident_comparison(funnel, checkout, incidents.CHECKOUT)
    supply_impact = incidents.incident_impact(supply_rows, incidents.SUPPLY)
    checkout_impact = incidents.incident_impact(checkout_rows, incidents.CHECKOUT)
    overall = marts.overall_funnel(funnel)
    alert_days = alerts.anomaly_alert_days(alerting)

    tables = {
        "overall_funnel": overall,
        "segment_performance": marts.segment_performance(funnel),
        "supply_incident": supply_rows,
        "checkout_incident": checkout_rows,
        "anomaly_alert_days": alert_days,
        "route_opportunities": marts.route_opportunities(routes),
    }
    base = report_directory.rstrip("/")
    by_rate = [F.desc_nulls_last("zero_result_rate_pct"), F.desc("searches"), F.col("route")]

    def write(name: str) -> None:
        order = by_rate if name == "route_opportunities" else marts.report_order(name)
        exports.export_csv(tables[name], f"{base}/{name}.csv", order)

    run_together(spark, {name: partial(write, name) for name in tables})
    summary = incidents.investigation_summary(overall, supply_impact, checkout_impact, alert_days)
    exports.export_json(summary, f"{base}/investigation_summary.json")
    return {
        **tables,
        "supply_impact": supply_impact,
        "checkout_impact": checkout_impact,
        "daily_metrics": alerts.daily_metrics(daily),
        "investigation_summary": summary,
    }
