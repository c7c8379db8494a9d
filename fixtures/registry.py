"""Registered queries: each takes (spark, data directory) and returns a DataFrame."""

from __future__ import annotations

from collections.abc import Callable
from functools import lru_cache

from pyspark.ml import PipelineModel
from pyspark.ml.feature import SQLTransformer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fixtures.derive import (
    CHECKOUT,
    SPLIT,
    SUPPLY,
    Journey,
    formula_score,
    journey,
    scoring_requests,
    tied_score,
)
from wayfunnel.functions.measures import round_to
from wayfunnel.operators import (
    alerts,
    evaluation,
    features,
    funnel,
    importance,
    incidents,
    joins,
    marts,
    models,
    quality,
    validation,
)
from wayfunnel.plans.warehouse import build_funnel
from wayfunnel.settings import (
    CATEGORICAL_FEATURES,
    FEATURES,
    NUMERIC_FEATURES,
    TARGET,
    BoostingParams,
    HistogramBoostingParams,
    ModelParams,
)

Query = Callable[[SparkSession, str], DataFrame]


def six_digits(frame: DataFrame) -> DataFrame:
    """Round every double, because summation order differs between engines."""
    return frame.select(
        *[
            round_to(F.col(name), 6).alias(name) if kind == "double" else F.col(name)
            for name, kind in frame.dtypes
        ]
    )


def _daily(j: Journey) -> DataFrame:
    return marts.daily_funnel(j.funnel)


def _alerts(j: Journey) -> DataFrame:
    return alerts.daily_anomaly_alerts(_daily(j))


def _summary(j: Journey) -> DataFrame:
    return marts.warehouse_summary(marts.kpi_summary(j.funnel), _alerts(j))


def _checked_join(j: Journey) -> DataFrame:
    chosen = funnel.selected_results(j.staged("journey_results"))
    with_option = joins.checked_join(
        j.staged("checkout"), chosen, ["search_id"], validate="one_to_one"
    )
    joined = joins.checked_join(
        with_option.drop("device_type"), j.staged("sessions"), ["session_id"], "many_to_one"
    )
    return joined.select(
        "search_id",
        "checkout_id",
        "session_id",
        "selected_operator",
        "selected_fare",
        "customer_type",
        "country",
    )


def _supply(j: Journey) -> DataFrame:
    return incidents.incident_comparison(j.funnel, SUPPLY, incidents.SUPPLY)


def _checkout(j: Journey) -> DataFrame:
    return incidents.incident_comparison(j.funnel, CHECKOUT, incidents.CHECKOUT)


def _investigation(j: Journey) -> DataFrame:
    nested = incidents.investigation_summary(
        marts.overall_funnel(j.funnel),
        incidents.incident_impact(_supply(j), incidents.SUPPLY),
        incidents.incident_impact(_checkout(j), incidents.CHECKOUT),
        alerts.anomaly_alert_days(_alerts(j)),
    )
    return nested.select(
        "overall.searches",
        "overall.search_to_book_rate_pct",
        "overall.revenue",
        F.col("supply_incident.estimated_lost_bookings").alias("supply_lost_bookings"),
        F.col("supply_incident.estimated_revenue_impact").alias("supply_revenue_impact"),
        F.col("checkout_incident.estimated_lost_bookings").alias("checkout_lost_bookings"),
        F.col("checkout_incident.estimated_revenue_impact").alias("checkout_revenue_impact"),
        "anomaly_alert_days",
    )


def damaged(j: Journey) -> dict[str, DataFrame]:
    """Staged tables with dropped, repeated and altered rows, so that every check has findings."""

    def repeat(frame: DataFrame, kept, repeated) -> DataFrame:
        return frame.where(kept).unionByName(frame.where(repeated))

    staged = j.staged_tables()
    latency, hour = F.col("search_latency_ms"), F.col("session_hour")
    flipped = F.when(latency % 90 == 0, 1 - F.col("zero_results_flag"))
    searches = staged["searches"]
    also = (F.col("changes") == 1) & (F.col("duration_minutes") % 9 == 0)
    results = staged["journey_results"]
    started = F.hour("checkout_started_at")
    return {
        "sessions": repeat(staged["sessions"], hour != 3, hour == 5),
        "searches": searches.where(F.col("search_hour") != 4)
        .withColumn("zero_results_flag", F.coalesce(flipped, "zero_results_flag"))
        .unionByName(searches.where(latency % 200 == 7)),
        "journey_results": results.withColumn(
            "selected_flag", F.when(also, 1).otherwise(F.col("selected_flag"))
        ).unionByName(results.where(F.col("duration_minutes") == 77)),
        "checkout": repeat(staged["checkout"], started != 9, started == 11),
        "bookings": repeat(staged["bookings"], F.lit(True), F.hour("booked_at") == 13),
    }


def damaged_funnel(j: Journey) -> DataFrame:
    latency = F.col("search_latency_ms")
    return j.funnel.withColumns(
        {
            "selected_flag": F.when(latency % 30 == 0, 1).otherwise(F.col("selected_flag")),
            "checkout_completed_flag": F.when(latency % 70 == 0, 0).otherwise(
                F.col("checkout_completed_flag")
            ),
        }
    )


def _splits(j: Journey) -> tuple[DataFrame, DataFrame, DataFrame]:
    return features.temporal_split(j.dataset, SPLIT)


@lru_cache(maxsize=4)
def _preparation(j: Journey) -> PipelineModel:
    """Imputation and category indexes of the training rows, which all candidates share."""
    return models.fit_preparation(_splits(j)[0])


@lru_cache(maxsize=16)
def candidate(j: Journey, name: str) -> models.Candidate:
    """A model fitted on the training rows, once per data directory and application."""
    prepared = None if name == models.PRIOR else _preparation(j)
    return models.fit_candidate(name, _splits(j)[0], prepared=prepared)


@lru_cache(maxsize=4)
def champion(j: Journey) -> tuple[str, str]:
    """(name, saved model path) of the validation winner, refitted on train plus validation."""
    train, holdout, _ = _splits(j)
    name = models.champion_name(_comparison(j))
    path = j.area.path("champion_model")
    models.save_model(models.refit(name, train, holdout).model, path)
    return name, path


def _comparison(j: Journey) -> DataFrame:
    def compare() -> DataFrame:
        candidates = [candidate(j, name) for name in models.CANDIDATES]
        return models.model_comparison(candidates, _splits(j)[1])

    return j.area.table("model_comparison", compare)


def _validation_scores(j: Journey, name: str) -> DataFrame:
    scored = models.probability(candidate(j, name).model, _splits(j)[1])
    return scored.select("search_id", TARGET, "score")


def _locked_test(j: Journey) -> DataFrame:
    """Test rows scored by the saved champion, written once like the prediction sink."""

    def score() -> DataFrame:
        model = models.load_model(champion(j)[1])
        return models.predictions(models.probability(model, _splits(j)[2]))

    return j.area.table("test_predictions", score)


def _best_threshold(j: Journey):
    columns = {"score": "booking_probability", "label": TARGET}
    table = evaluation.threshold_analysis(_locked_test(j), **columns)
    return evaluation.best_threshold(table).select("threshold").scalar()


def _batch_scoring(j: Journey) -> DataFrame:
    """All valid records of the request table through the saved champion."""
    requests = validation.validate_records(scoring_requests(j.dataset), keys=("search_id",))
    valid, _ = validation.split_valid(requests)
    name, path = champion(j)
    scored = models.probability(models.load_model(path), valid)
    return models.batch_scores(scored, name, _best_threshold(j))


def _model_info(j: Journey) -> DataFrame:
    metrics = evaluation.model_metrics(_locked_test(j), "booking_probability", TARGET)
    return models.model_info(champion(j)[0], metrics, _best_threshold(j))


# Scores that SQL can state, as saved pipelines: what surrounds a fitted model is then exact.
FORMULAS = {
    "Formula": (
        "least(search_latency_ms * 0.0002D + results_count * 0.03D + railcard_used * 0.15D"
        " + is_logged_in * 0.05D, 0.95D)"
    ),
    "Steps": (
        "case when results_count >= 3 then 0.3D"
        " else results_count * 0.1D + railcard_used * 0.05D end"
    ),
}


@lru_cache(maxsize=16)
def _formula_model(j: Journey, name: str) -> models.Candidate:
    path = j.area.path(f"model_{name.lower()}")
    statement = f"SELECT *, {FORMULAS[name]} AS score FROM __THIS__"
    models.save_model(PipelineModel([SQLTransformer(statement=statement)]), path)
    return models.Candidate(name, models.load_model(path))


def _formula_locked_test(j: Journey) -> DataFrame:
    model = _formula_model(j, "Formula").model
    return models.predictions(models.probability(model, _splits(j)[2]))


def _formula_threshold(j: Journey):
    columns = {"score": "booking_probability", "label": TARGET}
    table = evaluation.threshold_analysis(_formula_locked_test(j), **columns)
    return evaluation.best_threshold(table).select("threshold").scalar()


def _formula_comparison(j: Journey) -> DataFrame:
    candidates = [_formula_model(j, name) for name in FORMULAS]
    return models.model_comparison(candidates, _splits(j)[1])


def _formula_batch(j: Journey) -> DataFrame:
    requests = validation.validate_records(scoring_requests(j.dataset), keys=("search_id",))
    valid, _ = validation.split_valid(requests)
    candidate = _formula_model(j, "Formula")
    scored = models.probability(candidate.model, valid)
    return models.batch_scores(scored, candidate.name, _formula_threshold(j))


def _formula_info(j: Journey) -> DataFrame:
    """Metadata and training summary, one column per metric."""
    metrics = evaluation.model_metrics(_formula_locked_test(j), "booking_probability", TARGET)
    info = models.training_summary(
        models.model_info("Formula", metrics, _formula_threshold(j)),
        features.label_split(j.dataset, SPLIT),
        _formula_comparison(j),
        importance.permutation_importance(j.dataset, formula_score),
    )
    return info.select(
        "champion_model",
        "prediction_point",
        "threshold",
        "best_f1_threshold",
        "feature_count",
        "train_rows",
        "validation_rows",
        "test_rows",
        F.concat_ws(",", "features").alias("features"),
        F.concat_ws(",", "ranking").alias("ranking"),
        F.col("top_features")[0].alias("top_feature"),
        *[F.col("test_metrics")[name].alias(name) for name in evaluation.METRICS],
    )


def _only(rows: DataFrame, *kept: str) -> DataFrame:
    """Records that differ in these features alone, so that a fit can be stated in SQL."""
    same = {name: F.lit("same") for name in CATEGORICAL_FEATURES}
    same |= {name: F.lit(1.0) for name in NUMERIC_FEATURES if name not in kept}
    return rows.withColumns(same)


def _railcard_only(rows: DataFrame) -> DataFrame:
    return _only(rows, "railcard_used")


CLOSED_FORM = ModelParams(
    inverse_regularisation=1e9,
    boosting=BoostingParams(rounds=1, max_depth=1, min_rows_per_leaf=1),
)


@lru_cache(maxsize=8)
def _railcard_fit(j: Journey, name: str) -> PipelineModel:
    train = _railcard_only(_splits(j)[0])
    if name == models.LOGISTIC:
        return models.fit_logistic(train, CLOSED_FORM)
    return models.fit_boosted(train, CLOSED_FORM, held_out=_hashed_tenth())


def _hashed_tenth():
    digest = F.md5(F.col("search_id").cast("binary"))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % 10 == 0


# One tree of three leaves: the second split shows which of two leaves is taken first.
ONE_TREE = ModelParams(histogram=HistogramBoostingParams(rounds=1, max_leaves=3, step_size=1.0))


@lru_cache(maxsize=8)
def two_feature_fit(j: Journey) -> PipelineModel:
    train = _only(_splits(j)[0], "railcard_used", "results_count")
    return models.fit_histogram(train, ONE_TREE, held_out=_hashed_tenth())


def _two_feature_scores(j: Journey) -> DataFrame:
    """Validation rows scored by a tree over two features."""
    rows = _only(_splits(j)[1], "railcard_used", "results_count")
    scored = models.probability(two_feature_fit(j), rows)
    return scored.select("search_id", round_to(F.col("score"), 4).alias("score"))


def _railcard_scores(j: Journey, name: str) -> DataFrame:
    """Validation rows scored by a model that was fitted on one feature."""
    model = _railcard_fit(j, name)
    scored = models.probability(model, _railcard_only(_splits(j)[1]))
    return scored.select("search_id", round_to(F.col("score"), 4).alias("score"))


def _damaged_raw(j: Journey) -> dict[str, DataFrame]:
    """Raw tables with lost keys, repeated rows, a lost column and one of another type."""
    raw = j.raw_tables()
    slow = F.col("search_latency_ms")
    lost = F.when(slow % 40 != 3, F.col("search_id"))
    started = F.hour("checkout_started_at")
    checkout = raw["checkout"]
    return raw | {
        "searches": raw["searches"]
        .withColumns({"search_id": lost, "results_count": F.col("results_count").cast("string")})
        .drop("railcard_used"),
        "checkout": checkout.unionByName(checkout.where(started == 11)),
    }


def _damaged_dataset(j: Journey) -> DataFrame:
    slow = F.col("search_latency_ms")
    wrong = F.when(slow % 90 == 0, 2).otherwise(F.col(TARGET))
    return j.dataset.withColumn(TARGET, wrong).unionByName(j.dataset.where(slow % 200 == 7))


def _damaged_train(j: Journey) -> DataFrame:
    """Training rows with NaN and NULL in place of values."""
    slow = F.col("search_latency_ms")
    return _splits(j)[0].withColumns(
        {
            "search_latency_ms": F.when(slow % 7 != 0, slow).otherwise(F.lit(float("nan"))),
            "results_count": F.when(slow % 11 != 0, F.col("results_count")),
            "country": F.when(slow % 5 != 0, F.col("country")),
        }
    )


def _some_searchless(j: Journey) -> tuple[DataFrame, DataFrame]:
    """The funnel without the searches of some hours, and all sessions."""
    return j.funnel.where((F.col("search_hour") < 4) | (F.col("search_hour") > 9)), j.staged("sessions")


@lru_cache(maxsize=4)
def _encoding(j: Journey) -> PipelineModel:
    return models.fit_encoding(_splits(j)[0], _preparation(j))


def _unseen_country(j: Journey) -> DataFrame:
    """Validation rows of which some have a category that training did not hold."""
    slow = F.col("search_latency_ms")
    country = F.when(slow % 9 == 0, "Nowhere").otherwise(F.col("country"))
    return _splits(j)[1].withColumn("country", country)


def _damaged_splits(j: Journey) -> DataFrame:
    """The test rows called training rows."""
    split = F.when(F.col("split") == "test", "train").otherwise(F.col("split"))
    return features.label_split(j.dataset, SPLIT).withColumn("split", split)


def _damaged_report(j: Journey) -> DataFrame:
    """Only the alert days in the first week of a month."""
    return alerts.anomaly_alert_days(_alerts(j)).where(F.dayofmonth("metric_date") <= 7)


def _scored(j: Journey) -> DataFrame:
    return formula_score(j.dataset)


def _tied(j: Journey) -> DataFrame:
    return tied_score(j.dataset)


def _on(build: Callable[[Journey], DataFrame]) -> Query:
    return lambda spark, directory: build(journey(spark, directory))


def _mart(build: Callable[[DataFrame], DataFrame]) -> Query:
    return _on(lambda j: build(j.funnel))


def _evaluated(build: Callable[..., DataFrame], source: Callable[[Journey], DataFrame]) -> Query:
    return _on(lambda j: six_digits(build(source(j), label=TARGET)))


def queries() -> dict[str, Query]:
    e = evaluation
    return {
        "contract_check": _on(lambda j: quality.contract_check(j.raw_tables())),
        "source_profile": _on(
            lambda j: marts.source_profile(
                *[
                    j.staged(name)
                    for name in ("sessions", "searches", "journey_results", "checkout", "bookings")
                ]
            )
        ),
        "stg_sessions": _on(lambda j: j.staged("sessions")),
        "stg_searches": _on(lambda j: j.staged("searches")),
        "stg_results": _on(lambda j: j.staged("journey_results")),
        "stg_checkout": _on(lambda j: j.staged("checkout")),
        "stg_bookings": _on(lambda j: j.staged("bookings")),
        "stg_stations": _on(lambda j: j.staged("station_reference")),
        "selected_results": _on(lambda j: funnel.selected_results(j.staged("journey_results"))),
        "checkout_summary": _on(lambda j: funnel.checkout_summary(j.staged("checkout"))),
        "booking_summary": _on(lambda j: funnel.booking_summary(j.staged("bookings"))),
        "search_funnel": _on(lambda j: build_funnel(j.staged_tables())),
        "kpi_summary": _mart(marts.kpi_summary),
        "warehouse_summary": _on(_summary),
        "daily_funnel": _mart(marts.daily_funnel),
        "device_performance": _mart(marts.device_performance),
        "channel_performance": _mart(marts.channel_performance),
        "route_performance": _mart(marts.route_performance),
        "zero_result_analysis": _mart(marts.zero_result_analysis),
        "checkout_failure_analysis": _mart(marts.checkout_failure_analysis),
        "commercial_impact": _on(lambda j: marts.commercial_impact(j.funnel, j.staged("bookings"))),
        "overall_funnel": _mart(marts.overall_funnel),
        "segment_performance": _mart(marts.segment_performance),
        "route_opportunities": _mart(
            lambda f: marts.route_opportunities(marts.route_performance(f))
        ),
        "documented_metrics": _mart(marts.documented_metrics),
        "session_features": _mart(marts.session_features),
        "checked_join": _on(_checked_join),
        "rolling_baseline": _on(lambda j: six_digits(alerts.rolling_baseline(_daily(j)))),
        "zscores": _on(lambda j: six_digits(alerts.zscores(alerts.rolling_baseline(_daily(j))))),
        "daily_anomaly_alerts": _on(lambda j: six_digits(_alerts(j))),
        "route_anomaly_alerts": _mart(
            lambda f: six_digits(
                alerts.daily_anomaly_alerts(
                    marts.daily_funnel(f, by=["route"]), partition_by=["route"]
                )
            )
        ),
        "anomaly_alert_days": _on(lambda j: alerts.anomaly_alert_days(_alerts(j))),
        "daily_metrics": _on(lambda j: alerts.daily_metrics(_daily(j))),
        "alert_reconciliation": _on(
            lambda j: quality.alert_reconciliation(
                _summary(j), alerts.anomaly_alert_days(_alerts(j))
            )
        ),
        "dq_report": _on(lambda j: quality.dq_report(damaged(j), damaged_funnel(j))),
        "dq_orphans": _on(lambda j: quality.orphan_report(damaged(j))),
        "dq_model_dataset": _on(lambda j: quality.model_dataset_checks(j.dataset)),
        "dq_splits": _on(lambda j: quality.split_checks(features.label_split(j.dataset, SPLIT))),
        "supply_incident": _on(_supply),
        "checkout_incident": _on(_checkout),
        "proportion_test": _on(
            lambda j: six_digits(incidents.proportion_test(_checkout(j), incidents.CHECKOUT))
        ),
        "effect_size": _on(
            lambda j: six_digits(incidents.effect_size(_checkout(j), incidents.CHECKOUT))
        ),
        "supply_impact": _on(lambda j: incidents.incident_impact(_supply(j), incidents.SUPPLY)),
        "checkout_impact": _on(
            lambda j: incidents.incident_impact(_checkout(j), incidents.CHECKOUT)
        ),
        "investigation_summary": _on(_investigation),
        "model_dataset": _on(
            lambda j: features.model_dataset(j.funnel, j.staged("searches"), j.staged("sessions"))
        ),
        "model_rows": _mart(features.model_rows),
        "temporal_split": _on(
            lambda j: features.split_profile(features.label_split(j.dataset, SPLIT))
        ),
        "imputation_values": _on(lambda j: features.imputation_values(_splits(j)[0])),
        "prior_scores": _on(
            lambda j: six_digits(
                models.prior_scores(*_splits(j)[:2]).select("search_id", "score")
            )
        ),
        "model_metrics": _evaluated(e.model_metrics, _scored),
        "model_metrics_tied": _evaluated(e.model_metrics, _tied),
        "threshold_analysis": _evaluated(e.threshold_analysis, _scored),
        "best_threshold": _on(
            lambda j: six_digits(e.best_threshold(e.threshold_analysis(_scored(j), label=TARGET)))
        ),
        "decile_analysis": _evaluated(e.decile_analysis, _scored),
        "decile_analysis_tied": _evaluated(e.decile_analysis, _tied),
        "top_decile_lift": _evaluated(e.top_decile_lift, _scored),
        "top_decile_lift_tied": _evaluated(e.top_decile_lift, _tied),
        "calibration": _evaluated(e.calibration, _scored),
        "calibration_tied": _evaluated(e.calibration, _tied),
        "roc_curve": _evaluated(e.roc_curve, _scored),
        "pr_curve": _evaluated(e.pr_curve, _scored),
        "permutation_importance": _on(
            lambda j: six_digits(importance.permutation_importance(j.dataset, formula_score))
        ),
        "score_validation": _on(
            lambda j: validation.count_violations(scoring_requests(j.dataset), keys=("search_id",))
        ),
        "score_violations": _on(
            lambda j: validation.violation_counts(
                validation.validate_records(scoring_requests(j.dataset), keys=("search_id",))
            )
        ),
        "foreign_keys": _on(lambda j: quality.foreign_key_report(j.staged_tables())),
        "foreign_keys_damaged": _on(lambda j: quality.foreign_key_report(damaged(j))),
        "documented_metrics_all_sessions": _on(
            lambda j: marts.documented_metrics(*_some_searchless(j))
        ),
        "session_features_all_sessions": _on(
            lambda j: marts.session_features(*_some_searchless(j))
        ),
        "imputation_values_damaged": _on(
            lambda j: features.imputation_values(_damaged_train(j))
        ),
        "one_hot_encoding": _on(
            lambda j: six_digits(models.encoded_rows(_encoding(j), _unseen_country(j)))
        ),
        "ordinal_encoding": _on(lambda j: models.coded_rows(_preparation(j), _unseen_country(j))),
        "alert_reconciliation_damaged": _on(
            lambda j: quality.alert_reconciliation(_summary(j), _damaged_report(j))
        ),
        "contract_check_damaged": _on(lambda j: quality.contract_check(_damaged_raw(j))),
        "dq_model_dataset_damaged": _on(
            lambda j: quality.model_dataset_checks(_damaged_dataset(j))
        ),
        "dq_splits_damaged": _on(lambda j: quality.split_checks(_damaged_splits(j))),
        "formula_test_predictions": _on(lambda j: six_digits(_formula_locked_test(j))),
        "formula_comparison": _on(lambda j: six_digits(_formula_comparison(j))),
        "formula_batch_scoring": _on(lambda j: six_digits(_formula_batch(j))),
        "formula_model_info": _on(lambda j: six_digits(_formula_info(j))),
        "lr_one_feature": _on(lambda j: _railcard_scores(j, models.LOGISTIC)),
        "gbt_one_feature": _on(lambda j: _railcard_scores(j, models.BOOSTED)),
        "histogram_two_features": _on(_two_feature_scores),
        "histogram_scores": _on(lambda j: _validation_scores(j, models.HISTOGRAM)),
        "lr_scores": _on(lambda j: _validation_scores(j, models.LOGISTIC)),
        "gbt_scores": _on(lambda j: _validation_scores(j, models.BOOSTED)),
        "model_comparison": _on(_comparison),
        "locked_test_predictions": _on(_locked_test),
        "batch_scoring": _on(_batch_scoring),
        "model_info": _on(_model_info),
    }
