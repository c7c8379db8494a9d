"""Modelling: split, fit, select, refit, score the locked test rows, evaluate, publish."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfunnel.operators import evaluation, features, importance, models, quality, validation
from wayfunnel.settings import DEFAULT_THRESHOLD, FEATURES, TARGET, ModelParams, SplitDates
from wayfunnel.sources import exports


UNKNOWN = "Unknown"


@dataclass
class ModellingResult:
    champion: str
    model_path: str
    threshold: float
    comparison: DataFrame
    predictions: DataFrame
    tables: dict[str, DataFrame]


def train_and_evaluate(
    dataset: DataFrame,
    directory: str,
    dates: SplitDates = SplitDates(),
    params: ModelParams = ModelParams(),
) -> ModellingResult:
    """``dataset`` should be a written table: it is read by every fit.

    The test rows are scored once and written; all evaluation reads that table.
    """
    spark, base = dataset.sparkSession, directory.rstrip("/")
    quality.require_columns(dataset, ["search_id", "searched_at", TARGET, *FEATURES], "dataset")
    quality.run_checks(quality.model_dataset_checks(dataset))
    quality.run_checks(quality.split_checks(features.label_split(dataset, dates)))
    train, holdout, test = features.temporal_split(dataset, dates)

    candidates = models.fit_candidates(train, params)
    comparison_path = f"{base}/model_comparison"
    models.model_comparison(candidates, holdout).write.mode("overwrite").parquet(comparison_path)
    comparison = spark.read.parquet(comparison_path)
    champion = models.refit(models.champion_name(comparison), train, holdout, params)
    model_path = f"{base}/model"
    models.save_model(champion.model, model_path)

    predictions_path = f"{base}/test_predictions"
    scored = models.probability(champion.model, test)
    exports.export_predictions(models.predictions(scored), predictions_path)
    predictions = spark.read.parquet(predictions_path)

    columns = {"score": "booking_probability", "label": TARGET}

    def saved(table: DataFrame, name: str) -> DataFrame:
        path = f"{base}/tables/{name}"
        table.write.mode("overwrite").parquet(path)
        return spark.read.schema(table.schema).parquet(path)

    # each is computed once; exports and the summary read the small results back
    metrics = saved(evaluation.model_metrics(predictions, **columns), "model_metrics")
    thresholds = saved(evaluation.threshold_analysis(predictions, **columns), "threshold_analysis")
    best = evaluation.best_threshold(thresholds).first()["threshold"]
    ranked_features = importance.permutation_importance(
        test, lambda rows: models.probability(champion.model, rows), seed=params.seed
    )
    ranked_features = saved(ranked_features, "feature_importance")
    labelled = features.label_split(dataset, dates)
    info = models.model_info(champion.name, metrics, best)
    tables = {
        "test_metrics": evaluation.as_metric_rows(metrics),
        "threshold_analysis": thresholds,
        "decile_analysis": evaluation.decile_analysis(predictions, **columns),
        "top_decile_lift": evaluation.top_decile_lift(predictions, **columns),
        "calibration": evaluation.calibration(predictions, **columns),
        "feature_importance": ranked_features,
        "model_info": models.training_summary(info, labelled, comparison, ranked_features),
    }
    for name in ("threshold_analysis", "decile_analysis", "calibration"):
        exports.export_csv(tables[name], f"{base}/{name}.csv", tables[name].columns[:1])
    exports.export_csv(tables["test_metrics"], f"{base}/test_metrics.csv")
    exports.export_csv(tables["top_decile_lift"], f"{base}/top_decile_lift.csv")
    best_first = [F.desc("pr_auc"), F.desc("roc_auc")]
    exports.export_csv(comparison, f"{base}/model_comparison.csv", best_first)
    by_importance = [F.desc("importance_mean")]
    exports.export_csv(tables["feature_importance"], f"{base}/feature_importance.csv", by_importance)
    exports.export_json(tables["model_info"], f"{base}/model_info.json")
    return ModellingResult(champion.name, model_path, best, comparison, predictions, tables)


def published(spark: SparkSession, directory: str) -> tuple[str, float]:
    """Name and threshold of the model whose run was written to the directory; "Unknown" and the
    default threshold if it left no metadata or not these fields."""
    try:
        info = spark.read.json(f"{directory.rstrip('/')}/model_info.json")
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return UNKNOWN, DEFAULT_THRESHOLD
    row = info.first()
    found = row.asDict() if row else {}
    limit = found.get("threshold")
    return found.get("champion_model") or UNKNOWN, DEFAULT_THRESHOLD if limit is None else limit


def score_batch(
    records: DataFrame,
    model_path: str,
    model_name: str | None = None,
    threshold: float | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Validate records of any number, score the valid ones: (predictions, rejected records).

    Name and threshold are those published beside the model unless given.
    """
    if model_name is None or threshold is None:
        name, limit = published(records.sparkSession, model_path.rstrip("/").rpartition("/")[0])
        model_name = name if model_name is None else model_name
        threshold = limit if threshold is None else threshold
    valid, rejected = validation.split_valid(
        validation.validate_records(records, keys=("search_id",))
    )
    scored = models.probability(models.load_model(model_path), valid)
    return models.batch_scores(scored, model_name, threshold), rejected
