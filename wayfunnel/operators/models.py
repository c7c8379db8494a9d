"""Conversion models on ``pyspark.ml``: candidates, champion selection, scoring, metadata."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import (
    OneHotEncoder,
    SQLTransformer,
    StandardScaler,
    StringIndexer,
    VectorAssembler,
)
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayfunnel.operators.boosting import fit_trees
from wayfunnel.operators.evaluation import METRICS, model_metrics
from wayfunnel.operators.features import imputation_values
from wayfunnel.operators.level_trees import fit_level_trees
from wayfunnel.settings import (
    CATEGORICAL_FEATURES,
    DEFAULT_THRESHOLD,
    FEATURES,
    NUMERIC_FEATURES,
    PREDICTION_POINT,
    TARGET,
    ModelParams,
)

PRIOR, LOGISTIC = "Dummy Baseline", "Logistic Regression"
HISTOGRAM, BOOSTED = "Histogram Gradient Boosting", "Gradient Boosted Trees"
CANDIDATES = (PRIOR, LOGISTIC, HISTOGRAM)


def _sql_literal(value: str | float) -> str:
    if isinstance(value, float):
        return f"CAST('{value!r}' AS DOUBLE)"
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _imputer(train: DataFrame) -> SQLTransformer:
    """Fill missing values with those of the training rows, as a saveable pipeline stage.

    NULL and NaN are missing. One row per feature is read back, eighteen in all. A feature without
    any value in training stays as it is, but for NaN, which becomes NULL.
    """
    fills = {
        row["feature"]: row["text_value"] if row["number_value"] is None else row["number_value"]
        for row in imputation_values(train).collect()
    }

    def filled(name: str, kind: str) -> str:
        source = f"CAST({name} AS {kind})"
        if kind == "DOUBLE":
            source = f"NULLIF({source}, CAST('NaN' AS DOUBLE))"
        if fills.get(name) is None:
            return f"{source} AS {name}_filled"
        return f"COALESCE({source}, {_sql_literal(fills[name])}) AS {name}_filled"

    columns = [filled(name, "STRING") for name in CATEGORICAL_FEATURES]
    columns += [filled(name, "DOUBLE") for name in NUMERIC_FEATURES]
    return SQLTransformer(statement=f"SELECT *, {', '.join(columns)} FROM __THIS__")


def _filled(names: tuple[str, ...], suffix: str = "_filled") -> list[str]:
    return [name + suffix for name in names]


def _indexer() -> StringIndexer:
    """Labels are sorted, values unseen in training share one extra last index."""
    return StringIndexer(
        inputCols=_filled(CATEGORICAL_FEATURES),
        outputCols=_filled(CATEGORICAL_FEATURES, "_index"),
        stringOrderType="alphabetAsc",
        handleInvalid="keep",
    )


def fit_preparation(train: DataFrame) -> PipelineModel:
    """Imputation and category indexes of the training rows; candidates can share them."""
    return Pipeline(stages=[_imputer(train), _indexer()]).fit(train)


def _fit_after(prepared: PipelineModel, stages: list, train: DataFrame) -> PipelineModel:
    """The prepared stages followed by those fitted on the prepared rows, as one pipeline."""
    fitted = Pipeline(stages=stages).fit(prepared.transform(train))
    return PipelineModel(stages=[*prepared.stages, *fitted.stages])


def _encoding() -> list:
    """One-hot and standardised features. An unseen category is all zeros, because the extra index
    is the slot that ``dropLast`` drops."""
    encoder = OneHotEncoder(
        inputCols=_filled(CATEGORICAL_FEATURES, "_index"),
        outputCols=_filled(CATEGORICAL_FEATURES, "_onehot"),
        dropLast=True,
    )
    numbers = VectorAssembler(inputCols=_filled(NUMERIC_FEATURES), outputCol="numbers")
    scaler = StandardScaler(inputCol="numbers", outputCol="scaled", withMean=True, withStd=True)
    features = VectorAssembler(
        inputCols=[*_filled(CATEGORICAL_FEATURES, "_onehot"), "scaled"], outputCol="features"
    )
    return [encoder, numbers, scaler, features]


def fit_encoding(train: DataFrame, prepared: PipelineModel | None = None) -> PipelineModel:
    """What the logistic model sees of a record, without the model."""
    return _fit_after(prepared or fit_preparation(train), _encoding(), train)


def encoded_rows(encoding: PipelineModel, records: DataFrame, key: str = "search_id") -> DataFrame:
    """(key, feature, level, value): the encoding matrix, one row per record and feature.

    Categories have the level whose slot is 1, or NULL and 0 if training did not hold it; numbers
    their standardised value and no level.
    """
    labels = encoding.stages[1].labelsArray
    parts = []
    for name, levels in zip(CATEGORICAL_FEATURES, labels, strict=True):
        slots = vector_to_array(F.col(f"{name}_onehot"))
        slot = F.array_position(slots, F.lit(1.0))
        level = F.when(slot > 0, F.element_at(F.array(*map(F.lit, levels)), slot.cast("int")))
        value = F.aggregate(slots, F.lit(0.0), lambda total, x: total + x)
        parts.append((name, level, value))
    scaled = vector_to_array(F.col("scaled"))
    parts += [
        (name, F.lit(None).cast("string"), scaled[i]) for i, name in enumerate(NUMERIC_FEATURES)
    ]
    lines = [
        F.struct(F.lit(n).alias("feature"), level.alias("level"), value.alias("value"))
        for n, level, value in parts
    ]
    return encoding.transform(records).select(key, F.inline(F.array(*lines)))


def coded_rows(prepared: PipelineModel, records: DataFrame, key: str = "search_id") -> DataFrame:
    """(key, feature, value): the ordinal codes and filled numbers that the trees see."""
    seen = ordinal_codes(prepared).transform(prepared.transform(records))
    columns = {n: f"{n}_code" for n in CATEGORICAL_FEATURES}
    columns |= {n: f"{n}_filled" for n in NUMERIC_FEATURES}
    lines = [
        F.struct(F.lit(n).alias("feature"), F.col(c).alias("value")) for n, c in columns.items()
    ]
    return seen.select(key, F.inline(F.array(*lines)))


def fit_logistic(
    train: DataFrame, params: ModelParams = ModelParams(), prepared: PipelineModel | None = None
) -> PipelineModel:
    """L2 logistic regression on one-hot and standardised features.

    The penalty is divided by the row count: Spark averages the loss, while a unit inverse
    regularisation is stated for summed losses.
    """
    classifier = LogisticRegression(
        featuresCol="features",
        labelCol=TARGET,
        regParam=1.0 / (params.inverse_regularisation * max(train.count(), 1)),
        elasticNetParam=0.0,
        standardization=False,
        maxIter=params.logistic_iterations,
        tol=1e-8,
    )
    return _fit_after(prepared or fit_preparation(train), [*_encoding(), classifier], train)


def held_out_share(
    params: ModelParams = ModelParams(), key: str = "search_id", percent: int | None = None
) -> Column:
    """Whether a training row only decides when boosting stops: a share by a hash of key and seed."""
    draw = F.abs(F.xxhash64(key, F.lit(params.seed)) % 100)
    return draw < (params.boosting.holdout_percent if percent is None else percent)


def ordinal_codes(prepared: PipelineModel) -> SQLTransformer:
    """Categories by their place among the sorted training values, unseen ones as -1."""
    values = [len(labels) for labels in prepared.stages[1].labelsArray]
    codes = ", ".join(
        f"IF({name}_index < {n}, {name}_index + 0D, -1D) AS {name}_code"
        for name, n in zip(CATEGORICAL_FEATURES, values, strict=True)
    )
    return SQLTransformer(statement=f"SELECT *, {codes} FROM __THIS__")


def fit_histogram(
    train: DataFrame,
    params: ModelParams = ModelParams(),
    prepared: PipelineModel | None = None,
    held_out: Column | None = None,
) -> PipelineModel:
    """Second-order boosted trees, grown best leaf first (``boosting.py``), on ordinal features."""
    prepared = prepared or fit_preparation(train)
    ordinal = ordinal_codes(prepared)
    stopping = held_out_share(params, percent=params.histogram.holdout_percent)
    trees = fit_trees(
        ordinal.transform(prepared.transform(train)),
        [*_filled(CATEGORICAL_FEATURES, "_code"), *_filled(NUMERIC_FEATURES)],
        TARGET,
        stopping if held_out is None else held_out,
        params.histogram,
    )
    return PipelineModel(stages=[*prepared.stages, ordinal, trees])


def fit_boosted(
    train: DataFrame,
    params: ModelParams = ModelParams(),
    prepared: PipelineModel | None = None,
    held_out: Column | None = None,
) -> PipelineModel:
    """First-order boosted trees, grown level by level (``level_trees.py``), on ordinal features,
    stopped early on a hashed tenth of the rows or those that ``held_out`` names.

    Unseen categories get the highest code.
    """
    prepared = prepared or fit_preparation(train)
    codes = ", ".join(f"{name}_index + 0D AS {name}_code" for name in CATEGORICAL_FEATURES)
    ordinal = SQLTransformer(statement=f"SELECT *, {codes} FROM __THIS__")
    trees = fit_level_trees(
        ordinal.transform(prepared.transform(train)),
        [*_filled(CATEGORICAL_FEATURES, "_code"), *_filled(NUMERIC_FEATURES)],
        TARGET,
        held_out_share(params) if held_out is None else held_out,
        params.boosting,
    )
    return PipelineModel(stages=[*prepared.stages, ordinal, trees])


def fit_prior(train: DataFrame) -> PipelineModel:
    """The booking rate of the training rows as a model that ignores its input."""
    rate = train.agg(F.avg(TARGET).alias("rate")).first()["rate"]
    constant = SQLTransformer(statement=f"SELECT *, {_sql_literal(rate)} AS score FROM __THIS__")
    return PipelineModel([constant])


def prior_scores(train: DataFrame, rows_to_score: DataFrame) -> DataFrame:
    """Every row scored with the booking rate of the training rows, in one job."""
    return rows_to_score.withColumn("score", train.agg(F.avg(TARGET)).scalar())


def probability(model: PipelineModel, rows_to_score: DataFrame) -> DataFrame:
    """Input rows plus ``score``, the probability of a booking."""
    scored = model.transform(rows_to_score)
    if "score" in scored.columns:
        return scored.select(*rows_to_score.columns, "score")
    score = vector_to_array(F.col("probability"))[1].alias("score")
    return scored.select(*rows_to_score.columns, score)


@dataclass(frozen=True)
class Candidate:
    name: str
    model: PipelineModel


def fit_candidate(
    name: str,
    train: DataFrame,
    params: ModelParams = ModelParams(),
    prepared: PipelineModel | None = None,
) -> Candidate:
    if name == PRIOR:
        return Candidate(name, fit_prior(train))
    fit = {LOGISTIC: fit_logistic, HISTOGRAM: fit_histogram, BOOSTED: fit_boosted}[name]
    return Candidate(name, fit(train, params, prepared))


def fit_candidates(train: DataFrame, params: ModelParams = ModelParams()) -> list[Candidate]:
    prepared = fit_preparation(train)
    return [fit_candidate(name, train, params, prepared) for name in CANDIDATES]


def model_comparison(candidates: list[Candidate], validation: DataFrame) -> DataFrame:
    """(model, eight metrics) on the validation rows, best average precision first."""
    lines = [
        model_metrics(probability(c.model, validation), label=TARGET).select(F.lit(c.name).alias("model"), "*")
        for c in candidates
    ]
    return reduce(DataFrame.unionByName, lines).orderBy(F.desc("pr_auc"), F.desc("roc_auc"))


def champion_name(comparison: DataFrame) -> str:
    return comparison.orderBy(F.desc("pr_auc"), F.desc("roc_auc")).first()["model"]


def refit(
    name: str, train: DataFrame, validation: DataFrame, params: ModelParams = ModelParams()
) -> Candidate:
    """The champion again, on training and validation rows together."""
    return fit_candidate(name, train.unionByName(validation), params)


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def predictions(scored: DataFrame) -> DataFrame:
    """Columns of the scored-prediction sink, with the label at 0.50."""
    p = F.col("score")
    return scored.select(
        "search_id",
        "searched_at",
        TARGET,
        p.alias("booking_probability"),
        F.when(p >= DEFAULT_THRESHOLD, 1).otherwise(0).alias("predicted_booking_050"),
    )


def batch_scores(
    scored: DataFrame, model_name: str, threshold: float | Column = DEFAULT_THRESHOLD
) -> DataFrame:
    """Prediction records: probability, decision at the threshold, threshold and model name."""
    limit = threshold if isinstance(threshold, Column) else F.lit(threshold)
    p = F.col("score")
    return scored.select(
        *[c for c in scored.columns if c == "search_id"],
        p.alias("booking_probability"),
        F.when(p >= limit, 1).otherwise(0).alias("predicted_booking"),
        limit.alias("threshold"),
        F.lit(model_name).alias("model_name"),
    )


def model_info(
    champion: str, metrics: DataFrame, threshold: float | Column = DEFAULT_THRESHOLD
) -> DataFrame:
    """One metadata row: champion, prediction point, threshold, features, test metrics."""
    limit = threshold if isinstance(threshold, Column) else F.lit(threshold)
    pairs = [part for m in METRICS for part in (F.lit(m), F.col(m))]
    return metrics.select(
        F.lit(champion).alias("champion_model"),
        F.lit(PREDICTION_POINT).alias("prediction_point"),
        limit.alias("threshold"),
        F.lit(len(FEATURES)).alias("feature_count"),
        F.array(*map(F.lit, FEATURES)).alias("features"),
        F.create_map(*pairs).alias("test_metrics"),
    )


def training_summary(
    info: DataFrame, labelled: DataFrame, comparison: DataFrame, ranked_features: DataFrame
) -> DataFrame:
    """The metadata row with row counts of the splits, the candidates from best to worst and the
    ten features whose permutation costs most. All inputs but the labelled rows are small."""

    def best_first(frame: DataFrame, order: str, *names: str) -> Column:
        part = F.struct(order, *names)
        return frame.agg(F.sort_array(F.collect_list(part), asc=False)).scalar()

    splits = labelled.groupBy("split").count()
    counts = {
        f"{name}_rows": splits.agg(
            F.coalesce(F.sum(F.when(F.col("split") == name, F.col("count"))), F.lit(0))
        ).scalar()
        for name in ("train", "validation", "test")
    }
    top = F.slice(best_first(ranked_features, "importance_mean", "feature"), 1, 10)
    return info.withColumns(
        {
            **counts,
            "best_f1_threshold": F.col("threshold"),
            "ranking": best_first(comparison, "pr_auc", "roc_auc", "model")["model"],
            "top_features": top["feature"],
        }
    )
