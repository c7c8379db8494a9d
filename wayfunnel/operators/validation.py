"""Validation of scoring records: every broken rule is reported, bad rows are set apart."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayfunnel.functions.measures import rows
from wayfunnel.settings import CATEGORICAL_FEATURES, FEATURES


@dataclass(frozen=True)
class Range:
    column: str
    lowest: int
    highest: int | None = None

    def broken(self) -> Column:
        value = F.col(self.column)
        # NaN is greater than every number in Spark, so without a limit it would pass
        outside = (value < self.lowest) | F.isnan(value)
        return outside if self.highest is None else outside | (value > self.highest)

    def fractional(self) -> Column:
        value = F.col(self.column)
        return ~F.isnan(value) & (value != F.floor(value))


# Inclusive limits of the numeric fields.
RANGES = (
    Range("is_logged_in", 0, 1),
    Range("passengers", 1, 20),
    Range("railcard_used", 0, 1),
    Range("results_count", 0),
    Range("search_latency_ms", 0),
    Range("zero_results_flag", 0, 1),
    Range("days_before_travel", 0, 365),
    Range("search_hour", 0, 23),
    Range("day_of_week", 0, 6),
    Range("search_month", 1, 12),
)


# Fixed value: the one numeric field that takes fractions; the others are whole numbers.
FRACTIONS_ALLOWED = ("search_latency_ms",)
NUMBER = ("tinyint", "smallint", "int", "bigint", "float", "double", "decimal")


class RecordSchemaError(ValueError):
    """Scoring records lack a field, carry an unknown one, or have text where numbers belong or
    numbers where text belongs."""


def check_fields(records: DataFrame, keys: tuple[str, ...] = ()) -> None:
    """Raise on missing and on unexpected fields; ``keys`` may accompany the features."""
    missing = [f for f in FEATURES if f not in records.columns]
    extra = [c for c in records.columns if c not in FEATURES and c not in keys]
    if missing:
        raise RecordSchemaError(f"missing model features: {missing}")
    if extra:
        raise RecordSchemaError(f"unexpected fields: {extra}")
    kinds = dict(records.dtypes)
    wrong = [r.column for r in RANGES if kinds[r.column].split("(")[0] not in NUMBER]
    if wrong:
        raise RecordSchemaError(f"fields that are not numbers: {wrong}")
    wrong = [name for name in CATEGORICAL_FEATURES if kinds[name] != "string"]
    if wrong:
        raise RecordSchemaError(f"fields that are not text: {wrong}")


def _rules() -> dict[str, Column]:
    rules = {f"{name}: missing value": F.col(name).isNull() for name in FEATURES}
    rules.update({f"{r.column}: out of range": r.broken() for r in RANGES})
    rules.update(
        {
            f"{r.column}: not a whole number": r.fractional()
            for r in RANGES
            if r.column not in FRACTIONS_ALLOWED
        }
    )
    no_results, flagged = F.col("results_count") == 0, F.col("zero_results_flag") == 1
    rules["results_count: above 0 in a search flagged empty"] = flagged & ~no_results
    rules["results_count: 0 in a search not flagged empty"] = (
        F.col("zero_results_flag") == 0
    ) & no_results
    return rules


def validate_records(records: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """Records plus ``errors``, the array of broken rules; empty when the record is valid."""
    check_fields(records, keys)
    broken = [F.when(condition, rule) for rule, condition in _rules().items()]
    return records.withColumn("errors", F.array_compact(F.array(*broken)))


def split_valid(validated: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid records without the error column, rejected records with it)."""
    ok = F.size("errors") == 0
    return validated.where(ok).drop("errors"), validated.where(~ok)


def count_violations(records: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """(rule, violations) of the broken rules, straight from the records: all rules are counters of
    one aggregation, without an array per record."""
    check_fields(records, keys)
    rules = _rules()
    counted = records.agg(
        *[F.count_if(broken).alias(f"rule_{i}") for i, broken in enumerate(rules.values())]
    )
    lines = [
        F.struct(F.lit(rule).alias("rule"), F.col(f"rule_{i}").cast("bigint").alias("violations"))
        for i, rule in enumerate(rules)
    ]
    return counted.select(F.inline(F.array(*lines))).where(F.col("violations") > 0)


def violation_counts(validated: DataFrame) -> DataFrame:
    """(rule, violations) of the broken rules."""
    return (
        validated.select(F.explode("errors").alias("rule"))
        .groupBy("rule")
        .agg(rows("violations"))
    )
