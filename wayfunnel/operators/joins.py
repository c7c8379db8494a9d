"""Joins whose cardinality is part of the contract."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _unique_or_raise(frame: DataFrame, on: list[str], side: str) -> Column:
    """Scalar subquery: TRUE when ``on`` is unique, otherwise the job fails."""
    highest = frame.groupBy(*on).count().agg(F.coalesce(F.max("count"), F.lit(0)).alias("highest"))
    message = F.lit(f"the {side} key {on} of the join is not unique")
    verdict = highest.select(F.when(F.col("highest") > 1, F.raise_error(message)).otherwise(True))
    return verdict.scalar()


def checked_join(
    left: DataFrame,
    right: DataFrame,
    on: list[str],
    validate: str = "many_to_one",
    how: str = "left",
) -> DataFrame:
    """Equi-join that fails while running if the "one" side of ``validate`` repeats a key.

    The check is lazy: a key count, combined map-side, evaluated as a scalar subquery
    in the same job as the join. No driver round trip, no second action.
    """
    if validate not in ("one_to_one", "many_to_one", "one_to_many"):
        raise ValueError(f"unknown cardinality: {validate}")
    if validate in ("one_to_one", "one_to_many"):
        left = left.where(_unique_or_raise(left, on, "left"))
    if validate in ("one_to_one", "many_to_one"):
        right = right.where(_unique_or_raise(right, on, "right"))
    return left.join(right, on, how)
