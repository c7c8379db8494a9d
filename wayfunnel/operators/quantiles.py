"""Exact quantiles without sorting, or collecting the values of, a whole group.

Spark's ``percentile`` gathers every distinct value of a group in one task. Here the values are
counted, the counts are laid over cells (a grid equally wide in the logarithm of the distance from
the lowest value, cut again where an outlier or a narrow band crowds it), and only the cells that
hold a wanted position are sorted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wayfunnel.operators.cells import refined

CELLS = 65_536


def _interpolate(low: Column, high: Column, weight: Column) -> Column:
    """Linear interpolation that is exact at both ends."""
    return F.when(weight >= 0.5, high - (high - low) * (1 - weight)).otherwise(
        low + (high - low) * weight
    )


def value_cells(counts: DataFrame, by: str, cells: int = CELLS) -> DataFrame:
    """(``by``, value, n, group_n, cell) of (``by``, value, n) rows.

    The test on n is always true. It keeps n in every branch, whose shuffles are then reused.
    """
    counts = counts.where(F.col("n") > 0)
    spans = counts.groupBy(by).agg(
        F.min("value").alias("lowest"),
        F.max("value").alias("highest"),
        F.sum("n").alias("group_n"),
    )
    width = F.nullif(F.log1p(F.col("highest") - F.col("lowest")), F.lit(0.0))
    share = F.coalesce(F.log1p(F.col("value") - F.col("lowest")) / width, F.lit(0.0))
    ranged = counts.join(spans, by)
    return refined(ranged, "value", F.floor(share * (cells - 1)), cells, (by,)).select(
        by, "value", "n", "group_n", "cell"
    )


def grouped_quantiles(
    counts: DataFrame, by: str, probabilities: list[float], cells: int = CELLS
) -> DataFrame:
    """Linearly interpolated quantiles of (``by``, value, n) rows: (``by``, probability, quantile).

    Nothing is broadcast unasked: the small sides have one row per group (spans), two per group and
    probability (positions), or one per cell, and their sizes decide at run time.
    """
    celled = value_cells(counts, by, cells)

    before = Window.partitionBy(by).orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    histogram = (
        celled.groupBy(by, "cell", "group_n")
        .agg(F.sum("n").alias("cell_n"))
        .withColumn("below", F.coalesce(F.sum("cell_n").over(before), F.lit(0)))
    )
    chances = F.explode(F.array(*map(F.lit, probabilities))).alias("probability")
    at = F.col("probability") * (F.col("group_n") - 1)
    ends = F.array_distinct(F.array(F.floor(at), F.ceil(at)))
    positions = (
        histogram.select("*", chances)
        .withColumn("position", F.explode(ends))
        .where(
            (F.col("position") >= F.col("below"))
            & (F.col("position") < F.col("below") + F.col("cell_n"))
        )
        .select(by, "cell", "below", "probability", "position")
    )

    inside = (
        Window.partitionBy(by, "probability", "position")
        .orderBy("value")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    up_to = F.col("below") + F.sum("n").over(inside)
    hits = (
        celled.join(positions, [by, "cell"])
        .withColumn("up_to", up_to)
        .where(
            (F.col("position") < F.col("up_to"))
            & (F.col("position") >= F.col("up_to") - F.col("n"))
        )
    )
    return hits.groupBy(by, "probability").agg(
        _interpolate(F.min("value"), F.max("value"), F.max(at - F.floor(at))).alias("quantile")
    )
