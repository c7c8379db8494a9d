"""Cells that follow the data: contiguous ranges of a value, each light enough for one task.

A fixed grid leaves a narrow band, or everything beside an outlier, in one cell. Here each cell of
a first grid is cut again between the lowest and the highest value that it holds, into as many
parts as its share of the rows asks for. A band beside an outlier can still fill one part, so parts
that hold too much are cut twice more, each time between the values that are left in them: by then
a part spans less than 2 ** -36 of its first cell. Counts, minima and maxima do not depend on the
order of rows, so every evaluation of a plan finds the same cells.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


RECUTS = 2
RECUT_PARTS = 1024
TOO_MUCH = 8  # times the mean cell


def refined(
    rows: DataFrame, value: str, grid: Column, cells: int, by: tuple[str, ...] = ()
) -> DataFrame:
    """The rows with ``cell`` (bigint), which does not decrease with the value within a group.

    ``grid`` is the first grid, at most ``cells`` whole numbers (of 16 bits) per group that do not
    decrease with the value either. Rows without a place in the grid are left out. The joins' small
    sides have at most ``cells`` rows per group, or an eighth of that for cells that are cut again;
    only where there are no groups are they broadcast unasked.
    """
    everything = Window.partitionBy(*by)
    low, high, parts = F.col("low"), F.col("high"), F.col("parts")

    def spans(placed: DataFrame) -> DataFrame:
        return (
            placed.groupBy(*by, "cell")
            .agg(
                F.count(F.lit(1)).alias("held"),
                F.min(value).alias("low"),
                F.max(value).alias("high"),
            )
            .withColumn("share", F.col("held") / F.sum("held").over(everything) * cells)
        )

    def cut(placed: DataFrame, found: DataFrame, most: int, how: str) -> DataFrame:
        part = F.least(F.floor((F.col(value) - low) / (high - low) * parts), parts - 1)
        cell = F.col("cell") * most + F.when(high > low, part).otherwise(0)
        side = found.select(*by, "cell", "low", "high", "parts")
        joined = placed.join(side if by else F.broadcast(side), [*by, "cell"], how)
        return joined.withColumn("cell", cell.cast("bigint")).select(*rows.columns, "cell")

    placed = rows.withColumn("cell", grid.cast("bigint"))
    first = spans(placed).withColumn("parts", F.ceil("share"))
    placed = cut(placed, first, cells + 1, "inner")
    for _ in range(RECUTS):
        heavy = spans(placed).where((F.col("share") > TOO_MUCH) & (high > low))
        heavy = heavy.withColumn("parts", F.lit(RECUT_PARTS))
        placed = cut(placed, heavy, RECUT_PARTS, "left")
    return placed
