"""Ranked running totals over scores, without one global sort.

Every ranking metric needs "how many rows, and how many positives, score at least this high". A
window without partitions would put all rows into one task. Instead rows are first counted per
distinct score (combined map-side, so a score that a third of the rows share is one row), the
distinct scores are laid over cells that follow their distribution, cell totals are accumulated
over at most twice ``CELLS`` rows, and each cell finishes its own running totals in parallel.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wayfunnel.functions.measures import rows
from wayfunnel.operators.cells import refined

CELLS = 65_536
LOG_ODDS = 16.0  # cells span log-odds of -16 to 16
TIE_DIGITS = 3  # hex digits of the tie hash: 4,096 cells per tied score


def score_counts(
    scored: DataFrame, score: str = "score", label: str = "label", by: tuple[str, ...] = ()
) -> DataFrame:
    """(score, n, pos) per distinct score, and group if there are any."""
    return scored.groupBy(*by, F.col(score).alias("score")).agg(
        rows("n"), F.sum(F.col(label).cast("bigint")).alias("pos")
    )


def _grid(score: Column, cells: int) -> Column:
    """First grid, equally wide in log-odds: scores of rare events crowd near 0 and still spread
    over thousands of cells. Scores outside the open unit interval go to the edge cells."""
    log_odds = F.log(score) - F.log1p(-score)
    position = F.floor((log_odds + LOG_ODDS) / (2 * LOG_ODDS) * cells)
    inside = F.greatest(F.least(position, F.lit(cells - 1)), F.lit(0))
    return F.when(score <= 0, 0).when(score >= 1, cells - 1).otherwise(inside).cast("int")


def score_cells(counts: DataFrame, cells: int = CELLS, by: tuple[str, ...] = ()) -> DataFrame:
    """The counts with the cell of each score.

    The test on n and pos is always true. It keeps both in the branch that finds the cells, whose
    shuffle is then that of the other branches and is reused.
    """
    known = counts.where((F.col("n") > 0) & (F.coalesce("pos", F.lit(0)) >= 0))
    return refined(known, "score", _grid(F.col("score"), cells), cells, by)


def score_curve(
    counts: DataFrame, cells: int = CELLS, by: tuple[str, ...] = ()
) -> DataFrame:
    """(score, n, pos, cum_n, cum_pos, total_n, total_pos), cumulative from the highest score down,
    per group if there are any.

    The cells only balance the work; any scores give exact totals. Without groups the broadcast
    sides have at most twice ``cells`` rows by construction; with groups they are joined by their
    size.
    """
    celled = score_cells(counts, cells, by)

    higher = (
        Window.partitionBy(*by)
        .orderBy(F.desc("cell"))
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    everything = Window.partitionBy(*by)
    offsets = (
        celled.groupBy(*by, "cell")
        .agg(F.sum("n").alias("cell_n"), F.sum("pos").alias("cell_pos"))
        .select(
            *by,
            "cell",
            F.coalesce(F.sum("cell_n").over(higher), F.lit(0)).alias("n_above"),
            F.coalesce(F.sum("cell_pos").over(higher), F.lit(0)).alias("pos_above"),
            F.sum("cell_n").over(everything).alias("total_n"),
            F.sum("cell_pos").over(everything).alias("total_pos"),
        )
    )
    inside = (
        Window.partitionBy(*by, "cell")
        .orderBy(F.desc("score"))
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    running = celled.withColumns(
        {"run_n": F.sum("n").over(inside), "run_pos": F.sum("pos").over(inside)}
    )
    side = offsets if by else F.broadcast(offsets)
    return running.join(side, [*by, "cell"]).select(
        *by,
        "score",
        "n",
        "pos",
        (F.col("n_above") + F.col("run_n")).alias("cum_n"),
        (F.col("pos_above") + F.col("run_pos")).alias("cum_pos"),
        "total_n",
        "total_pos",
    )


def ranked_buckets(
    scored: DataFrame,
    bucket_of: Callable[[Column, Column], Column],
    score: str = "score",
    label: str = "label",
    key: str = "search_id",
) -> DataFrame:
    """(bucket, n, pos, score_sum) of rows ranked by score, highest first.

    ``bucket_of(rank, total)`` maps the 0-based rank to a bucket and must not decrease with the
    rank; the number of buckets is a small constant. Rows that share a score are ranked by the md5
    of their key, then the key.

    Three levels, each over what the one before left open: counts per distinct score; where the
    ties of a score cross a bucket boundary, counts per score and hash cell; where a cell crosses
    a boundary, its rows. Each boundary leaves one score and one cell open, so row-level sorting
    sees a 4,096th of the tied rows even if all rows have the same score.
    """

    def spread(rank: Column, size: Column) -> tuple[Column, Column]:
        total = F.col("total_n")
        return bucket_of(rank, total), bucket_of(rank + size - 1, total)

    def bucketed(level: DataFrame) -> DataFrame:
        return level.where(F.col("first_bucket") == F.col("last_bucket")).select(
            F.col("first_bucket").alias("bucket"),
            "n",
            "pos",
            (F.col("score") * F.col("n")).alias("score_sum"),
        )

    def open_parts(level: DataFrame) -> DataFrame:
        return level.where(F.col("first_bucket") < F.col("last_bucket"))

    # The tests on pos are always true. They keep the positives in both branches of a level, whose
    # shuffles are then equal and reused instead of scanning the input once more.
    positives = F.coalesce("pos", F.lit(0))
    first = F.col("cum_n") - F.col("n")
    low, high = spread(first, F.col("n"))
    scores = (
        score_curve(score_counts(scored, score, label))
        .where(F.coalesce("total_pos", F.lit(0)) >= positives)
        .withColumns({"first_rank": first, "first_bucket": low, "last_bucket": high})
    )
    open_scores = open_parts(scores).select(
        F.col("score").alias("open_score"), F.col("first_rank").alias("score_rank"), "total_n"
    )

    key_hash = F.md5(F.col("key").cast("string").cast("binary"))
    tied = (
        scored.select(F.col(key).alias("key"), F.col(score).alias("score"), F.col(label).alias("y"))
        .join(F.broadcast(open_scores), F.col("score") == F.col("open_score"))
        .withColumn("hash", key_hash)
        .withColumn("cell", F.substring("hash", 1, TIE_DIGITS))
    )
    before = Window.partitionBy("score").orderBy("cell")
    before = before.rowsBetween(Window.unboundedPreceding, -1)
    offset = F.coalesce(F.sum("n").over(before), F.lit(0))
    cells = (
        tied.groupBy("score", "cell", "score_rank", "total_n")
        .agg(rows("n"), F.sum(F.col("y").cast("bigint")).alias("pos"))
        .withColumn("cell_rank", F.col("score_rank") + offset)
    )
    low, high = spread(F.col("cell_rank"), F.col("n"))
    cells = cells.where(positives >= 0).withColumns({"first_bucket": low, "last_bucket": high})
    open_cells = open_parts(cells).select("score", "cell", "cell_rank")

    in_cell = Window.partitionBy("score", "cell").orderBy("hash", "key")
    resolved = (
        tied.join(F.broadcast(open_cells), ["score", "cell"])
        .withColumn("rank", F.col("cell_rank") + F.row_number().over(in_cell) - 1)
        .select(
            bucket_of(F.col("rank"), F.col("total_n")).alias("bucket"),
            F.lit(1).cast("bigint").alias("n"),
            F.col("y").cast("bigint").alias("pos"),
            F.col("score").alias("score_sum"),
        )
    )
    return (
        bucketed(scores)
        .unionByName(bucketed(cells))
        .unionByName(resolved)
        .groupBy("bucket")
        .agg(*[F.sum(c).alias(c) for c in ("n", "pos", "score_sum")])
    )
