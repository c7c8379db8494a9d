"""Permutation importance: the drop in average precision when one feature is shuffled."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wayfunnel.operators.curves import score_counts, score_curve
from wayfunnel.settings import FEATURES, TARGET
from wayfunnel.sources.workarea import shared_folder

NOTHING = "(none)"
RANK_DIGITS = 4  # rows are ranked in 65,536 hash cells
GROUP_CELLS = 1024
BLOCK_ROWS = 8192  # positions that are filled together
TASK_ROWS = 100_000  # positions that a task fills, on average
BASE = -1  # the round that holds the unchanged order


def _draw(key: str, *salt: object) -> Column:
    return F.md5(F.concat_ws(":", *[F.lit(str(s)) for s in salt], F.col(key)).cast("binary"))


def _draws(rows: DataFrame, repeats: int, seed: int, key: str) -> DataFrame:
    """Every row once per round, with its hash (``draw``) and the cell that it falls into (``spot``).

    Rounds are ``BASE`` and 0 to ``repeats`` - 1. A cell is a round and the first digits of a hash.
    """
    rounds = F.explode(F.array(*[F.lit(r) for r in (BASE, *range(repeats))])).alias("repeat")
    salted = F.when(F.col("repeat") == BASE, _draw(key, seed)).otherwise(
        F.md5(F.concat_ws(":", F.lit(str(seed)), "repeat", key).cast("binary"))
    )
    cell = F.conv(F.substring("draw", 1, RANK_DIGITS), 16, 10).cast("bigint")
    spot = (F.col("repeat") - BASE) * F.lit(16**RANK_DIGITS).cast("bigint")
    spot += F.coalesce(cell, F.lit(0))  # never null, or a join would draw twice to test that
    drawn = rows.select("*", rounds).withColumn("draw", salted).withColumn("spot", spot)
    return drawn.withColumn("draw", F.unhex("draw"))


def _offsets(drawn: DataFrame) -> DataFrame:
    """(spot, held, offset): rows of a cell, and rows of its round in the cells before it."""
    before = Window.partitionBy("repeat").orderBy("spot").rowsBetween(Window.unboundedPreceding, -1)
    held = drawn.groupBy("repeat", "spot").agg(F.count(F.lit(1)).alias("held"))
    offset = F.coalesce(F.sum("held").over(before), F.lit(0)).alias("offset")
    return held.select("spot", "held", offset)


def shuffled_positions(rows: DataFrame, repeats: int, seed: int, key: str) -> DataFrame:
    """Every row once per round, with its position from 1 in the round's random order.

    Rounds are ``BASE`` and 0 to ``repeats`` - 1; the order is that of a hash of seed, round and
    key. The first digits of the hash are a cell: cells are counted and numbered within, so that
    no task ever orders more than a cell.
    """
    drawn = _draws(rows, repeats, seed, key)
    inside = Window.partitionBy("spot").orderBy("draw", key)
    ranked = drawn.withColumn("place", F.row_number().over(inside)).join(_offsets(drawn), "spot")
    return ranked.withColumn("position", F.col("offset") + F.col("place")).drop(
        "draw", "spot", "held", "offset", "place"
    )


def with_donors(rows: DataFrame, repeats: int, seed: int, key: str = "search_id") -> DataFrame:
    """Every row once, with ``donors``: per repeat the features of the row whose place it takes.
    All features of a repeat share one permutation.

    The rows of all rounds that compete for a block of positions are sent to one task, which numbers
    them and lays the rounds beside each other: the wide rows are shuffled once. A cell that crosses
    the border of blocks is numbered in each of them; rows that tie in everything are alike. The
    broadcast counts have at most a row per round and cell.
    """
    wide = rows.select(key, TARGET, F.struct(*FEATURES).alias("features"))
    last = F.col("offset") + F.col("held") - 1
    blocks = F.sequence(F.floor(F.col("offset") / BLOCK_ROWS), F.floor(last / BLOCK_ROWS))
    dealt = (
        _draws(wide, repeats, seed, key)
        .join(F.broadcast(_offsets(_draws(rows.select(key), repeats, seed, key))), "spot")
        .withColumn("block", F.explode(blocks))
        .repartition(rows.count() // TASK_ROWS + 1, "block")
    )
    # the leading column of a sort is the one that tells most rows apart
    inside = Window.partitionBy("spot", "block").orderBy("draw", key, TARGET, "features")
    position = F.col("offset") + F.row_number().over(inside) - 1
    numbered = (
        dealt.withColumn("position", position)
        .where(F.floor(F.col("position") / BLOCK_ROWS) == F.col("block"))
        .select("block", "position", "repeat", key, TARGET, "features")
    )
    beside = Window.partitionBy("position", "block").orderBy("repeat")
    donors = F.array(*[F.lead("features", r + 1).over(beside) for r in range(repeats)])
    return (
        numbered.withColumn("donors", donors)
        .where(F.col("repeat") == BASE)
        .select(key, TARGET, "features.*", "donors")
    )


def swapped_rows(paired: DataFrame, name: str, key: str = "search_id") -> DataFrame:
    """Every row once per repeat, with this one feature of its donor. A field of an array of structs
    is read alone, without the other features of the donors."""
    values = F.posexplode(F.col("donors")[name]).alias("repeat", "_swapped")
    return paired.select("*", values).select(
        "repeat", key, TARGET, *[F.col("_swapped" if f == name else f).alias(f) for f in FEATURES]
    )


def passes(paired: DataFrame, key: str = "search_id") -> dict[str, DataFrame]:
    """The rows of every pass by the feature that it swaps, and unchanged under ``NOTHING``."""
    unchanged = paired.select(F.lit(0).alias("repeat"), key, TARGET, *FEATURES)
    return {NOTHING: unchanged} | {name: swapped_rows(paired, name, key) for name in FEATURES}


def permuted_rows(rows: DataFrame, repeats: int, seed: int, key: str = "search_id") -> DataFrame:
    """The rows of all passes, with the feature that each swaps."""
    named = passes(with_donors(rows, repeats, seed, key), key).items()
    return reduce(
        DataFrame.unionByName, [part.select(F.lit(f).alias("feature"), "*") for f, part in named]
    )


def grouped_average_precision(
    scored: DataFrame, by: tuple[str, ...], score: str = "score", label: str = TARGET
) -> DataFrame:
    """Step-wise average precision per group of any size, from the grouped ranked curve.

    A group is cut into fewer cells than a single ranking, so that the cells of all groups stay
    small beside their rows.
    """
    return _average_precision(score_counts(scored, score, label, by), by)


def _average_precision(counts: DataFrame, by: tuple[str, ...]) -> DataFrame:
    curve = score_curve(counts, GROUP_CELLS, by)
    steps = F.sum(F.col("pos") * (F.col("cum_pos") / F.col("cum_n")))
    return curve.groupBy(*by).agg(
        (steps / F.nullif(F.sum("pos"), F.lit(0))).alias("average_precision")
    )


def permutation_importance(
    frame: DataFrame,
    score_rows: Callable[[DataFrame], DataFrame],
    repeats: int = 3,
    seed: int = 42,
    key: str = "search_id",
) -> DataFrame:
    """(feature, importance_mean, importance_std) over the repeats, population deviation.

    ``score_rows`` adds a ``score`` column, for example ``model.transform`` plus a projection. Rows
    are paired with their donors once and written; each feature is then a pass of its own over that
    table, which reads the row's features and one column of its donors, and shuffles no more than
    counts per score. These are written as well: ranking refers to them many times, and a plan that
    held all passes as often would take longer to make than to run. Every row of the frame takes
    part.
    """
    spark = frame.sparkSession
    place = f"{shared_folder(spark)}/wayfunnel-{spark.sparkContext.applicationId}"
    path = f"{place}/importance-{uuid.uuid4().hex}"

    def written(rows: DataFrame, name: str) -> DataFrame:
        rows.write.parquet(f"{path}/{name}")
        return spark.read.schema(rows.schema).parquet(f"{path}/{name}")

    paired = written(with_donors(frame, repeats, seed, key), "paired")
    # a pass and repeat is one number, so that keys of the counts have a fixed width
    all_passes = passes(paired, key)
    scored = [
        score_rows(rows).select(
            (F.lit(i * repeats) + F.col("repeat")).cast("int").alias("part"), TARGET, "score"
        )
        for i, rows in enumerate(all_passes.values())
    ]
    everything = reduce(DataFrame.unionByName, scored)
    counts = written(score_counts(everything, by=("part",), label=TARGET), "counts")
    names = F.array(*map(F.lit, all_passes))
    feature = F.element_at(names, (F.floor(F.col("part") / repeats) + 1).cast("int"))
    precision = _average_precision(counts, ("part",)).withColumn("feature", feature)
    # one row per feature and repeat: the unchanged rows' value goes to all of them
    baseline = F.max(
        F.when(F.col("feature") == NOTHING, F.col("average_precision"))
    ).over(Window.partitionBy())
    drops = precision.withColumn("drop", baseline - F.col("average_precision"))
    return (
        drops.where(F.col("feature") != NOTHING)
        .groupBy("feature")
        .agg(
            F.avg("drop").alias("importance_mean"),
            F.stddev_pop("drop").alias("importance_std"),
        )
    )
