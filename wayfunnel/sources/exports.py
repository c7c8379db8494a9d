"""Exports. Every writer stays distributed; nothing is collected to the driver."""

from __future__ import annotations

from collections.abc import Sequence
from functools import partial

from pyspark.sql import Column, DataFrame

from wayfunnel.sources.together import run_together


def export_marts(marts: dict[str, DataFrame], directory: str) -> dict[str, str]:
    """Each ``layer.table`` to zstd Parquet under ``layer_table.parquet``; name to path."""
    paths = {
        name: f"{directory.rstrip('/')}/{name.replace('.', '_')}.parquet" for name in marts
    }

    def write(name: str) -> None:
        writer = marts[name].write.option("compression", "zstd").mode("overwrite")
        writer.parquet(paths[name])

    if marts:
        spark = next(iter(marts.values())).sparkSession
        run_together(spark, {name: partial(write, name) for name in marts})
    return paths


def export_csv(frame: DataFrame, path: str, order_by: Sequence[Column | str] = ()) -> None:
    """One CSV file with a header, for aggregated tables of report size.

    ``repartition`` keeps the stages before it parallel (``coalesce`` would run them in one task);
    the few result rows are then sorted in place.
    """
    out = frame.repartition(1)
    if order_by:
        out = out.sortWithinPartitions(*order_by)
    out.write.option("header", True).mode("overwrite").csv(path)


def export_json(frame: DataFrame, path: str) -> None:
    """Summary documents: one JSON object per row, NULLs kept."""
    frame.repartition(1).write.option("ignoreNullFields", False).mode("overwrite").json(path)


def export_predictions(predictions: DataFrame, path: str) -> None:
    predictions.write.mode("overwrite").parquet(path)
