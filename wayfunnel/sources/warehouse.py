"""Warehouse layers as Spark databases: staging, analytics, product."""

from __future__ import annotations

import re
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

LAYERS = ("staging", "analytics", "product")


def create_layers(spark: SparkSession, prefix: str = "") -> None:
    for layer in LAYERS:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {prefix}{layer}")


def save_table(
    frame: DataFrame,
    name: str,
    prefix: str = "",
    partition_by: Sequence[str] = (),
    bucket_by: tuple[int, str] | None = None,
) -> DataFrame:
    """Replace a managed Parquet table and return it as a table scan.

    The name is a view of the table's current version. A new version is written beside it, shown
    once it is whole, and the one before is dropped then: a build that fails leaves the old rows
    readable, and the frame may read the table that it replaces.

    ``partition_by`` the search date prunes incident and date-range scans; the rebalance before it
    lets adaptive execution merge small and split large partitions, so that neither quiet days
    leave tiny files nor a busy day one huge task. ``bucket_by`` a join key lets later joins of
    tables with the same buckets skip their shuffles.
    """
    if partition_by:
        frame = frame.hint("rebalance", *partition_by)
    spark, target = frame.sparkSession, prefix + name
    beside = f"{target}__{uuid.uuid4().hex[:8]}"
    writer = frame.write.format("parquet")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if bucket_by:
        buckets, column = bucket_by
        writer = writer.bucketBy(buckets, column).sortBy(column)
    try:
        writer.saveAsTable(beside)
    except Exception:
        spark.sql(f"DROP TABLE IF EXISTS {beside}")
        raise
    _show(spark, target, beside)
    return spark.table(target)


def _show(spark: SparkSession, target: str, version: str) -> None:
    """Lets the name show this version, in one step, and drops the versions before it."""
    database, _, name = target.rpartition(".")
    if spark.catalog.tableExists(target) and spark.catalog.getTable(target).tableType != "VIEW":
        spark.sql(f"DROP TABLE {target}")  # written before versions were kept apart
    spark.sql(f"CREATE OR REPLACE VIEW {target} AS SELECT * FROM {version}")
    kept = version.rpartition(".")[2]
    for row in spark.sql(f"SHOW TABLES IN {database} LIKE '{name}__*'").collect():
        old = row["tableName"]
        if re.fullmatch(rf"{re.escape(name)}__[0-9a-f]{{8}}", old) and old != kept:
            spark.sql(f"DROP TABLE {database}.{old}")


def open_table(spark: SparkSession, name: str, prefix: str = "") -> DataFrame:
    return spark.table(prefix + name)
