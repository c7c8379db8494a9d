"""Helpers that several operators share."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.sql.window import Window


def shared_folder(spark: SparkSession) -> str:
    """The folder that the cluster names in spark.checkpoint.dir; unset, one in the warehouse,
    which all executors reach as well."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    return (folder or spark.conf.get("spark.sql.warehouse.dir") + "/_checkpoints").rstrip("/")


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    return f"{shared_folder(spark)}/llm-{name}-{uuid.uuid4().hex}"


def written(frame: DataFrame, name: str) -> DataFrame:
    """The frame as a Parquet table in the shared folder: lineage ends here for good."""
    path = scratch(frame.sparkSession, name)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{directory.rstrip('/')}/{name}.parquet")


def crc_of_id(column: str) -> Column:
    return F.crc32(F.col(column).cast("string").cast("binary"))


def lower_ascii(text: Column) -> Column:
    """Lower-cases A-Z and nothing else; null counts as empty."""
    return F.translate(
        F.coalesce(text, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    )


def runs(sorted_keys: np.ndarray) -> np.ndarray:
    """Start of each run of equal values, and the length as a last entry."""
    if not len(sorted_keys):
        return np.zeros(1, np.int64)
    change = np.flatnonzero(sorted_keys[1:] != sorted_keys[:-1]) + 1
    return np.concatenate(([0], change, [len(sorted_keys)]))


def ragged_positions(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For rows with so many items each: the row of every item, and its number within the row."""
    row = np.repeat(np.arange(len(counts)), counts)
    first = np.cumsum(counts) - counts
    return row, np.arange(len(row)) - first[row]


def fresh(name: str, taken: list[str]) -> str:
    """The name, with underscores added until no taken column has it in any letter case."""
    used = {column.lower() for column in taken}
    while name.lower() in used:
        name += "_"
    return name


def numbered(frame: DataFrame, group: str, order: list[str], name: str) -> DataFrame:
    """The rows, written, with `position` (from 0) in their group and `held`, its number of rows.

    Rows are dealt by ranges of group and order, so a group of any size spreads over tasks; only
    one row per group and range is summed over ranges. Groups must not be null; in the order nulls
    come first, and equal rows stand in any order. The frame should be a written table.
    """
    tie = fresh("tie", frame.columns)
    row = fresh("row", frame.columns)
    keys = [group, *order, tie]
    ranged = frame.withColumn(tie, F.xxhash64(F.monotonically_increasing_id()))
    ranged = ranged.repartitionByRange(*keys).sortWithinPartitions(*keys).drop(tie)
    laid = written(ranged.withColumn(row, F.monotonically_increasing_id()), name)
    part = F.shiftright(row, 33)
    before = Window.partitionBy("t").orderBy("part")
    places = (
        laid.groupBy(F.col(group).alias("t"), part.alias("part"))
        .agg(F.count("*").alias("n"), F.min(row).alias("first"))
        .withColumn("held", F.sum("n").over(Window.partitionBy("t")))
        .withColumn("offset", F.sum("n").over(before) - F.col("n") - F.col("first"))
        .select("t", "part", "held", "offset")
    )
    placed = laid.join(places, (laid[group] == places["t"]) & (part == places["part"]))
    return placed.withColumn("position", F.col(row) + F.col("offset")).drop(row, "t", "part", "offset")


def map_texts(
    frame: DataFrame,
    text: str,
    carry: list[str],
    added: str,
    work: Callable[[list[str | None]], list[pa.Array]],
    at_once: int = 4_000_000,
) -> DataFrame:
    """The carried columns and those that `work` makes of lists of whole texts.

    added is a DDL list of work's columns. A list ends at about `at_once` characters, so memory
    follows that and the longest text, not the batch.
    """
    columns = carry if text in carry else [*carry, text]
    place = columns.index(text)
    schema = StructType(
        frame.select(*carry).schema.fields + StructType.fromDDL(added).fields
    )
    names = schema.names

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, kept = batch.column(place), batch.columns[: len(carry)]
            for start, end in _slices(texts, at_once):
                made = work(texts.slice(start, end - start).to_pylist())
                sliced = [c.slice(start, end - start) for c in kept]
                yield pa.RecordBatch.from_arrays([*sliced, *made], names)

    source = frame.select(*[F.col(f"`{c}`") for c in columns])
    return source.withColumn(text, F.col(f"`{text}`").cast("string")).mapInArrow(mapped, schema)


def _slices(texts: pa.Array, at_once: int) -> Iterator[tuple[int, int]]:
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    block = (np.cumsum(sizes, dtype=np.int64) - sizes) // at_once
    bounds = runs(block)
    return zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)
