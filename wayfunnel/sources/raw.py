"""The raw layer: six Parquet inputs, their presence, and temporary views over them."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from wayfunnel.schemas import CONTRACT


def raw_path(directory: str, name: str) -> str:
    return f"{directory.rstrip('/')}/{name}.parquet"


def missing_inputs(spark: SparkSession, directory: str) -> list[str]:
    """Names of the inputs that cannot be opened. Works on any file system Spark can read."""

    def readable(name: str) -> bool:
        try:
            spark.read.schema(CONTRACT[name].schema).parquet(raw_path(directory, name))
        except AnalysisException as error:
            if error.getCondition() == "PATH_NOT_FOUND":
                return False
            raise
        return True

    return [name for name in CONTRACT if not readable(name)]


def read_raw(spark: SparkSession, directory: str) -> dict[str, DataFrame]:
    """All inputs; fails with the full list of missing ones."""
    missing = missing_inputs(spark, directory)
    if missing:
        raise FileNotFoundError(f"missing raw datasets in {directory}: {missing}")
    return {name: spark.read.parquet(raw_path(directory, name)) for name in CONTRACT}


def register_raw_views(tables: dict[str, DataFrame], prefix: str = "raw_") -> None:
    for name, frame in tables.items():
        frame.createOrReplaceTempView(prefix + name)
