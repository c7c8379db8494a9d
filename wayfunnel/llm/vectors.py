"""Vectors in blocks of bounded size, and blocks of queries met with blocks of rows."""

from __future__ import annotations

import io
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from wayfunnel.llm.common import written


def packed(**arrays: np.ndarray) -> bytes:
    out = io.BytesIO()
    np.savez(out, **arrays)
    return out.getvalue()


def unpacked(data: bytes) -> dict[str, np.ndarray]:
    with np.load(io.BytesIO(data)) as found:
        return {name: found[name] for name in found.files}


def usable(rows: DataFrame, key: str, vector: str, *, zero: bool) -> DataFrame:
    """(row, id, vector) of the rows whose vector is not null and holds only finite numbers; zero:
    whether all may be zero. row is a number of its own for each. Shorter vectors are filled up with
    zeros to the longest, which changes neither inner products nor cosines; empty ones take no part."""
    found = F.col(vector).cast("array<double>")
    finite = F.forall(
        found, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    )
    kept = F.coalesce(finite & (F.size(found) > 0), F.lit(False))
    if not zero:
        kept = kept & F.exists(found, lambda x: x != 0)
    sound = rows.select(F.col(key).cast("long").alias("id"), found.alias("vector")).where(kept)
    numbered = written(sound.withColumn("row", F.monotonically_increasing_id()), "vectors")
    width = F.size("vector")
    shortest, longest = numbered.agg(F.min(width), F.max(width)).first()
    if shortest == longest:
        return numbered
    filled = F.concat("vector", F.array_repeat(F.lit(0.0), F.lit(longest) - width))
    return numbered.withColumn("vector", filled)


def blocks(vectors: DataFrame, size: int, pack: Callable[[pd.DataFrame], bytes]) -> DataFrame:
    """(block, data): rows dealt evenly by a hash of their number, about `size` to a block."""
    count = max(1, -(-vectors.count() // size))
    dealt = vectors.withColumn("block", F.pmod(F.xxhash64("row"), F.lit(count)))

    def one(rows: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"block": rows["block"].iloc[:1], "data": [pack(rows)]})

    return written(dealt.groupBy("block").applyInPandas(one, "block long, data binary"), "blocks")


def matrix(rows: pd.DataFrame) -> dict[str, np.ndarray]:
    rows = rows.sort_values("row", kind="stable")
    return {
        "row": rows["row"].to_numpy(np.int64),
        "id": rows["id"].fillna(-1).to_numpy(np.int64),
        "vector": np.stack(rows["vector"].to_numpy()),
    }


def meet(
    row_blocks: DataFrame,
    query_blocks: DataFrame,
    work: Callable[[dict[str, np.ndarray], dict[str, np.ndarray]], Iterator[pd.DataFrame]],
    schema: str,
) -> DataFrame:
    """What work makes of every block of rows with every block of queries; a task holds one of
    each at a time."""
    last = [side.agg(F.max("block")).first()[0] for side in (row_blocks, query_blocks)]
    if None in last:
        return row_blocks.sparkSession.createDataFrame([], schema)
    none = F.lit(None).cast("binary")

    def spread(side: DataFrame, others: int, own: str, other: str, columns: list[Column]):
        copies = F.explode(F.sequence(F.lit(0), F.lit(others).cast("long")))
        return side.select(F.col("block").alias(own), copies.alias(other), *columns)

    data = F.col("data")
    both = spread(
        row_blocks, last[1], "b", "q", [data.alias("rows"), none.alias("queries")]
    ).unionByName(
        spread(query_blocks, last[0], "q", "b", [none.alias("rows"), data.alias("queries")])
    )
    names = StructType.fromDDL(schema).names

    def one(pair: pd.DataFrame) -> pd.DataFrame:
        rows, queries = (pair[c].dropna() for c in ("rows", "queries"))
        if not len(rows) or not len(queries):  # a number that no block has
            return pd.DataFrame(columns=names)
        found = list(work(unpacked(rows.iloc[0]), unpacked(queries.iloc[0])))
        return pd.concat(found, ignore_index=True)

    return both.groupBy("b", "q").applyInPandas(one, schema)
