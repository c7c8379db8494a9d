"""Connected components of a graph of edges, whatever its hubs weigh."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfunnel.llm.common import written


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The edges of each batch as stars around the least node of each of its components."""
    for batch in batches:
        ends = np.concatenate([batch.column(i).to_numpy(zero_copy_only=False) for i in range(2)])
        nodes, place = np.unique(ends, return_inverse=True)
        a, b = np.split(place, 2)
        root = np.arange(len(nodes))
        while True:
            least = root.copy()
            np.minimum.at(least, a, root[b])
            np.minimum.at(least, b, root[a])
            least = least[least]
            if np.array_equal(least, root):
                break
            root = least
        member = np.flatnonzero(root != np.arange(len(nodes)))
        columns = [pa.array(nodes[member]), pa.array(nodes[root[member]])]
        yield pa.RecordBatch.from_arrays(columns, ["v", "u"])


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, root): the smallest node of its component, for each node with an edge (a, b) of longs.

    Batches of edges are first reduced to stars of their own; then large and small stars alternate
    until the edges stay the same. Minima are summed before the shuffle and written, so that the
    joins with them stand on plain exchanges, whose hubs adaptive execution splits. An edge from a
    node to itself makes it known. The edges need not be distinct.
    """
    edges = written(edges.select(F.col("a").cast("long"), F.col("b").cast("long")), "edges")
    alone = edges.where("a = b").select(F.col("a").alias("node"))
    schema = "v long, u long"
    pairs = written(edges.where("a <> b").mapInArrow(_forest, schema).distinct(), "stars")
    before = None
    for _ in range(most_rounds):
        state = pairs.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before or state[0] == 0:
            roots = pairs.select(F.col("u").alias("node"), F.col("u").alias("root")).distinct()
            alone = alone.select("node", F.col("node").alias("root"))
            found = pairs.select(F.col("v").alias("node"), F.col("u").alias("root"))
            return found.unionByName(roots).unionByName(alone).groupBy("node").agg(
                F.min("root").alias("root")
            )
        before = state
        # large star: larger neighbours go to the smallest neighbour
        around = written(
            pairs.unionByName(pairs.select(F.col("u").alias("v"), F.col("v").alias("u"))), "around"
        )
        least = written(around.groupBy(F.col("v").alias("c")).agg(F.min("u").alias("m")), "least")
        large = around.join(least, around["v"] == least["c"]).where("u > v")
        large = large.select(F.col("u").alias("v"), F.least("m", "c").alias("u")).distinct()
        large = written(large, "large")
        # small star: smaller neighbours and the centre go to the smallest neighbour
        least = written(large.groupBy(F.col("v").alias("c")).agg(F.min("u").alias("m")), "least")
        small = large.join(least, large["v"] == least["c"]).where("u <> m")
        small = small.select(F.col("u").alias("v"), F.col("m").alias("u"))
        centres = least.select(F.col("c").alias("v"), F.col("m").alias("u"))
        pairs = written(small.unionByName(centres).distinct(), "small")
    raise RuntimeError(f"components did not settle in {most_rounds} rounds")
