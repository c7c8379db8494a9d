"""Mixing sources to target weights by Poisson replication.

A source's repetition rate is its target volume over its volume. Each document gets a number of
copies from the Poisson distribution of that mean: the inverse distribution function at a uniform
number that is a hash of seed and key, so that a run repeats exactly. Copies are then dealt to
partitions and sorted by another hash, which shuffles them globally in one exchange; documents of
sources with large rates are first spread in parts of their copies.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from wayfunnel.llm.common import fresh, written

# 13 hexadecimal digits: as many bits as a double holds exactly
DIGITS = 13
# copies of a document that one row makes, and steps of a source whose copies need no spreading
PART, STEPS_IN_PLACE = 64, 100


def uniform(*parts: Column) -> Column:
    """A number in [0, 1) from the md5 of the parts, joined by colons; nulls count as empty."""
    joined = F.concat_ws(":", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    digits = F.substring(F.md5(joined.cast("binary")), 1, DIGITS)
    return F.conv(digits, 16, 10).cast("double") / float(16**DIGITS)


def poisson_steps(rate: float) -> tuple[int, list[float]]:
    """A number of copies that no draw goes below, and the cumulative probabilities of that many
    and of one more each, as far as doubles tell them from 1.

    About 24 square roots of the rate: worked out by ratios around the mean, so that no probability
    underflows whatever the rate.
    """
    spread = 12 * math.sqrt(rate) + 25
    first, last = max(0, math.floor(rate - spread)), math.ceil(rate + spread)
    if rate <= 0:
        return 0, [1.0]
    logs = np.concatenate(([0.0], np.cumsum(np.log(rate / np.arange(first + 1, last + 1)))))
    sums = np.cumsum(np.exp(logs - logs.max()))
    return first, (sums / sums[-1]).tolist()


def with_steps(rates: DataFrame) -> DataFrame:
    """The rates with fewest (copies) and steps, a row at a time."""
    schema = StructType(rates.schema.fields + StructType.fromDDL("fewest long, steps array<double>").fields)

    def worked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, rate in enumerate(batch.column("rate").to_pylist()):
                fewest, steps = poisson_steps(rate)
                made = [pa.array([fewest], pa.int64()), pa.array([steps], pa.list_(pa.float64()))]
                yield pa.RecordBatch.from_arrays([*batch.slice(i, 1).columns, *made], schema.names)

    return rates.mapInArrow(worked, schema)


def source_rates(
    documents: DataFrame,
    *,
    source: str = "source",
    text: str = "text",
    targets: Mapping[str, float] | None = None,
    volume: float = 1.0,
    power: float = 0.5,
) -> DataFrame:
    """(source, n_bytes, rate, fewest, steps): one row per source, null being a source of its own.

    targets are relative weights; sources that it does not name get none. Without targets a
    source's weight is its UTF-8 bytes to the given power. volume is the size of the mix relative
    to the input. A source without bytes has rate 1; a small source's rate is as large as its target
    asks for.
    """
    n_bytes = F.coalesce(F.octet_length(F.col(text).cast("string")), F.lit(0)).cast("long")
    sizes = documents.groupBy(F.col(source).alias("source")).agg(F.sum(n_bytes).alias("n_bytes"))
    if targets is None:
        weight = F.pow(F.col("n_bytes").cast("double"), F.lit(power))
        if power == 0.5:
            weight = F.sqrt(F.col("n_bytes").cast("double"))
    else:
        weight = F.lit(0.0)
        for name, value in targets.items():
            weight = F.when(F.col("source").eqNullSafe(F.lit(name)), float(value)).otherwise(weight)
    weighted = sizes.withColumn("weight", weight)
    totals = weighted.agg(
        F.sum("n_bytes").cast("double").alias("all_bytes"),
        # rounded, so that the order of summation cannot show
        F.round(F.sum(F.round("weight", 6).cast("decimal(38,6)")).cast("double"), 6).alias("all"),
    )
    share = F.col("weight") / totals.select("all").scalar()
    wanted = share * totals.select("all_bytes").scalar() * volume
    rate = F.when(F.col("n_bytes") > 0, wanted / F.col("n_bytes"))
    rated = weighted.select("source", "n_bytes", F.coalesce(rate, F.lit(1.0)).alias("rate"))
    # written, so that its size is known when the join with the documents is planned
    return written(with_steps(rated), "rates")


def mix(
    documents: DataFrame,
    rates: DataFrame,
    *,
    key: str = "doc_id",
    source: str = "source",
    seed: int = 11,
    copy: str = "copy",
    order: str = "shuffle_key",
) -> DataFrame:
    """Every document as often as its draw says, with the copy's number from 0 and its place in the
    global order: sorted by that number in each partition, with like chances for all partitions.

    Rows with one key draw the same number, and repeated rows are drawn each; a null key is hashed
    like an empty one. A null source matches the null source's rate, and a document whose source has
    no rate goes. All columns stay; `copy` and `order` must not be among them, in any letter case.
    """
    taken = [*documents.columns, copy, order]
    own = {
        name: fresh(name, taken)
        for name in ("_source", "_fewest", "_steps", "_copies", "_start", "_first", "_number", "_one")
    }
    rate = rates.select(
        *[F.col(name).alias(own[f"_{name}"]) for name in ("source", "fewest", "steps")]
    )
    names = [F.col(f"`{name}`") for name in documents.columns]

    def drawn_copies(rate: DataFrame) -> DataFrame:
        """The documents of the sources with their number of copies."""
        joined = documents.join(rate, F.col(f"`{source}`").eqNullSafe(F.col(own["_source"])))
        drawn = uniform(F.lit(seed), F.col(f"`{key}`"))
        # copies: how many cumulative probabilities the draw has reached. The draw is bound once by
        # the outer function; named in a column, it would be worked out for every step.
        reached = F.transform(
            F.array(drawn), lambda u: F.size(F.filter(own["_steps"], lambda s: s <= u))
        )
        copies = (F.col(own["_fewest"]) + F.get(reached, F.lit(0))).cast("int")
        return joined.select(*names, copies.alias(own["_copies"]))

    def numbered(drawn: DataFrame, first: Column, size: Column) -> DataFrame:
        repeated = F.posexplode(F.array_repeat(F.lit(True), size)).alias(
            own["_number"], own["_one"]
        )
        found = drawn.select(*names, first.alias(own["_first"]), repeated)
        number = F.col(own["_first"]) + F.col(own["_number"])
        return found.select(*names, number.alias(copy))

    # a document of a source with many copies goes out in parts of bounded size, over all tasks
    many = F.size(own["_steps"]) > STEPS_IN_PLACE
    drawn, start = F.col(own["_copies"]), F.col(own["_start"])
    copies = numbered(drawn_copies(rate.where(~many)), F.lit(0), drawn)
    if not rate.where(many).isEmpty():
        starts = F.explode(F.sequence(F.lit(0), drawn - 1, F.lit(PART))).alias(own["_start"])
        parts = drawn_copies(rate.where(many)).where(drawn > 0).select(*names, drawn, starts)
        tasks = int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        parts = parts.repartition(tasks, F.xxhash64(F.col(f"`{key}`"), start))
        size = F.least(F.lit(PART), drawn - start)
        copies = copies.unionByName(numbered(parts, start, size))
    copies = copies.withColumn(order, uniform(F.lit(seed + 1), F.col(f"`{key}`"), F.col(copy)))
    cell = F.floor(F.col(order) * 1_000_000)
    return copies.repartition(cell).sortWithinPartitions(order)


def mixed_documents(
    documents: DataFrame, *, key: str = "doc_id", source: str = "source", text: str = "text", **rates
) -> DataFrame:
    """The mix with the columns of the documents only."""
    columns = documents.columns
    found = source_rates(documents, source=source, text=text, **rates)
    names = {"copy": fresh("copy", columns), "order": fresh("shuffle_key", columns)}
    return mix(documents, found, key=key, source=source, **names).select(*columns)
