"""Exact top-k by inner product with a uniform threshold in three phases.

Vectors of whole numbers are cut into a few lists of components; each list knows its share of every
score. First, each list reports the rows with its best shares per query, and its smallest share;
the k-th best full score among the reported rows bounds the answer from below. A row that reaches
the bound has, in at least one list, a share that reaches that list's cutoff: the smallest share
plus an even part of the bound's excess over all smallest shares. So second, the cutoffs go out and
each list collects the rows that reach its own. Third, the scores of these are completed by the
other lists, and the best of each block go on to the merge.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wayfunnel.llm.common import written
from wayfunnel.llm.vectors import blocks, matrix, meet, packed, usable

# Shares are summed as doubles; up to here they are exact. Beyond, they only find the candidates,
# with room for their error, and the candidates' scores are summed as whole numbers.
EXACT = float(1 << 52)
ROOM = float(2) ** -40  # of the largest possible share
LONGEST = (1 << 63) - 1
WITHIN = 9.2e18  # a little less


def whole_numbers(vectors: DataFrame, factor: int) -> DataFrame:
    """floor(factor * x) as doubles: from 2 ** 53 on a double has no fraction. A product beyond all
    doubles becomes the largest."""

    def floored(x):
        y = F.greatest(F.least(x * factor, F.lit(1.7976931348623157e308)), F.lit(-1.7976931348623157e308))
        return F.when(F.abs(y) < EXACT, F.floor(y).cast("double")).otherwise(y)

    return vectors.withColumn("vector", F.transform("vector", floored))


def whole_scores(one: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Exact inner products of rows of whole numbers, as longs; what lies beyond is the nearest
    long."""
    with np.errstate(over="ignore", invalid="ignore"):
        sizes = (np.abs(one) * np.abs(other)).sum(axis=1)
    small = (sizes < float(1 << 62)) & (np.maximum(np.abs(one), np.abs(other)).max(axis=1) < 2.0**62)
    found = np.zeros(len(one), np.int64)
    found[small] = (one[small].astype(np.int64) * other[small].astype(np.int64)).sum(axis=1)
    for i in np.flatnonzero(~small).tolist():
        score = sum(int(a) * int(b) for a, b in zip(one[i].tolist(), other[i].tolist(), strict=True))
        found[i] = max(-LONGEST - 1, min(LONGEST, score))
    return found


def _parts(width: int, lists: int) -> list[slice]:
    edges = [round(i * width / lists) for i in range(min(lists, width) + 1)]
    return [slice(a, b) for a, b in zip(edges, edges[1:], strict=False)]


def _shares(rows: dict, queries: dict, part: slice, start: int, stop: int) -> np.ndarray:
    """Shares of one list for some queries and all rows; the query's own row has none."""
    one, other = queries["vector"][start:stop, part], rows["vector"][:, part]
    with np.errstate(over="ignore", invalid="ignore"):
        shares = one @ other.T
    # beyond all doubles: the largest, of the sign that the halved factors give
    wild = ~np.isfinite(shares)
    if wild.any():
        small = np.ldexp(one, -520) @ np.ldexp(other, -520).T
        shares[wild] = np.sign(small[wild]) * 1e300
    np.clip(shares, -1e300, 1e300, out=shares)
    shares[queries["row"][start:stop, None] == rows["row"][None, :]] = np.nan
    return shares


def _chunks(rows: dict, queries: dict, lists: int) -> Iterator[tuple[int, list[np.ndarray]]]:
    """Some queries at a time: the first one's number and the shares of each list."""
    parts = _parts(rows["vector"].shape[1], lists)
    for start in range(0, len(queries["row"]), 256):
        yield start, [_shares(rows, queries, part, start, start + 256) for part in parts]


def _best(depth: int, lists: int):
    """Phase one: of each list and query the smallest share, and the full scores of the rows with
    the `depth` largest."""

    def work(rows: dict, queries: dict) -> Iterator[pd.DataFrame]:
        for start, shares in _chunks(rows, queries, lists):
            for part, one in enumerate(shares):
                known = np.where(np.isnan(one), -np.inf, one)
                lowest = np.where(np.isnan(one), np.inf, one).min(axis=1)
                n = min(depth, known.shape[1])
                best = np.argpartition(-known, n - 1, axis=1)[:, :n]
                query = np.repeat(np.arange(len(one)), n)
                place = best.ravel()
                real = known[query, place] > -np.inf
                query, place = query[real], place[real]
                score = sum(other[query, place] for other in shares)
                yield pd.DataFrame(
                    {
                        "query_row": queries["row"][start + query],
                        "list": part,
                        "row": rows["row"][place],
                        "score": score,
                        "lowest": lowest[query],
                    }
                )

    return work


def _above(k: int, lists: int, largest: float):
    """Phases two and three: rows that reach the cutoff of some list, their scores in full, and of
    these the k best of the block. largest: of all components, in size."""

    def work(rows: dict, queries: dict) -> Iterator[pd.DataFrame]:
        for start, shares in _chunks(rows, queries, lists):
            cutoff = queries["cutoff"][start : start + 256]
            asked = queries["vector"][start : start + 256]
            most = min(np.abs(asked).max(initial=0.0) * largest * asked.shape[1], 1e300)
            if most >= EXACT:
                cutoff = cutoff - most * ROOM
            reached = np.zeros(shares[0].shape, bool)
            for part, one in enumerate(shares):
                with np.errstate(invalid="ignore"):
                    reached |= one >= cutoff[:, part, None]
            query, place = np.nonzero(reached)
            if most < EXACT:
                score = sum(one[query, place] for one in shares).astype(np.int64)
            else:
                score = whole_scores(asked[query], rows["vector"][place])
            order = np.lexsort((rows["id"][place], ~score, query))
            query, place, score = query[order], place[order], score[order]
            first = np.searchsorted(query, query, side="left")
            best = np.arange(len(query)) - first < k
            yield pd.DataFrame(
                {
                    "query_row": queries["row"][start + query[best]],
                    "query_id": queries["id"][start + query[best]],
                    "vec_id": rows["id"][place[best]],
                    "score": score[best],
                }
            )

    return work


def _pack_queries(part: pd.DataFrame) -> bytes:
    part = part.sort_values("row", kind="stable")
    return packed(**matrix(part), cutoff=np.stack(part["cutoff"].to_numpy()).astype(np.float64))


def top_k(
    rows: DataFrame,
    is_query,
    *,
    key: str = "vec_id",
    vector: str = "embedding",
    k: int = 5,
    factor: int = 256,
    lists: int = 2,
    depth: int = 20,
    block: int = 8192,
    queries: int = 1024,
) -> DataFrame:
    """(query_id, rank, vec_id, score): of each row that is_query (on `id`) selects the k rows
    with the largest inner product of floor(factor * x), its own row left out, ties to the
    smaller id; all rows if there are fewer.

    Vectors that are null, empty or hold a null or a number that is not finite take no part, nor do
    rows with a null id; shorter vectors count as filled up with zeros to the longest. Rows that
    share a vector or an id are rows of their own. Scores are exact as far as a long goes; one
    beyond is given as the nearest long, and such rows count as ties. depth is how many rows
    each list of a block reports first; more of them make the bound, not the answer, better.
    """
    vectors = usable(rows.where(F.col(key).isNotNull()), key, vector, zero=True)
    vectors = whole_numbers(vectors, factor)
    largest = vectors.agg(F.max(F.array_max(F.transform("vector", F.abs)))).first()[0] or 0.0
    asked = vectors.where(is_query)

    def pack(part: pd.DataFrame) -> bytes:
        return packed(**matrix(part))

    row_blocks = blocks(vectors, block, pack)
    first = meet(
        row_blocks,
        blocks(asked, queries, pack),
        _best(depth, lists),
        "query_row long, list int, row long, score double, lowest double",
    )
    first = written(first, "local_lists")
    place = Window.partitionBy("query_row").orderBy(F.desc("score"), "row")
    scores = first.select("query_row", "row", "score").distinct()
    bound = (
        scores.withColumn("n", F.row_number().over(place))
        .where((F.col("n") == k) & (F.col("score") > -WITHIN))
        # what is beyond a long ties with the largest long
        .select("query_row", F.least("score", F.lit(WITHIN)).alias("bound"))
    )
    lows = first.groupBy("query_row", "list").agg(F.min("lowest").alias("lowest"))
    by_query = lows.groupBy("query_row").agg(
        F.sum("lowest").alias("all_lowest"),
        F.array_sort(F.collect_list(F.struct("list", "lowest"))).alias("lists"),
    )
    even = (F.col("bound") - F.col("all_lowest")) / F.size("lists")
    # with fewer than k rows, or ties at the smallest long, everything is wanted
    cutoffs = by_query.join(bound, "query_row", "left").select(
        F.col("query_row").alias("row"),
        F.transform(
            "lists", lambda x: F.coalesce(x["lowest"] + even, F.lit(float("-inf")))
        ).alias("cutoff"),
    )
    scored = meet(
        row_blocks,
        blocks(asked.join(cutoffs, "row"), queries, _pack_queries),
        _above(k, lists, largest),
        "query_row long, query_id long, vec_id long, score long",
    )
    order = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id")
    ranked = scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
