"""Nearest neighbours by cosine: a hierarchical navigable small-world graph per shard.

Each layer of a shard's graph is one flat array of neighbour numbers. The upper layers hold ever
fewer vectors; a search walks greedily down to the lowest layer and there keeps the best found so
far in a beam. All queries of a block walk at the same time. Shard results are merged by score.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wayfunnel.llm.vectors import blocks, matrix, meet, packed, usable


@dataclass(frozen=True)
class Graph:
    """degree: neighbours kept per vector and direction; every `thin`-th vector is in the next
    layer; beam: entries a search keeps in the lowest layer."""

    degree: int = 16
    thin: int = 16
    beam: int = 96
    shard: int = 8192
    queries: int = 1024


def _candidates(vectors: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """For each vector the nearest others in the shard, nearest first, and their cosines."""
    count = len(vectors)
    most = min(most, count - 1)
    near, cosine = np.zeros((count, most), np.int32), np.zeros((count, most), np.float32)
    for start in range(0, count, 512):
        part = vectors[start : start + 512] @ vectors.T
        part[np.arange(len(part)), start + np.arange(len(part))] = -np.inf
        best = np.argpartition(-part, most - 1, axis=1)[:, :most]
        value = np.take_along_axis(part, best, axis=1)
        order = np.argsort(-value, axis=1, kind="stable")
        near[start : start + 512] = np.take_along_axis(best, order, axis=1)
        cosine[start : start + 512] = np.take_along_axis(value, order, axis=1)
    return near, cosine


def layer(vectors: np.ndarray, degree: int) -> np.ndarray:
    """Neighbour numbers of each unit vector, -1 where there are fewer.

    A candidate is kept if it is nearer to the vector than to any neighbour kept before, so that
    neighbours lie in different directions; links then go both ways, the nearest of them first.
    """
    count = len(vectors)
    if count < 2:
        return np.full((count, 1), -1, np.int32)
    near, cosine = _candidates(vectors, 3 * degree)
    kept = np.full((count, degree), -1, np.int32)
    held = np.zeros(count, np.int64)
    closest = np.zeros((count, degree), np.float32)
    for rank in range(near.shape[1]):
        candidate = near[:, rank]
        others = vectors[np.maximum(kept, 0)]
        between = np.einsum("nd,nkd->nk", vectors[candidate], others)
        between[kept < 0] = -np.inf
        good = (held < degree) & (between.max(axis=1) < cosine[:, rank])
        rows = np.flatnonzero(good)
        kept[rows, held[rows]] = candidate[rows]
        closest[rows, held[rows]] = cosine[rows, rank]
        held[rows] += 1
    own = np.repeat(np.arange(count), degree)
    there, value = kept.ravel(), closest.ravel()
    real = there >= 0
    own, there, value = own[real], there[real].astype(np.int64), value[real]
    # both directions, each link once
    a, b = np.append(own, there), np.append(there, own)
    _, first = np.unique(a * count + b, return_index=True)
    a, b, value = a[first], b[first], np.append(value, value)[first]
    order = np.lexsort((b, -value, a))
    a, b = a[order], b[order]
    place = np.arange(len(a)) - np.searchsorted(a, a, side="left")
    links = np.full((count, 2 * degree), -1, np.int32)
    fits = place < 2 * degree
    links[a[fits], place[fits]] = b[fits]
    return links


def build(rows: pd.DataFrame, graph: Graph, copies: int) -> bytes:
    """The index of a shard: distinct vectors, the rows of each, and a graph per layer.

    Of the rows with one vector the `copies` smallest ids are enough for any answer."""
    found = matrix(rows)
    vectors, group = np.unique(found["vector"], axis=0, return_inverse=True)
    group = group.ravel()
    order = np.lexsort((found["row"], found["id"], group))
    ordered = group[order]
    place = np.arange(len(order)) - np.searchsorted(ordered, ordered, side="left")
    order = order[place < copies]
    unit = (vectors / np.linalg.norm(vectors / np.abs(vectors).max(axis=1, keepdims=True), axis=1, keepdims=True))
    unit = unit / np.abs(vectors).max(axis=1, keepdims=True)
    unit = unit.astype(np.float32)
    chosen = np.random.default_rng(len(vectors)).permutation(len(vectors)).astype(np.int32)
    layers: dict[str, np.ndarray] = {"links0": layer(unit, graph.degree)}
    size, number = len(vectors) // graph.thin, 1
    while size >= 2:
        members = np.sort(chosen[:size])
        layers[f"members{number}"] = members
        inside = layer(unit[members], graph.degree)
        layers[f"links{number}"] = np.where(inside >= 0, members[np.maximum(inside, 0)], -1)
        size, number = size // graph.thin, number + 1
    starts = np.searchsorted(group[order], np.arange(len(vectors) + 1))
    return packed(
        vector=vectors,
        unit=unit,
        row=found["row"][order],
        id=found["id"][order],
        starts=starts,
        entry=chosen[:1],
        **layers,
    )


def _step(index: dict, links: np.ndarray, at: np.ndarray, unit: np.ndarray):
    """Neighbours of each query's place and their cosines."""
    near = links[at]
    cosine = np.einsum("qd,qkd->qk", unit, index["unit"][np.maximum(near, 0)])
    cosine[near < 0] = -np.inf
    return near, cosine


def walk(index: dict, unit: np.ndarray, beam: int) -> np.ndarray:
    """For each query the numbers of the vectors in its beam, -1 where there are fewer."""
    queries, count = len(unit), len(index["unit"])
    at = np.repeat(index["entry"], queries)
    best = np.einsum("qd,qd->q", unit, index["unit"][at])
    top = sum(name.startswith("members") for name in index)
    for level in range(top, 0, -1):
        members, links = index[f"members{level}"], index[f"links{level}"]
        moving = np.arange(queries)
        while len(moving):
            place = np.minimum(np.searchsorted(members, at[moving]), len(members) - 1)
            inside = members[place] == at[moving]
            near, cosine = _step(index, links, place, unit[moving])
            cosine[~inside] = -np.inf
            choice = cosine.argmax(axis=1)
            value = cosine[np.arange(len(moving)), choice]
            better = value > best[moving]
            rows = moving[better]
            at[rows] = near[np.arange(len(moving)), choice][better]
            best[rows] = value[better]
            moving = rows
    beam = min(beam, count)
    found = np.full((queries, beam), -1, np.int64)
    score = np.full((queries, beam), -np.inf, np.float32)
    opened = np.ones((queries, beam), bool)
    seen = np.zeros((queries, count), bool)
    found[:, 0], score[:, 0], opened[:, 0] = at, best, False
    seen[np.arange(queries), at] = True
    active = np.arange(queries)
    while len(active):
        waiting = np.where(opened[active], -np.inf, score[active])
        choice = waiting.argmax(axis=1)
        going = waiting[np.arange(len(active)), choice] > -np.inf
        active, choice = active[going], choice[going]
        if not len(active):
            break
        opened[active, choice] = True
        near, cosine = _step(index, index["links0"], found[active, choice], unit[active])
        known = np.take_along_axis(seen[active], np.maximum(near, 0).astype(np.int64), axis=1)
        cosine[known] = -np.inf
        rows = np.repeat(active, near.shape[1])
        real = near.ravel() >= 0
        seen[rows[real], near.ravel()[real]] = True
        new = cosine > -np.inf
        all_score = np.concatenate([score[active], cosine], axis=1)
        all_found = np.concatenate([found[active], np.where(new, near, -1)], axis=1)
        all_opened = np.concatenate([opened[active], ~new], axis=1)
        order = np.argpartition(-all_score, beam - 1, axis=1)[:, :beam]
        score[active] = np.take_along_axis(all_score, order, axis=1)
        found[active] = np.take_along_axis(all_found, order, axis=1)
        opened[active] = np.take_along_axis(all_opened, order, axis=1)
    return found


def cosines(one: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Cosine in double precision, row by row, whatever the size of the numbers: rows are scaled by
    powers of two, which changes no digit."""
    one, other = (
        np.ldexp(v, -np.frexp(np.abs(v).max(axis=1, keepdims=True))[1]) for v in (one, other)
    )
    return (one * other).sum(axis=1) / (
        np.sqrt((one * one).sum(axis=1)) * np.sqrt((other * other).sum(axis=1))
    )


def _search(k: int, beam: int):
    def work(index: dict, queries: dict) -> Iterator[pd.DataFrame]:
        vectors = queries["vector"]
        scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
        unit = (scaled / np.linalg.norm(scaled, axis=1, keepdims=True)).astype(np.float32)
        for start in range(0, len(unit), 256):
            found = walk(index, unit[start : start + 256], beam)
            query, place = np.nonzero(found >= 0)
            number = found[query, place]
            query = query + start
            score = cosines(vectors[query], index["vector"][number])
            # every row of a vector that was found
            size = index["starts"][number + 1] - index["starts"][number]
            first = np.cumsum(size) - size
            row = np.repeat(index["starts"][number] - first, size) + np.arange(size.sum())
            query, score = np.repeat(query, size), np.repeat(score, size)
            other = index["row"][row] != queries["row"][query]
            query, score, row = query[other], score[other], row[other]
            order = np.lexsort((index["id"][row], -score, query))
            query, score, row = query[order], score[order], row[order]
            best = np.arange(len(query)) - np.searchsorted(query, query, side="left") < k
            yield pd.DataFrame(
                {
                    "query_row": queries["row"][query[best]],
                    "query_id": queries["id"][query[best]],
                    "vec_id": index["id"][row[best]],
                    "score": score[best],
                }
            )

    return work


def nearest(
    rows: DataFrame,
    is_query,
    *,
    key: str = "vec_id",
    vector: str = "embedding",
    k: int = 5,
    graph: Graph | None = None,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found of each row that is_query (on `id`)
    selects, its own row left out, ties to the smaller id.

    Vectors that are null, empty, zero, or hold a null or a number that is not finite take no part;
    shorter ones count as filled up with zeros to the longest. Rows
    that share a vector or an id are rows of their own. The graph is approximate: its recall is
    measured against brute force; scores are exact. Rows with a null id are left out.
    """
    graph = graph or Graph()
    vectors = usable(rows.where(F.col(key).isNotNull()), key, vector, zero=False)
    index = blocks(vectors, graph.shard, lambda part: build(part, graph, k + 1))
    asked = blocks(vectors.where(is_query), graph.queries, lambda part: packed(**matrix(part)))
    schema = "query_row long, query_id long, vec_id long, score double"
    found = meet(index, asked, _search(k, graph.beam), schema)
    order = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
