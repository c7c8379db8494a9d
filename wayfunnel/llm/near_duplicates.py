"""Near-duplicate documents: SimHash fingerprints, links within a Hamming distance, components.

Exact copies share a fingerprint and collapse before any pair is looked at. Two fingerprints within
the distance agree on all but `distance` of their blocks, so they share at least one choice of
`blocks - distance` blocks; each choice deals fingerprints into groups. In a group they are sorted
by Gray rank and cut into chunks of bounded size. The hierarchical index finds the links inside a
chunk and between those chunks that their shared bits do not rule out.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wayfunnel.llm.common import fresh, map_texts, written
from wayfunnel.llm.gray_index import Forest


def fingerprint(text: str | None, words: int, seed: int) -> int:
    """Signed 64-bit SimHash of the word shingles, repeats included; 0 without a word."""
    tokens = (text or "").encode().lower().split()
    if not tokens:
        return 0
    width = min(words, len(tokens))
    joined = b" ".join(tokens)
    ends = np.cumsum([len(t) + 1 for t in tokens])
    starts = np.concatenate(([0], ends[:-1])).tolist()
    digest = xxhash.xxh64_digest
    shingles = zip(starts, (ends[width - 1 :] - 1).tolist(), strict=False)
    hashes = np.frombuffer(b"".join([digest(joined[a:b], seed) for a, b in shingles]), np.uint8)
    count = np.zeros(64, np.int64)
    for start in range(0, len(hashes), 1 << 20):
        count += np.unpackbits(hashes[start : start + (1 << 20)]).reshape(-1, 64).sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * count > len(hashes) // 8)
    return int(bits.view(">i8")[0])


def fingerprints(
    documents: DataFrame,
    *,
    text: str = "text",
    carry: list[str],
    name: str = "fingerprint",
    words: int = 4,
    seed: int = 42,
) -> DataFrame:
    """The carried columns and the fingerprint of each whole text."""

    def work(texts: list[str | None]) -> list[pa.Array]:
        return [pa.array([fingerprint(t, words, seed) for t in texts], pa.int64())]

    return map_texts(documents, text, carry, f"`{name}` long", work)


def block_masks(blocks: int, distance: int) -> list[int]:
    """Signed masks, one for each choice of blocks of which one must agree."""
    edges = [round(i * 64 / blocks) for i in range(blocks + 1)]
    bits = [(1 << edges[i + 1]) - (1 << edges[i]) for i in range(blocks)]
    masks = [sum(choice) for choice in combinations(bits, blocks - distance)]
    return [mask - (1 << 64) if mask >= 1 << 63 else mask for mask in masks]


def gray_rank(code: Column) -> Column:
    """Position of a bit pattern in the Gray code (as a signed number)."""
    for shift in (1, 2, 4, 8, 16, 32):
        code = code.bitwiseXOR(F.shiftrightunsigned(code, shift))
    return code


def _search(distance: int):
    """From rows (members, others): links within members, or between both where others is set."""

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [batch.column(0), batch.column(1)]
            sizes = [np.diff(part.offsets.to_numpy()) for part in parts]
            both = sizes[1] > 0
            values = [part.flatten().to_numpy(zero_copy_only=False).view(np.uint64) for part in parts]
            # trees 0.. are the members, those after them the others
            group = np.concatenate(
                [
                    np.repeat(np.arange(len(sizes[0])), sizes[0]),
                    len(sizes[0]) + np.repeat(np.arange(len(sizes[1])), sizes[1]),
                ]
            )
            members = np.concatenate(values)
            forest = Forest(members, group)
            first = np.arange(len(sizes[0]))
            second = first.copy()
            second[both] = len(sizes[0]) + np.arange(both.sum())
            left, right = forest.links((first, second), distance)
            yield pa.RecordBatch.from_arrays(
                [pa.array(members[left].view(np.int64)), pa.array(members[right].view(np.int64))],
                ["a", "b"],
            )

    return found


def links(
    distinct: DataFrame, *, distance: int = 4, blocks: int = 6, chunk: int = 1024
) -> DataFrame:
    """(a, b): links that connect whatever lies within the distance, from distinct fingerprints.

    chunk bounds what one task holds of a group; a larger group is compared chunk by chunk.
    """
    keys = F.array(
        *[
            F.struct(F.lit(i).alias("choice"), F.col("fingerprint").bitwiseAND(mask).alias("bits"))
            for i, mask in enumerate(block_masks(blocks, distance))
        ]
    )
    dealt = distinct.select("fingerprint", F.explode(keys).alias("key")).select(
        "fingerprint", "key.*"
    )
    place = Window.partitionBy("choice", "bits").orderBy(gray_rank(F.col("fingerprint")))
    chunks = (
        dealt.withColumn("chunk", F.floor((F.row_number().over(place) - 1) / chunk))
        .groupBy("choice", "bits", "chunk")
        .agg(
            F.sort_array(
                F.collect_list(
                    F.struct(gray_rank(F.col("fingerprint")).alias("rank"), "fingerprint")
                )
            )["fingerprint"].alias("members"),
            F.bit_and("fingerprint").alias("all_set"),
            F.bit_or("fingerprint").alias("any_set"),
        )
        .where((F.size("members") > 1) | (F.col("chunk") > 0))
    )
    chunks = written(chunks, "chunks")
    none = F.array().cast("array<bigint>").alias("others")
    inside = chunks.where(F.size("members") > 1).select("members", none)
    found = inside.mapInArrow(_search(distance), "a long, b long")

    # groups of more than one chunk: every chunk of such a group but the first has a number
    several = chunks.where(F.col("chunk") > 0).select("choice", "bits").distinct()
    parts = chunks.join(several, ["choice", "bits"], "left_semi")
    thin = parts.select("choice", "bits", "chunk", "all_set", "any_set")
    other = thin.select(
        "choice",
        "bits",
        F.col("chunk").alias("chunk_b"),
        F.col("all_set").alias("all_b"),
        F.col("any_set").alias("any_b"),
    )
    varied = F.col("all_set").bitwiseXOR(F.col("any_set"))
    varied = varied.bitwiseOR(F.col("all_b").bitwiseXOR(F.col("any_b")))
    differing = F.col("all_set").bitwiseXOR(F.col("all_b")).bitwiseAND(F.bitwise_not(varied))
    close = thin.join(other, ["choice", "bits"]).where(
        (F.col("chunk") < F.col("chunk_b")) & (F.bit_count(differing) <= distance)
    )
    members_b = parts.select(
        "choice", "bits", F.col("chunk").alias("chunk_b"), F.col("members").alias("others")
    )
    across = (
        close.select("choice", "bits", "chunk", "chunk_b")
        .join(parts.select("choice", "bits", "chunk", "members"), ["choice", "bits", "chunk"])
        .join(members_b, ["choice", "bits", "chunk_b"])
        .select("members", "others")
        .mapInArrow(_search(distance), "a long, b long")
    )
    return found.unionByName(across).distinct()


def connected(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, root): the smallest node of the component of each node with an edge (a, b).

    Alternates large and small stars until the edges stay the same; each round is written.
    """
    pairs = written(
        edges.where("a <> b")
        .select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("u"))
        .distinct(),
        "edges",
    )
    before = None
    for _ in range(most_rounds):
        state = pairs.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before or state[0] == 0:
            roots = pairs.select(F.col("u").alias("node"), F.col("u").alias("root"))
            members = pairs.select(F.col("v").alias("node"), F.col("u").alias("root"))
            return members.unionByName(roots.distinct())
        before = state
        # large star: larger neighbours go to the smallest neighbour
        around = pairs.unionByName(pairs.select(F.col("u").alias("v"), F.col("v").alias("u")))
        least = around.groupBy(F.col("v").alias("centre")).agg(F.min("u").alias("m"))
        large = (
            around.join(least, around["v"] == least["centre"])
            .where("u > v")
            .select(F.col("u").alias("v"), F.least("m", F.col("centre")).alias("u"))
            .distinct()
        )
        large = written(large, "large_star")
        # small star: smaller neighbours and the centre go to the smallest neighbour
        least = large.groupBy(F.col("v").alias("centre")).agg(F.min("u").alias("m"))
        joined = large.join(least, large["v"] == least["centre"])
        small = joined.where("u <> m").select(F.col("u").alias("v"), F.col("m").alias("u"))
        centres = least.select(F.col("centre").alias("v"), F.col("m").alias("u"))
        pairs = written(small.unionByName(centres).distinct(), "small_star")
    raise RuntimeError(f"components did not settle in {most_rounds} rounds")


def group(
    marked: DataFrame, *, key: str = "doc_id", name: str = "fingerprint", distance: int = 4, **index
) -> DataFrame:
    """The rows with their component, named by a fingerprint in it, and component_id: the smallest
    key of the component, null if it has none."""
    nodes = written(
        marked.groupBy(F.col(name).alias("fingerprint")).agg(F.min(key).alias("smallest")), "nodes"
    )
    roots = connected(links(nodes.select("fingerprint"), distance=distance, **index))
    placed = nodes.join(roots, nodes["fingerprint"] == roots["node"], "left").select(
        "fingerprint", "smallest", F.coalesce("root", "fingerprint").alias("root")
    )
    placed = written(placed, "placed")
    least = placed.groupBy("root").agg(F.min("smallest").alias("component_id"))
    classes = placed.join(least, "root").select(
        F.col("fingerprint").alias("_f"), F.col("root").alias("component"), "component_id"
    )
    return marked.join(classes, marked[name] == F.col("_f")).drop("_f")


def find_near_duplicates(
    documents: DataFrame, *, key: str = "doc_id", text: str = "text", words: int = 4, **index
) -> DataFrame:
    """One row per document: key, fingerprint (16 lower-case hex digits), component_id.

    Null and empty texts have fingerprint zero and are linked like any other; repeated rows stay
    and share a component; a null key never becomes a component_id unless all keys are null.
    """
    marked = written(fingerprints(documents, text=text, carry=[key], words=words), "fingerprints")
    digits = F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint")
    return group(marked, key=key, **index).select(key, digits, "component_id")


def keep_one(
    documents: DataFrame, *, key: str = "doc_id", text: str = "text", words: int = 5, **index
) -> DataFrame:
    """One document, all its columns, of each component: the first written of those with the
    smallest key.

    Documents are written once with a row number, so that repeated rows are told apart.
    """
    columns = documents.columns
    name, row = fresh("fingerprint", columns), fresh("row", columns)
    chosen = fresh("_kept", columns)
    marked = fingerprints(documents, text=text, carry=columns, name=name, words=words)
    marked = written(marked.withColumn(row, F.monotonically_increasing_id()), "marked")
    thin = marked.select(F.col(key).alias("key"), F.col(name).alias("f"), F.col(row).alias("row"))
    grouped = group(thin, key="key", name="f", **index)
    kept = (
        grouped.where(F.col("key").eqNullSafe(F.col("component_id")))
        .groupBy("component")
        .agg(F.min("row").alias(chosen))
        .select(chosen)
    )
    names = [F.col(f"`{column}`") for column in columns]
    return marked.join(kept, marked[row] == F.col(chosen), "left_semi").select(*names)
