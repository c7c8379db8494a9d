"""Merkle manifest of a dataset: a digest per row, a root per group and one over all groups, and a
witness per row that proves it belongs to the root.

Rows of a group are leaves in key order. While a tree has several nodes, every `ARITY` consecutive
ones become their hash; the last run may be shorter, even one. Trees are cut into aligned blocks of
ARITY ** LEVELS nodes. A task appends the nodes of a block from left to right: a subtree stays open
until its run is complete, holds the witnesses of what lies beneath it so far, and each completion
extends them by the siblings of the run. The roots of blocks are appended in turn to the next
round's blocks, as are the groups' roots to the tree over all groups, until one node is left; what
these later completions add to a witness is the same for all of a block, and goes down to it once.
"""

from __future__ import annotations

from hashlib import sha256

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from wayfunnel.llm.common import fresh, numbered, written

ARITY = 16
LEVELS = 2  # of a block
BLOCK = ARITY**LEVELS

WITNESS = "array<struct<place: int, siblings: string>>"
_NODE = "tree string, position long, held long, digest string"


def field(value: Column) -> Column:
    """A value as it enters a leaf: UTF-8 byte count, colon, value; a hyphen for null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(*values: Column) -> Column:
    """Lower-case hexadecimal SHA-256 over the fields."""
    return F.sha2(F.concat(*[field(v) for v in values]), 256)


def _hash(parts: str) -> str:
    return sha256(parts.encode()).hexdigest()


class OpenTree:
    """A tree that grows by appends from the left, `levels` above its leaves.

    Open runs hold (digest, leaves beneath). `witness[i]` are the (place, siblings) steps of leaf i
    so far; a completed run adds one step to every leaf beneath it.
    """

    def __init__(self, levels: int, witnesses: bool = True):
        self.open: list[list[tuple[str, range]]] = [[] for _ in range(levels + 1)]
        self.witness: list[list[tuple[int, str]]] = []
        self.witnesses, self.leaves = witnesses, 0

    def append(self, digest: str) -> None:
        if self.witnesses:
            self.witness.append([])
        self._add(0, digest, range(self.leaves, self.leaves + 1))
        self.leaves += 1

    def _add(self, level: int, digest: str, beneath: range) -> None:
        run = self.open[level]
        run.append((digest, beneath))
        if len(run) == ARITY and level < len(self.open) - 1:
            self._complete(level)

    def _complete(self, level: int) -> None:
        run, self.open[level] = self.open[level], []
        joined = "".join([digest for digest, _ in run])
        if self.witnesses:
            for place, (digest, beneath) in enumerate(run):
                step = (place, joined[: place * len(digest)] + joined[(place + 1) * len(digest) :])
                for leaf in beneath:
                    self.witness[leaf].append(step)
        self._add(level + 1, _hash(joined), range(run[0][1].start, run[-1][1].stop))

    def close(self) -> str:
        """Completes the last runs; the root."""
        for level in range(len(self.open) - 1):
            if self.open[level]:
                self._complete(level)
        return self.open[-1][0][0]


def _levels(held: int) -> int:
    """Levels of a block in a tree of so many nodes: all above it where it is the only block."""
    levels = 0
    while levels < LEVELS and held > 1:
        held, levels = -(-held // ARITY), levels + 1
    return levels


def _grown(block: pa.Table, witnesses: bool) -> tuple[OpenTree, str]:
    tree = OpenTree(_levels(block.column("held")[0].as_py()), witnesses)
    for digest in block.column("digest").to_pylist():
        tree.append(digest)
    return tree, tree.close()


def _block(position: str = "position") -> Column:
    return F.floor(F.col(position) / BLOCK).cast("long").alias("block")


def _climb(nodes: DataFrame, most: int, name: str) -> tuple[list[DataFrame], DataFrame]:
    """The nodes (tree, position, held, digest) of every round, and (tree, digest) of each root."""

    def roots(key: tuple, block: pa.Table) -> pa.Table:
        order = pc.sort_indices(block, [("position", "ascending")])
        _, root = _grown(block.take(order), witnesses=False)
        held = -(-block.column("held")[0].as_py() // BLOCK)
        row = {"tree": [key[0].as_py()], "position": [key[1].as_py()], "held": [held], "digest": [root]}
        return pa.table(row, schema=_arrow(_NODE))

    rounds = [nodes]
    while True:
        blocks = nodes.select("tree", "position", "held", "digest").groupBy("tree", _block())
        nodes = written(blocks.applyInArrow(roots, _NODE), f"{name}-{len(rounds)}")
        if most <= BLOCK:
            return rounds, nodes.select("tree", "digest")
        rounds.append(nodes)
        most = -(-most // BLOCK)


def _arrow(schema: str) -> pa.Schema:
    kinds = {"string": pa.string(), "long": pa.int64()}
    return pa.schema([(n, kinds[k]) for n, k in (part.split() for part in schema.split(", "))])


_STEP = pa.struct([("place", pa.int32()), ("siblings", pa.string())])


def _descend(nodes: DataFrame, above: DataFrame) -> DataFrame:
    """The nodes with their witness up to the root, and what else the rows of `above` carry.

    above has a row (tree, block, witness, ...) for the root of each block.
    """
    own = [c for c in nodes.columns if c not in ("tree", "position", "held", "digest")]
    crown = [c for c in above.columns if c not in ("tree", "block", "witness")]
    base = nodes.select("tree", "position", "held", "digest", *[f"`{c}`" for c in own])
    names = base.columns
    schema = StructType(base.schema.fields + above.select(*crown).schema.fields)
    schema = StructType(schema.fields + StructType.fromDDL(f"witness {WITNESS}").fields)

    def extended(block: pa.Table, upper: pa.Table) -> pa.Table:
        order = pc.sort_indices(block, [("position", "ascending")])
        block = block.take(order)
        tree, _ = _grown(block, witnesses=True)
        top = [(s["place"], s["siblings"]) for s in upper.column("witness")[0].as_py()]
        steps = [step for witness in tree.witness for step in (*witness, *top)]
        ends = [0]
        for witness in tree.witness:
            ends.append(ends[-1] + len(witness) + len(top))
        flat = pa.StructArray.from_arrays(
            [pa.array([s[0] for s in steps], pa.int32()), pa.array([s[1] for s in steps], pa.string())],
            fields=list(_STEP),
        )
        lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), flat)
        repeated = pa.array([0] * block.num_rows, pa.int64())
        shared = [upper.column(c).take(repeated) for c in crown]
        columns = [*[block.column(c) for c in names], *shared, lists]
        return pa.table(columns, names=[*names, *crown, "witness"])

    # the block number goes beside the rows under a name of its own
    number = fresh("block", base.columns)
    grouped = base.withColumn(number, _block()).groupBy("tree", number)
    return grouped.cogroup(above.groupBy("tree", "block")).applyInArrow(extended, schema)


def _witnessed(rounds: list[DataFrame], above: DataFrame, name: str) -> DataFrame:
    """The lowest round's nodes with their witnesses; above has those of the roots of the trees."""
    for number, nodes in reversed(list(enumerate(rounds))):
        found = _descend(nodes, above)
        if not number:
            return found
        crown = [c for c in above.columns if c not in ("tree", "block", "witness")]
        above = written(
            found.select("tree", F.col("position").alias("block"), "witness", *crown),
            f"{name}-down-{number}",
        )
    raise ValueError("a tree has at least one round")


def manifest(
    rows: DataFrame, leaf: Column, *, key: str, group: str, carry: dict[str, Column] | None = None
) -> DataFrame:
    """One row per row: key, group, the carried columns, leaf, subroot (of its group), root and
    witness (array of place and joined siblings, from the leaf's run up to the root's).

    Within a group leaves ascend by key, null keys first, rows of one key by leaf; groups ascend by
    the bytes of their UTF-8 text, the null group first. A group of one row has that leaf as
    subroot, and a single group's subroot is the root. Repeated rows are leaves of their own. Other
    columns are neither read nor returned, so none can clash. No rows give no rows.
    """
    carried = carry or {}
    leaves = rows.select(
        F.when(F.col(f"`{group}`").isNull(), "")
        .otherwise(F.concat(F.lit("+"), F.col(f"`{group}`").cast("string")))
        .alias("tree"),
        F.col(f"`{key}`").alias("key"),
        F.col(f"`{group}`").alias("group"),
        leaf.alias("digest"),
        *[column.alias(f"carried_{name}") for name, column in carried.items()],
    )
    nodes = numbered(written(leaves, "leaves"), "tree", ["key", "digest"], "laid-leaves")
    most = nodes.agg(F.max("held")).first()[0] or 0
    rounds, subroots = _climb(nodes, most, "nodes")

    tops = subroots.select(F.col("tree").alias("name"), F.lit("").alias("tree"), "digest")
    tops = numbered(tops, "tree", ["name"], "laid-subroots")
    groups = tops.agg(F.max("held")).first()[0] or 0
    top_rounds, root = _climb(tops, groups, "top-nodes")
    none = F.array().cast(WITNESS).alias("witness")
    crown = root.select("tree", F.lit(0).cast("long").alias("block"), none, F.col("digest").alias("root"))
    above = _witnessed(top_rounds, crown, "tops").select(
        F.col("name").alias("tree"),
        F.lit(0).cast("long").alias("block"),
        "witness",
        F.col("digest").alias("subroot"),
        "root",
    )
    found = _witnessed(rounds, written(above, "subroots"), "nodes")
    return found.select(
        F.col("key").alias(key),
        F.col("group").alias(group),
        *[F.col(f"carried_{name}").alias(name) for name in carried],
        F.col("digest").alias("leaf"),
        "subroot",
        "root",
        "witness",
    )


def folded(leaf: Column, witness: Column) -> Column:
    """The root that a leaf's digest and its witness lead to."""

    def up(below: Column, step: Column) -> Column:
        at = step["place"] * 64
        left, right = F.substr(step["siblings"], F.lit(1), at), F.substr(step["siblings"], at + 1)
        return F.sha2(F.concat(left, below, right), 256)

    return F.aggregate(witness, leaf, up)


def proof_digest(witness: Column) -> Column:
    """SHA-256 over all siblings, from the leaf's run to the root's, left to right."""
    return F.sha2(F.array_join(F.transform(witness, lambda step: step["siblings"]), ""), 256)
