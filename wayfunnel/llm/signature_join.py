"""Near-duplicate documents by MinHash: an inverted join over the coordinates of signatures.

Documents of equal shingle sets are one class. The signature of a class has `COORDINATES` minima;
two sets of Jaccard similarity s agree in each with probability s. Every class is posted under its
(coordinate, value) pairs, and classes that collide in at least `MATCHES` of them are compared on
their whole sets. At the least similarity of 0.8 a pair misses that threshold with probability 3e-7.

Two classes with that many matches share a value among the COORDINATES - MATCHES + 1 rarest of
each, in the order of how many classes hold a value: only this prefix is posted, and values of one
class, which nothing collides with, only count towards it. Classes that share fewer than MATCHES
values with anyone are skipped altogether. Collisions are then counted list by list. Long lists are
mostly copies of one another, so each list is first merged around a pivot, round after round; what
is one component by then is skipped, and the classes left in a list are compared chunk by chunk
where they belong to different components and their sizes allow it. There the whole sets travel with
the chunks, so that only links come out. Every pair that shares a list is either in one component or
compared, so no link between components is lost.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayfunnel.llm.common import map_texts, numbered, written
from wayfunnel.llm.components import components

COORDINATES, MATCHES = 64, 34
LEAST = 80  # per cent of the union that two sets share
CHUNK = 1024
FILTER_BITS = 1 << 24  # at most 262,144 words of 64 bits are broadcast
_KEPT_WORDS = 1_000_000


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_ODD = _mix(np.arange(1, 2 * COORDINATES + 1).astype(np.uint64)) | np.uint64(1)
_FACTORS, _ADDED = _ODD[:COORDINATES, None], _ODD[COORDINATES:, None]


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= _KEPT_WORDS:
            self.clear()
        found = self[word] = xxhash.xxh64_intdigest(word)
        return found


def shingles(text: str | None, width: int, hashes: dict[bytes, int] | None = None) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct shingles of a text in lower case (A-Z)."""
    words = (text or "").encode().lower().split()
    hashes = _WordHashes() if hashes is None else hashes
    one = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    if not len(one):
        return one
    many = min(width, len(one))
    n = len(one) - many + 1
    joined = np.full(n, many, np.uint64)
    for i in range(many):
        joined = _mix(joined * np.uint64(0x9E3779B97F4A7C15) + one[i : i + n])
    return np.unique(joined)


def signature(members: np.ndarray, at_once: int = 1 << 14) -> np.ndarray:
    """The least 32-bit hash of the members under each coordinate's hash function."""
    least = np.full(COORDINATES, 0xFFFFFFFF, np.uint32)
    for start in range(0, len(members), at_once):
        hashed = members[None, start : start + at_once] * _FACTORS + _ADDED
        least = np.minimum(least, (hashed >> np.uint64(32)).min(axis=1).astype(np.uint32))
    return least


def _sets(documents: DataFrame, text: str, key: str, width: int, added: list[str]) -> DataFrame:
    """key, n_shingles and of `added`: set_id (null where the set is empty), signature, members."""
    kinds = {"members": ("array<long>", pa.list_(pa.int64()))}

    def work(texts: list[str | None]) -> list[pa.Array]:
        hashes = _WordHashes()
        sets = [shingles(t, width, hashes) for t in texts]
        made = {
            "set_id": lambda m: xxhash.xxh3_128_digest(m.tobytes()) if len(m) else None,
            "signature": lambda m: signature(m).tobytes() if len(m) else None,
            "members": lambda m: m.view(np.int64),
        }
        columns = [
            pa.array([made[name](m) for m in sets], kinds.get(name, ("", pa.binary()))[1])
            for name in added
        ]
        return [pa.array([len(m) for m in sets], pa.int64()), *columns]

    ddl = ["n_shingles long", *[f"{name} {kinds.get(name, ('binary',))[0]}" for name in added]]
    ddl = ", ".join(ddl)
    return map_texts(documents, text, [key], ddl, work)


def _prefixes(classes: DataFrame, matches: int) -> DataFrame:
    """(rep, size, token): the prefix of each class that shares enough values with others."""

    def posted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coordinate = np.arange(COORDINATES, dtype=np.int64) << 32
        for batch in batches:
            reps = batch.column(0).to_numpy()
            values = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint32)
            tokens = values.reshape(len(reps), COORDINATES).astype(np.int64) | coordinate
            columns = [pa.array(np.repeat(reps, COORDINATES)), pa.array(tokens.ravel())]
            yield pa.RecordBatch.from_arrays(columns, ["rep", "token"])

    posts = classes.select("rep", "signature").mapInArrow(posted, "rep long, token long")
    shared = posts.groupBy("token").agg(F.count("*").alias("held")).where("held > 1")
    held = F.sort_array(F.collect_list(F.struct("held", "token")))
    many = F.size("held")
    # values of one class only come first in the order, and need no list
    prefix = F.slice("held", F.lit(1), many - matches + 1)
    return (
        posts.join(written(shared, "shared"), "token")
        .groupBy("rep")
        .agg(held.alias("held"))
        .where(many >= matches)
        .select("rep", F.explode(prefix["token"]).alias("token"))
    )


def _sizes_allow(a: Column, b: Column, least: int) -> Column:
    return F.least(a, b) * 100 >= F.greatest(a, b) * least


def _matching(pairs: DataFrame, classes: DataFrame, matches: int) -> DataFrame:
    """The pairs (a, b) whose signatures agree in that many coordinates."""

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = (
                np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint32) for i in (2, 3)
            )
            same = (left == right).reshape(-1, COORDINATES).sum(axis=1) >= matches
            yield batch.select([0, 1]).filter(pa.array(same))

    left = classes.select(F.col("rep").alias("a"), F.col("signature").alias("left"))
    right = classes.select(F.col("rep").alias("b"), F.col("signature").alias("right"))
    both = pairs.join(left, "a").join(right, "b").select("a", "b", "left", "right")
    return both.mapInArrow(kept, "a long, b long")


def _whole_sets(
    documents: DataFrame, wanted: DataFrame, key: str, text: str, width: int
) -> DataFrame:
    """(rep, members) of the wanted classes (rep, set_id, smallest), from texts of smallest keys.

    A bit map of the wanted keys' hashes, whose size is FILTER_BITS whatever is wanted, goes to all
    tasks and keeps other texts out of the shuffle; which sets are the wanted ones their ids decide.
    """
    slot = F.xxhash64("key").bitwiseAND(F.lit(FILTER_BITS - 1))
    word, bit = F.shiftright("slot", 6), F.expr("shiftleft(1L, cast(slot & 63 as int))")
    asked = wanted.select(F.col("smallest").alias("key")).withColumn("slot", slot)
    bits = asked.groupBy(word.alias("word")).agg(F.bit_or(bit).alias("bits"))
    chosen = documents.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"))
    chosen = chosen.withColumn("slot", slot).withColumn("word", word)
    chosen = chosen.join(F.broadcast(bits), "word").where(F.col("bits").bitwiseAND(bit) != 0)
    sets = _sets(chosen, "text", "key", width, ["set_id", "members"])
    found = sets.join(wanted.select("set_id", "rep"), "set_id")
    # several texts have the set, for example those without a key
    return written(found.groupBy("rep").agg(F.first("members").alias("members")), "sets")


def _confirmed(pairs: DataFrame, sets: DataFrame, least: int) -> DataFrame:
    """The pairs (a, b) whose whole sets are that similar."""
    left = sets.select(F.col("rep").alias("a"), F.col("members").alias("left"))
    right = sets.select(F.col("rep").alias("b"), F.col("members").alias("right"))
    common = F.size(F.array_intersect("left", "right"))
    union = F.size("left") + F.size("right") - F.col("common")
    both = pairs.join(left, "a").join(right, "b").withColumn("common", common)
    return both.where(100 * F.col("common") >= least * union).select("a", "b")


def _pair(x: Column, y: Column) -> list[Column]:
    return [F.least(x, y).alias("a"), F.greatest(x, y).alias("b")]


def _around_pivots(postings: DataFrame, number: int, least: int) -> DataFrame:
    """Pairs of each list's pivot with its members of other components."""
    order = F.col("rep") if number == 0 else F.xxhash64("rep", F.lit(number))
    own = F.struct(order.alias("order"), "rep", "size", "label")
    pivots = postings.groupBy("token").agg(
        F.min(own).alias("pivot"), F.min("label").alias("low"), F.max("label").alias("high")
    )
    pivots = written(pivots.where("low <> high").select("token", "pivot"), "pivots")
    pivot = F.col("pivot")
    return (
        postings.join(pivots, "token")
        .where(F.col("label") != pivot["label"])
        .where(_sizes_allow(F.col("size"), pivot["size"], least))
        .select(*_pair(F.col("rep"), pivot["rep"]))
        .distinct()
    )


class _Chunks:
    """The rows of two chunks of a list, or of one (all of side 0), and their candidate pairs."""

    def __init__(self, token: int, rows: pa.Table, matches: int, least: int):
        self.side, self.rep, self.size, self.label, mask = (
            rows.column(c).to_numpy() for c in ("side", "rep", "size", "label", "mask")
        )
        sig = np.frombuffer(b"".join(rows.column("signature").to_pylist()), np.uint32)
        self.sig = sig.reshape(-1, COORDINATES)
        bits = np.unpackbits(mask.astype("<i8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        self.owned = bits.astype(bool)
        self.coordinate, self.matches, self.least = token >> 32, matches, least

    def pairs(self) -> Iterator[tuple[int, np.ndarray]]:
        """Per row of the first side its partners: of another component, of a size and with matches
        that allow a link, and with no earlier coordinate whose list holds both."""
        inner = not self.side.any()
        to = np.arange(len(self.rep)) if inner else np.flatnonzero(self.side == 1)
        for i in np.flatnonzero(self.side == 0).tolist():
            j = to[to > i] if inner else to
            small, large = np.minimum(self.size[j], self.size[i]), np.maximum(self.size[j], self.size[i])
            j = j[(self.label[j] != self.label[i]) & (100 * small >= self.least * large)]
            same = self.sig[j] == self.sig[i]
            enough = same.sum(axis=1) >= self.matches
            j, same = j[enough], same[enough]
            if len(j):
                first = np.argmax(same & self.owned[j] & self.owned[i], axis=1)
                j = j[first == self.coordinate]
            if len(j):
                yield i, j


def _with_partners(matches: int, least: int):
    """The rows that have a candidate pair in these chunks."""

    def found(key: tuple, rows: pa.Table) -> pa.Table:
        chunks = _Chunks(key[0].as_py(), rows, matches, least)
        used = np.zeros(rows.num_rows, bool)
        for i, j in chunks.pairs():
            used[i] = used[j] = True
        return rows.filter(pa.array(used))

    return found


def _compare(matches: int, least: int):
    """The links between different components in these chunks, by whole sets; what a link has joined
    in this task is not compared again."""

    def compared(key: tuple, rows: pa.Table) -> pa.Table:
        chunks = _Chunks(key[0].as_py(), rows, matches, least)
        members = rows.column("members").combine_chunks()
        ends, flat = members.offsets.to_numpy(), members.values.to_numpy()
        root: dict[int, int] = {}

        def top(x: int) -> int:
            while root.get(x, x) != x:
                x = root[x]
            return x

        links = []
        for i, partners in chunks.pairs():
            for j in partners.tolist():
                a, b = top(int(chunks.label[i])), top(int(chunks.label[j]))
                if a == b:
                    continue
                x, y = flat[ends[i] : ends[i + 1]], flat[ends[j] : ends[j + 1]]
                common = len(np.intersect1d(x, y, assume_unique=True))
                if 100 * common >= least * (len(x) + len(y) - common):
                    root[max(a, b)] = min(a, b)
                    links.append((int(chunks.rep[i]), int(chunks.rep[j])))
        columns = [pa.array([link[n] for link in links], pa.int64()) for n in range(2)]
        return pa.table(columns, names=["a", "b"])

    return compared


def _left_over(
    postings: DataFrame,
    alive: DataFrame,
    fetch: Callable[[DataFrame], DataFrame],
    matches: int,
    least: int,
    chunk: int,
    shortest: int,
) -> DataFrame:
    """Links between components whose classes share a list of that many; fetch gives whole sets."""
    mixed = postings.groupBy("token").agg(
        F.min("label").alias("low"), F.max("label").alias("high"), F.count("*").alias("n")
    )
    mixed = written(mixed.where(f"low <> high AND n >= {shortest}").select("token"), "mixed")
    open_lists = written(postings.join(mixed, "token"), "open-lists")
    bit = F.expr("shiftleft(1L, cast(token >> 32 as int))")
    masks = postings.groupBy("rep").agg(F.bit_or(bit).alias("mask"))
    payload = alive.select("rep", "signature").join(masks, "rep")

    placed = numbered(open_lists, "token", ["label", "size", "rep"], "placed").drop("held")
    number = F.floor(F.col("position") / chunk).cast("long")
    placed = placed.withColumn("chunk", number).select("token", "chunk", "rep", "size", "label")
    spans = placed.groupBy("token", "chunk").agg(
        *[f(c).alias(f"{n}_{c}") for c in ("label", "size") for n, f in (("low", F.min), ("high", F.max))]
    )
    spans = written(spans, "spans")
    other = spans.select("token", *[F.col(c).alias(f"{c}_b") for c in spans.columns if c != "token"])
    close = (
        spans.join(other, "token")
        .where("chunk <= chunk_b AND (low_label <> high_label_b OR high_label <> low_label_b)")
        .where(f"100 * high_size >= {least} * low_size_b AND 100 * high_size_b >= {least} * low_size")
        .select("token", F.col("chunk").alias("first"), F.col("chunk_b").alias("second"))
    )
    first = close.select("*", F.lit(0).alias("side"), F.col("first").alias("chunk"))
    second = close.where("first < second").select(
        "*", F.lit(1).alias("side"), F.col("second").alias("chunk")
    )
    sent = placed.join(first.unionByName(second), ["token", "chunk"]).join(payload, "rep")
    group = ["token", "first", "second"]
    columns = [*group, "side", "rep", "size", "label", "mask", "signature"]
    sent = sent.select(*columns)
    # signatures first: whole sets are only sent where they are to be compared
    asked = sent.groupBy(*group).applyInArrow(_with_partners(matches, least), sent.schema)
    asked = written(asked, "asked")
    wanted = written(alive.join(asked.select("rep").distinct(), "rep", "left_semi"), "wanted")
    with_sets = asked.join(fetch(wanted), "rep").select(*columns, "members")
    return with_sets.groupBy(*group).applyInArrow(_compare(matches, least), "a long, b long")


def near_duplicates(
    documents: DataFrame,
    *,
    key: str = "doc_id",
    text: str = "text",
    width: int = 2,
    least: int = LEAST,
    matches: int = MATCHES,
    pivots: int = 8,
    chunk: int = CHUNK,
) -> DataFrame:
    """One row per document: key, n_shingles, component_id (the smallest key of its component).

    Documents are linked where their sets of distinct shingles of `width` words share `least` per
    cent of their union. Null and empty texts have no shingles and are linked with nothing: their
    own key is their component_id. Repeated rows stay and share a component. A null key never
    becomes a component_id unless all keys of the component are null. Other columns are neither
    read nor returned. At most so many rounds go around `pivots`, fewer once a round unites less
    than a hundredth of the components; any number of them finds the same links.
    """
    marked = _sets(documents, text, key, width, ["set_id", "signature"])
    marked = written(marked.withColumnRenamed(key, "key"), "marked")
    classes = (
        marked.where("n_shingles > 0")
        .groupBy("set_id")
        .agg(
            F.min("key").alias("smallest"),
            F.first("n_shingles").alias("size"),
            F.first("signature").alias("signature"),
        )
        .withColumn("rep", F.monotonically_increasing_id())
    )
    classes = written(classes, "classes")
    lists = written(_prefixes(classes, matches), "lists")
    alive = lists.select("rep").distinct()
    alive = written(classes.join(alive, "rep", "left_semi"), "alive")

    def fetch(wanted: DataFrame) -> DataFrame:
        return _whole_sets(documents, wanted, key, text, width)

    def links(pairs: DataFrame) -> DataFrame:
        pairs = written(_matching(pairs, alive, matches), "matching")
        named = pairs.select(F.explode(F.array("a", "b")).alias("rep")).distinct()
        wanted = written(alive.join(named, "rep", "left_semi"), "wanted")
        return _confirmed(pairs, fetch(wanted), least)

    lists = written(lists.join(alive.select("rep", "size"), "rep"), "postings")

    labels = alive.select("rep", F.col("rep").alias("label"))
    before = alive.count()
    for number in range(pivots):
        postings = written(lists.join(labels, "rep"), "labelled")
        pairs = written(_around_pivots(postings, number, least), "pivot-pairs")
        labels, united = _merged(labels, links(pairs))
        before -= united
        if united * 100 < before:
            break
    postings = written(lists.join(labels, "rep"), "labelled")
    shortest = 3 if pivots else 2  # a list of two has been compared with its pivot
    more = _left_over(postings, alive, fetch, matches, least, chunk, shortest)
    labels, _ = _merged(labels, more)

    placed = classes.join(labels, "rep", "left").select(
        "set_id", "smallest", F.coalesce("label", "rep").alias("root")
    )
    placed = written(placed, "placed")
    smallest = written(placed.groupBy("root").agg(F.min("smallest").alias("component_id")), "smallest")
    named = placed.join(smallest, "root").select("set_id", "component_id")
    whole = marked.join(named, "set_id", "left")
    empty = F.col("n_shingles") == 0
    return whole.select(
        F.col("key").alias(key),
        "n_shingles",
        F.when(empty, F.col("key")).otherwise(F.col("component_id")).alias("component_id"),
    )


def _merged(labels: DataFrame, links: DataFrame) -> tuple[DataFrame, int]:
    """The labels (rep, label) after these links, and how many components went into others.

    Only components that a link touches are merged; the links between them are the graph.
    """
    a, b = (labels.select(F.col("rep").alias(n), F.col("label").alias(f"of_{n}")) for n in "ab")
    between = links.join(a, "a").join(b, "b").where("of_a <> of_b")
    roots = written(
        components(between.select(F.col("of_a").alias("a"), F.col("of_b").alias("b"))), "roots"
    )
    joined = labels.join(roots, labels["label"] == roots["node"], "left")
    merged = joined.select("rep", F.coalesce("root", "label").alias("label"))
    return written(merged, "labels"), roots.where("node <> root").count()
