"""WARC archives: written as text files with a record to a line separator, and read back safely.

An archive is cut at every place where the record magic stands, wherever Spark splits the file.
Some of these places lie inside payloads. Each candidate points to where its header says that the
next record starts. Inside a split the pointers are contracted to the first place beyond it; over
the splits of a file, pointer jumping from the file's start finds which entries are reached. Only
records on the chain from the start are kept.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wayfunnel.llm.common import written

MAGIC = "WARC/1.0\r\n"
BLANK = "\r\n\r\n"
BASE32 = ("0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def payload_digest(payload: Column) -> Column:
    """Upper-case base32 SHA-1 of a string's UTF-8 bytes."""
    hexadecimal = F.sha1(payload.cast("binary"))
    groups = [
        F.lpad(F.conv(F.substring(hexadecimal, 1 + 5 * i, 5), 16, 32), 4, "0") for i in range(8)
    ]
    return F.translate(F.concat(*groups), *BASE32)


def _header(name: str, value: Column) -> Column:
    """A header line, or nothing where the value is null. Control characters are left out."""
    clean = F.regexp_replace(value, r"[\x00-\x1f\x7f]", "")
    return F.concat(F.lit(f"{name}: "), clean, F.lit("\r\n"))


def write_archives(
    pages: DataFrame,
    path: str,
    *,
    key: str = "page_id",
    url: str = "url",
    payload: str = "html",
    least_bytes: int = 0,
) -> None:
    """One record per page. Of equal payloads of at least least_bytes the one with the largest key
    is a response, the others are revisits of it, without a body.

    A null payload is empty. Rows that share the largest key are all responses, a null key is
    smaller than any other. Payloads do not shuffle unless the repeated ones are too many to
    broadcast by their measured size.
    """
    body = F.coalesce(F.col(payload).cast("string"), F.lit(""))
    named = pages.select(
        F.col(key).alias("id"),
        F.col(url).cast("string").alias("uri"),
        body.alias("body"),
        payload_digest(body).alias("digest"),
        F.octet_length(body).cast("long").alias("n"),
    )
    repeated = (
        named.where(F.col("n") >= least_bytes)
        .groupBy("digest", "n")
        .agg(F.max("id").alias("first"), F.count("*").alias("rows"))
        .where("rows > 1 AND first IS NOT NULL")
        .select(F.col("digest").alias("d"), F.col("n").alias("size"), "first")
    )
    repeated = written(repeated, "repeated")
    joined = named.join(
        repeated, (F.col("digest") == F.col("d")) & (F.col("n") == F.col("size")), "left"
    )
    revisit = F.col("first").isNotNull() & ~F.col("id").eqNullSafe(F.col("first"))
    identity = F.concat(F.lit("<urn:page:"), F.coalesce(F.col("id").cast("string"), F.lit("null")), F.lit(">"))
    refers = F.concat(F.lit("<urn:page:"), F.col("first").cast("string"), F.lit(">"))
    nothing = F.lit("")
    record = F.concat(
        F.lit(MAGIC),
        F.when(revisit, "WARC-Type: revisit\r\n").otherwise("WARC-Type: response\r\n"),
        _header("WARC-Record-ID", identity),
        F.coalesce(_header("WARC-Target-URI", F.col("uri")), nothing),
        F.when(revisit, _header("WARC-Refers-To", refers)).otherwise(nothing),
        _header("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        _header("WARC-Payload-Length", F.col("n").cast("string")),
        F.lit("Content-Type: text/html; charset=utf-8\r\n"),
        F.lit("Content-Length: "),
        F.when(revisit, "0").otherwise(F.col("n").cast("string")),
        F.lit(BLANK),
        F.when(revisit, nothing).otherwise(F.col("body")),
    )
    joined.select(record.alias("value")).write.option("lineSep", BLANK).text(path)


def _chunks(spark: SparkSession, path: str) -> DataFrame:
    """What stands between two magics, in order: file, split, order in it, value, and the header's
    fields. The first chunk of a file, before any magic, is empty in a sound archive."""
    read = spark.read.option("lineSep", MAGIC).text(path)
    chunks = read.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("seq"),
        "value",
    )
    return chunks.withColumn("header", F.substring_index("value", BLANK, 1))


def _field(name: str) -> Column:
    found = F.regexp_extract("header", rf"(?:^|\r\n){name}: ([^\r\n]*)", 1)
    return F.when(found != "", found)


def _page(value: Column) -> Column:
    return F.regexp_extract(value, r"^<urn:page:(-?\d+)>$", 1).try_cast("long")


def _fields() -> list[Column]:
    return [
        _field("WARC-Type").alias("record_type"),
        _page(_field("WARC-Record-ID")).alias("id"),
        _page(_field("WARC-Refers-To")).alias("refers_to"),
        F.regexp_replace(_field("WARC-Payload-Digest"), "^sha1:", "").alias("declared_digest"),
        _field("WARC-Payload-Length").try_cast("long").alias("declared_bytes"),
    ]


def _pointers(rows: pd.DataFrame) -> tuple[pd.DataFrame, np.ndarray]:
    """Candidates of a split in order, with start and successor relative to the split's first
    chunk, and the position of the successor among them (itself where it lies elsewhere)."""
    rows = rows.sort_values("seq", kind="stable")
    size = rows["size"].to_numpy(np.int64)
    start = np.cumsum(size + len(MAGIC)) - size - 2 * len(MAGIC)
    rows = rows.assign(start=start)[rows["content"].notna().to_numpy()]
    start = rows["start"].to_numpy(np.int64)
    body = rows["header_bytes"].to_numpy(np.int64) + rows["content"].to_numpy(np.int64)
    successor = start + len(MAGIC) + body + len(BLANK)
    place = np.minimum(np.searchsorted(start, successor), max(0, len(start) - 1))
    own = np.arange(len(start))
    following = np.where(start[place] == successor, place, own) if len(start) else own
    return rows.assign(successor=successor), following


def _contract(rows: pd.DataFrame) -> pd.DataFrame:
    """Where the chain from each candidate leaves the split."""
    found, following = _pointers(rows)
    while len(following) and not np.array_equal(twice := following[following], following):
        following = twice
    leaves = found["successor"].to_numpy(np.int64)[following]
    return found.assign(leaves=leaves)[["file", "split", "start", "leaves"]]


def _reached(rows: pd.DataFrame) -> pd.DataFrame:
    """Candidates on the chain from the split's entry."""
    found, following = _pointers(rows)
    on = (found["start"] == found["entry"]).to_numpy().copy()
    while True:
        on[following[on]] = True
        twice = following[following]
        if np.array_equal(twice, following):
            break
        following = twice
    return found[on][["file", "split", "seq", "start", "successor"]]


def _jump(entries: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(file, start) of entries reached from place 0 of their file, by doubling of the pointers
    (file, start, leaves). Each round is written."""
    reached = entries.where("start = 0").select("file", "start")
    jumps = entries
    for _ in range(most_rounds):
        step = jumps.join(reached, ["file", "start"]).select("file", F.col("leaves").alias("start"))
        known = entries.select("file", "start")
        more = reached.unionByName(step).distinct().join(known, ["file", "start"], "left_semi")
        more = written(more, "reached")
        onward = jumps.select("file", F.col("start").alias("leaves"), F.col("leaves").alias("end"))
        jumps = written(
            jumps.join(onward, ["file", "leaves"]).select("file", "start", F.col("end").alias("leaves")),
            "jumps",
        )
        reached = more
        if jumps.isEmpty():
            return reached
    raise RuntimeError(f"a file has more than 2 ** {most_rounds} splits")


def read_archives(spark: SparkSession, path: str, cell: int = 1 << 20) -> DataFrame:
    """One row per record on the chain from the start of its file: file, offset, id, record_type,
    refers_to, payload_bytes, payload_digest, declared_digest.

    Bytes and digest of responses are those of the body that was read, those of revisits the
    declared ones of the full payload. What follows a break in the chain is not reached.
    """
    head = F.octet_length("header") + len(BLANK)
    content = F.when(
        F.instr("value", BLANK) > 0,
        F.regexp_extract("header", r"(?:^|\r\n)Content-Length: (\d{1,15})(?:\r\n|$)", 1).try_cast("long"),
    )
    whole = F.col("size") == F.col("header_bytes") + F.col("content") + len(BLANK)
    # of a chunk that is a whole record
    body = F.substr(
        "value", F.length("header") + len(BLANK) + 1, F.length("value") - F.length("header") - 2 * len(BLANK)
    )
    chunks = _chunks(spark, path)
    thin = chunks.select(
        "file",
        "split",
        "seq",
        F.octet_length("value").cast("long").alias("size"),
        head.cast("long").alias("header_bytes"),
        content.alias("content"),
        *_fields(),
        body.alias("body"),
    )
    thin = thin.withColumn("digest", F.when(whole, payload_digest(F.col("body")))).drop("body")
    thin = written(thin.withColumn("whole", F.coalesce(whole, F.lit(False))), "chunks")

    sizes = thin.groupBy("file", "split").agg(F.sum(F.col("size") + len(MAGIC)).alias("total"))
    earlier = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    bases = sizes.select("file", "split", F.coalesce(F.sum("total").over(earlier), F.lit(0)).alias("base"))
    bases = written(bases, "bases")

    pointers = thin.select("file", "split", "seq", "size", "header_bytes", "content")
    left = pointers.groupBy("file", "split").applyInPandas(
        _contract, "file string, split long, start long, leaves long"
    )
    left = left.join(bases, ["file", "split"]).select(
        "file", "split", (F.col("base") + F.col("start")).alias("start"), (F.col("base") + F.col("leaves")).alias("leaves")
    )
    left = written(left, "pointers")
    # a split is entered at the start of a file or where a chain leaves another split
    exits = left.select("file", F.col("leaves").alias("start")).distinct()
    entries = left.where("start = 0").unionByName(left.join(exits, ["file", "start"], "left_semi"))
    entries = written(entries.distinct(), "entries")
    reached = _jump(entries.select("file", "start", "leaves"))
    doors = (
        entries.join(reached, ["file", "start"], "left_semi")
        .join(bases, ["file", "split"])
        .select("file", "split", (F.col("start") - F.col("base")).alias("entry"))
    )
    kept = (
        pointers.join(doors, ["file", "split"])
        .groupBy("file", "split")
        .applyInPandas(_reached, "file string, split long, seq long, start long, successor long")
        .join(bases, ["file", "split"])
        .select(
            "file",
            "split",
            "seq",
            (F.col("base") + F.col("start")).alias("offset"),
            (F.col("base") + F.col("successor")).alias("next"),
        )
    )
    records = written(kept.join(thin, ["file", "split", "seq"]), "records")
    broken = records.where(~F.col("whole"))
    if not broken.isEmpty():
        mended = _assembled(chunks, thin, bases, broken, cell)
        records = records.where("whole").unionByName(mended.select(*records.columns))
    response = ~F.col("record_type").eqNullSafe(F.lit("revisit"))
    return records.select(
        "file",
        "offset",
        "id",
        "record_type",
        "refers_to",
        F.when(response, F.col("content")).otherwise(F.col("declared_bytes")).alias("payload_bytes"),
        F.when(response, F.col("digest")).otherwise(F.col("declared_digest")).alias("payload_digest"),
        "declared_digest",
    )


def _assembled(
    chunks: DataFrame, thin: DataFrame, bases: DataFrame, broken: DataFrame, cell: int
) -> DataFrame:
    """Records with the magic inside their payload: their chunks are read again and joined."""
    inside = Window.partitionBy("file", "split").orderBy("seq")
    before = F.sum(F.col("size") + len(MAGIC)).over(inside) - F.col("size") - 2 * len(MAGIC)
    placed = (
        thin.select("file", "split", "seq", "size")
        .withColumn("before", before)
        .join(bases, ["file", "split"])
        .select("file", "split", "seq", (F.col("base") + F.col("before")).alias("at"))
        .withColumn("cell", F.floor(F.col("at") / cell))
    )
    spans = broken.select("file", "offset", "next").withColumn(
        "cell", F.explode(F.sequence(F.floor(F.col("offset") / cell), F.floor((F.col("next") - 1) / cell)))
    )
    parts = written(
        placed.join(spans, ["file", "cell"])
        .where((F.col("at") >= F.col("offset")) & (F.col("at") < F.col("next")))
        .select("file", "split", "seq", "at", "offset"),
        "parts",
    )
    texts = (
        chunks.join(parts, ["file", "split", "seq"])
        .groupBy("file", "offset")
        .agg(F.array_sort(F.collect_list(F.struct("at", "value"))).alias("list"))
        .select("file", "offset", F.array_join(F.col("list.value"), MAGIC).alias("text"))
    )
    bare = broken.drop("digest")
    start = F.length(F.substring_index("text", BLANK, 1)) + len(BLANK) + 1
    # the last chunk ends with the blank line that ends the record
    body = F.substr("text", start, F.length("text") - start + 1 - len(BLANK))
    joined = bare.join(texts, ["file", "offset"])
    return joined.withColumn("digest", payload_digest(body)).drop("text")
