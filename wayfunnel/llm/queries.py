"""The registered query of each operator, over its whole table, and the pipeline."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfunnel.llm import (
    language,
    licences,
    manifest,
    mixing,
    near_duplicates,
    nearest,
    packing,
    periodic_runs,
    quality,
    signature_join,
    token_counts,
    top_k,
    warc,
)
from wayfunnel.llm.common import crc_of_id, fresh, lower_ascii, scratch, table

Query = Callable[[SparkSession, str], DataFrame]


def op1_token_counts(spark: SparkSession, directory: str) -> DataFrame:
    counter = token_counts.Counter(public_tokenizers.path("piece_bpe_32k.model"))
    documents = table(spark, directory, "documents")
    return token_counts.count_tokens(documents, counter, carry=["doc_id"])


def learnt_languages(key: str = "doc_id"):
    """Rows that languages are learnt from; the others are held out."""
    return F.coalesce(crc_of_id(key) % 3 != 1, F.lit(True))


def op2_language(spark: SparkSession, directory: str) -> DataFrame:
    documents = table(spark, directory, "documents")
    profiles = language.learn(documents.where(learnt_languages()))
    found = language.detect(documents.select("doc_id", "text"), profiles, carry=["doc_id"])
    held_out = (~learnt_languages()).alias("held_out")
    return found.select("doc_id", held_out, "lang_pred", "score", "mixture")


def pack_tokens() -> packing.Tokens:
    return packing.Tokens(public_tokenizers.path("word_bpe_49k.json"), end=2)


def op3_packing(spark: SparkSession, directory: str) -> DataFrame:
    return packing.pack_documents(table(spark, directory, "documents"), pack_tokens())


def op4_licences(spark: SparkSession, directory: str) -> DataFrame:
    scanned = licences.scan(table(spark, directory, "documents"), carry=["doc_id"])
    return licences.summary(scanned, ["doc_id"])


def op5_mixing(spark: SparkSession, directory: str) -> DataFrame:
    documents = table(spark, directory, "documents")
    added = {"copy": "copy", "order": "shuffle_key"}
    names = {kind: fresh(name, documents.columns) for kind, name in added.items()}
    return mixing.mix(documents, mixing.source_rates(documents), **names)


def learnt_quality(key: str = "doc_id"):
    """Labels that quality is learnt from; the others are held out."""
    return F.coalesce(crc_of_id(key) % 5 != 0, F.lit(True))


def op6_quality(spark: SparkSession, directory: str) -> DataFrame:
    scored = quality.score_documents(
        table(spark, directory, "documents"), table(spark, directory, "labels"), learnt_quality()
    )
    held_out = (~learnt_quality()).alias("held_out")
    return scored.select("doc_id", held_out, "score", "predicted")


def op7_near_duplicates(spark: SparkSession, directory: str) -> DataFrame:
    return near_duplicates.find_near_duplicates(table(spark, directory, "documents"))


def op8_nearest(spark: SparkSession, directory: str) -> DataFrame:
    return nearest.nearest(table(spark, directory, "embeddings"), F.col("id") % 50 == 0)


def op9_warc(spark: SparkSession, directory: str) -> DataFrame:
    path = scratch(spark, "archives")
    warc.write_archives(table(spark, directory, "pages"), path, least_bytes=0)
    return warc.read_archives(spark, path).select(
        F.col("id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op10_top_k(spark: SparkSession, directory: str) -> DataFrame:
    return top_k.top_k(table(spark, directory, "embeddings"), F.col("id") % 50 == 0)


def op11_manifest(spark: SparkSession, directory: str) -> DataFrame:
    documents = table(spark, directory, "documents")
    text = F.col("text")
    before = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    # tampering lower-cases the texts of a fifth of the rows
    lowered = F.when(text.isNotNull(), lower_ascii(text))
    tampered = F.coalesce(crc_of_id("doc_id") % 5 == 0, F.lit(False))
    leaf = manifest.leaf_digest(*before, text)
    claimed = F.when(tampered, manifest.leaf_digest(*before, lowered)).otherwise(leaf)
    proofs = manifest.manifest(
        documents, leaf, key="doc_id", group="source", carry={"claimed": claimed}
    )
    proofs = proofs.withColumn("folded_root", manifest.folded(F.col("claimed"), F.col("witness")))
    return proofs.select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        manifest.proof_digest(F.col("witness")).alias("proof_sha256"),
        "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )


def with_repeats(text: Column, key: str = "doc_id") -> Column:
    """Texts of a tenth of the documents, whose words from some place on repeat from there."""
    crc = crc_of_id(key)
    g = F.floor(crc / 10)
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda word: word != "")
    n = F.size(words)
    start = (g % n).cast("int")
    period = (F.floor((n - start) / (3 + g % 8)) + 1).cast("int")
    times = F.ceil((n - start) / period).cast("int")
    repeated = F.flatten(F.array_repeat(F.slice(words, start + 1, period), times))
    changed = F.concat(F.slice(words, F.lit(1), start), F.slice(repeated, F.lit(1), n - start))
    return F.when((crc % 10 == 0) & (n > 0), F.array_join(changed, " ")).otherwise(text)


def op12_periodic_runs(spark: SparkSession, directory: str) -> DataFrame:
    documents = table(spark, directory, "documents")
    repeating = documents.select("doc_id", with_repeats(F.col("text")).alias("text"))
    found = periodic_runs.find_runs(repeating, carry=["doc_id"])
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    longest = F.transform("runs", lambda r: F.struct(-r["length"], r["start"], r["period"]))
    best = F.array_min(longest)
    length, period = -best["col1"], best["period"]
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        best["start"].alias("start"),
        length.alias("length"),
        period.alias("period"),
        F.floor(1000 * length / period).alias("exponent_milli"),
        F.sha2(F.array_join(F.transform(lines, lambda s: F.concat(s, F.lit("\n"))), ""), 256).alias(
            "runs_sha256"
        ),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op13_minhash(spark: SparkSession, directory: str) -> DataFrame:
    found = signature_join.near_duplicates(table(spark, directory, "documents"))
    kept = F.col("doc_id").eqNullSafe(F.col("component_id"))
    return found.select("doc_id", "n_shingles", "component_id", kept.alias("kept"))


def queries() -> dict[str, Query]:
    return {
        "op1_token_counts": op1_token_counts,
        "op2_language": op2_language,
        "op3_packing": op3_packing,
        "op4_licences": op4_licences,
        "op5_mixing": op5_mixing,
        "op6_quality": op6_quality,
        "op7_near_duplicates": op7_near_duplicates,
        "op8_nearest": op8_nearest,
        "op9_warc": op9_warc,
        "op10_top_k": op10_top_k,
        "op11_manifest": op11_manifest,
        "op12_periodic_runs": op12_periodic_runs,
        "op13_minhash": op13_minhash,
    }
