"""Empty tables, repeated rows and clashing columns in the operators on texts and pages."""

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from wayfunnel.llm import language, mixing, packing, quality, token_counts, warc
from wayfunnel.llm.common import scratch

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
ROWS = [
    (1, "the cat sat on the mat", "en", "a", 22),
    (1, "the cat sat on the mat", "en", "a", 22),
    (2, "le chat est sur la table", "fr", "b", 24),
    (2, "le chat est sur la table", "fr", "b", 24),
    (None, None, None, None, None),
    (None, None, None, None, None),
]


@pytest.fixture(scope="module")
def rows(spark):
    clash = ("n_bytes", "n_tokens", "score", "mixture", "predicted", "copies", "rank", "bits")
    return spark.createDataFrame(ROWS, SCHEMA).withColumns({c: F.lit("clash") for c in clash})


def test_token_counts(rows):
    counter = token_counts.Counter(public_tokenizers.path("piece_bpe_32k.model"))
    counted = token_counts.count_tokens(rows, counter, carry=["doc_id"]).collect()
    found = sorted((r["doc_id"] or 0, r["n_tokens"]) for r in counted)
    assert [i for i, _ in found] == [0, 0, 1, 1, 2, 2] and found[0][1] == found[1][1] == 0
    assert found[2] == found[3] and found[4] == found[5]
    assert token_counts.count_tokens(rows.where("false"), counter, carry=["doc_id"]).count() == 0


def test_languages(rows):
    profiles = language.learn(rows)
    found = language.detect(rows, profiles, carry=["doc_id"]).collect()
    assert sorted((r["doc_id"] or 0, r["lang_pred"]) for r in found) == [
        (0, "und"), (0, "und"), (1, "en"), (1, "en"), (2, "fr"), (2, "fr"),
    ]
    assert language.detect(rows.where("false"), profiles, carry=["doc_id"]).count() == 0
    nothing = language.learn(rows.where("false"))
    assert {r["lang_pred"] for r in language.detect(rows, nothing, carry=["doc_id"]).collect()} == {"und"}


def test_quality(spark, rows):
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 0)], "doc_id long, quality int, toxic int")
    scored = quality.score_documents(rows, labels, F.lit(True)).collect()
    assert len(scored) == 6 and len({r["score"] for r in scored if r["doc_id"] == 1}) == 1
    assert quality.score_documents(rows.where("false"), labels, F.lit(True)).count() == 0
    assert quality.score_documents(rows, labels.where("false"), F.lit(True)).count() == 6


def test_packing(rows):
    tokens = packing.Tokens(public_tokenizers.path("word_bpe_49k.json"), end=2)
    pieces = packing.pack_documents(rows, tokens).collect()
    assert sorted(r["doc_id"] or 0 for r in pieces) == [0, 0, 1, 1, 2, 2]
    places = sorted((r["sequence_id"], r["offset"], r["length"]) for r in pieces)
    assert len(set(places)) == 6 and sum(n for _, _, n in places) == sum(r["doc_tokens"] for r in pieces)


def test_mixing(rows):
    mixed = mixing.mix(rows, mixing.source_rates(rows, targets={"a": 1.0, "b": 1.0}, volume=40.0))
    counts = {r["doc_id"]: r["count"] for r in mixed.groupBy("doc_id").count().collect()}
    assert counts[1] % 2 == counts[2] % 2 == 0 and counts[1] > 40 and counts[2] > 40
    empty = rows.where("false")
    assert mixing.mix(empty, mixing.source_rates(empty)).count() == 0


def test_archives(spark):
    pages = [(7, "http://x", "same"), (7, "http://x", "same"), (5, None, "same"), (None, None, None)]
    frame = spark.createDataFrame(pages, "page_id long, url string, html string")
    frame = frame.withColumns({c: F.lit("clash") for c in ("first", "d", "size", "value", "n")})
    path = scratch(spark, "repeated")
    warc.write_archives(frame, path)
    found = warc.read_archives(spark, path).collect()
    assert sorted((r["id"] or 0, r["record_type"], r["refers_to"]) for r in found) == [
        (0, "response", None), (5, "revisit", 7), (7, "response", None), (7, "response", None),
    ]
    path = scratch(spark, "nothing")
    warc.write_archives(frame.where("false"), path)
    assert warc.read_archives(spark, path).count() == 0
