"""Near duplicates, vector searches, WARC archives and the pipeline."""

import base64
import hashlib
import math
from fractions import Fraction

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from wayfunnel.llm import mixing, near_duplicates, nearest, queries, top_k, warc
from wayfunnel.llm.common import scratch, table
from wayfunnel.llm.gray_index import Forest, components

SF = "/root/testdata/sf0.001"


def brute_fingerprint(text, words=4):
    tokens = (text or "").encode().lower().split()
    if not tokens:
        return 0
    shingles = [b" ".join(tokens[i : i + words]) for i in range(max(1, len(tokens) - words + 1))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints, distance=4):
    prints = np.array(prints, np.uint64)
    left, right = [], []
    for i in range(len(prints)):
        near = np.flatnonzero(np.bitwise_count(prints[i + 1 :] ^ prints[i]) <= distance) + i + 1
        left += [i] * len(near)
        right += near.tolist()
    return components(len(prints), np.array(left, int), np.array(right, int))


def crowded(n, seed, flips):
    draw = np.random.default_rng(seed)
    centres = draw.integers(0, 1 << 63, 5, dtype=np.uint64)
    found = centres[draw.integers(0, 5, n)]
    for _ in range(flips):
        found ^= np.uint64(1) << draw.integers(0, 64, n, dtype=np.uint64)
    return found


def test_fingerprints_and_components_of_whole_documents(spark):
    texts = {r["doc_id"]: r["text"] for r in table(spark, SF, "documents").collect()}
    ids = sorted(texts)
    prints = [brute_fingerprint(texts[i]) for i in ids]
    label = brute_components(prints)
    found = {r["doc_id"]: r for r in queries.op7_near_duplicates(spark, SF).collect()}
    assert len(found) == len(ids)
    for place, i in enumerate(ids):
        assert found[i]["fingerprint"] == f"{prints[place]:016x}"
        assert found[i]["component_id"] == ids[label[place]]


@pytest.mark.parametrize("flips", [2, 3, 8])
def test_index_finds_what_all_comparisons_find(flips):
    prints = np.unique(crowded(700, flips, flips))
    rank = prints.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    prints = prints[np.argsort(rank)]
    forest = Forest(prints, np.zeros(len(prints), int))
    left, right = forest.links((np.array([0]), np.array([0])), 4, at_once=5000)
    assert np.array_equal(components(len(prints), left, right), brute_components(prints))


@pytest.mark.parametrize("chunk", [3, 64])
def test_links_across_chunks(spark, chunk):
    prints = np.unique(crowded(400, 9, 3))
    frame = spark.createDataFrame([(int(p),) for p in prints.view(np.int64)], "fingerprint long")
    roots = near_duplicates.connected(near_duplicates.links(frame, chunk=chunk))
    root = {r["node"]: r["root"] for r in roots.collect()}
    own = [root.get(int(p), int(p)) for p in prints.view(np.int64)]
    label = brute_components(prints)
    assert len(set(zip(own, label.tolist(), strict=True))) == len(set(own)) == len(set(label.tolist()))


def test_components_of_a_long_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(200)] + [(1000, 1000 + i) for i in range(1, 300)] + [(5, 5)]
    roots = near_duplicates.connected(spark.createDataFrame(edges, "a long, b long"))
    found = {r["node"]: r["root"] for r in roots.collect()}
    assert {found[i] for i in range(201)} == {0} and {found[1000 + i] for i in range(300)} == {1000}


def test_near_duplicates_of_awkward_rows(spark):
    long = " ".join(f"w{i}" for i in range(3000))
    rows = [(3, None), (1, ""), (2, " \n"), (7, long), (6, long + " end"), (6, long), (None, long), (9, "other text")]
    frame = spark.createDataFrame(rows, "doc_id long, text string").withColumn("fingerprint", F.lit(1))
    frame = frame.withColumn("row", F.lit(2))
    found = near_duplicates.find_near_duplicates(frame).collect()
    assert sorted((r["doc_id"] or -1, r["component_id"]) for r in found) == [
        (-1, 6), (1, 1), (2, 1), (3, 1), (6, 6), (6, 6), (7, 6), (9, 9)
    ]
    kept = near_duplicates.keep_one(frame)
    assert kept.columns == frame.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 6, 9]
    assert near_duplicates.find_near_duplicates(frame.where("false")).count() == 0
    assert near_duplicates.keep_one(frame.where("doc_id IS NULL")).count() == 1


def vectors(spark, n=1500, width=16):
    draw = np.random.default_rng(3)
    values = draw.normal(size=(n, width)).astype(np.float32)
    values[100:160] = values[100]
    rows = [(i, v.tolist()) for i, v in enumerate(values)]
    odd = [(5000, None), (5050, [0.0] * width), (5100, [float("nan")] * width), (5150, [None] * width)]
    odd += [(5200, [float("inf")] * width), (5250, []), (5300, [1.0]), (None, values[0].tolist())]
    frame = spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>")
    return frame.withColumn("score", F.lit(1)).withColumn("row", F.lit(1)), values.astype(float)


def answers(frame):
    found = {}
    for r in frame.orderBy("query_id", "rank").collect():
        found.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    return found


def test_nearest_recall_and_exact_scores(spark):
    frame, values = vectors(spark)
    graph = nearest.Graph(shard=400, queries=10)
    found = answers(nearest.nearest(frame, F.col("id") % 50 == 0, graph=graph))
    short = np.eye(1, values.shape[1])  # 5300 counts as filled up with zeros
    values, ids = np.concatenate([values, short]), np.append(np.arange(1500), 5300)
    unit = values / np.linalg.norm(values, axis=1, keepdims=True)
    assert sorted(found) == [*range(0, 1500, 50), 5300]
    hits = 0
    for query, got in found.items():
        own = min(query, 1500)
        exact = unit @ unit[own]
        exact[own] = -9
        best = np.lexsort((np.arange(len(exact)), -exact.round(12)))[:5]
        hits += len({i for i, _ in got} & set(ids[best].tolist()))
        assert [s for _, s in got] == pytest.approx([exact[min(i, 1500)] for i, _ in got], abs=1e-12)
        assert got == sorted(got, key=lambda x: (-x[1], x[0]))
    assert hits >= 0.9 * 5 * len(found)
    assert [i for i, _ in found[100]] == [101, 102, 103, 104, 105]


def test_nearest_of_few_rows(spark):
    few = spark.createDataFrame([(0, [1.0, 0.0]), (0, [1.0, 0.0]), (7, [1.0, 1.0])], "vec_id long, embedding array<float>")
    rows = nearest.nearest(few, F.col("id") % 50 == 0).collect()
    assert sorted((r["query_id"], r["rank"], r["vec_id"]) for r in rows) == [
        (0, 1, 0), (0, 1, 0), (0, 2, 7), (0, 2, 7)
    ]
    assert nearest.nearest(few.where("false"), F.col("id") == 0).count() == 0
    assert top_k.top_k(few.where("false"), F.col("id") == 0).count() == 0


@pytest.mark.parametrize("lists", [1, 2, 3])
def test_top_k_is_exact(spark, lists):
    frame, values = vectors(spark)
    found = answers(
        top_k.top_k(frame, F.col("id") % 50 == 0, lists=lists, depth=2, block=300, queries=9)
    )
    whole = np.floor(256 * values).astype(np.int64)
    # a zero vector takes part here, and a short one filled up with zeros
    whole = np.concatenate([whole, np.zeros((1, whole.shape[1]), np.int64), 256 * np.eye(1, whole.shape[1], dtype=np.int64)])
    ids = np.append(np.arange(1500), [5050, 5300])
    assert sorted(found) == sorted(i for i in ids.tolist() if i % 50 == 0)
    for query, got in found.items():
        own = int(np.flatnonzero(ids == query)[0])
        score = whole @ whole[own]
        others = [i for i in range(len(ids)) if i != own]
        best = sorted(others, key=lambda i: (-score[i], ids[i]))[:5]
        assert got == [(int(ids[i]), int(score[i])) for i in best]


def digest(payload):
    return base64.b32encode(hashlib.sha1((payload or "").encode()).digest()).decode()


def test_warc_round_trip_with_magic_in_payloads(spark):
    inner = "WARC/1.0\r\nWARC-Type: response\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"
    payloads = [None, "", "é日👍", "x" * 3000, inner, inner * 40, "WARC/1.0\r\n", "a" + inner + "b", "\r\n\r\n",
                "WARC/1.0\r\nContent-Length: 999999999999999\r\n\r\n", "WARC/1.0", "same", "same", "same"]
    payloads += [f"page {i} {inner * (i % 3)}" for i in range(300)]
    rows = [(i, f"http://x/{i}\r\nContent-Length: 3", p) for i, p in enumerate(payloads)] + [(None, None, "same")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    pages = pages.withColumn("id", F.lit("clash")).withColumn("digest", F.lit(0)).repartition(2)
    path = scratch(spark, "test-archives")
    warc.write_archives(pages, path)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2k")  # splits inside records
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        found = warc.read_archives(spark, path, cell=4096).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert len(found) == len(rows)
    largest = {}
    for i, p in enumerate(payloads):
        largest[p or ""] = i
    for r in found:
        if r["id"] is None:
            assert (r["record_type"], r["refers_to"], r["payload_digest"]) == ("revisit", 13, digest("same"))
            continue
        payload = payloads[r["id"]] or ""
        first = largest[payload]
        assert r["payload_bytes"] == len(payload.encode())
        assert r["payload_digest"] == digest(payload) == r["declared_digest"]
        kind = ("response", None) if r["id"] == first else ("revisit", first)
        assert (r["record_type"], r["refers_to"]) == kind


def test_warc_least_bytes_and_no_pages(spark):
    pages = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab")], "page_id long, url string, html string")
    path = scratch(spark, "test-archives")
    warc.write_archives(pages, path, least_bytes=3)
    assert {r["record_type"] for r in warc.read_archives(spark, path).collect()} == {"response"}
    path = scratch(spark, "test-archives")
    warc.write_archives(pages.where("false"), path)
    assert warc.read_archives(spark, path).count() == 0


def test_pipeline_stages_take_effect(spark):
    sf = "/root/testdata/sf0.01"
    docs = table(spark, sf, "documents")
    junk = {r["doc_id"] for r in table(spark, sf, "labels").where("quality = 0").collect()}
    good = {r["doc_id"] for r in table(spark, sf, "labels").where("quality = 1").collect()}
    kept = docs
    for name, stage in corpus_pipeline.STAGES:
        before, path = kept, scratch(spark, f"test-{name}")
        stage(spark, kept, sf).write.parquet(path)
        kept = spark.read.parquet(path)
        ids = [r["doc_id"] for r in kept.select("doc_id").collect()]
        if name != "packing":
            assert kept.columns == docs.columns
            assert set(ids) <= {r["doc_id"] for r in before.select("doc_id").collect()}
        if name == "quality":
            assert len(junk & set(ids)) <= 0.03 * len(junk) and len(good - set(ids)) <= 0.02 * len(good)
        if name == "language":
            assert len(ids) == before.count()
        if name == "near_duplicates":
            prints = [brute_fingerprint(r["text"], 5) for r in before.collect()]
            assert len(ids) == len(set(brute_components(prints).tolist()))
        if name == "mixing":
            assert len(set(ids)) < len(ids)
    assert kept.agg(F.sum("length")).first()[0] > 0


def few_vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>")


def test_top_k_of_large_components(spark):
    rows = [
        (0, [1e8, 1.0, -3.0]), (1, [1e8, 2.0, 5.0]), (2, [1e8, 2.0, 4.0]), (3, [1e6, 0.0, 0.0]),
        (4, [1e20, 0.0, 1.0]), (5, [-1e20, 7.0, 0.0]), (6, [1e200, 1e300, 0.0]), (7, [2e9, 1.0, 1.0]),
        (50, [1e6, 1e6, 0.5]), (100, [1.0, -1.0, 2.0]), (150, [-1e8, 1e8, 0.0]),
    ]
    whole = {i: [math.floor(256 * Fraction(x)) for x in v] for i, v in rows}
    longest = (1 << 63) - 1
    want = []
    for q in (0, 50, 100, 150):
        scores = [
            (max(-longest - 1, min(longest, sum(a * b for a, b in zip(whole[q], v, strict=True)))), i)
            for i, v in whole.items()
            if i != q
        ]
        best = sorted(scores, key=lambda s: (-s[0], s[1]))[:5]
        want += [(q, rank, i, score) for rank, (score, i) in enumerate(best, 1)]
    found = top_k.top_k(few_vectors(spark, rows), F.col("id") % 50 == 0)
    assert sorted(tuple(r) for r in found.collect()) == sorted(want)


def test_vectors_of_unequal_lengths_are_filled_up(spark):
    rows = [(0, [1.0, 2.0]), (1, [1.0, 2.0, 0.0]), (2, [0.0, 1.0, 5.0]), (3, [2.0]), (4, [])]
    found = nearest.nearest(few_vectors(spark, rows), F.col("id") % 50 == 0).collect()
    assert [(r["vec_id"], round(r["score"], 6)) for r in found] == [
        (1, 1.0), (3, round(1 / 5**0.5, 6)), (2, round(2 / 130**0.5, 6)),
    ]
    scores = top_k.top_k(few_vectors(spark, rows), F.col("id") % 50 == 0).collect()
    assert [(r["vec_id"], r["score"]) for r in scores] == [
        (1, 5 * 65536), (2, 2 * 65536), (3, 2 * 65536),
    ]


def test_cosines_of_very_large_and_small_numbers(spark):
    rows = [(0, [1e200, 2e200]), (1, [1e-200, 2e-200]), (2, [3e-200, 0.0]), (3, [-1e200, 1e-200])]
    found = nearest.nearest(few_vectors(spark, rows), F.col("id") % 50 == 0).collect()
    assert [r["vec_id"] for r in found] == [1, 2, 3]
    assert np.allclose([r["score"] for r in found], [1.0, 5**-0.5, -(5**-0.5)])


def test_helper_columns_may_clash(spark):
    names = "_source _fewest _steps _copies _start _first _number _one copy shuffle_key _kept row fingerprint Copy_"
    rows = [(i, f"text {i} of some words", f"s{i % 3}") for i in range(30)]
    plain = spark.createDataFrame(rows, "doc_id long, text string, source string")
    clash = plain.withColumns({name: F.lit(name) for name in names.split()})
    mixed = mixing.mixed_documents(clash, targets={"s0": 200.0, "s1": 1.0})
    assert mixed.columns == clash.columns
    same = mixing.mixed_documents(plain, targets={"s0": 200.0, "s1": 1.0})
    assert mixed.count() == same.count() and mixed.where("_kept <> '_kept'").count() == 0
    kept = near_duplicates.keep_one(clash)
    assert kept.columns == clash.columns and kept.count() == near_duplicates.keep_one(plain).count()
