"""The MinHash join against the similarity of all pairs, and components against a union-find."""

import random

import pytest
from pyspark.sql import functions as F

from wayfunnel.llm import queries, signature_join
from wayfunnel.llm.components import components

SCHEMA = "doc_id long, text string"


def sets_of(texts, width=2):
    lowered = [(t or "").encode().lower().split() for t in texts]
    return [
        {tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1))} if w else set()
        for w in lowered
    ]


def roots(n, links):
    parent = list(range(n))

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in links:
        a, b = top(a), top(b)
        parent[max(a, b)] = min(a, b)
    return [top(i) for i in range(n)]


def brute(keys, texts):
    """(key, n_shingles, component) per row; keys in ascending order."""
    sets = sets_of(texts)
    links = [
        (i, j)
        for i in range(len(sets))
        for j in range(i)
        if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])
    ]
    named = roots(len(keys), links)
    return [(keys[i], len(sets[i]), keys[named[i]]) for i in range(len(keys))]


def found(frame, **options):
    rows = signature_join.near_duplicates(frame, **options).collect()
    return [(r["doc_id"], r["n_shingles"], r["component_id"]) for r in rows]


def copies(draw, n, words=120, edits=9):
    """Texts of few words: chains of near copies, all around the threshold."""
    texts = []
    for i in range(n):
        if texts and draw.random() < 0.8:
            new = draw.choice(texts[-20:]).split()
            for _ in range(draw.randint(0, edits)):
                new[draw.randrange(len(new))] = f"w{draw.randrange(400)}"
            texts.append(" ".join(new))
        else:
            texts.append(" ".join(f"w{draw.randrange(400)}" for _ in range(draw.randint(3, words))))
    return texts


@pytest.mark.parametrize("options", [{}, {"pivots": 0, "chunk": 8}, {"pivots": 1, "chunk": 16}])
def test_chains_of_near_copies(spark, options):
    texts = copies(random.Random(5), 300)
    frame = spark.createDataFrame(list(enumerate(texts)), SCHEMA).repartition(5)
    assert sorted(found(frame, **options)) == brute(list(range(300)), texts)


def test_one_large_group_and_a_common_passage(spark):
    draw = random.Random(6)
    passage = " ".join(f"p{i}" for i in range(80))
    base = [f"b{i}" for i in range(100)]
    texts = [f"{passage} " + " ".join(f"u{draw.randrange(9999)}" for _ in range(40)) for _ in range(150)]
    for _ in range(150):
        words = list(base)
        for _ in range(draw.randint(0, 12)):
            words[draw.randrange(100)] = f"e{draw.randrange(9999)}"
        texts.append(" ".join(words))
    frame = spark.createDataFrame(list(enumerate(texts)), SCHEMA)
    assert sorted(found(frame, chunk=32)) == brute(list(range(300)), texts)


def test_awkward_rows(spark):
    texts = [
        None, "", " \t ", "one", "One", "one two", "ONE\x0btwo", "two one", "a b c d e", "a b c d e f",
        "é É", "É é", "x y z", "x y z", "one two", "é É",
    ]
    frame = spark.createDataFrame(list(enumerate(texts)), SCHEMA)
    frame = frame.withColumns({c: F.lit("clash") for c in ("key", "rep", "members", "set_id", "label")})
    assert sorted(found(frame)) == brute(list(range(len(texts))), texts)
    assert found(frame.where("false")) == []
    # rows without a key, and rows of one key
    rows = [(None, "a b c d"), (None, "a b c d"), (7, "p q r s t u"), (7, "p q r s t u v"), (8, "a b c d e")]
    got = found(spark.createDataFrame(rows, SCHEMA))
    assert sorted(got, key=str) == sorted(
        [(None, 3, 8), (None, 3, 8), (7, 5, 7), (7, 6, 7), (8, 4, 8)], key=str
    ) or sorted(got, key=str) == sorted(
        [(None, 3, None), (None, 3, None), (7, 5, 7), (7, 6, 7), (8, 4, 8)], key=str
    )


def test_a_long_text(spark):
    draw = random.Random(2)
    words = [f"w{draw.randrange(50_000)}" for _ in range(200_000)]
    changed = [f"x{i}" if i % 25 == 0 else w for i, w in enumerate(words)]
    frame = spark.createDataFrame([(1, " ".join(words)), (2, " ".join(changed)), (3, "w1 w2")], SCHEMA)
    assert sorted(c for _, _, c in found(frame)) == [1, 1, 3]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_components(spark, seed):
    draw = random.Random(seed)
    edges = [(draw.randrange(400), draw.randrange(400)) for _ in range(260)]
    edges += [(0, i) for i in range(0, 400, 9)] + [(i, i + 1) for i in range(300, 340)]
    frame = spark.createDataFrame(edges, "a long, b long").repartition(6)
    want = dict(enumerate(roots(400, edges)))
    got = {r["node"]: r["root"] for r in components(frame).collect()}
    assert got == {node: want[node] for edge in edges for node in edge}
    assert components(frame.where("false")).count() == 0


def test_query_on_whole_documents(spark):
    sf = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{sf}/documents.parquet").orderBy("doc_id").collect()
    want = brute([r["doc_id"] for r in rows], [r["text"] for r in rows])
    got = queries.op13_minhash(spark, sf).collect()
    assert sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got) == want
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)
