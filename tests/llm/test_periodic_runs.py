"""Periodic runs against a comparison of every word with every later one."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from wayfunnel.llm import periodic_runs, queries

SCHEMA = "doc_id long, text string"


def brute(words, least=12):
    n, best = len(words), {}
    for p in range(1, n // 2 + 1):
        i = 0
        while i + p < n:
            start = i
            while i + p < n and words[i] == words[i + p]:
                i += 1
            if i - start >= p:
                best.setdefault((start, i + p), p)
            i += 1
    return sorted((b, e - b, p) for (b, e), p in best.items() if e - b >= least)


def hard(draw):
    """Texts of many runs: few letters, Fibonacci and Thue-Morse words, nested and mirrored repeats."""
    n = draw.randint(0, 250)
    fibonacci = ["a", "ab"]
    while len(fibonacci[-1]) < n:
        fibonacci.append(fibonacci[-1] + fibonacci[-2])
    unit = [draw.choice("abcdefgh") for _ in range(draw.randint(1, 40))]
    nested = "aab" * draw.randint(1, 15) + "aab"[: draw.randint(0, 2)]
    block = nested * draw.randint(1, 4)
    kinds = [
        [draw.choice("ab") for _ in range(n)],
        "ba" * draw.randint(0, 60) + "ab" * draw.randint(0, 60),
        fibonacci[-1][:n],
        [str(bin(i).count("1") % 2) for i in range(n)],
        (unit * 9)[:n],
        block + "x" * draw.randint(0, 1) + block,
        [str(draw.randrange(50)) for _ in range(n)],
        "a" * n,
    ]
    text = list(draw.choice(kinds))
    for _ in range(draw.choice([0, 0, 1, 3])):
        if text:
            text[draw.randrange(len(text))] = "z"
    return [word.encode() for word in text]


@pytest.mark.parametrize("seed", range(8))
@pytest.mark.parametrize("least", [2, 12])
def test_runs_of_hard_texts(seed, least):
    draw = random.Random(seed)
    texts = [hard(draw) for _ in range(60)]
    found = periodic_runs.runs_of(texts, least)
    for text, runs in zip(texts, found, strict=True):
        assert [tuple(r) for r in runs.tolist()] == brute(text, least)


def test_mirrored_repeats_have_a_run_for_each_odd_period():
    text = [c.encode() for c in "ba" * 200 + "ab" * 200]
    (runs,) = periodic_runs.runs_of([text], 2)
    assert [tuple(r) for r in runs.tolist()] == brute(text, 2)
    assert len(runs) > 190


def test_one_hash_that_fails_is_replaced(monkeypatch):
    text = [c.encode() for c in "abcdefg" * 6 + "hijklmn" * 5]
    want = brute(text)
    sound, calls = periodic_runs._confirmed, []

    def once(words, runs):
        calls.append(1)
        return len(calls) > 1 and sound(words, runs)

    monkeypatch.setattr(periodic_runs, "_confirmed", once)
    (runs,) = periodic_runs.runs_of([text])
    assert [tuple(r) for r in runs.tolist()] == want and len(calls) > 2


def test_awkward_rows(spark):
    repeat = "x y z " * 5
    texts = [None, "", " \t\n", "a", repeat, repeat, repeat.replace(" ", "\x0b\r"), "a\u00a0a " * 12, "A a " * 9]
    frame = spark.createDataFrame(list(enumerate(texts)), SCHEMA)
    frame = frame.withColumns({c: F.lit("clash") for c in ("runs", "collapsed", "n_words")})
    rows = periodic_runs.find_runs(frame, carry=["doc_id"]).orderBy("doc_id").collect()
    for row, text in zip(rows, texts, strict=True):
        words = (text or "").encode().split()
        assert [tuple(r) for r in row["runs"]] == brute(words) and row["n_words"] == len(words)
    assert [r["collapsed"] for r in rows[:4]] == ["", "", "", "a"]
    assert rows[4]["collapsed"] == "x y z" and rows[5]["collapsed"] == rows[6]["collapsed"] == "x y z"
    assert rows[7]["collapsed"] == "a\u00a0a" and rows[8]["collapsed"] == "A a"
    nothing = periodic_runs.find_runs(frame.where("false"), carry=["doc_id"])
    assert nothing.count() == 0


def test_a_long_text(spark):
    draw = random.Random(3)
    block = [f"w{draw.randrange(900)}" for _ in range(70_000)]
    text = " ".join(["start", *block, *block, "end"])
    frame = spark.createDataFrame([(1, text)], SCHEMA)
    row = periodic_runs.find_runs(frame, carry=["doc_id"]).first()
    assert (1, 140_000, 70_000) in [tuple(r) for r in row["runs"]]


def test_query_on_whole_documents(spark):
    sf = "/root/testdata/sf0.001"
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    for row in queries.op12_periodic_runs(spark, sf).collect():
        words = (texts[row["doc_id"]] or "").encode().split()
        n, h = len(words), zlib.crc32(str(row["doc_id"]).encode())
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        if n > 2500:
            continue
        runs = brute(words)
        gone = {i for b, length, p in runs for i in range(b + p, b + length)}
        start, length, period = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None,) * 3)
        lines = "".join(f"{b},{size},{p}\n" for b, size, p in runs)
        left = b" ".join(w for i, w in enumerate(words) if i not in gone)
        assert row["n_runs"] == len(runs)
        assert (row["start"], row["length"], row["period"]) == (start, length, period)
        assert row["exponent_milli"] == (1000 * length // period if runs else None)
        assert row["runs_sha256"] == hashlib.sha256(lines.encode()).hexdigest()
        assert row["collapsed_sha256"] == hashlib.sha256(left).hexdigest()
