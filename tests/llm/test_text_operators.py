"""Token counts, languages, packing, licences, mixing, quality: brute force and awkward rows."""

import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from fixtures.compare import differences, duck
from wayfunnel.llm import language, licences, mixing, oracle, packing, quality, queries, token_counts
from wayfunnel.llm.common import table

SF = "/root/testdata/sf0.001"
PIECES = public_tokenizers.path("piece_bpe_32k.model")
WORDS = public_tokenizers.path("word_bpe_49k.json")
AWKWARD = [
    None, "", " ", "  a  b ", "\n\n x \n", "▁", "a▁b", "a" * 3000, "ab" * 999, "日本語 テキスト",
    "<s> </s> <0x0A>", "x\x00y\r\tz", "👍🏽 ﬁ Ａ　b", "don't I'LL 'S it's!'s", "<|endoftext|>x", "é x",
    "Σας ΟΔΟΣ İß×÷ªµ²½", "all rights reserved", "CC by CC  BY", "1 2 33",
]


def documents(spark, texts, **columns):
    rows = [(i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    return frame.withColumns({name: F.lit(value) for name, value in columns.items()})


def noise(n=400, alphabet="abc \n▁é日<0x>the '1sll"):
    draw = random.Random(4)
    return ["".join(draw.choice(alphabet) for _ in range(draw.randint(0, 200))) for _ in range(n)]


def test_token_counts_are_those_of_the_library(spark):
    texts = AWKWARD + noise()
    model = SentencePieceProcessor(model_file=PIECES)
    counted = token_counts.count_tokens(
        documents(spark, texts), token_counts.Counter(PIECES, kept_words=50), carry=["doc_id"], limit=900
    )
    found = {r["doc_id"]: r for r in counted.collect()}
    for i, text in enumerate(texts):
        n = len(model.encode(text or "", num_threads=1))
        assert (found[i]["n_tokens"], found[i]["over_limit"]) == (n, n > 900)
        assert found[i]["n_bytes"] == len((text or "").encode())


def test_token_counts_of_whole_documents(spark):
    model = SentencePieceProcessor(model_file=PIECES)
    texts = {r["doc_id"]: r["text"] for r in table(spark, SF, "documents").collect()}
    for row in queries.op1_token_counts(spark, SF).collect():
        assert row["n_tokens"] == len(model.encode(texts[row["doc_id"]], num_threads=1))


def test_packing_keeps_every_id_once_and_wastes_little(spark):
    library = Tokenizer.from_file(WORDS)
    texts = AWKWARD + noise() + ["the cat sat " * 4000] * 3
    frame = documents(spark, texts, sequence_id=7, rank="x")
    tokens = packing.Tokens(WORDS, kept_words=100)
    check_packing(packing.pack_documents(frame, tokens).collect(), texts, library)


def check_packing(rows, texts, library, least=0.97):
    ids = [library.encode(t or "", add_special_tokens=False).ids + [2] for t in texts]
    taken, places = Counter(), {}
    for r in rows:
        own = ids[r["doc_id"]]
        part = np.array(own[r["start"] : r["start"] + r["length"]], "<u4")
        assert r["ids_crc32"] == zlib.crc32(part.tobytes()) and r["doc_tokens"] == len(own)
        taken[r["doc_id"]] += r["length"]
        places.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert taken == Counter({i: len(own) for i, own in enumerate(ids)})
    for spots in places.values():
        spots.sort()
        assert [o for o, _ in spots] == np.cumsum([0, *[n for _, n in spots]])[:-1].tolist()
        assert sum(n for _, n in spots) <= 4096
    assert sum(taken.values()) >= least * 4096 * (len(places) - 1)


def test_packing_of_whole_documents(spark):
    rows = {r["doc_id"]: r["text"] for r in table(spark, SF, "documents").collect()}
    texts = [rows[i] for i in range(len(rows))]
    check_packing(queries.op3_packing(spark, SF).collect(), texts, Tokenizer.from_file(WORDS))


@pytest.mark.parametrize("lengths", [[5], [4096] * 7, [1] * 9999, [3000] * 9, list(range(1, 4096))])
def test_a_plan_places_every_piece(lengths):
    histogram = np.bincount(lengths, minlength=4097)
    found = packing.plan(histogram, 4096)
    key = (found.length << 48) + found.first
    filled = Counter()
    for length in np.flatnonzero(histogram):
        rank = np.arange(histogram[length])
        row = np.searchsorted(key, (np.int64(length) << 48) + rank, side="right") - 1
        assert (found.length[row] == length).all()
        number = (rank - found.first[row]) // found.times[row]
        for s in (found.sequence[row] + number).tolist():
            filled[s] += int(length)
    assert max(filled.values()) <= 4096
    assert sorted(filled) == list(range(len(filled)))


def test_least_squares_solves_what_can_be_solved():
    matrix = packing.combinations_filling(8)
    wanted = matrix @ np.arange(1, matrix.shape[1] + 1)
    found = packing.least_squares(matrix, wanted)
    assert (found >= 0).all() and np.allclose(matrix @ found, wanted)


def test_packing_nothing(spark):
    empty = documents(spark, ["x"]).where("false")
    assert packing.pack_documents(empty, packing.Tokens(WORDS)).count() == 0


def test_languages_of_held_out_documents(spark):
    sf = "/root/testdata/sf0.01"
    found = queries.op2_language(spark, sf).join(table(spark, sf, "documents"), "doc_id")
    right = found.where("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")))
    assert right.first()[0] > 0.97
    assert found.where("score < 0 OR score > 1").count() == 0


def test_a_mixture_has_both_its_languages(spark):
    draw = random.Random(1)
    words = {"xx": ["zig", "zag", "zog", "zizi"], "yy": ["mum", "mam", "momo", "mim"]}
    text = {k: [" ".join(draw.choice(v) for _ in range(60)) for _ in range(30)] for k, v in words.items()}
    known = documents(spark, text["xx"]).withColumn("lang", F.lit("xx"))
    known = known.unionByName(documents(spark, text["yy"]).withColumn("lang", F.lit("yy")))
    profiles = language.learn(known)
    asked = [text["xx"][0], f"{text['xx'][0]} {text['yy'][0]} {text['yy'][1]}", None, "", "12 !?", "q"]
    frame = documents(spark, asked, score="clash", mixture=1)
    rows = language.detect(frame, profiles, carry=["doc_id"]).orderBy("doc_id").collect()
    assert [r["lang_pred"] for r in rows[:5]] == ["xx", "yy", "und", "und", "und"]
    assert rows[0]["score"] == 1.0 and 0.6 < rows[1]["score"] < 0.75
    assert sorted(rows[1]["mixture"]) == ["xx", "yy"] and rows[2]["mixture"] == {}
    kept = language.keep_known(frame, F.lit(True), least=0.25)
    assert kept.columns == frame.columns
    assert language.learn(known.where("false")).languages == ()
    nothing = language.detect(frame, language.learn(known.where("false")), carry=["doc_id"])
    assert {r["lang_pred"] for r in nothing.collect()} == {"und"}


def test_only_text_of_learnt_languages_is_kept(spark):
    sf = "/root/testdata/sf0.01"
    known = table(spark, sf, "documents").select("doc_id", "text", "lang")
    rows = known.where("length(text) > 400").orderBy("doc_id").limit(200).collect()
    clean = {k: [r["text"] for r in rows if r["lang"] == k][:5] for k in ("en", "fr", "de", "es")}
    draw = random.Random(6)
    foreign = [
        "Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan. Heille on annettu järki.",
        "Minden emberi lény szabadon születik és egyenlő méltósága és joga van, ésszel és lelkiismerettel bír.",
        "Все люди рождаются свободными и равными в своем достоинстве и правах. Они наделены разумом и совестью.",
        "人人生而自由在尊严和权利上一律平等他们赋有理性和良心并应以兄弟关系的精神相对待",
        " ".join("".join(draw.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(7)) for _ in range(60)),
        " ".join("".join(draw.choice("qxzjkwv") for _ in range(5)) for _ in range(200)),
        "12 !?", "", None,
    ]
    both = [f"{clean['en'][0][:300]} {clean['fr'][0][:300]}", " ".join(v[0][:300] for v in clean.values())]
    both += [f"{clean['de'][1][:400]} {foreign[0]}"]
    good = [text for texts in clean.values() for text in texts] + both
    # the asked rows have no language, so nothing is learnt from them
    asked = [(10**9 + i, text, None) for i, text in enumerate(good + foreign)]
    frame = known.unionByName(spark.createDataFrame(asked, known.schema))
    kept = language.keep_known(frame, F.col("lang").isNotNull()).where("lang IS NULL")
    assert {r["doc_id"] - 10**9 for r in kept.collect()} == set(range(len(good)))


@pytest.mark.parametrize("name", sorted(oracle.oracle_sql()))
def test_query_matches_its_sql(spark, name):
    assert differences(spark, duck(SF), SF, queries.queries()[name], oracle.oracle_sql()[name]) == []


def brute_licences(words, templates=licences.TEMPLATES, threshold=0.8):
    """(label, start, words, containment) by comparing every block with every template."""
    found = set()
    for step in {licences.step_of(text) for _, text in templates}:
        for start in range(0, len(words), step):
            held, matched = set(words[start : start + 2 * step]), {}
            for label, text in templates:
                own = set(text.split())
                shared = len(own & held)
                if licences.step_of(text) == step and shared >= licences.needed_of(text, threshold):
                    matched[text] = (shared / len(own), shared, label)
            for text, (share, shared, label) in matched.items():
                own = set(text.split())
                if not any(
                    (rival[0], rival[1]) > (share, shared)
                    and len(own & set(other.split())) >= licences.needed_of(text, threshold)
                    for other, rival in matched.items()
                ):
                    found.add((label, start, 2 * step, share))
    return found


def test_licence_join_equals_all_comparisons(spark):
    draw = random.Random(2)
    vocabulary = licences.vocabulary(licences.TEMPLATES) + ["cat", "dog"]
    texts = [" ".join(draw.choice(vocabulary) for _ in range(draw.randint(3, 400))) for _ in range(60)]
    for _, text in licences.TEMPLATES:  # some words lost, changed or moved, over several lines
        words = [draw.choice([w, w, w, w, w, w, w, w, "cat"]) for w in text.split() if draw.random() > 0.07]
        lines = [draw.choice([w, f"{w}\n", f"{w}, ", f"\n# {w}"]) for w in words]
        texts.append("lead " * draw.randint(0, 70) + " ".join(lines) + " tail" * draw.randint(0, 70))
        texts.append("lead " * draw.randint(0, 70) + text)
    texts += AWKWARD
    frame = documents(spark, texts, labels=3, matches=1, start="x")
    rows = licences.scan(frame, carry=["doc_id"]).collect()
    hits = 0
    for row in rows:
        text = texts[row["doc_id"]] or ""
        words = [w.decode() for w in licences.WORD.findall(text.encode().lower())]
        expected = brute_licences(words)
        assert {tuple(m) for m in row["matches"]} == expected and row["n_words"] == len(words)
        hits += bool(expected)
    assert hits > 60
    summary = {r["doc_id"]: r for r in licences.summary(spark.createDataFrame(rows), ["doc_id"]).collect()}
    place = len(texts) - len(AWKWARD) + AWKWARD.index("CC by CC  BY")
    assert [summary[place][c] for c in ("n_base", "first_word", "last_word", "base_labels", "score")] == [2, 0, 2, "cc-by", 1.0]
    null = summary[len(texts) - len(AWKWARD)]
    assert (null["n_words"], null["first_word"], null["labels"], null["score"]) == (0, None, "", 0.0)


def test_notices_tell_licences_apart_across_lines(spark):
    mpl = "This Source Code Form is subject to the terms of the Mozilla Public\n * License, v. 2.0. If a copy of the MPL was not\n * distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."
    gnu = "under the terms of the GNU %s General Public License as published by\n# the Free Software Foundation, either version 3 of the License, or\n# (at your option) any later version."
    start = "# This program is free software: you can redistribute it and/or modify it\n# "
    asked = {
        "Licensed under CC BY 4.0.": "cc-by-4.0", "Licensed under CC BY-SA 4.0.": "cc-by-sa-4.0",
        "Licensed under CC BY-NC 4.0.": "cc-by-nc-4.0", "CC BY-NC-SA 4.0": "cc-by-nc-sa-4.0",
        "Released under the BSD License.": "bsd", "Released under the Apache License.": "",
        "Released under the MIT License.": "mit", "released under\nthe MIT\nlicense": "mit",
        "Licensed under the Apache License, Version 2.0.": "apache-2.0",
        "This work is licensed under the GNU Lesser General Public License version 3": "lgpl-3.0",
        "This work is licensed under the GNU General Public License, version 3.": "gpl-3.0",
        "x " * 50 + mpl: "mpl-2.0", licences._MIT.replace(" ", "\n", 20): "mit",
        licences._MIT.replace("merge, ", ""): "mit", licences._ISC.replace("hereby ", ""): "isc",
        start + gnu % "": "gpl-3.0", start + gnu % "Lesser": "lgpl-3.0", start + gnu % "Affero": "agpl-3.0",
        "the cat sat on the mat and is free to do so " * 30: "", None: "", "": "",
    }
    texts = [*asked, *asked]
    for row in licences.scan(documents(spark, texts), carry=["doc_id"]).collect():
        found = {m["label"] for m in row["matches"]}
        assert found == set(filter(None, [asked[texts[row["doc_id"]]]])), texts[row["doc_id"]]
    nothing = licences.scan(documents(spark, ["x"]).where("false"), carry=["doc_id"])
    assert nothing.count() == 0


def test_mixing_reaches_its_targets(spark):
    rows = [(i, "x" * 10, "big" if i % 4 else None) for i in range(20_000)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string")
    frame = frame.withColumn("shuffle_key", F.lit("kept")).withColumn("copy", F.lit(5))
    rates = mixing.source_rates(frame, targets={"big": 1.0})
    assert {r["source"]: round(r["rate"], 6) for r in rates.collect()} == {"big": round(4 / 3, 6), None: 0.0}
    even = {r["source"]: r["rate"] for r in mixing.source_rates(frame, power=0.0).collect()}
    assert even["big"] == pytest.approx(2 / 3) and even[None] == pytest.approx(2.0)
    mixed = mixing.mixed_documents(frame, power=0.0)
    assert mixed.columns == frame.columns
    sizes = {r["source"]: r["count"] for r in mixed.groupBy("source").count().collect()}
    assert sizes["big"] == pytest.approx(10_000, rel=0.05) and sizes[None] == pytest.approx(10_000, rel=0.05)
    copies = mixed.where("source IS NULL").groupBy("doc_id").count().groupBy("count").count()
    share = {r[0]: r[1] / 5000 for r in copies.collect()}
    assert share[1] == pytest.approx(0.2707, abs=0.03) and share[2] == pytest.approx(0.2707, abs=0.03)
    assert mixing.mixed_documents(frame.where("false")).count() == 0
    assert mixing.mixed_documents(frame.withColumn("text", F.lit(None).cast("string"))).count() > 0


def test_mixing_reaches_targets_far_from_the_volumes(spark):
    rows = [(i, "x" * 100, "big" if i % 1000 else "rare") for i in range(100_000)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string")
    rates = mixing.source_rates(frame, targets={"rare": 0.5, "big": 0.5})
    rate = {r["source"]: r["rate"] for r in rates.collect()}
    assert rate["rare"] == pytest.approx(500) and rate["big"] == pytest.approx(0.5, rel=0.01)
    mixed = mixing.mix(frame, rates)
    sizes = {r["source"]: r["count"] for r in mixed.groupBy("source").count().collect()}
    assert sizes["rare"] == pytest.approx(50_000, rel=0.02) and sizes["big"] == pytest.approx(50_000, rel=0.02)
    copies = [r["n"] for r in mixed.where("source = 'rare'").groupBy("doc_id").agg(
        F.count("*").alias("n"), F.countDistinct("copy").alias("d"), F.max("copy").alias("m")
    ).where("n = d AND m = n - 1").collect()]
    assert len(copies) == 100 and np.var(copies) == pytest.approx(500, rel=0.5)
    assert mixing.mix(frame, rates).groupBy("copy").count().exceptAll(mixed.groupBy("copy").count()).count() == 0


@pytest.mark.parametrize("rate", [0.0, 0.3, 64.0, 150.0, 3000.0, 3e7])
def test_poisson_steps_at_any_rate(rate):
    fewest, steps = mixing.poisson_steps(rate)
    chance = np.diff([0.0, *steps])
    copies = fewest + np.arange(len(steps))
    assert steps[-1] == 1 and (chance >= 0).all()
    assert chance @ copies == pytest.approx(rate, rel=1e-9)
    assert chance @ (copies - rate) ** 2 == pytest.approx(rate, rel=1e-6)


def test_quality_of_held_out_documents(spark):
    sf = "/root/testdata/sf0.01"
    scored = queries.op6_quality(spark, sf).join(table(spark, sf, "labels"), "doc_id").where("held_out")
    right, rows = scored.agg(F.avg((F.col("predicted") == F.col("quality")).cast("int")), F.count("*")).first()
    assert rows > 50 and right > 0.95
    bad = {r["predicted"] for r in scored.where("(predicted = 1) <> (score >= 0.3)").collect()}
    assert bad == set()


def test_quality_of_awkward_documents(spark):
    frame = documents(spark, AWKWARD + ["good words here", "BAD!! BAD!!"] * 20, features=1, score=2)
    frame = frame.unionByName(frame.limit(3))
    labels = spark.createDataFrame(
        [(len(AWKWARD) + i, 1 - i % 2) for i in range(40)] + [(0, None), (None, 1)], "doc_id long, quality int"
    )
    scored = quality.score_documents(frame, labels, F.lit(True))
    assert scored.count() == frame.count() and scored.where("score IS NULL OR score < 0 OR score > 1").count() == 0
    kept = quality.keep_good(frame, labels, F.lit(True))
    assert kept.columns == frame.columns
    assert kept.where("text LIKE 'good%'").count() == 20 and kept.where("text LIKE 'BAD%'").count() == 0
    assert quality.keep_good(frame, labels.where("false"), F.lit(True)).count() == frame.count()
    assert quality.keep_good(frame.where("false"), labels, F.lit(True)).count() == 0
