"""Licence scans: fixed phrases, and an exact set-similarity join of text blocks with templates.

Templates are whole notices and the ways in which licences are named. A block is a window of words,
whatever the line breaks: for templates of up to S words, a power of two, windows of 2 S words start
at every S-th word, so that any S words in a row lie in one. A block matches a template if it holds
at least a share of the template's distinct words; short templates must be held whole.

Words are ordered by how many texts have them, rarest first. A matching block must hold one of the
first words of the template in that order (prefix), enough words of templates (length), and enough
of them from the shared word on (positions); only what passes is compared. Of templates that are so
alike that one's words match the other, a block keeps those of which it holds the largest share, and
of equal shares the most words: a notice of the Lesser GPL is not one of the GPL as well.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections.abc import Iterator, Mapping

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfunnel.llm.common import map_texts

WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
SHORT = 10  # templates of fewer distinct words must be held whole
LEAST_STEP = 8  # words between blocks

# The phrases and labels of the scan.
PHRASES = {
    "cc by": "cc-by",
    "general public license": "gpl",
    "all rights reserved": "reserved",
}

# Public licence notices.
_APACHE = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file
except in compliance with the License. You may obtain a copy of the License at"""
_APACHE_TERMS = """Unless required by applicable law or agreed to in writing, software distributed under
the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either
express or implied. See the License for the specific language governing permissions and limitations
under the License."""
_BSD = """Redistribution and use in source and binary forms, with or without modification, are
permitted provided that the following conditions are met"""
_GNU = """This program is free software: you can redistribute it and/or modify it under the terms of
the GNU {} General Public License as published by the Free Software Foundation, either version {} of
the License, or (at your option) any later version."""
_ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or
without fee is hereby granted, provided that the above copyright notice and this permission notice
appear in all copies."""
_MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software
and associated documentation files (the "Software"), to deal in the Software without restriction,
including without limitation the rights to use, copy, modify, merge, publish, distribute,
sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions"""
_MPL = """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a
copy of the MPL was not distributed with this file, You can obtain one at
http://mozilla.org/MPL/2.0/."""
_UNLICENSE = """This is free and unencumbered software released into the public domain. Anyone is
free to copy, modify, publish, use, compile, sell, or distribute this software, either in source
code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any
means."""


def _templates() -> Iterator[tuple[str, str]]:
    yield "apache-2.0", _APACHE
    yield "apache-2.0", _APACHE_TERMS
    yield "bsd", _BSD
    yield "isc", _ISC
    yield "mit", _MIT
    yield "mpl-2.0", _MPL
    yield "public-domain", _UNLICENSE
    yield "public-domain", "unencumbered software released into the public domain"
    for verb in ("licensed", "released", "distributed"):
        yield "apache-2.0", f"{verb} under the Apache License, Version 2.0"
        for name in ("BSD", "ISC", "MIT"):
            yield name.lower(), f"{verb} under the {name} License"
        yield "mpl-2.0", f"{verb} under the Mozilla Public License 2.0"
    for start, kind, numbers in (
        ("gpl", "", ("2", "3")),
        ("lgpl", "Lesser", ("2.1", "3")),
        ("agpl", "Affero", ("3",)),
    ):
        for number in numbers:
            label = f"{start}-{number}" if "." in number else f"{start}-{number}.0"
            yield label, _GNU.format(kind, number)
            yield label, f"GNU {kind} General Public License version {number}"
            yield label, f"GNU {kind} General Public License v{number}"
    full = {"by": "Attribution", "nc": "NonCommercial", "sa": "ShareAlike", "nd": "NoDerivatives"}
    for kind in ("by", "by-sa", "by-nd", "by-nc", "by-nc-sa", "by-nc-nd"):
        spelled = " ".join(full[part] for part in kind.split("-"))
        hyphened = spelled.replace("NonCommercial", "Non-Commercial").replace("ShareAlike", "Share-Alike")
        for version in ("3.0", "4.0"):
            yield f"cc-{kind}-{version}", f"CC {kind} {version}"
            for name in sorted({spelled, hyphened}):
                yield f"cc-{kind}-{version}", f"Creative Commons {name} {version}"


def words_of(text: str) -> list[str]:
    return [word.decode() for word in WORD.findall(text.lower().encode())]


# (label, words) of notices and of the ways in which licences are named.
TEMPLATES = tuple((label, " ".join(words_of(text))) for label, text in _templates())


def vocabulary(templates) -> list[str]:
    return sorted({word for _, text in templates for word in text.split()})


def word_frequencies(documents: DataFrame, text: str, words: list[str]) -> dict[str, int]:
    """In how many whole texts each of the words is; one row per word comes to the driver."""
    wanted = {word.encode() for word in words}

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, int] = {}
        for batch in batches:
            for one in batch.column(0):
                data = (one.as_py() or "").encode().lower()
                for word in wanted.intersection(WORD.findall(data)):
                    totals[word.decode()] = totals.get(word.decode(), 0) + 1
        yield pa.RecordBatch.from_pydict({"word": list(totals), "n": list(totals.values())})

    parts = documents.select(F.col(text).cast("string")).mapInArrow(counted, "word string, n long")
    rows = parts.groupBy("word").agg(F.sum("n").alias("n")).collect()
    return {row["word"]: row["n"] for row in rows}


def step_of(template: str) -> int:
    """Words between the blocks that the template is compared with; a block is twice as long."""
    step = LEAST_STEP
    while step < len(template.split()):
        step *= 2
    return step


def needed_of(template: str, threshold: float) -> int:
    size = len(set(template.split()))
    return size if size < SHORT else math.ceil(threshold * size - 1e-9)


class TemplateIndex:
    """Templates with their words in global order, and the prefix words that lead to them."""

    def __init__(self, templates, frequencies: Mapping[str, int], threshold: float):
        words = vocabulary(templates)
        words.sort(key=lambda w: (frequencies.get(w, 0), w))
        self.order = {word.encode(): i for i, word in enumerate(words)}
        self.templates = [
            (label, sorted({self.order[w.encode()] for w in text.split()}))
            for label, text in templates
        ]
        self.needed = [needed_of(text, threshold) for _, text in templates]
        self.steps = [step_of(text) for _, text in templates]
        self.rivals = [
            {
                j
                for j, (_, other) in enumerate(self.templates)
                if j != i and self.steps[j] == self.steps[i]
                and len(set(own) & set(other)) >= self.needed[i]
            }
            for i, (_, own) in enumerate(self.templates)
        ]
        self.prefixes: dict[int, list[tuple[int, int]]] = {}
        for number, (_, tokens) in enumerate(self.templates):
            for place, token in enumerate(tokens[: len(tokens) - self.needed[number] + 1]):
                self.prefixes.setdefault(token, []).append((number, place))
        leading = [re.escape(word) for word, i in self.order.items() if i in self.prefixes]
        self.leading = re.compile(
            rb"(?<![0-9a-z\x80-\xff])(?:" + b"|".join(leading) + rb")(?![0-9a-z\x80-\xff])"
        )

    def matches(self, data: bytes, words: list[bytes]) -> list[tuple[str, int, int, float]]:
        """(label, first word, words, containment) of every block and template that match."""
        if not self.leading.search(data):
            return []
        spots = [(i, self.order[w]) for i, w in enumerate(words) if w in self.order]
        places = [i for i, _ in spots]
        asked: dict[tuple[int, int], set[int]] = {}
        for i, token in spots:
            for number, _ in self.prefixes.get(token, ()):
                step = self.steps[number]
                for block in {i // step, max(i // step - 1, 0)}:
                    asked.setdefault((step, block), set()).add(number)
        found = []
        for (step, block), numbers in sorted(asked.items()):
            start = block * step
            held = spots[bisect_left(places, start) : bisect_left(places, start + 2 * step)]
            overlaps = self._overlaps(sorted({token for _, token in held}), numbers)
            for number, overlap in overlaps.items():
                label, template = self.templates[number]
                share = overlap / len(template)
                better = (
                    (overlaps[r] / len(self.templates[r][1]), overlaps[r])
                    for r in self.rivals[number] & overlaps.keys()
                )
                if not any(rival > (share, overlap) for rival in better):
                    found.append((label, start, 2 * step, share))
        return found

    def _overlaps(self, tokens: list[int], numbers: set[int]) -> dict[int, int]:
        """How many words a block of these tokens shares with each template that it matches."""
        held, tried, found = set(tokens), set(), {}
        for place, token in enumerate(tokens):
            for number, position in self.prefixes.get(token, ()):
                if number in tried or number not in numbers:
                    continue
                tried.add(number)  # the first shared word: none is shared before it
                template = self.templates[number][1]
                most = min(len(tokens) - place, len(template) - position)
                if len(tokens) < self.needed[number] or most < self.needed[number]:
                    continue
                overlap = sum(t in held for t in template)
                if overlap >= self.needed[number]:
                    found[number] = overlap
        return found


class Phrases:
    """Places where the words of a phrase stand one after another."""

    def __init__(self, phrases: Mapping[str, str]):
        self.phrases = [(p.encode().split(), label) for p, label in phrases.items()]
        gap = rb"[\x00-\x2f\x3a-\x60\x7b-\x7f]+"
        self.any = re.compile(
            b"|".join(gap.join(map(re.escape, words)) for words, _ in self.phrases)
        )

    def places(self, data: bytes, words: list[bytes]) -> list[tuple[int, str]]:
        if not self.any.search(data):
            return []
        return sorted(
            (start, label)
            for phrase, label in self.phrases
            for start, word in enumerate(words)
            if word == phrase[0] and words[start : start + len(phrase)] == phrase
        )


def scan(
    documents: DataFrame,
    *,
    text: str = "text",
    carry: list[str],
    phrases: Mapping[str, str] = PHRASES,
    templates=TEMPLATES,
    threshold: float = 0.8,
) -> DataFrame:
    """The carried columns, n_words, places (word number from 0, label) of phrases in order, and
    matches (label, start, words, containment) of blocks, by their first word and number of words,
    with templates.

    A-Z are lower-cased first. Null and empty texts have no words, places or matches; repeated rows
    stay. Carried columns must not be called n_words, places or matches; others are neither read nor
    returned. Two passes over the text and no shuffle of it; templates and their word counts are
    bounded by the list.
    """
    frequencies = word_frequencies(documents, text, vocabulary(templates))
    fixed, index = Phrases(phrases), TemplateIndex(templates, frequencies, threshold)

    def work(texts: list[str | None]) -> list[pa.Array]:
        counts, places, matches = [], [], []
        for one in texts:
            data = (one or "").encode().lower()
            words = WORD.findall(data)
            counts.append(len(words))
            places.append([{"word": w, "label": label} for w, label in fixed.places(data, words)])
            names = ("label", "start", "words", "containment")
            matches.append([dict(zip(names, m, strict=True)) for m in index.matches(data, words)])
        kinds = (
            {"word": pa.int64(), "label": pa.string()},
            {
                "label": pa.string(),
                "start": pa.int64(),
                "words": pa.int64(),
                "containment": pa.float64(),
            },
        )
        return [pa.array(counts, pa.int64())] + [
            pa.array(rows, pa.list_(pa.struct(list(kind.items()))))
            for rows, kind in zip((places, matches), kinds, strict=True)
        ]

    added = (
        "n_words long, places array<struct<word:long,label:string>>, "
        "matches array<struct<label:string,start:long,words:long,containment:double>>"
    )
    return map_texts(documents, text, carry, added, work)


def summary(scanned: DataFrame, carry: list[str]) -> DataFrame:
    """One row per text: counts, first and last place, labels joined by commas, and the score: the
    largest containment, 1 where a phrase stands, else 0."""
    base = F.col("places.label")
    every = F.concat(base, F.col("matches.label"))
    labels = [F.array_join(F.array_sort(F.array_distinct(c)), ",") for c in (base, every)]
    return scanned.select(
        *carry,
        "n_words",
        F.size("places").cast("long").alias("n_base"),
        F.array_min("places.word").alias("first_word"),
        F.array_max("places.word").alias("last_word"),
        labels[0].alias("base_labels"),
        labels[1].alias("labels"),
        F.when(F.size("places") > 0, 1.0)
        .otherwise(F.coalesce(F.array_max("matches.containment"), F.lit(0.0)))
        .alias("score"),
    )
