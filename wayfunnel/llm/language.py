"""Languages of a text as a mixture, found by expectation-maximisation over n-grams.

Each language is a distribution over byte trigrams. A text mixes languages in unknown proportions;
the language set grows one language at a time while the likelihood, less a charge per language,
improves.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayfunnel.llm.common import fresh, map_texts, runs

BUCKETS = 1 << 16
UNKNOWN = "und"
LETTER = re.compile(r"[^\W\d_]")


def _letters() -> np.ndarray:
    """Bytes as they count in a trigram: letters and parts of them as they are, all else a gap."""
    table = np.zeros(256, np.uint32)
    for byte in (*range(ord("a"), ord("z") + 1), *range(128, 256)):
        table[byte] = byte
    return table


def _codes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """The text number and the three bytes of each trigram around a letter, in order of the texts."""
    encoded = [(text or "").lower().encode() for text in texts]
    data = np.frombuffer(b"\n" + b"\n".join(encoded) + b"\n", np.uint8)
    letters = _letters()[data]
    middle = np.flatnonzero(letters)
    code = (letters[middle - 1] << 16) | (letters[middle] << 8) | letters[middle + 1]
    ends = np.cumsum([len(e) + 1 for e in encoded])
    return np.searchsorted(ends, middle, side="left").astype(np.int64), code


def _buckets(code: np.ndarray) -> np.ndarray:
    return ((code * np.uint32(2654435761)) >> np.uint32(16)).astype(np.int64)


def grams(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """The text number and bucket of each trigram around a letter, in order of the texts."""
    row, code = _codes(texts)
    return row, _buckets(code)


def _tally(texts: list[str | None]) -> np.ndarray:
    """How often each bucket occurs, then each byte as a middle letter; byte 0: gaps before one."""
    code = _codes(texts)[1]
    letters = np.bincount((code >> 8) & 255, minlength=256)
    letters[0] = np.count_nonzero(code < 1 << 16)
    return np.concatenate([np.bincount(_buckets(code), minlength=BUCKETS), letters])


def gram_counts(documents: DataFrame, text: str, language: str) -> DataFrame:
    """(language, bucket, n) over whole texts, letters after the buckets; each task adds up before
    it sends anything."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}

        def rows() -> Iterator[pa.RecordBatch]:
            for name, counts in totals.items():
                seen = np.flatnonzero(counts)
                yield pa.RecordBatch.from_pydict(
                    {"language": [name] * len(seen), "bucket": seen, "n": counts[seen]}
                )
            totals.clear()

        for batch in batches:
            texts, names = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            groups: dict[str, list[str]] = {}
            for one, name in zip(texts, names, strict=True):
                groups.setdefault(name, []).append(one)
            for name, group in groups.items():
                found = totals.setdefault(name, np.zeros(BUCKETS + 256, np.int64))
                for start in range(0, len(group), 256):
                    found += _tally(group[start : start + 256])
                if len(totals) >= 64:
                    yield from rows()
        yield from rows()

    known = documents.where(F.col(text).isNotNull() & F.col(language).isNotNull())
    parts = known.select(F.col(text).cast("string"), F.col(language).cast("string")).mapInArrow(
        counted, "language string, bucket long, n long"
    )
    return parts.groupBy("language", "bucket").agg(F.sum("n").alias("n"))


@dataclass(frozen=True)
class Profiles:
    """Languages in alphabetical order and the chance of each bucket in each language; in
    background, in text of none of them: its letters drawn one by one, and all buckets alike."""

    languages: tuple[str, ...]
    chance: np.ndarray = field(repr=False)
    background: np.ndarray = field(repr=False)


def _background(letters: np.ndarray) -> np.ndarray:
    """From a column of letter counts per language, the chance of each bucket if letters and gaps
    come independently, averaged over the languages, and the same chance for every bucket."""
    found = np.full((BUCKETS, 2), 1 / BUCKETS)
    left, right = np.meshgrid(np.arange(256, dtype=np.uint32), np.arange(256, dtype=np.uint32), indexing="ij")
    seen = [np.flatnonzero(column[1:]) + 1 for column in letters.T]
    models = []
    for column, used in zip(letters.T, seen, strict=True):
        middle = column / max(1, column[1:].sum())
        gap = min(1.0, middle[0])
        side = middle * (1 - gap)
        side[0] = gap
        beside = np.outer(side, side)
        model = np.zeros(BUCKETS)
        for letter in used.tolist():
            code = (left << 16) | np.uint32(letter << 8) | right
            model += np.bincount(_buckets(code).ravel(), (middle[letter] * beside).ravel(), BUCKETS)
        models.append(model)
    if models:
        found[:, 0] = np.mean(models, axis=0)
    # never zero, so that its logarithm is finite
    return (0.999 * found + 0.001 / BUCKETS).astype(np.float32)


def learn(
    documents: DataFrame, *, text: str = "text", language: str = "lang", smoothing: float = 0.5
) -> Profiles:
    """Profiles from all rows with a text and a language. At most 65,792 numbers per language come
    to the driver; the number of languages is that of the language codes in the column."""
    counts = gram_counts(documents, text, language).toPandas()
    languages = tuple(sorted(counts["language"].unique()))
    table = np.zeros((BUCKETS + 256, len(languages)))
    columns = np.searchsorted(np.array(languages, dtype=object), counts["language"].to_numpy())
    table[counts["bucket"].to_numpy(np.int64), columns.astype(np.int64)] = counts["n"].to_numpy()
    table, letters = table[:BUCKETS] + smoothing, table[BUCKETS:]
    chance = (table / table.sum(axis=0)).astype(np.float32)
    return Profiles(languages, chance, _background(letters))


def _sums(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    return np.add.reduceat(values, starts, axis=0, dtype=np.float64)


def mixtures(
    texts: list[str | None],
    profiles: Profiles,
    *,
    charge: float,
    steps: int,
    background: bool = False,
) -> np.ndarray:
    """Proportions of the languages per text; zeros where there is no letter.

    With background, text of no learnt language may take a part of its own, and proportions sum
    to 1 less that part. To be all of a text, it has to be likelier by the charge of a language.
    """
    size = len(profiles.languages)
    chances = np.hstack([profiles.chance, profiles.background]) if background else profiles.chance
    shares = np.zeros((len(texts), size))
    if not size:
        return shares
    row, bucket = grams(texts)
    if not len(row):
        return shares
    key = np.sort(row * BUCKETS + bucket)
    bounds = runs(key)
    count = np.diff(bounds).astype(np.float32)
    key = key[bounds[:-1]]
    row, bucket = key // BUCKETS, key % BUCKETS
    starts = runs(row)[:-1]
    texts_with = row[starts]
    weight = count[:, None]
    total = _sums(count, starts)
    charges = charge * np.log1p(total)
    single = _sums(weight * np.log(chances)[bucket], starts)
    handicap = np.where(np.arange(chances.shape[1]) < size, 0, charges[:, None])
    chosen = (single - handicap).argmax(axis=1)[:, None]
    likelihood = np.take_along_axis(single, chosen, axis=1)[:, 0]
    found = np.zeros_like(single)
    np.put_along_axis(found, chosen, 1.0, axis=1)
    open_rows = np.arange(len(starts))
    ends = np.append(starts[1:], len(key))
    while len(open_rows) and chosen.shape[1] < chances.shape[1]:
        # the trigrams of the texts that may still gain a language
        sizes = (ends - starts)[open_rows]
        first = np.cumsum(sizes) - sizes
        where = np.repeat(starts[open_rows] - first, sizes) + np.arange(sizes.sum())
        owner = np.repeat(np.arange(len(open_rows)), sizes)
        chance, weight = chances[bucket[where]], count[where]
        mixed = (found[open_rows].astype(np.float32)[owner] * chance).sum(axis=1)
        gain = _sums((weight / mixed)[:, None] * chance, first) / total[open_rows][:, None]
        gain[found[open_rows] > 0] = 0
        np.put_along_axis(gain, chosen, 0, axis=1)
        # at a gain of 1 or less the mixture without the language is the best there is
        rising = gain.max(axis=1) > 1
        candidate = np.concatenate([chosen, gain.argmax(axis=1)[:, None]], axis=1)
        part = np.take_along_axis(chance, candidate[owner], axis=1)
        share = np.full(candidate.shape, 1 / candidate.shape[1], np.float32)
        for _ in range(steps):
            joint = share[owner] * part
            joint *= (weight / joint.sum(axis=1))[:, None]
            share = (_sums(joint, first) / total[open_rows][:, None]).astype(np.float32)
        fit = _sums(weight * np.log((share[owner] * part).sum(axis=1)), first)
        better = rising & (fit - likelihood[open_rows] > charges[open_rows])
        kept = open_rows[better]
        likelihood[kept] = fit[better]
        found[kept] = 0
        rows = np.repeat(kept[:, None], candidate.shape[1], axis=1)
        found[rows, candidate[better]] = share[better]
        chosen, open_rows = candidate[better], kept
    shares[texts_with] = (found / found.sum(axis=1, keepdims=True))[:, :size]
    return shares


def detect(
    documents: DataFrame,
    profiles: Profiles,
    *,
    text: str = "text",
    carry: list[str],
    charge: float = 4.0,
    steps: int = 12,
    names: tuple[str, str, str] = ("lang_pred", "score", "mixture"),
) -> DataFrame:
    """The carried columns, the main language, its proportion, and all proportions above zero.

    A text that is null or has no letter is 'und' with score 0 and an empty mixture, as is every
    text if nothing could be learnt. Equal proportions go to the first language in the alphabet.
    Repeated rows are told each. Carried columns must not have one of the `names`; others are
    neither read nor returned.
    """

    def work(texts: list[str | None]) -> list[pa.Array]:
        shares = mixtures(texts, profiles, charge=charge, steps=steps)
        known = [bool(text and LETTER.search(text)) for text in texts]
        best = shares.argmax(axis=1) if len(profiles.languages) else np.zeros(len(texts), int)
        main, score, mixture = [], [], []
        for i, is_text in enumerate(known):
            sure = is_text and len(profiles.languages) and shares[i, best[i]] > 0
            main.append(profiles.languages[best[i]] if sure else UNKNOWN)
            score.append(float(min(1.0, shares[i, best[i]])) if sure else 0.0)
            parts = np.flatnonzero(shares[i]) if sure else []
            mixture.append([(profiles.languages[k], float(shares[i, k])) for k in parts])
        kind = pa.map_(pa.string(), pa.float64())
        return [pa.array(main), pa.array(score, pa.float64()), pa.array(mixture, kind)]

    added = f"`{names[0]}` string, `{names[1]}` double, `{names[2]}` map<string,double>"
    return map_texts(documents, text, carry, added, work, at_once=2_000_000)


def keep_known(
    documents: DataFrame,
    trained: Column,
    *,
    text: str = "text",
    language: str = "lang",
    least: float = 0.5,
    charge: float = 4.0,
    steps: int = 12,
) -> DataFrame:
    """The documents, all columns, of which the learnt languages together make up the least
    proportion; the rest is background. So a text in several of them stays, one in another
    language or without words goes, and the number of languages does not matter."""
    profiles = learn(documents.where(trained), text=text, language=language)

    def work(texts: list[str | None]) -> list[pa.Array]:
        shares = mixtures(texts, profiles, charge=charge, steps=steps, background=True).sum(axis=1)
        letters = np.array([bool(text and LETTER.search(text)) for text in texts], bool)
        return [pa.array(letters & (shares > 0) & (shares >= least - 1e-9))]

    name = fresh("known", documents.columns)
    found = map_texts(
        documents, text, documents.columns, f"`{name}` boolean", work, at_once=2_000_000
    )
    return found.where(F.col(name)).drop(name)
