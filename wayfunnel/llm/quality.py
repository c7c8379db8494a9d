"""Quality scores learnt from preferences between pairs of documents.

Bradley-Terry model: a document's strength is a weighted sum of text features, and the chance that
one document is preferred over another is the logistic function of the difference in strength. The
weights minimise the logistic loss on feature differences of pairs (labelled good, labelled bad).
The strength that cuts off the share of bad labels, a quantile over all labelled training rows,
becomes the threshold.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayfunnel.llm.common import fresh, map_texts, written

FEATURES = (
    "log_words",
    "upper",
    "symbols",
    "pipes",
    "bangs",
    "digits",
    "non_space",
    "repeated_words",
    "repeated_lines",
    "commonest_word",
    "distinct_words",
    "word_length",
    "marked_words",
)
SYMBOLS = b"#$%&*@^~<>{}[]\\=+_"


def text_features(text: str | None) -> list[float]:
    """One value per name in FEATURES; null and empty texts have zeros throughout."""
    data = (text or "").encode()
    words = data.split()
    if not words:
        return [0.0] * len(FEATURES)

    def share(characters: bytes) -> float:
        return (len(data) - len(data.translate(None, characters))) / len(data)

    n = len(words)
    frequency: dict[bytes, int] = {}
    for word in words:
        frequency[word] = frequency.get(word, 0) + 1
    same = sum(map(bytes.__eq__, words, words[1:]))
    lines = [line for line in data.split(b"\n") if line.strip()]
    capitals = len(data) - len(data.translate(None, b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"))
    small = len(data) - len(data.translate(None, b"abcdefghijklmnopqrstuvwxyz"))
    symbols = share(SYMBOLS)
    return [
        math.log1p(n),
        capitals / (capitals + small + 1),
        math.sqrt(symbols),
        math.sqrt(share(b"|")),
        math.sqrt(share(b"!")),
        math.sqrt(share(b"0123456789")),
        sum(map(len, words)) / len(data),
        same / (n + 5),
        1 - len(set(lines)) / len(lines),
        max(frequency.values()) / (n + 5),
        math.log1p(len(frequency)) / math.log1p(n),
        min(sum(map(len, words)) / n, 30.0) / 10,
        min(1.0, symbols * len(data) / n),
    ]


def _features(texts: list[str | None]) -> list[pa.Array]:
    return [pa.array([text_features(text) for text in texts], pa.list_(pa.float64()))]


def with_features(
    documents: DataFrame, text: str, carry: list[str], name: str = "features"
) -> DataFrame:
    """The carried columns and an array of features of each whole text."""
    return map_texts(documents, text, carry, f"`{name}` array<double>", _features)


@dataclass(frozen=True)
class Ranker:
    centre: tuple[float, ...]
    weights: tuple[float, ...]
    cutoff: float
    spread: float
    threshold: float

    def strength(self, features: str = "features") -> Column:
        return strength(F.col(features), self.centre, self.weights)

    def score(self, features: str = "features") -> Column:
        """Between 0 and 1; equal to the threshold where the strength is the cutoff."""
        odds = math.log(self.threshold / (1 - self.threshold))
        scaled = (self.strength(features) - self.cutoff) / self.spread + odds
        bounded = F.greatest(F.lit(-700.0), F.least(F.lit(700.0), scaled))
        return 1.0 / (1.0 + F.exp(-bounded))


def strength(features: Column, centre, weights) -> Column:
    terms = [
        (F.get(features, F.lit(i)) - F.lit(float(c))) * F.lit(float(w))
        for i, (c, w) in enumerate(zip(centre, weights, strict=True))
    ]
    total = terms[0]
    for term in terms[1:]:
        total = total + term
    return total


def fit_pairs(
    good: np.ndarray, bad: np.ndarray, *, pairs: int, penalty: float, seed: int, steps: int = 50
) -> np.ndarray:
    """Weights by Newton's method on the logistic loss of differences good - bad."""
    order = np.random.default_rng(seed)
    better, worse = (order.integers(len(side), size=pairs) for side in (good, bad))
    difference = good[better] - bad[worse]
    weights = np.zeros(difference.shape[1])
    for _ in range(steps):
        wrong = 1 / (1 + np.exp(np.clip(difference @ weights, -700, 700)))
        slope = penalty * weights - difference.T @ wrong / pairs
        curve = (difference.T * (wrong * (1 - wrong))) @ difference / pairs
        step = np.linalg.solve(curve + penalty * np.eye(len(weights)), slope)
        weights -= step
        if np.abs(step).max() < 1e-9:
            break
    return weights


def fit_ranker(
    labelled: DataFrame,
    *,
    label: str = "label",
    key: str = "doc_id",
    sample: int = 20_000,
    pairs: int = 100_000,
    penalty: float = 1e-3,
    threshold: float = 0.3,
    margin: float = 0.004,
    seed: int = 7,
) -> Ranker:
    """Learns from rows (key, features, label 0/1); rows with another label are left out.

    sample bounds the rows of each label that are brought to the driver for the weights, taken in
    hash order of the key. The cutoff is a quantile of the strength of all rows. Without rows of
    both labels the weights are zero, and every document scores the threshold or, if all labels
    are 0, less.
    """
    known = labelled.where(F.col(label).isin(0, 1)).select(
        F.col(label).cast("int").alias("label"),
        "features",
        F.xxhash64(F.col(key), F.lit(seed)).alias("h"),
    )
    sides = []
    for value in (0, 1):
        rows = known.where(F.col("label") == value).orderBy("h").limit(sample).collect()
        values = np.array([r["features"] for r in rows], float)
        sides.append(values.reshape(len(rows), len(FEATURES)))
    bad, good = sides
    if not len(bad) or not len(good):
        blank = (0.0,) * len(FEATURES)
        return Ranker(blank, blank, 1.0 if len(bad) else 0.0, 1.0, threshold)
    both = np.concatenate(sides)
    centre, scale = both.mean(axis=0), np.maximum(both.std(axis=0), 1e-6)
    weights = fit_pairs(
        (good - centre) / scale, (bad - centre) / scale, pairs=pairs, penalty=penalty, seed=seed
    )
    weights = weights / scale
    strengths = known.select("label", strength(F.col("features"), centre, weights).alias("s"))
    cutoff, spread = _cutoff(strengths, margin)
    return Ranker(
        tuple(map(float, centre)), tuple(map(float, weights)), cutoff, spread, threshold
    )


def _cutoff(strengths: DataFrame, margin: float) -> tuple[float, float]:
    """Half-way between the quantiles a margin below and above the share of bad labels, and the
    distance between the quartiles; from mergeable summaries of all rows."""
    share = strengths.agg(F.avg(1.0 - F.col("label"))).first()[0]
    wanted = [max(0.0, share - margin), min(1.0, share + margin), 0.25, 0.75]
    below, above, low, high = strengths.agg(F.percentile_approx("s", wanted, 20_000)).first()[0]
    return (below + above) / 2, max(high - low, 1e-6)


def labelled_rows(features: DataFrame, labels: DataFrame, key: str, label: str) -> DataFrame:
    """Features joined with labels by key. A key labelled twice counts with its smallest label;
    null keys and null labels are left out."""
    single = (
        labels.where(F.col(key).isNotNull() & F.col(label).isNotNull())
        .groupBy(F.col(key).alias("_key"))
        .agg(F.min(label).alias("label"))
    )
    return features.join(single, features[key] == F.col("_key")).select(
        features[key], "features", "label"
    )


def score_documents(
    documents: DataFrame,
    labels: DataFrame,
    trained: Column,
    *,
    key: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    **fitting,
) -> DataFrame:
    """One row per document: key, score, predicted (score >= threshold).

    Reads whole texts once: the features of all documents are written, those that `trained` (on
    the key) selects are learnt from, all are scored. Null and empty texts have zero features and
    a score like any other; repeated rows stay.
    """
    features = written(with_features(documents, text, [key]), "quality")
    ranker = fit_ranker(
        labelled_rows(features.where(trained), labels, key, label), key=key, **fitting
    )
    return features.select(key, ranker.score().alias("score")).withColumn(
        "predicted", (F.col("score") >= ranker.threshold).cast("int")
    )


def keep_good(
    documents: DataFrame,
    labels: DataFrame,
    trained: Column,
    *,
    key: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    **fitting,
) -> DataFrame:
    """The documents, all columns, that score at least the threshold.

    Features are computed twice, to learn from and to decide by, so that no text shuffles: only
    the features meet the labels.
    """
    features = written(with_features(documents, text, [key]), "quality")
    features = features.where(trained)
    ranker = fit_ranker(labelled_rows(features, labels, key, label), key=key, **fitting)
    name = fresh("features", documents.columns)
    scored = with_features(documents, text, documents.columns, name)
    return scored.where(ranker.score(name) >= ranker.threshold).drop(name)
