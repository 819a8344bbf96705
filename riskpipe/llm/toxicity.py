"""Toxicity by a chain of classifiers.

Categories are predicted one after the other by linear models; each model also sees the log-odds of
the categories before it. To train a later model on what it will see, the earlier ones' outputs on
labelled rows are out-of-fold: each row is predicted by a model that was fitted without its fold.

The chain: ``low_quality`` (label ``quality`` 0), ``toxic`` (label ``toxic``), and ``severe``, those
toxic rows that hold at least as many tell-tale features, in proportion to their words, as half of
them do. Other categories can be given as any 0/1 columns.

Features are a text's distinct words in lower case and their first five, six and seven letters, so
that forms of an abusive stem count together; they are hashed into 2^18 places. Models are fitted on
about ``MAX_PER_CLASS`` labelled rows with, and as many without, each of the two labels, chosen by
a hash of the id. All texts are scored, whole.

A null text is empty. Null labels are no labels, and ids that several rows carry are learned from
row by row. Without a labelled row every probability is 0. Repeated rows are scored row by row.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Sequence

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskpipe.llm.shared import about, checkpointed, map_columns, texts

PLACES = 1 << 18
PREFIXES = (5, 6, 7)
MAX_PER_CLASS = 3000
FOLDS = 4
EPOCHS = 8
BATCH_ROWS = 128
RATE = 0.2
DECAY = 1e-4
SMOOTHING = 1.0
MIN_ROWS = 5
FIRST_WEIGHT = 0.05
THRESHOLD = 0.4
CATEGORIES = ("low_quality", "toxic", "severe")
SEED = 3
#: Words a Python worker remembers the places of.
CACHED_WORDS = 200_000

_WORD = re.compile(r"\w+")


class _Places(dict):
    def __missing__(self, word: str) -> tuple[int, ...]:
        if len(self) >= CACHED_WORDS:
            self.clear()
        forms = [word, *(f"{word[:n]}*{n}" for n in PREFIXES if len(word) >= n)]
        places = tuple(xxhash.xxh3_64_intdigest(f) % PLACES for f in forms)
        if len(word) <= 40:
            self[word] = places
        return places


_places = functools.cache(_Places)


def features(text: str) -> bytes:
    """The places of a text's distinct features, sorted, as little-endian 32-bit integers."""
    known = _places()
    found: set[int] = set()
    for word in set(_WORD.findall(text.lower())):
        found.update(known[word])
    return np.array(sorted(found), "<i4").tobytes()


class Rows:
    """Feature places of several texts in one array."""

    def __init__(self, parts: Sequence[bytes]) -> None:
        arrays = [np.frombuffer(p, "<i4") for p in parts]
        self.n = len(arrays)
        self.ends = np.cumsum([0, *map(len, arrays)])
        self.places = np.concatenate(arrays) if arrays else np.zeros(0, "<i4")

    def take(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of the given rows, and which of them each belongs to."""
        sizes = self.ends[rows + 1] - self.ends[rows]
        owner = np.repeat(np.arange(len(rows)), sizes)
        start = np.repeat(self.ends[rows] - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes)
        return self.places[np.arange(len(owner)) + start], owner


class Linear:
    """Logistic regression over places and a few dense inputs, by AdaGrad.

    A place counts by its log-odds among the rows fitted on, so that the many places that say
    nothing do not drown the few that tell.
    """

    def __init__(self, dense: int) -> None:
        self.places = np.zeros(PLACES)  # weights, odds included
        self.dense = np.zeros(dense + 1)

    def margins(self, rows: Rows, which: np.ndarray, dense: np.ndarray) -> np.ndarray:
        places, owner = rows.take(which)
        ones = np.ones((len(which), 1))
        return np.bincount(owner, self.places[places], len(which)) + np.hstack([dense, ones]) @ self.dense

    def fit(self, rows: Rows, which: np.ndarray, dense: np.ndarray, truth: np.ndarray) -> Linear:
        rng = np.random.default_rng(SEED)
        places, owner = rows.take(which)
        with_, without = (
            np.bincount(places, (truth == v)[owner], PLACES) + SMOOTHING for v in (1, 0)
        )
        odds = np.log(with_ / without) - np.log(with_.sum() / without.sum())
        odds[(with_ + without) - 2 * SMOOTHING < MIN_ROWS] = 0
        weights = np.full(PLACES, FIRST_WEIGHT)
        self.places = odds * weights
        seen_places, seen_dense = np.full(PLACES, 1e-2), np.full(len(self.dense), 1e-2)
        for _ in range(EPOCHS):
            order = rng.permutation(len(which))
            for at in range(0, len(order), BATCH_ROWS):
                part = order[at : at + BATCH_ROWS]
                slope = _sigmoid(self.margins(rows, which[part], dense[part])) - truth[part]
                places, owner = rows.take(which[part])
                used, back = np.unique(places, return_inverse=True)
                step = odds[used] * np.bincount(back, slope[owner]) / len(part) + DECAY * weights[used]
                seen_places[used] += step * step
                weights[used] -= RATE * step / np.sqrt(seen_places[used])
                self.places[used] = odds[used] * weights[used]
                step = np.hstack([dense[part], np.ones((len(part), 1))]).T @ slope / len(part)
                seen_dense += step * step
                self.dense -= 5 * RATE * step / np.sqrt(seen_dense)
        return self


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(np.asarray(x) / 2))


def fit_chain(rows: Rows, truths: np.ndarray) -> list[Linear]:
    """One model for each column of ``truths`` (0/1), in turn."""
    every = np.arange(rows.n)
    fold = np.random.default_rng(SEED).permutation(rows.n) % FOLDS
    dense = np.zeros((rows.n, 0))
    models = []
    for column in truths.T:
        models.append(Linear(dense.shape[1]).fit(rows, every, dense, column))
        outside = np.zeros(rows.n)
        for f in range(FOLDS):
            inside = every[fold != f]
            part = Linear(dense.shape[1]).fit(rows, inside, dense[inside], column[inside])
            outside[fold == f] = part.margins(rows, every[fold == f], dense[fold == f])
        dense = np.hstack([dense, _input(outside)[:, None]])
    return models


def _input(margins: np.ndarray) -> np.ndarray:
    return np.clip(margins, -6, 6) / 3


def chain_probabilities(models: list[Linear], rows: Rows) -> np.ndarray:
    """A column of probabilities for each category."""
    every, dense, found = np.arange(rows.n), np.zeros((rows.n, 0)), []
    for model in models:
        margins = model.margins(rows, every, dense)
        found.append(_sigmoid(margins))
        dense = np.hstack([dense, _input(margins)[:, None]])
    return np.stack(found, axis=1) if found else np.zeros((rows.n, len(CATEGORIES)))


def severity(rows: Rows, toxic: np.ndarray) -> np.ndarray:
    """Which toxic rows have tell-tale features in at least the median proportion."""
    owner = np.repeat(np.arange(rows.n), np.diff(rows.ends))
    with_, without = (
        np.bincount(rows.places[toxic[owner] == v], minlength=PLACES) for v in (1, 0)
    )
    telling = (with_ >= 3) & (without <= 0.1 * with_)
    share = np.bincount(owner, telling[rows.places], rows.n) / np.maximum(1, np.diff(rows.ends))
    middle = np.median(share[toxic == 1]) if toxic.any() else np.inf
    return ((toxic == 1) & (share >= max(middle, 1e-9))).astype(float)


def learn(df: DataFrame, labels: DataFrame) -> list[Linear]:
    """The chain's models from labelled texts."""
    known = labels.select("doc_id", "quality", "toxic").filter(
        "doc_id is not null and quality is not null and toxic is not null"
    )

    def chosen(condition: str) -> DataFrame:
        return about(known.filter(condition), MAX_PER_CLASS, "doc_id")

    picks = [chosen(c) for c in ("toxic = 1", "toxic = 0", "quality = 0", "quality = 1")]
    sample = checkpointed(picks[0].union(picks[1]).union(picks[2]).union(picks[3]).distinct())
    # about 4 * MAX_PER_CLASS rows of three numbers
    bodies = texts(df).join(F.broadcast(sample), "doc_id").select(
        F.struct("doc_id", "quality", "toxic").alias("key"), "text"
    )
    found = map_columns(
        bodies,
        lambda keys, rows: [(k, features(t)) for k, t in zip(keys, rows, strict=True)],
        "key",
        "features binary",
    ).collect()
    if not found:
        return []
    found.sort(key=lambda r: (r["key"]["doc_id"], r["features"]))
    rows = Rows([bytes(r["features"]) for r in found])
    bad = np.array([r["key"]["quality"] == 0 for r in found], float)
    toxic = np.array([r["key"]["toxic"] == 1 for r in found], float)
    return fit_chain(rows, np.stack([bad, toxic, severity(rows, toxic)], axis=1))


def toxicity(df: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id``, a probability for each category, and ``predicted`` (0/1) for ``toxic``."""
    models = learn(df, labels)

    def rows(keys: list, bodies: list[str]) -> list[tuple]:
        found = chain_probabilities(models, Rows([features(t) for t in bodies]))
        return [(k, *map(float, p)) for k, p in zip(keys, found, strict=True)]

    scores = map_columns(
        texts(df), rows, "doc_id", ", ".join(f"{name} double" for name in CATEGORIES)
    )
    return scores.withColumn("predicted", _is(F.col("toxic")))


def _is(probability: Column) -> Column:
    return (probability >= THRESHOLD).cast("int")
