"""A quality classifier from positive and unlabelled texts.

Trusted positives are labelled rows with ``quality`` 1; rows labelled 0 are never used as such. The
unlabelled texts are documents of any kind. A small network over measures of a text's shape is
trained by non-negative unbiased risk: with class prior p and loss l,

    p E_P[l(+g)]  +  max(0, E_U[l(-g)] - p E_P[l(-g)])

and where the second part falls below zero, a step is taken to raise it again. The prior is
estimated first: a classifier of positives against unlabelled texts is split into thresholds, and
the least share of unlabelled over positive texts above one of them, with a margin for the sample
size, bounds the share of positives from above. The unlabelled texts above each are counted over all rows.

Rows whose ``crc32`` of the id, modulo 4, is 2 are held out: neither their labels nor their texts
are learned from. Labels, language, source and id are no inputs of a score. One pass makes the
measures of all texts; training collects those of about ``MAX_POSITIVE`` and ``MAX_UNLABELLED``
rows, chosen by a hash of the id below a bound that follows from their number; all texts are scored.

A null text is empty and has a score like any other. A null id is not held out and not learned from.
Without a positive to learn from every score is 0.5. Repeated rows are scored row by row.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskpipe.llm.shared import about, checkpointed, map_columns, texts

MAX_POSITIVE = 20_000
MAX_UNLABELLED = 40_000
THRESHOLD = 0.7
HIDDEN = 24
EPOCHS = 60
BATCHES = 20
SEED = 5

N_MEASURES = 16
_SYMBOLS = frozenset(b"#*$%&|<>~^=_{}[]\\")
_COUNTED = [bytes(sorted(_SYMBOLS)), b"!?", b".", b",;:", bytes(range(48, 58))]


def measures(text: str) -> list[float]:
    """Shares and means that describe a text's shape, whatever its language."""
    raw = text.encode()
    words = raw.split()
    n, size = max(1, len(words)), max(1, len(raw))
    counts = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    lines = [line for line in raw.split(b"\n") if line.strip()]
    by_word = Counter(words)
    pairs = Counter(zip(words, words[1:], strict=False))
    capitals = sum(map(str.isupper, text)) if not raw.isascii() else int(counts[65:91].sum())
    lone = sum(by_word[w] for w in by_word if len(w) == 1 and not w.isalnum())
    return [
        *(float(counts[list(group)].sum()) / n for group in _COUNTED),
        capitals / size,
        float(np.log1p(len(words))),
        len(by_word) / n,
        max(by_word.values(), default=0) / n,
        sum(a == b for a, b in zip(words, words[1:], strict=False)) / n,
        1 - len(pairs) / max(1, len(words) - 1),
        size / n,
        float(np.log1p(max(map(len, words), default=0))),
        1 - len(set(lines)) / max(1, len(lines)),
        float(np.log1p(len(words) / max(1, len(lines)))),
        lone / n,
    ]


def measured(df: DataFrame) -> DataFrame:
    """``doc_id, held_out, measures`` of every row."""
    rows = map_columns(
        texts(df),
        lambda keys, bodies: [(k, measures(t)) for k, t in zip(keys, bodies, strict=True)],
        "doc_id",
        "measures array<double>",
    )
    return rows.select("doc_id", held_out().alias("held_out"), "measures")


def held_out() -> Column:
    rest = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4
    return F.coalesce(rest == 2, F.lit(False))


class Network:
    """One hidden layer over scaled measures; gradients by hand."""

    def __init__(self, inputs: np.ndarray, seed: int = SEED) -> None:
        rng = np.random.default_rng(seed)
        self.mean, self.scale = inputs.mean(0), inputs.std(0) + 1e-6
        n = inputs.shape[1]
        self.weights = [
            rng.normal(0, 1 / np.sqrt(n), (n, HIDDEN)),
            np.zeros(HIDDEN),
            rng.normal(0, 1 / np.sqrt(HIDDEN), HIDDEN),
            np.zeros(1),
        ]
        self.moments = [[np.zeros_like(w), np.zeros_like(w)] for w in self.weights]
        self.steps = 0

    def scaled(self, inputs: np.ndarray) -> np.ndarray:
        z = (inputs - self.mean) / self.scale
        return np.sign(z) * np.log1p(np.abs(z))

    def hidden(self, z: np.ndarray) -> np.ndarray:
        return np.tanh(z @ self.weights[0] + self.weights[1])

    def margin(self, inputs: np.ndarray) -> np.ndarray:
        return self.hidden(self.scaled(inputs)) @ self.weights[2] + self.weights[3]

    def step(self, z: np.ndarray, slope: np.ndarray, rate: float) -> None:
        """One Adam step along the margin's gradient, weighted by the loss's slopes."""
        h = self.hidden(z)
        back = slope[:, None] * self.weights[2] * (1 - h * h)
        gradients = [z.T @ back, back.sum(0), h.T @ slope, np.array([slope.sum()])]
        self.steps += 1
        for w, g, m in zip(self.weights, gradients, self.moments, strict=True):
            m[0] = 0.9 * m[0] + 0.1 * (g + 1e-4 * w)
            m[1] = 0.999 * m[1] + 0.001 * g * g
            first = m[0] / (1 - 0.9**self.steps)
            second = m[1] / (1 - 0.999**self.steps)
            w -= rate * first / (np.sqrt(second) + 1e-8)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(x / 2))


def _descend(
    net: Network,
    positive: np.ndarray,
    unlabelled: np.ndarray,
    slopes: Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]],
    epochs: int,
) -> None:
    """Mini-batches of both kinds; ``slopes`` are those of the loss at their margins."""
    rng = np.random.default_rng(SEED)
    p, u = net.scaled(positive), net.scaled(unlabelled)
    for epoch in range(epochs):
        parts = zip(
            np.array_split(rng.permutation(len(p)), BATCHES),
            np.array_split(rng.permutation(len(u)), BATCHES),
            strict=True,
        )
        for a, b in parts:
            if len(a) and len(b):
                both = np.vstack([p[a], u[b]])
                g = net.hidden(both) @ net.weights[2] + net.weights[3]
                of_p, of_u = slopes(g[: len(a)], g[len(a) :])
                net.step(both, np.concatenate([of_p / len(a), of_u / len(b)]), 0.01 * 0.5 ** (epoch / 20))


def train(positive: np.ndarray, unlabelled: np.ndarray, prior: float) -> Network:
    """Minimise the non-negative risk at a prior."""

    def slopes(gp: np.ndarray, gu: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        # logistic loss l(g) = log(1 + exp(-g)): slope of l(g) is -sigmoid(-g), of l(-g) sigmoid(g)
        negative = np.logaddexp(0, gu).mean() - prior * np.logaddexp(0, gp).mean()
        if negative < 0:
            return prior * _sigmoid(gp), -_sigmoid(gu)
        return -prior * _sigmoid(gp) - prior * _sigmoid(-gp), _sigmoid(gu)

    net = Network(np.vstack([positive, unlabelled]))
    _descend(net, positive, unlabelled, slopes, EPOCHS)
    return net


def ranking(positive: np.ndarray, unlabelled: np.ndarray) -> Network:
    """A network that ranks positives before unlabelled rows."""
    net = Network(np.vstack([positive, unlabelled]))
    _descend(net, positive, unlabelled, lambda p, u: (-_sigmoid(-p), _sigmoid(u)), EPOCHS // 2)
    return net


def estimated_prior(positive: np.ndarray, counted: Callable[[np.ndarray], tuple[np.ndarray, int]]) -> float:
    """The share of positives among the unlabelled, from the cleanest top of a ranking.

    ``positive`` are the scores of positives that the ranking was not made from. ``counted`` tells, for
    rising scores, how many of the unlabelled rows have each or more, and how many rows there are.
    """
    above_p = np.sort(positive)[::-1]
    ranks = np.unique(np.linspace(1, len(above_p), 200).astype(int))
    share_p = ranks / len(above_p)
    above, n = counted(above_p[ranks - 1][::-1])
    share_u = above[::-1] / max(1, n)
    margin = np.sqrt(np.log(40) / 2) * (1 / np.sqrt(max(1, n)) + 1 / np.sqrt(len(above_p)))
    best = np.argmin((share_u + margin) / share_p)
    return float(np.clip(share_u[best] / share_p[best], 0.01, 0.99))


def counts_above(rows: DataFrame, net: Network, scores: np.ndarray) -> tuple[np.ndarray, int]:
    """How many ``measures`` of ``rows`` score at least each of the rising ``scores``; and all rows."""

    def binned(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(len(scores) + 1, np.int64)
        for batch in source:
            if batch.num_rows:
                values = net.margin(batch["measures"].flatten().to_numpy().reshape(-1, N_MEASURES))
                counts += np.bincount(np.searchsorted(scores, values, "right"), minlength=len(scores) + 1)
        yield pa.RecordBatch.from_pydict({"bin": np.arange(len(counts)), "n": counts})

    found = rows.select("measures").mapInArrow(binned, "bin long, n long").groupBy("bin").agg(F.sum("n").alias("n"))
    counts = np.zeros(len(scores) + 1, np.int64)
    for r in found.collect():  # a row per score
        counts[r["bin"]] = r["n"]
    return counts[::-1].cumsum()[::-1][1:], int(counts.sum())


def fit(rows: DataFrame, labels: DataFrame) -> tuple[Network | None, float]:
    """The network and the prior from ``measured`` rows and ``labels`` (``doc_id, quality``)."""
    rows = rows.filter("not held_out and doc_id is not null").select("doc_id", "measures")
    trusted = labels.filter("quality = 1").select("doc_id").distinct()

    def sample(df: DataFrame, most: int) -> np.ndarray:
        found = about(df, most, "doc_id").collect()
        found.sort(key=lambda r: (r["doc_id"], r["measures"]))
        return np.array([r["measures"] for r in found]).reshape(-1, N_MEASURES)

    positive = sample(rows.join(trusted, "doc_id"), MAX_POSITIVE)
    unlabelled = sample(rows, MAX_UNLABELLED)
    if not len(positive):
        return None, 0.5
    prior = 0.5
    if len(positive) > 1 and len(unlabelled) > 1:
        net = ranking(positive[::2], unlabelled[::2])
        prior = estimated_prior(net.margin(positive[1::2]), lambda scores: counts_above(rows, net, scores))
    return train(positive, unlabelled, prior), prior


def scored(df: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row."""
    rows = checkpointed(measured(df))
    net, _ = fit(rows, labels)

    def score(keys: list, inputs: list) -> list[tuple]:
        values = _sigmoid(net.margin(np.array(inputs))) if net else np.full(len(keys), 0.5)
        return [(k, float(v)) for k, v in zip(keys, values, strict=True)]

    scores = map_columns(
        rows.select(F.struct("doc_id", "held_out").alias("key"), "measures"), score, "key", "score double"
    )
    return scores.select(
        "key.doc_id",
        "key.held_out",
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
