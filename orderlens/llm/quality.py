"""Quality by a generalised additive model with pairwise interactions.

Cyclic boosting: round after round, one shallow tree per feature is fitted to what the
others leave, and added to that feature's lookup table; then the same for the pairs of
features with the strongest remaining interaction. A score is the sum of one entry per
table. The features are shares and ratios of the whole text, counted byte-wise.
"""

import zlib
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from orderlens.llm.common import table
from orderlens.llm.labelled import SAMPLE_ROWS, labelled_sample, one_in_three

BINS = 32
PAIR_BINS = 8
PAIRS = 6
ROUNDS = 150
RATE = 0.1
RIDGE = 2.0

FEATURES = (
    "log_bytes upper digits plain_marks odd_marks common_mark breaks beyond_ascii log_words word_length "
    "distinct_words top_word same_as_before odd_endings distinct_lines words_per_line squeezed"
).split()

_SPACES = np.array([32, 9, 10, 11, 12, 13])
_PLAIN = np.array([ord(c) for c in ".,;:'\"-()?"])
_UPPER, _LOWER, _DIGIT = np.arange(65, 91), np.arange(97, 123), np.arange(48, 58)
_ODD = np.setdiff1d(np.arange(33, 127), np.concatenate([_PLAIN, _UPPER, _LOWER, _DIGIT]))
_ODD_BYTES = frozenset(_ODD.tolist())


def features(text):
    """The features of a text given as bytes; all zero where it has no word."""
    words = text.split() if text else []
    if not words:
        return np.zeros(len(FEATURES))
    counts = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    size, n = len(text), len(words)
    letters = counts[_UPPER].sum() + counts[_LOWER].sum()
    seen = {}
    for word in words:
        seen[word] = seen.get(word, 0) + 1
    lines = [line for line in text.split(b"\n") if line.strip()]
    squeezer = zlib.compressobj(1)
    squeezed = len(squeezer.compress(text)) + len(squeezer.flush())
    return np.array(
        [
            np.log1p(size),
            counts[_UPPER].sum() / max(1, letters),
            counts[_DIGIT].sum() / size,
            counts[_PLAIN].sum() / size,
            counts[_ODD].sum() / size,
            counts[_ODD].max() / size,
            counts[10] / size,
            counts[128:].sum() / size,
            np.log1p(n),
            (size - counts[_SPACES].sum()) / n,
            len(seen) / n,
            max(seen.values()) / n,
            sum(map(bytes.__eq__, words, words[1:])) / n,
            sum(w[-1] in _ODD_BYTES for w in words) / n,
            len(set(lines)) / len(lines),
            n / len(lines),
            squeezed / size,
        ]
    )


def _leaves(gradient, weight, depth=2):
    """Leaf values, per bin, of the best tree of that depth on the bins of one feature."""
    total_g, total_w = gradient.sum(), weight.sum()
    flat = np.full(len(gradient), total_g / (total_w + RIDGE))
    if depth == 0 or len(gradient) < 2:
        return flat
    g, w = np.cumsum(gradient)[:-1], np.cumsum(weight)[:-1]
    gain = g**2 / (w + RIDGE) + (total_g - g) ** 2 / (total_w - w + RIDGE)
    cut = int(gain.argmax())
    if gain[cut] <= total_g**2 / (total_w + RIDGE) + 1e-9:
        return flat
    return np.concatenate([_leaves(gradient[: cut + 1], weight[: cut + 1], depth - 1), _leaves(gradient[cut + 1 :], weight[cut + 1 :], depth - 1)])


def _pair_leaves(gradient, weight):
    """The same on a grid: one cut of the first feature, one of the second on either side."""
    flat = np.full(gradient.shape, gradient.sum() / (weight.sum() + RIDGE))
    best, found = gradient.sum() ** 2 / (weight.sum() + RIDGE) + 1e-9, flat
    for cut in range(1, gradient.shape[0]):
        halves, gain = [], 0.0
        for g, w in ((gradient[:cut], weight[:cut]), (gradient[cut:], weight[cut:])):
            leaf = _leaves(g.sum(axis=0), w.sum(axis=0), 1)
            gain += float((leaf * g.sum(axis=0)).sum())
            halves.append(np.broadcast_to(leaf, g.shape))
        if gain > best:
            best, found = gain, np.concatenate(halves)
    return best, found


def _edges(column, bins):
    return np.unique(np.quantile(column, np.linspace(0, 1, bins + 1)[1:-1]))


class AdditiveModel:
    """Tables of one and of two features; ``score`` is between 0 and 1."""

    def __init__(self, x, y):
        self.single, self.pairs = [], []
        share = (y.sum() + 1) / (len(y) + 2)
        self.base = float(np.log(share / (1 - share)))
        margin = np.full(len(y), self.base)
        if len(y) == 0 or y.min() == y.max():
            return
        binned = []
        for j in range(x.shape[1]):
            edges = _edges(x[:, j], BINS)
            self.single.append((edges, np.zeros(len(edges) + 1)))
            binned.append(np.searchsorted(edges, x[:, j], side="right"))
        coarse = [_edges(x[:, j], PAIR_BINS) for j in range(x.shape[1])]
        coarse_binned = [np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(coarse)]

        def slopes():
            p = 1 / (1 + np.exp(-margin))
            return y - p, p * (1 - p)

        for _ in range(ROUNDS):
            for (edges, values), at in zip(self.single, binned):
                g, h = slopes()
                n = len(values)
                step = RATE * _leaves(np.bincount(at, g, n), np.bincount(at, h, n))
                values += step
                margin += step[at]

        def grid(a, b):
            shape = len(coarse[a]) + 1, len(coarse[b]) + 1
            at = coarse_binned[a] * shape[1] + coarse_binned[b]
            g, h = slopes()
            n = shape[0] * shape[1]
            return at, np.bincount(at, g, n).reshape(shape), np.bincount(at, h, n).reshape(shape)

        strength = {(a, b): _pair_leaves(*grid(a, b)[1:])[0] for a, b in combinations(range(x.shape[1]), 2)}
        for a, b in sorted(strength, key=strength.get, reverse=True)[:PAIRS]:
            self.pairs.append((a, b, coarse[a], coarse[b], np.zeros((len(coarse[a]) + 1, len(coarse[b]) + 1))))
        for _ in range(ROUNDS // 3):
            for a, b, _, _, values in self.pairs:
                at, g, h = grid(a, b)
                step = RATE * _pair_leaves(g, h)[1]
                values += step
                margin += step.reshape(-1)[at]

    def score(self, x):
        margin = np.full(len(x), self.base)
        for j, (edges, values) in enumerate(self.single):
            margin += values[np.searchsorted(edges, x[:, j], side="right")]
        for a, b, first, second, values in self.pairs:
            margin += values[np.searchsorted(first, x[:, a], side="right"), np.searchsorted(second, x[:, b], side="right")]
        return 1 / (1 + np.exp(-margin))


def _matrix(texts):
    return np.array([features(t) for t in texts]).reshape(-1, len(FEATURES))


def fit(docs, labels, rows=SAMPLE_ROWS):
    """A model from at most ``rows`` labelled documents that are not held out.

    Their features, not their texts, come to the driver. Without labelled documents
    every score is one half; with one class only, its share with one added to each.
    """

    @F.pandas_udf("array<double>")
    def described(texts: pd.Series) -> pd.Series:
        return pd.Series([features(t).tolist() for t in texts])

    sample = labelled_sample(docs, labels, "quality", one_in_three, rows)
    found = sample.select("label", described(F.col("text").cast("binary")).alias("x")).collect()
    found.sort(key=lambda r: (r.x, r.label))
    x = np.array([r.x for r in found]).reshape(-1, len(FEATURES))
    return AdditiveModel(x, np.array([r.label for r in found], float))


def scored(docs, labels, name="score", text_col="text"):
    """``docs`` with a score beside their columns: the nearer to 1, the likelier label 1.

    Null, empty and blank texts are scored as texts without any word. Rows are scored
    one by one: repeated rows alike, none dropped.
    """
    model = fit(docs, labels)

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series(model.score(_matrix(texts)))

    return docs.withColumn(name, score(F.coalesce(F.col(text_col), F.lit("")).cast("binary")))


def op4_quality(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return scored(docs, table(spark, sf_dir, "labels")).select(
        "doc_id",
        one_in_three(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
