"""Toxic spans by a linear-chain conditional random field.

Documents carry one label each, so tokens get theirs first: words, beginnings and ends
of words that toxic documents hold far more often than others, by a likelihood ratio
that allows for the number of them looked at, are telling. Tokens with one are toxic
where they stand in a toxic document; every other token is not. The field has two
states, a weight per telling mark, one for another such token nearby, a bias and
transitions, fitted by conditional likelihood on windows of tokens.

Forward and backward messages run over whole texts. Between telling tokens all
look alike, so a stretch of them is one power of one matrix, and the work per text is
a look-up per word and a few products per telling token. The marginals of a document
are summed up as the largest and the expected number of toxic tokens; a logistic
curve over these two, fitted on the same sample, is the score.
"""

import re

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from orderlens.llm.common import table
from orderlens.llm.labelled import labelled_sample, one_in_three

#: Bounds of the fit: labelled documents, telling marks, windows of tokens, tokens per
#: window, marks per token.
FIT_ROWS = 12_000
MOST_MARKS = 4_096
MOST_WINDOWS = 8_192
WINDOW_TOKENS = 32
LEAST_DOCUMENTS = 3
LEAST_SHARE = 0.4
MARGIN = 4.0
AROUND = 4
NEAR = 5
STEPS = 120
RIDGE = 1e-3
_PARTS = (4, 5, 6, 7)
#: The word itself, and a beginning and an ending of each length.
TOKEN_MARKS = 1 + 2 * len(_PARTS)
_REMEMBERED = 200_000
_WORDS = re.compile(r"[^\W\d_]+")


def _lower(text):
    low = text.lower()
    return low if len(low) == len(text) else "".join(c.lower() if len(c.lower()) == 1 else c for c in text)


def marks(word):
    """The word itself, and its beginnings and ends of four to seven letters."""
    out = [word]
    for n in _PARTS:
        if len(word) > n:
            out += [word[:n] + "-", "-" + word[-n:]]
    return out


def _sketched(batches):
    """The smallest hash of a text's three-word shingles beside it: near copies mostly share it."""
    for batch in batches:
        smallest = []
        for text in batch.column("text").to_pylist():
            words = _WORDS.findall(_lower(text))
            shingles = zip(words, words[1:], words[2:]) if len(words) > 2 else [words]
            smallest.append(min(xxh64_intdigest(" ".join(s)) for s in shingles) >> 1)
        columns = [batch.column("label"), batch.column("text"), pa.array(smallest, pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, ["label", "text", "sketch"])


def _document_marks(batches):
    for batch in batches:
        counts = {}
        for text, label in zip(batch.column("text").to_pylist(), batch.column("label").to_pylist()):
            for mark in {m for w in set(_WORDS.findall(_lower(text))) for m in marks(w)}:
                n, t = counts.get(mark, (0, 0))
                counts[mark] = n + 1, t + label
        columns = list(zip(*[(m, n, t) for m, (n, t) in counts.items()])) or [()] * 3
        kinds = [pa.string(), pa.int64(), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["mark", "n", "t"])


def telling_marks(sample):
    """Marks of toxic documents beyond chance, at most MOST_MARKS of them."""
    n, toxic = sample.agg(F.count("*"), F.sum("label")).first()
    if not toxic or toxic == n:
        return []
    counts = sample.mapInArrow(_document_marks, "mark string, n long, t long").groupBy("mark")
    counts = counts.agg(F.sum("n").alias("n"), F.sum("t").alias("t")).where(F.col("t") >= LEAST_DOCUMENTS).persist()
    looked_at = max(2, counts.count())
    share, t, k = toxic / n, F.col("t"), F.col("n")
    other = F.when(k > t, (k - t) * F.log((k - t) / (k * (1 - share)))).otherwise(0.0)
    ratio = 2 * (t * F.log(t / (k * share)) + other)
    kept = counts.where((t > k * share) & (t >= LEAST_SHARE * k)).withColumn("g", ratio)
    kept = kept.where(F.col("g") > 2 * float(np.log(looked_at)) + 2 * MARGIN)
    found = sorted(r.mark for r in kept.orderBy(F.desc("g"), "mark").limit(MOST_MARKS).collect())
    counts.unpersist()
    return found


class _Marked(dict):
    """Numbers of the telling marks of a word, most words remembered."""

    def __init__(self, index):
        self.index = index

    def __missing__(self, word):
        if len(self) > _REMEMBERED:
            self.clear()
        found = self[word] = tuple(self.index[m] for m in marks(word) if m in self.index)
        return found


def _windows(index):
    """Token windows (numbers of telling marks) round telling tokens, or one without."""

    def run(batches):
        marked = _Marked(index)
        for batch in batches:
            rows = []
            for text, label in zip(batch.column("text").to_pylist(), batch.column("label").to_pylist()):
                tokens = [marked[w] for w in _WORDS.findall(_lower(text))]
                at, found = 0, False
                while at < len(tokens):
                    if tokens[at]:
                        start = max(0, at - AROUND)
                        rows.append((tokens[start : start + WINDOW_TOKENS], label))
                        at, found = start + WINDOW_TOKENS, True
                    else:
                        at += 1
                if tokens and not found:
                    rows.append((tokens[: 2 * AROUND + 1], label))
            columns = list(zip(*rows)) or [(), ()]
            kind = pa.list_(pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([pa.array(columns[0], kind), pa.array(columns[1], pa.int32())], ["tokens", "label"])

    return run


def _near(telling):
    """Where a telling token has another within NEAR tokens."""
    out = np.zeros_like(telling)
    for d in range(1, NEAR + 1):
        out[:, d:] |= telling[:, :-d]
        out[:, :-d] |= telling[:, d:]
    return out & telling


class Field:
    """Weights: per telling mark (0: the bias of all tokens), one for company, transitions."""

    def __init__(self, marks):
        self.index = {m: i + 1 for i, m in enumerate(marks)}
        self.word = np.zeros(len(marks) + 1)
        self.company = 0.0
        self.step = np.zeros((2, 2))
        self.curve = np.zeros(3)
        self._powers, self._marked = {}, None

    def fit(self, tokens, lengths, y):
        """Adam on the mean conditional log-likelihood of padded windows."""
        n, width, _ = tokens.shape
        telling = tokens[:, :, 0] > 0
        near, inside = _near(telling), np.arange(width)[None, :] < lengths[:, None]
        theta = np.zeros(len(self.word) + 5)
        first, second = np.zeros_like(theta), np.zeros_like(theta)
        for step in range(1, STEPS + 1):
            word, company, trans = theta[: len(self.word)], theta[len(self.word)], theta[-4:].reshape(2, 2)
            score = word[0] + np.where(tokens > 0, word[tokens], 0).sum(2) + company * near
            state = np.exp(np.clip(np.stack([np.zeros_like(score), score], axis=2), -30, 30))
            move = np.exp(trans)
            alpha, beta = np.zeros_like(state), np.ones_like(state)
            alpha[:, 0] = state[:, 0] / state[:, 0].sum(1, keepdims=True)
            for t in range(1, width):
                a = (alpha[:, t - 1] @ move) * state[:, t]
                alpha[:, t] = np.where(inside[:, t, None], a / a.sum(1, keepdims=True), alpha[:, t - 1])
            for t in range(width - 2, -1, -1):
                b = (state[:, t + 1] * beta[:, t + 1]) @ move.T
                beta[:, t] = np.where(inside[:, t + 1, None], b / b.sum(1, keepdims=True), 1.0)
            marginal = alpha * beta
            marginal /= marginal.sum(2, keepdims=True)
            gap = np.where(inside, y - marginal[:, :, 1], 0)
            grad = np.zeros_like(theta)
            grad[: len(word)] = np.bincount(tokens.reshape(-1), np.repeat(gap.reshape(-1), TOKEN_MARKS), len(word))
            grad[0] = gap.sum()
            grad[len(word)] = gap[near].sum()
            pairs = inside[:, 1:]
            joint = alpha[:, :-1, :, None] * move[None, None] * (state * beta)[:, 1:, None, :]
            joint /= joint.sum((2, 3), keepdims=True)
            for i in (0, 1):
                for j in (0, 1):
                    seen = (y[:, :-1] == i) & (y[:, 1:] == j)
                    grad[-4 + 2 * i + j] = np.where(pairs, seen - joint[:, :, i, j], 0).sum()
            grad = grad / n - RIDGE * theta
            first, second = 0.9 * first + 0.1 * grad, 0.99 * second + 0.01 * grad**2
            theta += 0.2 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
        self.word, self.company, self.step = theta[: len(self.word)], float(theta[len(self.word)]), theta[-4:].reshape(2, 2)

    def _power(self, gap):
        """The messages over so many tokens that tell nothing, scaled."""
        if gap not in self._powers:
            if len(self._powers) > 100_000:
                self._powers.clear()
            step = np.exp(self.step) * np.array([1.0, np.exp(self.word[0])])
            out, left = np.eye(2), gap
            while left:
                if left & 1:
                    out = out @ step
                    out /= out.max()
                step = step @ step
                step /= step.max()
                left >>= 1
            self._powers[gap] = out.tolist()
        return self._powers[gap]

    def marginals(self, text):
        """[(token, probability of being toxic)] of the tokens with telling marks."""
        if self._marked is None:
            self._marked = _Marked(self.index)
        tokens = _WORDS.findall(_lower(text))
        found = [(i, m) for i, m in enumerate(map(self._marked.__getitem__, tokens)) if m]
        if not found:
            return []
        weights = []
        for k, (at, own) in enumerate(found):
            near = (k and at - found[k - 1][0] <= NEAR) or (k + 1 < len(found) and found[k + 1][0] - at <= NEAR)
            score = self.word[0] + sum(self.word[m] for m in own) + (self.company if near else 0.0)
            weights.append(float(np.exp(np.clip(score, -30.0, 30.0))))
        move = np.exp(self.step).tolist()
        bias = float(np.exp(self.word[0]))

        def forward(a, gap, weight):
            p = self._power(gap)
            a = (a[0] * p[0][0] + a[1] * p[1][0], a[0] * p[0][1] + a[1] * p[1][1])
            x, y = a[0] * move[0][0] + a[1] * move[1][0], (a[0] * move[0][1] + a[1] * move[1][1]) * weight
            return x / (x + y), y / (x + y)

        alphas, a = [], None
        for k, ((at, _), weight) in enumerate(zip(found, weights)):
            if k:
                a = forward(a, at - found[k - 1][0] - 1, weight)
            elif at:
                a = forward((1 / (1 + bias), bias / (1 + bias)), at - 1, weight)
            else:
                a = (1 / (1 + weight), weight / (1 + weight))
            alphas.append(a)
        p = self._power(len(tokens) - 1 - found[-1][0])
        b = (p[0][0] + p[0][1], p[1][0] + p[1][1])
        out = []
        for k in range(len(found) - 1, -1, -1):
            x, y = alphas[k][0] * b[0], alphas[k][1] * b[1]
            out.append((found[k][0], y / (x + y)))
            if k:
                c0, c1 = b[0], b[1] * weights[k]
                b = (move[0][0] * c0 + move[0][1] * c1, move[1][0] * c0 + move[1][1] * c1)
                p = self._power(found[k][0] - found[k - 1][0] - 1)
                b = (p[0][0] * b[0] + p[0][1] * b[1], p[1][0] * b[0] + p[1][1] * b[1])
                b = (b[0] / (b[0] + b[1]), b[1] / (b[0] + b[1]))
        return out[::-1]

    def summary(self, text):
        """Largest marginal, and the logarithm of one plus the expected number of toxic tokens."""
        p = [q for _, q in self.marginals(text)]
        return max(p, default=0.0), float(np.log1p(sum(p)))

    def calibrate(self, x, y):
        """The score's curve over the summaries, by Newton steps with a light ridge."""
        x = np.column_stack([np.ones(len(x)), x])
        for _ in range(30):
            p = 1 / (1 + np.exp(-x @ self.curve))
            hessian = x.T @ (x * (p * (1 - p))[:, None]) + 0.05 * np.eye(3)
            move = np.linalg.solve(hessian, x.T @ (y - p) - 0.05 * self.curve)
            self.curve = self.curve + np.clip(move, -4, 4)

    def judge(self, text):
        """(score, [(start, end, probability)] of tokens that are toxic rather than not)."""
        found = self.marginals(text)
        p = [q for _, q in found]
        x = self.curve @ np.array([1.0, max(p, default=0.0), np.log1p(sum(p))])
        toxic = {at: q for at, q in found if q >= 0.5}
        spans = []
        if toxic:
            for at, match in enumerate(_WORDS.finditer(_lower(text))):
                if at in toxic:
                    spans.append((match.start(), match.end(), toxic[at]))
        return float(1 / (1 + np.exp(-x))), spans


def fit(docs, labels, rows=FIT_ROWS):
    """A Field from at most ``rows`` labelled documents that are not held out.

    Of near copies with one label mostly one is used. To the driver come the telling
    marks, windows of a few thousand documents, and two numbers per document. Without labelled documents every score is one
    half; with one class only, or no telling marks, it is near the share of that class.
    """
    sample = labelled_sample(docs, labels, "toxic", one_in_three, rows).select("label", "text")
    sample = sample.mapInArrow(_sketched, "label int, text string, sketch long")
    sample = sample.dropDuplicates(["sketch", "label"]).select("label", "text").persist()
    field = Field(telling_marks(sample))
    if field.index:
        windows = sample.mapInArrow(_windows(field.index), "tokens array<array<int>>, label int")
        held = windows.orderBy(F.desc(F.exists("tokens", lambda m: F.size(m) > 0)), F.xxhash64("tokens"), "label").limit(MOST_WINDOWS).collect()
        tokens = np.zeros((len(held), WINDOW_TOKENS, TOKEN_MARKS), np.int64)
        for i, row in enumerate(held):
            for j, own in enumerate(row.tokens):
                tokens[i, j, : len(own)] = own
        lengths = np.array([len(r.tokens) for r in held])
        y = ((tokens[:, :, 0] > 0) & (np.array([r.label for r in held])[:, None] == 1)).astype(int)
        field.fit(tokens, lengths, y)

    @F.pandas_udf("array<double>")
    def summed(texts: pd.Series) -> pd.Series:
        return pd.Series([list(field.summary(t)) for t in texts])

    found = sample.select("label", summed("text").alias("x")).collect()
    sample.unpersist()
    found.sort(key=lambda r: (r.x, r.label))
    field.calibrate(np.array([r.x for r in found]).reshape(-1, 2), np.array([r.label for r in found], float))
    return field


def scored(docs, labels, id_col="doc_id", text_col="text"):
    """One row per row of ``docs``: doc_id, score (the nearer to 1, the likelier toxic), spans.

    spans lists the toxic tokens by their characters in the text, end exclusive. Null,
    empty and wordless texts get the score of a text without telling marks. Repeated
    rows get equal results, an empty table none. Other columns are not read.
    """
    field = fit(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), labels)

    @F.pandas_udf("score double, spans array<struct<start:int,end:int,probability:double>>")
    def judge(texts: pd.Series) -> pd.DataFrame:
        names = ("start", "end", "probability")
        judged = [field.judge(t) for t in texts]
        return pd.DataFrame({"score": [s for s, _ in judged], "spans": [[dict(zip(names, x)) for x in spans] for _, spans in judged]})

    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(id_col).alias("doc_id"), judge(text).alias("j")).select("doc_id", "j.score", "j.spans")


def op5_toxicity(spark, sf_dir):
    found = scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return found.select(
        "doc_id",
        one_in_three(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"),
        "spans",
    )
