import zlib
from itertools import product

import numpy as np
import pytest

from orderlens.llm import toxicity


@pytest.fixture(scope="module")
def labelled(spark, make_docs, prose):
    """Toxic documents hold words on one stem, among words of no telling kind."""
    rows, labels = [], []
    for i in range(240):
        toxic = i % 4 == 0
        word = f"grumb{'abcdefgh'[i % 8]}x" if toxic else None
        rows.append((i, prose(8, 1000 + i, word)))
        labels.append((i, 1, int(toxic)))
    return make_docs(rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def a_field():
    field = toxicity.Field(["bad", "worse"])
    field.word = np.array([-1.0, 2.0, 3.0])
    field.company, field.step = 0.5, np.array([[0.3, -0.2], [-0.4, 0.6]])
    return field


@pytest.mark.parametrize("text", ["bad", "a bad b", "a b c bad d e f g h worse", "bad worse x y bad", "x y z", "worse a b c d e f bad bad q"])
def test_marginals_against_all_taggings(text):
    field = a_field()
    tokens = text.split()
    own = [field.index.get(w, 0) for w in tokens]
    score = []
    for i, mark in enumerate(own):
        near = mark and any(own[j] for j in range(max(0, i - 5), min(len(own), i + 6)) if j != i)
        score.append(field.word[0] + (field.word[mark] if mark else 0) + (field.company if near else 0))
    weight, total = np.zeros(len(tokens)), 0.0
    for tags in product((0, 1), repeat=len(tokens)):
        w = np.exp(sum(s for s, t in zip(score, tags) if t) + sum(field.step[a, b] for a, b in zip(tags, tags[1:])))
        total += w
        weight += w * np.array(tags)
    found = dict(field.marginals(text))
    assert found.keys() == {i for i, mark in enumerate(own) if mark}
    assert all(found[i] == pytest.approx(weight[i] / total) for i in found)


def test_gradient_raises_the_likelihood_of_the_labels():
    tokens = np.zeros((40, 6, toxicity.TOKEN_MARKS), np.int64)
    tokens[::2, 2, 0] = 1
    y = (tokens[:, :, 0] > 0).astype(int)
    field = toxicity.Field(["bad"])
    field.fit(tokens, np.full(40, 6), y)
    assert field.marginals("x y bad z")[0][1] > 0.8 and field.word[0] < 0 < field.word[1]


def test_held_out_documents_and_spans(spark, labelled):
    docs, labels = labelled
    texts = {r.doc_id: r.text for r in docs.collect()}
    rows = toxicity.scored(docs, labels).collect()
    assert len(rows) == 240
    for r in rows:
        if zlib.crc32(str(r.doc_id).encode()) % 3 == 1:
            assert (r.score >= 0.7) == (r.doc_id % 4 == 0)
            assert bool(r.spans) == (r.doc_id % 4 == 0)
        assert all(texts[r.doc_id][s.start : s.end].lower().startswith("grumb") for s in r.spans)


def test_odd_rows_and_missing_labels(spark, labelled, odd_docs, odd_rows, no_docs):
    docs, labels = labelled
    for given in (labels, labels.where("false"), labels.where("toxic = 0")):
        rows = toxicity.scored(odd_docs, given).collect()
        assert len(rows) == len(odd_rows) and all(0 <= r.score <= 1 for r in rows)
    assert toxicity.scored(no_docs, labels).collect() == []


def test_query_has_all_rows(spark, folder):
    rows = toxicity.op5_toxicity(spark, folder).collect()
    assert len(rows) == spark.read.parquet(f"{folder}/documents.parquet").count()
    assert all(r.predicted == (r.score >= 0.7) for r in rows)


def test_every_mark_of_a_word_counts():
    word = "abcdefghij"
    assert len(toxicity.marks(word)) == len(set(toxicity.marks(word))) == toxicity.TOKEN_MARKS
    field = toxicity.Field(toxicity.marks(word))
    assert len(toxicity._Marked(field.index)[word]) == toxicity.TOKEN_MARKS
