import zlib

import numpy as np
import pytest

from orderlens.llm import quality


def test_model_learns_a_curve_and_an_interaction():
    draw = np.random.default_rng(2)
    x = draw.uniform(size=(4000, 4))
    y = ((x[:, 0] > 0.3) & ((x[:, 1] > 0.5) == (x[:, 2] > 0.5))).astype(float)
    model = quality.AdditiveModel(x[:3000], y[:3000])
    right = (model.score(x[3000:]) >= 0.5) == (y[3000:] == 1)
    assert right.mean() > 0.93 and (1, 2) in [(a, b) for a, b, *_ in model.pairs]


def test_leaves_against_all_cuts():
    draw = np.random.default_rng(0)
    g, w = draw.normal(size=12), draw.uniform(0.5, 1, 12)
    loss = lambda leaf: (leaf**2 * (w + 0)).sum() / 2 - (leaf * g).sum()
    leaf = quality._leaves(g, w, 1)
    gains = []
    for cut in range(1, 12):
        parts = (slice(0, cut), slice(cut, 12))
        gains.append(sum(g[p].sum() ** 2 / (w[p].sum() + quality.RIDGE) for p in parts))
    best = 1 + int(np.argmax(gains))
    assert len(set(leaf[:best])) == 1 and len(set(leaf[best:])) == 1 and loss(leaf) < 0


@pytest.mark.parametrize("text", [b"", b" \n\t", None, b"one", b"!!! ???", "ünï\n\nünï".encode(), b"word " * 50_000])
def test_features_are_finite(text):
    found = quality.features(text)
    assert len(found) == len(quality.FEATURES) and np.isfinite(found).all()


def test_held_out_accuracy(spark, folder):
    rows = quality.op4_quality(spark, folder).collect()
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    assert len(rows) == spark.read.parquet(f"{folder}/documents.parquet").count()
    held = [r for r in rows if r.held_out and r.doc_id in labels]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    assert np.mean([r.predicted == labels[r.doc_id] for r in held]) > 0.9
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)


def test_labels_of_held_out_rows_do_not_matter(spark, folder):
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    turned = labels.withColumn("quality", quality.F.when(quality.one_in_three(quality.F.col("doc_id")), 1 - quality.F.col("quality")).otherwise(quality.F.col("quality")))
    first = {r.doc_id: r.score for r in quality.scored(docs, labels).collect()}
    assert first == {r.doc_id: r.score for r in quality.scored(docs, turned).collect()}


def test_odd_rows_and_missing_labels(spark, odd_docs, no_docs, odd_rows):
    kind = "doc_id long, quality int, toxic int"
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, 0), (3, None, None), (None, 1, 1), (5, 0, 1), (7, 1, 0)], kind)
    for given in (labels, labels.where("false")):
        rows = quality.scored(odd_docs, given, name="judged").collect()
        assert len(rows) == len(odd_rows) and all(0 <= r.judged <= 1 for r in rows)
    assert quality.scored(no_docs, labels).collect() == []
