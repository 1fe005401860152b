import hashlib
import re

import numpy as np
import pytest

from orderlens.llm import exact_dedup


@pytest.mark.parametrize("values", [[0], [5], [0, 1, 2], [3, 1000, 1001, 2**40], list(range(0, 9000, 7))])
def test_golomb_round_trip(values):
    values = np.array(values, np.int64)
    k, unary, rest = exact_dedup.golomb_encode(values)
    assert exact_dedup.golomb_decode(len(values), k, unary, rest).tolist() == values.tolist()


def test_golomb_code_is_short():
    values = np.unique(np.random.default_rng(3).integers(0, 2**40, 20_000))
    k, unary, rest = exact_dedup.golomb_encode(values)
    assert len(unary) + len(rest) < len(values) * (40 - np.log2(len(values)) + 2.5) / 8


@pytest.mark.parametrize("block_rows", [2, 1 << 17])
def test_against_brute_force(spark, odd_docs, odd_rows, block_rows):
    norm = [re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for _, t, *_ in odd_rows]
    groups = {}
    for (doc_id, *_), text in zip(odd_rows, norm):
        groups.setdefault(text, []).append(doc_id)
    expected = []
    for (doc_id, *_), text in zip(odd_rows, norm):
        least = min((i for i in groups[text] if i is not None), default=None)
        expected.append((str(doc_id), str(least), len(groups[text]), hashlib.sha256(text.encode()).hexdigest()))
    rows = exact_dedup.exact_duplicates(spark, odd_docs, block_rows=block_rows).collect()
    assert sorted((str(r.doc_id), str(r.keep_id), r.group_size, r.text_sha256) for r in rows) == sorted(expected)
    assert sum(r.kept for r in rows) == len(groups)
    assert all(r.doc_id == r.keep_id for r in rows if r.kept)


def test_many_copies_in_many_blocks(spark, make_docs):
    docs = make_docs([(i, "the same" if i % 3 else f"other {i % 50}") for i in range(300)]).repartition(7)
    rows = exact_dedup.exact_duplicates(spark, docs, block_rows=16).collect()
    assert sum(r.kept for r in rows) == 51
    assert {r.group_size for r in rows if r.keep_id == 1} == {200}


def test_empty_table(spark, no_docs):
    assert exact_dedup.exact_duplicates(spark, no_docs).collect() == []
