"""Packing: every id once, ids as the tokenizer gives them, little padding, bounded windows."""

from collections import defaultdict
from zlib import crc32

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from orderlens.llm import packing
from orderlens.llm.common import table

PATH = public_tokenizers.path(packing.VOCABULARY)
FILES = PATH, public_tokenizers.path(packing.RANKS), public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def plain(tokenizer, text):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]


def whole(pieces):
    """row -> (id, ids); sequence -> length. Fails where pieces or sequences have gaps."""
    docs, sequences = defaultdict(list), defaultdict(list)
    for p in pieces:
        ids = np.frombuffer(bytes(p.ids), "<u4").tolist()
        assert ids
        docs[p.row].append((p.start, ids, p.doc_id, p.doc_tokens))
        sequences[p.sequence_id].append((p.offset, len(ids)))
    for runs in [*docs.values(), *sequences.values()]:
        runs.sort(key=lambda r: r[0])
    for runs in sequences.values():
        assert [o for o, _ in runs] == [sum(n for _, n in runs[:i]) for i in range(len(runs))]
    out = {}
    for row, runs in docs.items():
        ids = [i for _, part, _, _ in runs for i in part]
        assert [r[0] for r in runs] == [sum(len(q[1]) for q in runs[:i]) for i in range(len(runs))]
        assert {r[3] for r in runs} == {len(ids)}
        out[row] = (runs[0][2], ids)
    return out, {s: sum(n for _, n in runs) for s, runs in sequences.items()}


def check(docs, lengths, rows, tokenizer, length=packing.LENGTH):
    expected = sorted((repr(i), plain(tokenizer, text)) for i, text in rows)
    assert sorted((repr(i), ids) for i, ids in docs.values()) == expected
    short = [n for n in lengths.values() if n != length]
    assert all(n & (n - 1) == 0 and n < length for n in short) and len(short) == len(set(short))
    assert sum(lengths.values()) == sum(len(ids) for _, ids in expected)


def test_odd_rows_and_empty_tables(spark, odd_docs, odd_rows, no_docs, tokenizer):
    pieces = packing.pack(spark, odd_docs.repartition(3), *FILES).collect()
    check(*whole(pieces), [(r[0], r[1]) for r in odd_rows], tokenizer)
    pieces = packing.pack(spark, odd_docs.coalesce(1), PATH).collect()
    check(*whole(pieces), [(r[0], r[1]) for r in odd_rows], tokenizer)
    assert packing.pack(spark, no_docs, *FILES).collect() == []


def test_merging_over_several_rounds(spark, make_docs, prose, tokenizer):
    rows = [(i, prose(i % 7, i)) for i in range(300)]
    pieces = packing.pack(spark, make_docs(rows).repartition(9), *FILES, length=64, windows=3, fan=2)
    pieces = pieces.collect()
    check(*whole(pieces), rows, tokenizer, 64)
    assert len({p.sequence_id >> 56 for p in pieces}) == 5  # documents, then 9, 5, 3, 2 parts


def test_query_over_all_documents(spark, folder, tokenizer):
    rows = {r.doc_id: r.text for r in table(spark, folder, "documents").select("doc_id", "text").collect()}
    got = packing.op12_packing(spark, folder).collect()
    assert sorted(got) == sorted(packing.op12_packing(spark, folder).collect())
    seen, lengths = defaultdict(int), defaultdict(int)
    for p in got:
        ids = np.array(plain(tokenizer, rows[p.doc_id]), "<u4")
        assert p.ids_crc32 == crc32(ids[p.start : p.start + p.length].tobytes()) and p.doc_tokens == len(ids)
        seen[p.doc_id] += p.length
        lengths[p.sequence_id] += p.length
    assert set(seen) == set(rows)
    short = [n for n in lengths.values() if n != 1024]
    assert all(n & (n - 1) == 0 for n in short) and len(short) <= 10


def test_special_tokens_and_odd_characters(tokenizer):
    ids = packing.Ids(*FILES)
    for text in ("a<|endoftext|>b", "  x\n\n y\t  é 12 \U0001f600's", "\x00\x1c a", "\n \n", "abc" * 30_000):
        assert np.frombuffer(ids(text), "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60))
def test_ids_by_pieces_are_those_of_whole_texts(text):
    ids = _IDS.setdefault("ids", packing.Ids(*FILES))
    assert np.frombuffer(ids(text), "<u4").tolist() == ids.tokenizer.encode(text, add_special_tokens=False).ids


_IDS = {}


def test_best_fit_and_bounded_windows():
    packer, made = packing.Packer(length=10, windows=2), []
    for name, n in [("a", 6), ("b", 7), ("c", 3), ("d", 4), ("e", 5)]:
        made += packer.add(name, 0, bytes(4 * n))
        assert len(packer.windows) <= 2
    # c fits b's window best, d fills a's; e opens a window of its own.
    assert [[p[0] for p in s] for s in made] == [["b", "c"], ["a", "d"]]
    made = [*packer.add("f", 0, bytes(4 * 7)), *packer.add("g", 0, bytes(4 * 8))]
    # g fits nowhere: the fullest (f) takes its first three ids and goes, the rest fits beside e.
    assert [[(p[0], p[1], len(p[2]) // 4) for p in s] for s in made] == [[("f", 0, 7), ("g", 0, 3)], [("e", 0, 5), ("g", 3, 5)]]


def test_last_ids_are_cut_at_powers_of_two():
    packer = packing.Packer(length=16, windows=4)
    for name, n in [("a", 9), ("b", 12), ("c", 10)]:
        assert list(packer.add(name, 0, bytes(4 * n))) == []
    assert [sum(len(p[2]) for p in s) // 4 for s in packer.closed()] == [16, 8, 4, 2, 1]
