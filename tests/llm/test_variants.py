"""Spelling variants against plain comparisons of all words."""

import random
import re
from collections import Counter
from zlib import crc32

import numpy as np
import pytest

from orderlens.llm import variants as V

VOCABULARY = "word string, n long"


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return len(long) - len(short) == 1 and any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def by_hand(words, ratio=5):
    """(word, form, root, n, n_near, form_n) of every word of a dict."""
    around = {w: [v for v in words if near(w, v)] for w in words}
    best = {w: min(a, key=lambda v: (-words[v], v)) if a else None for w, a in around.items()}
    form = {w: b if b and words[b] >= ratio * words[w] else None for w, b in best.items()}

    def root(w):
        while form[w]:
            w = form[w]
        return w

    return sorted((w, str(form[w]), root(w), n, len(around[w]), words[form[w]] if form[w] else -1) for w, n in words.items())


def rows(df):
    return sorted((r.word, str(r.form), r.root, r.n, r.n_near, -1 if r.form_n is None else r.form_n) for r in df.collect())


@pytest.fixture(scope="module")
def crowd():
    """Words that crowd together: many edits of few, over few letters, some long and accented."""
    draw = random.Random(3)
    words = {}
    for stem in ("banana", "aaaaaaaa", "éàöüÿÀ", "z" * 70 + "ab" * 20):
        for _ in range(60):
            w = list(stem)
            for _ in range(draw.randint(0, 3)):
                at = draw.randrange(len(w))
                w[at : at + draw.randint(0, 1)] = draw.choice(["", "a", "b", "÷", "Þ", "z"])
            words["".join(w)] = draw.choice([5, 6, 25, 30, 31, 150, 1000])
    return words


@pytest.mark.parametrize("pass_bytes", [V.PASS_BYTES, 32 << 10])
def test_against_all_pairs(spark, crowd, pass_bytes):
    table = spark.createDataFrame(list(crowd.items()), VOCABULARY)
    expected = by_hand(crowd)
    assert any(r[2] not in (r[0], r[1]) for r in expected)  # chains of forms occur
    assert rows(V.variants(spark, table, pass_bytes=pass_bytes)) == expected


def test_several_passes_and_parts_lose_nothing(spark):
    draw = random.Random(4)
    words = {"".join(draw.choices("abcd", k=draw.randint(6, 9))): draw.randint(5, 500) for _ in range(4000)}
    table = spark.createDataFrame(list(words.items()), VOCABULARY)
    lengths = Counter(map(len, words))
    few = V.passes(lengths, 3 << 10)
    assert len(few) > 1 and any(s.parts > 1 for shards in few for s in shards.values())
    assert all(max(s.first + s.blocks for s in shards.values()) * V.BLOCK_BITS // 8 <= 3 << 10 for shards in few)
    assert rows(V.variants(spark, table, pass_bytes=3 << 10)) == rows(V.variants(spark, table))


def test_hashes_of_edits_are_those_of_the_edited_words():
    codes = V._codes(["banana", "xÿzaab"])
    words = ["banana", "xÿzaab"]
    for word, at, raw in zip(*V.deletions(codes)):
        edited = words[word][:at] + words[word][at + 1 :]
        assert V.raw_hashes(V._codes([edited]))[0] == raw
    for word, at, letter, raw in zip(*V.replacements(codes, 1, 4)):
        assert 1 <= at < 4
        edited = words[word][:at] + chr(letter) + words[word][at + 1 :]
        assert V.raw_hashes(V._codes([edited]))[0] == raw


def counted(rows, least_length, least_count, every):
    counts = Counter()
    for doc, text, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = crc32(f"{'' if doc is None else doc}:{run}".encode())
            if every and h % every == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= least_length and n >= least_count}


@pytest.mark.parametrize("every", [None, 3, 199])
def test_word_counts(spark, odd_docs, odd_rows, every):
    got = {r.word: r.n for r in V.word_counts(spark, odd_docs, torn_every=every).collect()}
    assert got == counted(odd_rows, 6, 5, every) and got


def test_odd_texts_and_empty_tables(spark, make_docs, no_docs, tmp_path):
    long = "ab" * 4000
    texts = [
        (1, f"{long} {long}x ÀÉÎÕ× ÀÉÎÕ×ÿ straße STRASSE Straße x9abcdefg"),
        (1, f"{long} {long}x ÀÉÎÕ×ÿ straße"),
        (None, f"{long} {long}x {long}b ÀÉÎÕ×ÿ"),
        (None, None),
        (2, ""),
    ] * 5
    docs = make_docs(texts, ["word", "n", "near", "form", "root"])
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    words = counted(texts, 6, 5, 199)
    assert long in words and rows(V.op13_variants(spark, str(tmp_path))) == by_hand(words)
    assert V.variants(spark, V.word_counts(spark, no_docs)).collect() == []


def test_filter_never_misses(spark, crowd):
    shards = V.passes(Counter(map(len, crowd)))[0]
    bits = V._filter(spark.createDataFrame(list(crowd.items()), VOCABULARY), shards)
    for w in crowd:
        assert V.held(bits, shards[len(w)], V.raw_hashes(V._codes([w]))).tolist() == [0]
    others = np.random.default_rng(1).integers(0, 1 << 63, 100_000).astype(np.uint64)
    assert all(len(V.held(bits, s, others)) < 100 for s in shards.values())
