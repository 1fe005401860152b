import math
import zlib
from collections import Counter

import numpy as np
import pytest

from orderlens.llm import language_model as lm


def plain(rows):
    texts = [[*(t or "").encode().lower().split(), None] for _, t in rows]
    ids = ["" if i is None else str(i) for i, _ in rows]
    held = [zlib.crc32(i.encode()) % 10 == 0 for i in ids]
    counts = Counter(w for words, h in zip(texts, held) if not h for w in words)
    n, v = sum(counts.values()), len(counts)
    out = []
    for (doc_id, _), words, h in zip(rows, texts, held):
        base = sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in words)
        out.append((str(doc_id), h, len(words), sum(counts[w] > 0 for w in words), n, round(base, 6)))
    return sorted(out)


def result(rows):
    return sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in rows)


@pytest.mark.parametrize("head, part_bytes", [(1 << 19, 24 << 20), (64, 2_000), (0, 10_000)])
def test_exact_part_against_brute_force(spark, make_docs, prose, odd_rows, monkeypatch, head, part_bytes):
    monkeypatch.setattr(lm, "HEAD_TOKENS", head)
    monkeypatch.setattr(lm, "PART_BYTES", part_bytes)
    rows = [(i, t) for i, t, *_ in odd_rows if t is None or len(t) < 10_000] + [(i, prose(5, i)) for i in range(10, 80)]
    found = lm.scored(spark, make_docs(rows)).collect()
    assert result(found) == plain(rows)
    assert all(r.score <= 0 for r in found)


def test_levels_of_counts():
    counts = np.arange(1, 100_000)
    levels = lm.levels_of(counts)
    assert levels[0] == 1 and (np.diff(levels) >= 0).all() and (np.diff(np.unique(levels)) <= 2).all()
    assert np.abs(np.log(lm.LEVEL_VALUES[levels] / counts)).max() < math.log(1.5)


@pytest.mark.parametrize("least", [1, 3])
def test_filter_gives_levels_back(least):
    draw = np.random.default_rng(4)
    keys = np.unique(draw.integers(0, 2**62, 6000, dtype=np.uint64))
    counts = draw.geometric(0.3, len(keys)) ** 2
    part = lm.part_of(keys, 62, 4)
    held = lm.CountFilter(62, 4, 12 * 8 * 3000, least)
    held.cells = np.concatenate([held.part(keys[part == p], counts[part == p]) for p in range(4)])
    levels = lm.levels_of(counts)
    want = np.where(levels >= least, levels, 0)
    got = held.levels(keys)
    assert (got >= want).all() and (got == want).mean() > 0.97
    strangers = held.levels(draw.integers(0, 2**62, 6000, dtype=np.uint64))
    assert (strangers > 0).mean() < 0.03


def test_counts_go_through_the_code_and_back():
    keys = np.sort(np.random.default_rng(1).integers(2**61, 2**62, 500).astype(np.uint64))
    counts = np.arange(1, 501) % 5 + 1
    got = lm._unpack(*lm._pack(keys, counts))
    assert (got[0] == keys).all() and (got[1] == counts).all()


def test_model_beats_the_base_on_held_out_text(spark, folder):
    rows = [r for r in lm.op7_lm_scoring(spark, folder).collect() if r.held_out]
    assert sum(r.score for r in rows) > sum(r.base_score for r in rows)


def plain_scores(rows):
    """The scores by plain dictionaries, and the model's p(token | history) for all tokens that occur."""
    texts = [[*(t or "").encode().lower().split(), None] for _, t in rows]
    held = [zlib.crc32(("" if i is None else str(i)).encode()) % 10 == 0 for i, _ in rows]
    tokens, pairs = Counter(), Counter()
    for words, h in zip(texts, held):
        if not h:
            tokens.update(words)
            pairs.update(zip([None, *words], words))
    n, v = sum(tokens.values()), len(tokens)
    level = {k: int(lm.levels_of(np.array([c]))[0]) for c in (tokens, pairs) for k, c in c.items()}
    mass, times = Counter(), Counter()
    for (h, _), c in pairs.items():
        mass[level[h]] += lm.DISCOUNT
        times[level[h]] += c

    def p(h, w):
        alone = (lm.LEVEL_VALUES[level.get(w, 0)] + 0.1) / (n + 0.1 * (v + 1))
        if h not in tokens:
            return min(alone, 1.0)
        history = lm.LEVEL_VALUES[level[h]]
        pair = min(lm.LEVEL_VALUES[level.get((h, w), 0)], history)
        return min(max(pair - lm.DISCOUNT, 0) / history + mass[level[h]] / times[level[h]] * alone, 1.0)

    scores = [sum(math.log10(p(h, w)) for h, w in zip([None, *words], words)) for words in texts]
    return sorted((str(i), round(x, 6)) for (i, _), x in zip(rows, scores)), tokens, p


@pytest.mark.parametrize("token_bytes, pair_bytes, asked", [(16 << 20, 32 << 20, 1 << 21), (16 << 20, 400, 50), (3000, 3000, 50), (3000, 3000, 1 << 21)])
def test_score_against_brute_force_however_little_is_broadcast(spark, make_docs, prose, odd_rows, monkeypatch, token_bytes, pair_bytes, asked):
    monkeypatch.setattr(lm, "TOKEN_FILTER_BYTES", token_bytes)
    monkeypatch.setattr(lm, "PAIR_FILTER_BYTES", pair_bytes)
    monkeypatch.setattr(lm, "BITS_PER_ENTRY", 96)  # no false positives to speak of
    monkeypatch.setattr(lm, "ASKED", asked)
    monkeypatch.setattr(lm, "PART_BYTES", 4_000)
    least, choose = [], lm._least_level
    monkeypatch.setattr(lm, "_least_level", lambda *a: least.append(choose(*a)) or least[-1])
    rows = [(i, t) for i, t, *_ in odd_rows if t is None or len(t) < 10_000] + [(i, prose(4, i)) for i in range(10, 80)]
    rows += [(200 + i, "again and again an unknownword " * 40) for i in range(8)]
    found = sorted((str(r.doc_id), round(r.score, 6)) for r in lm.scored(spark, make_docs(rows)).collect())
    want, _, _ = plain_scores(rows)
    assert [level > 1 for level, _ in least] == [token_bytes < 1 << 20, pair_bytes < 1 << 20]
    assert [i for i, _ in found] == [i for i, _ in want]
    near = [abs(a - b) <= 1e-4 for (_, a), (_, b) in zip(found, want)]
    assert np.mean(near) > 0.97
    assert abs(sum(x for _, x in found) / sum(x for _, x in want) - 1) < 1e-3


def test_probabilities_after_a_history_add_up(prose):
    """Over all tokens and one unseen; what the rounding of counts adds or takes is small on average."""
    _, tokens, p = plain_scores([(i, prose(6, i)) for i in range(300)])
    sums = {h: sum(p(h, w) for w in tokens) + p(h, b"no such token") for h in tokens}
    mean = sum(sums[h] * c for h, c in tokens.items()) / sum(tokens.values())
    assert 0.85 < mean < 1.15


def test_words_against_split(odd_rows):
    """Equal words have equal hashes and others have others, whatever stands beside them."""
    texts = [(t or "").encode() for _, t, *_ in odd_rows]
    texts += [b"", b" \t", b"a A b\x00 b\x00\x00 b", b"x" * 64, b"y " + b"x" * 65, b"x" * 64 + b"X" * 3 + b"\v" + b"x" * 9, "\u00a0 \u0085 \u3000".encode()]
    got, starts = lm.token_hashes(texts)
    want = [w for t in texts for w in [*t.lower().split(), None]]
    assert starts.tolist() == [0, *np.cumsum([len(t.split()) + 1 for t in texts])[:-1].tolist()]
    assert len(got) == len(want) and len(set(zip(got.tolist(), want))) == len(set(want)) == len(set(got.tolist()))
    for text in texts:
        alone, _ = lm.token_hashes([text])
        assert dict(zip([*text.lower().split(), None], alone.tolist())).items() <= dict(zip(want, got.tolist())).items()


def test_empty_table(spark, no_docs, make_docs):
    assert lm.scored(spark, no_docs).collect() == []
    only_held_out = next(i for i in range(1000) if zlib.crc32(str(i).encode()) % 10 == 0)
    row = lm.scored(spark, make_docs([(only_held_out, "some words")])).first()
    assert (row.n_tokens, row.n_known, row.train_tokens, row.base_score) == (3, 0, 0, 0.0)
