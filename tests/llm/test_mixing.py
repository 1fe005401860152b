import pytest

from orderlens.llm import mixing


def targets(sizes):
    """Shares by weight, stopped at twice the size, the excess dealt out again."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    weight = {s: mixing.WEIGHTS[i % 3] for i, s in enumerate(names)}
    out, open_, left = {}, set(names), 1.5 * sum(sizes.values())
    while open_:
        level = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if level * weight[s] >= 2 * sizes[s]}
        if not full:
            out |= {s: level * weight[s] for s in open_}
            break
        out |= {s: 2.0 * sizes[s] for s in full}
        left -= sum(2 * sizes[s] for s in full)
        open_ -= full
    return out


def words(text):
    return len((text or "").encode().split())


@pytest.mark.parametrize("counts", [(400, 20, 100, 5), (10, 10, 10, 300)])
def test_targets_and_taken(spark, make_docs, counts):
    names = ["b", "a", "é", None]
    rows, doc_id = [], 0
    for name, count in zip(names, counts):
        for i in range(count):
            rows.append((doc_id, "w " * (1 + (7 * i) % 11), "aa", name))
            doc_id += 1
    out = {r.doc_id: r for r in mixing.mix(spark, make_docs(rows)).collect()}
    sizes = {}
    for _, text, _, source in rows:
        sizes[source] = sizes.get(source, 0) + words(text)
    goal, taken = targets(sizes), dict.fromkeys(names, 0)
    for doc_id, text, _, source in rows:
        r = out[doc_id]
        assert r.size == words(text) and r.source_size == sizes[source] and r.taken in (0, r.size, 2 * r.size)
        assert r.target == pytest.approx(goal[source])
        taken[source] += r.taken
    assert all(abs(taken[s] - goal[s]) <= 22 for s in names)
    assert sum(taken.values()) <= 1.5 * sum(sizes.values())


def test_odd_rows_and_reruns(spark, odd_docs, odd_rows):
    first = sorted(map(str, mixing.mix(spark, odd_docs).collect()))
    again = sorted(map(str, mixing.mix(spark, odd_docs.repartition(3)).collect()))
    assert len(first) == len(odd_rows) and first == again


def test_mixed_repeats_rows(spark, odd_docs):
    copies = {r.doc_id: r.copies for r in mixing.mix(spark, odd_docs).groupBy("doc_id").agg({"copies": "max"}).toDF("doc_id", "copies").collect()}
    mixed = mixing.mixed(spark, odd_docs)
    assert mixed.columns == odd_docs.columns
    rows = [r.doc_id for r in mixed.collect()]
    assert rows.count(7) == copies[7] and rows.count(1) == 2 * copies[1]


def test_empty_and_wordless_tables(spark, no_docs, make_docs):
    assert mixing.mix(spark, no_docs).collect() == []
    rows = mixing.mix(spark, make_docs([(1, None), (2, " "), (3, "", "aa", "s")])).collect()
    assert [(r.size, r.target, r.taken) for r in rows] == [(0, 0.0, 0)] * 3


def test_rows_without_id_are_taken_one_by_one(spark, make_docs):
    rows = [(None, f"{i} " + "w " * (i % 7), "aa", "a") for i in range(200)] + [(i, f"{i} " + "v " * (i % 5), "aa", "b") for i in range(200)]
    docs = make_docs(rows)
    want = {r.source_size: r.target for r in mixing.mix(spark, docs).collect()}
    got = {"a": 0, "b": 0}
    for r in mixing.mixed(spark, docs).collect():
        got[r.source] += words(r.text)
    sizes = {s: sum(words(t) for _, t, _, x in rows if x == s) for s in got}
    assert all(abs(got[s] - want[sizes[s]]) <= 14 for s in got)
