import zlib

import pytest

from orderlens.llm import sharding


def check(rows, shards):
    by_shard = {}
    for r in rows:
        by_shard.setdefault(r.shard, []).append(r.slot)
    loads = [len(by_shard.get(s, [])) for s in range(shards)]
    assert max(loads) - min(loads) <= 1
    assert all(sorted(slots) == list(range(len(slots))) for slots in by_shard.values())


@pytest.mark.parametrize("crowded_rows", [1, 1 << 20])
@pytest.mark.parametrize("shards", [1, 7, 24])
def test_full_shards_and_gapless_slots(spark, make_docs, shards, crowded_rows):
    docs = make_docs([(i if i % 3 else 0, f"text {i}") for i in range(500)])
    rows = sharding.assign(spark, docs, shards, crowded_rows=crowded_rows).collect()
    assert len(rows) == 500
    check(rows, shards)


def test_walk_against_one_row_at_a_time():
    """Rows that overflow go to the next shard with room, in rounds."""
    owners, loads, free = [0, 1, 0, 2], [5, 1, 2, 0], [3, 3, 2]
    got = {}
    for arc, a, b, shard, _ in sharding.walk(loads, owners, free):
        for row in range(a, b):
            got[arc, row] = shard
    room, want, waiting, step = list(free), {}, [(a, r) for a, n in enumerate(loads) for r in range(n)], 0
    while waiting:
        left = []
        for arc, row in waiting:
            shard = owners[(arc + step) % len(owners)]
            if room[shard]:
                room[shard] -= 1
                want[arc, row] = shard
            else:
                left.append((arc, row))
        waiting, step = left, step + 1
    assert got == want


def test_one_more_shard_moves_few_rows(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    before = {r.doc_id: r.shard for r in sharding.assign(spark, docs, 24).collect()}
    after = {r.doc_id: r.shard for r in sharding.assign(spark, docs, 25).collect()}
    moved = sum(before[i] != after[i] for i in before)
    assert moved < len(before) * 0.2


def test_sizes_and_odd_rows(spark, odd_docs, odd_rows):
    rows = sharding.assign(spark, odd_docs, 5).collect()
    want = sorted((str(i), len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t, *_ in odd_rows)
    assert sorted((str(r.doc_id), r["size"], r.text_crc32) for r in rows) == want
    assert {(r.law, r.grown_shard) for r in rows} == {("rows", None)}
    check(rows, 5)


def test_carried_columns_and_empty_table(spark, odd_docs, no_docs):
    placed = sharding.assign(spark, odd_docs, 3, carry=odd_docs.columns)
    assert len(placed.columns) == len(set(placed.columns)) and "text" in placed.columns
    assert placed.count() == odd_docs.count()
    assert sharding.assign(spark, no_docs).collect() == []


def test_columns_named_like_its_own(spark, make_docs, prose):
    names = ["_size", "_crc", "_cell", "_row", "_salt", "_n", "_first", "_rank", "_place", "_low", "_high", "_shift", "_Row_"]
    docs = make_docs([(i, prose(1, i)) for i in range(30)], names)
    for crowded_rows in (0, 1 << 20):
        rows = sharding.assign(spark, docs, 3, carry=docs.columns, crowded_rows=crowded_rows).collect()
        assert len(rows) == 30 and {r[name] for r in rows for name in names} == {7}
        check(rows, 3)


def test_no_python_in_the_plan(spark, folder):
    plan = sharding.op6_sharding(spark, folder)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
