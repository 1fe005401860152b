import numpy as np
import pytest
import xxhash

from orderlens.llm import simhash
from orderlens.llm.common import saved


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def plain_components(rows):
    prints = [plain_fingerprint(text) for _, text in rows]
    label = list(range(len(rows)))
    for _ in rows:
        for i, a in enumerate(prints):
            for j, b in enumerate(prints):
                if (a ^ b).bit_count() <= 3:
                    label[j] = min(label[i], label[j])
    groups = {}
    for (doc_id, _), root in zip(rows, label):
        groups.setdefault(root, []).append(doc_id)
    least = {root: min((i for i in ids if i is not None), default=None) for root, ids in groups.items()}
    return sorted((str(doc_id), f"{fp:016x}", str(least[root])) for (doc_id, _), fp, root in zip(rows, prints, label))


def result(df):
    return sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in df.collect())


def test_spark_and_python_hash_alike(spark):
    from pyspark.sql import functions as F

    value = spark.sql("SELECT 'á b c' AS s").select(F.xxhash64("s")).first()[0]
    assert value % 2**64 == xxhash.xxh64_intdigest("á b c".encode(), 42)


def test_near_and_exact_copies_against_brute_force(spark, make_docs, prose):
    rows = [(i, prose(8, i)) for i in range(30)]
    for i in range(30, 60):
        words = rows[i % 7][1].split()
        words[i % len(words)] = "changed"
        rows.append((i, " ".join(words)))
    rows += [(60, rows[3][1]), (61, None), (62, ""), (63, "one"), (64, "one two"), (65, "ONE two")]
    assert result(simhash.near_duplicates(spark, make_docs(rows))) == plain_components(rows)


def test_odd_rows(spark, odd_docs, odd_rows):
    short = [(i, t) for i, t, *_ in odd_rows]
    assert result(simhash.near_duplicates(spark, odd_docs)) == plain_components(short)


def test_empty_table(spark, no_docs):
    assert simhash.near_duplicates(spark, no_docs).collect() == []


@pytest.mark.parametrize("limit", [4, 100_000])
def test_links_of_dense_fingerprints(spark, monkeypatch, limit):
    """Every link keeps its ends connected, whether keys are crowded or not."""
    draw = np.random.default_rng(1)
    base = draw.integers(0, 2**63, 12, dtype=np.uint64)
    prints = set()
    for b in base:
        for _ in range(60):
            flips = draw.integers(0, 64, draw.integers(0, 5))
            prints.add(int(np.bitwise_xor.reduce([b, *(np.uint64(1) << flips.astype(np.uint64))])))
    prints = np.array(sorted(prints), np.uint64)
    label = list(range(len(prints)))

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for i in range(len(prints)):
        for j in np.flatnonzero(np.bitwise_count(prints ^ prints[i]) <= 3):
            a, b = sorted((find(i), find(int(j))))
            label[b] = a
    monkeypatch.setattr(simhash, "RUN_LIMIT", limit)
    table = saved(spark, spark.createDataFrame([(int(x),) for x in prints.view(np.int64)], "fp long"))
    at = {int(x): i for i, x in enumerate(prints.view(np.int64))}
    linked = list(range(len(prints)))

    def found(x):
        while linked[x] != x:
            x = linked[x]
        return x

    edges = simhash.links(spark, table).collect()
    for r in edges:
        a, b = sorted((found(at[r.a]), found(at[r.b])))
        linked[b] = a
    same = {}
    assert all(same.setdefault(find(i), found(i)) == found(i) for i in range(len(prints)))
    assert len(set(map(find, range(len(prints))))) == len(set(map(found, range(len(prints)))))


def test_one_of_each_group(spark, odd_docs, odd_rows):
    kept = simhash.one_of_each_group(spark, odd_docs)
    assert kept.columns == odd_docs.columns
    ids = sorted(str(r.doc_id) for r in kept.collect())
    assert ids.count("1") == 1 and "8" not in ids and "2" in ids and "3" not in ids


def test_texts_that_share_or_lack_an_id_all_stay(spark, make_docs, prose):
    rows = [(None, prose(6, 40)), (None, prose(6, 41)), (None, prose(6, 41)), (None, prose(6, 42)), (7, prose(6, 43)), (7, prose(6, 44)), (7, prose(6, 43))]
    kept = simhash.one_of_each_group(spark, make_docs(rows)).collect()
    assert sorted((str(r.doc_id), r.text) for r in kept) == sorted({(str(i), t) for i, t in rows})
