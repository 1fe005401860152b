import numpy as np
import pytest

from orderlens.llm import decontamination as dc

QUESTION = (
    "A train leaves Boston at 9:15 and travels 120 km in 2 hours. How far will it have gone from Boston "
    "after 5 hours if it keeps the same speed all the way to the coast?"
)
OTHER = "If Maria buys 3 pencils for 45 cents, how many cents does she have to pay for 12 of the same pencils in that shop?"


@pytest.fixture(scope="module")
def items(spark):
    rows = [(1, QUESTION), (2, OTHER), (3, None), (4, ""), (5, "Too short"), (6, "12 45 78")]
    return spark.createDataFrame(rows, "item_id long, text string")


def found(spark, make_docs, items, rows):
    return {(r.doc_id, r.item_id): r for r in dc.leaks(spark, make_docs(rows), items).collect()}


def test_copies_and_other_numbers_names_and_units(spark, make_docs, items, prose):
    renamed = QUESTION.replace("Boston", "Denver").replace("120 km", "90 miles").replace("9:15", "7:40").replace("5 hours", "3 hours").replace("in 2 hours", "in 6 hours")
    torn = renamed.replace("gone from Denver", "gone from Dallas")
    rows = [
        (1, f"{prose(3, 1)} {QUESTION} {prose(3, 2)}"),
        (2, f"{prose(3, 3)} {QUESTION.upper()}"),
        (3, f"{prose(2, 4)} {renamed} {prose(2, 5)}"),
        (4, torn),
        (5, prose(30, 6)),
        (6, f"{OTHER}\n{QUESTION}"),
        (7, " ".join(w + "%%%" for w in OTHER.split())),
        (8, QUESTION[: len(QUESTION) // 3]),
    ]
    out = found(spark, make_docs, items, rows)
    assert out.keys() >= {(1, 1), (3, 1), (6, 1), (6, 2)}
    assert not out.keys() & {(4, 1), (5, 1), (5, 2), (8, 1), (1, 2)}
    assert out[1, 1].exact and not out[3, 1].exact
    assert out[1, 1].coverage > 0.9


def test_windows_against_brute_force(spark, make_docs, prose):
    """Without slots the coverage is the share of an item's word windows in the text."""
    texts = [prose(2, 500 + i).lower().replace(".", "") for i in range(6)]
    items = spark.createDataFrame(list(enumerate(texts)), "item_id long, text string")
    rows = [(i, f"{prose(3, i).lower()} {texts[i % 6][: 40 + 13 * i]} {prose(1, 900 + i).lower()}".replace(".", "")) for i in range(12)]
    want = {}
    for doc_id, text in rows:
        words = text.split()
        mine = {tuple(words[i : i + 8]) for i in range(len(words) - 7)}
        for item_id, item in enumerate(texts):
            parts = item.split()
            hits = [tuple(parts[i : i + 8]) in mine for i in range(len(parts) - 7)]
            if np.mean(hits) >= dc.COVERAGE:
                want[doc_id, item_id] = pytest.approx(np.mean(hits))
    got = {k: r.coverage for k, r in found(spark, make_docs, items, rows).items()}
    assert got == want and got


def test_odd_rows_and_empty_tables(spark, odd_docs, no_docs, items, odd_rows):
    assert dc.leaks(spark, no_docs, items).collect() == []
    assert dc.leaks(spark, odd_docs, items.where("false")).collect() == []
    own = spark.createDataFrame([(1, odd_rows[0][1]), (1, odd_rows[0][1]), (None, odd_rows[5][1])], "item_id long, text string")
    rows = dc.leaks(spark, odd_docs, own).collect()
    assert {(r.doc_id, r.item_id) for r in rows} == {(1, 1), (8, 1), (None, None)}
    kept = dc.clean(spark, odd_docs, own)
    assert kept.columns == odd_docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(i) for i, *_ in odd_rows if i not in (1, 8))


def test_query_finds_whole_passages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").collect()
    items = spark.read.parquet(f"{folder}/benchmark.parquet").collect()
    held = {(d.doc_id, b.item_id) for d in docs for b in items if b.text in d.text}
    got = {(r.doc_id, r.item_id) for r in dc.op10_decontamination(spark, folder).collect()}
    assert held and held <= got


def test_documents_that_share_or_lack_an_id(spark, make_docs, items, prose):
    """Each text is decided by itself: no clash and no coverage across texts, and none stays for want of an id."""
    parts = QUESTION.split()
    rows = [
        (None, QUESTION), (None, QUESTION.replace("Boston", "Denver")), (None, prose(4, 1)), (7, OTHER), (7, prose(4, 2)),
        (None, " ".join(parts[:13])), (None, " ".join(parts[12:22])), (None, " ".join(parts[20:30])),
    ]
    docs = make_docs(rows)
    found = [(r.doc_id, r.item_id) for r in dc.leaks(spark, docs, items).collect()]
    assert sorted(map(str, found)) == sorted(map(str, [(None, 1), (None, 1), (7, 2)]))
    kept = dc.without_items(spark, docs, items)
    assert kept.columns == docs.columns
    assert sorted(r.text for r in kept.collect()) == sorted(rows[i][1] for i in (2, 4, 5, 6, 7))


def test_one_clash_does_not_discard_the_other_windows(spark, make_docs, prose):
    tail = prose(3, 8).lower().replace(".", "")
    items = spark.createDataFrame([(1, f"take 12 of them and then 7 {tail} until 12 are left")], "item_id long, text string")
    rows = [
        (1, f"take 12 of them and then 7 {tail} until 13 are left"),
        (2, f"take 9 of them and then 9 {tail} until 9 are left"),
    ]
    found_rows = found(spark, make_docs, items, rows)
    assert set(found_rows) == {(1, 1), (2, 1)}
    assert found_rows[2, 1].coverage == 1 and found_rows[1, 1].coverage > 0.7


def test_words_that_begin_sentences_match_as_names_too(spark, make_docs, prose):
    short = "What is the capital of the old kingdom?"
    named = "Tom has 12 red apples in the box. Tom buys 5 more of them there. Tom eats 3 of those in the park."
    items = spark.createDataFrame([(1, short), (2, named)], "item_id long, text string")
    rows = [
        (1, f"Question: {short}"),
        (2, f"{prose(1, 1)[:-1]} {short} {prose(1, 2)}"),
        (3, named.replace("Tom", "Lucy").replace("12", "14")),
        (4, f"they said {named.replace('Tom', 'Lucy')}"),
        (5, prose(20, 3)),
    ]
    out = found(spark, make_docs, items, rows)
    assert set(out) == {(1, 1), (2, 1), (3, 2), (4, 2)}
    assert out[1, 1].exact and out[2, 1].exact and out[3, 2].coverage == 1 and not out[3, 2].exact
