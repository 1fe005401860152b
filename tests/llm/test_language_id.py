import numpy as np

from orderlens.llm import language_id


def test_held_out_accuracy(spark, folder):
    rows = language_id.op9_language_id(spark, folder).collect()
    langs = {r.doc_id: r.lang for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    assert len(rows) == len(langs)
    held = [r for r in rows if r.held_out]
    assert held and np.mean([r.lang_pred == langs[r.doc_id] for r in held]) > 0.97
    assert all(0 <= r.score <= 1 for r in rows)


def test_labels_of_held_out_rows_do_not_matter(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    turned = docs.withColumn("lang", language_id.F.when(~language_id.held_out(docs["doc_id"]), docs["lang"]).otherwise("zz"))
    first = {r.doc_id: (r.lang_pred, r.score) for r in language_id.predicted(spark, docs).collect()}
    assert first == {r.doc_id: (r.lang_pred, r.score) for r in language_id.predicted(spark, turned).collect()}


def test_grams_against_a_plain_loop():
    texts = ["ab c", "", "éa!", "x"]
    hashes, number, total = language_id.grams(texts)
    plain = []
    for i, text in enumerate(texts):
        spaced = " " + "".join(c if c.isalpha() else " " for c in text) + " "
        plain += [(i, spaced[j - 1 : j + 2]) for j in range(1, len(spaced) - 1) if spaced[j] != " "]
    assert number.tolist() == [i for i, _ in plain] and total.tolist() == [3, 0, 2, 1]
    seen = {}
    assert all(seen.setdefault(g, h) == h for (_, g), h in zip(plain, hashes)) and len(set(seen.values())) == len(seen)


def test_more_languages_than_one_word_of_bits(spark, make_docs):
    letters = "abcdefghij"
    langs = [f"l{a}{b}" for a in letters for b in letters[:7]]
    rows = [(i, " ".join([f"{lang[1:] * 3}q"] * 20), lang, "s") for i, lang in enumerate(langs * 4)]
    out = {r.doc_id: r.lang_pred for r in language_id.predicted(spark, make_docs(rows)).collect()}
    learned = {lang for i, _, lang, _ in rows if out[i] == lang}
    assert len(learned) >= 65


def test_odd_rows_and_nothing_learned(spark, odd_docs, odd_rows, no_docs, make_docs):
    rows = language_id.predicted(spark, odd_docs).collect()
    assert len(rows) == len(odd_rows)
    by_id = {r.doc_id: r for r in rows if r.doc_id}
    assert all((by_id[i].lang_pred, by_id[i].score) == ("und", 0.0) for i in (2, 3, 4, 9))
    assert by_id[7].lang_pred in ("aa", "bb")
    assert language_id.predicted(spark, no_docs).collect() == []
    unknown = language_id.predicted(spark, make_docs([(1, "some words"), (2, None)])).collect()
    assert {r.lang_pred for r in unknown} == {"und"}
