import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from (doc_id, text) or (doc_id, text, lang, source), with extra columns."""

    def build(rows, extra=()):
        full = []
        for row in rows:
            doc_id, text, lang, source = (*row, None, None)[:4]
            full.append((doc_id, text, lang, source, None if text is None else len(text), *[7] * len(extra)))
        return spark.createDataFrame(full, SCHEMA + "".join(f", {name} int" for name in extra))

    return build


@pytest.fixture(scope="session")
def prose():
    """Invented sentences, the same at every run."""
    draw = random.Random(5)
    parts = "an be co du el fi ga ho is ju ka lo mi no or pe qui ra so tu ve wi ya zu".split()
    words = ["".join(draw.choices(parts, k=draw.randint(1, 4))) for _ in range(4000)]

    def text(sentences, seed, word=None):
        own = random.Random(seed)
        out = []
        for _ in range(sentences):
            chosen = own.choices(words, k=own.randint(9, 16))
            if word:
                chosen[own.randrange(len(chosen))] = word
            out.append(" ".join(chosen).capitalize() + ".")
        return " ".join(out)

    return text


@pytest.fixture(scope="session")
def odd_rows(prose):
    """Missing, empty, blank, repeated and very long texts, missing and repeated ids."""
    return [
        (1, prose(6, 1), "aa", "s1"),
        (1, prose(6, 1), "aa", "s1"),
        (2, None, None, None),
        (3, "", "aa", None),
        (4, " \t\r\n ", None, "s2"),
        (None, prose(6, 2), "bb", "s2"),
        (None, None, None, None),
        (5, "one", "bb", "s3"),
        (6, "one two", "bb", "s3"),
        (7, prose(20_000, 3), "aa", "s1"),
        (8, prose(6, 1), "aa", "s3"),
        (9, "1234 5678 !!! ???", "bb", "s2"),
    ]


@pytest.fixture(scope="session")
def odd_docs(make_docs, odd_rows):
    """The odd rows, with columns named like those the operators make."""
    names = "fp component_id score size shard slot row pos label hash key id taken copies target mark n word"
    return make_docs(odd_rows, names.split())


@pytest.fixture(scope="session")
def no_docs(make_docs):
    return make_docs([])
