"""Language by bit-sliced Bloom filters of character n-grams.

A filter slot holds one bit per language. An n-gram's languages are those whose bit is
set in all its slots: one AND over a few words answers for all languages at once. A
text's n-grams are counted per language, the counts are corrected for the filter's
false positives, and the language with the largest share decides.
"""

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F

from orderlens.llm.common import below_share, crc_remainder, table

GRAM = 3
SLOT_BITS = 20
PROBES = 3
#: The filters are fitted on at most this many documents of each language.
SAMPLE_PER_LANGUAGE = 1_000
#: A language holds an n-gram that is at least this often there, relative to the
#: language where it is most frequent; strays of mislabelled documents fall below.
LEAST_SHARE = 0.1
_PIECE = 1 << 20
_STATE = {}


def _letters():
    if "letters" not in _STATE:
        _STATE["letters"] = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
    return _STATE["letters"]


def _pieces(texts):
    """Texts in turn, as many together as make about a million characters."""
    held, size = [], 0
    for text in texts:
        held.append((text or "").lower())
        size += len(held[-1])
        if size >= _PIECE:
            yield held
            held, size = [], 0
    if held:
        yield held


def grams(texts):
    """Hashes of the n-grams of some texts, text numbers beside them, and letters per text.

    Anything but a letter counts as a space; n-grams have a letter in the middle and
    do not reach into the next text.
    """
    joined = " ".join(["", *texts, ""])
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _letters()[points]
    points = np.where(letter, points, 32).astype(np.uint64)
    ends = np.cumsum([1, *[len(t) + 1 for t in texts]])
    number = np.repeat(np.arange(len(texts)), np.diff(ends))
    hashes = points[:-2] * np.uint64(0x9E3779B97F4A7C15) + points[1:-1]
    hashes = hashes * np.uint64(0xC2B2AE3D27D4EB4F) + points[2:]
    hashes ^= hashes >> np.uint64(29)
    hashes *= np.uint64(0xBF58476D1CE4E5B9)
    hashes ^= hashes >> np.uint64(32)
    middle = letter[1:-1]
    return hashes[middle], number[: len(middle)][middle], np.bincount(number[: len(middle)][middle], minlength=len(texts))


def _slots(hashes):
    return [(hashes >> np.uint64(SLOT_BITS * p)) & np.uint64((1 << SLOT_BITS) - 1) for p in range(PROBES)]


def _counted(batches):
    for batch in batches:
        langs = batch.column("lang").to_pylist()
        by_lang = {}
        for lang, text in zip(langs, batch.column("text").to_pylist()):
            by_lang.setdefault(lang, []).append(text)
        for lang, texts in by_lang.items():
            for piece in _pieces(texts):
                values, n = np.unique(grams(piece)[0].view(np.int64), return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(values), pa.string()), pa.array(values), pa.array(n.astype(np.int64))], ["lang", "gram", "n"]
                )


class LanguageFilter:
    """Learned languages and, per 64 of them, one word for each slot of the filter."""

    def __init__(self, languages, slots):
        self.languages = languages
        words = max(1, -(-len(languages) // 64))
        self.masks = np.zeros((words, 1 << SLOT_BITS), np.uint64)
        for word, slot, mask in slots:
            self.masks[word][slot] = mask
        fill = [np.mean((self.masks[i // 64] >> np.uint64(i % 64)) & np.uint64(1)) for i in range(len(languages))]
        self.false_rate = np.array(fill) ** PROBES

    def judge(self, texts):
        """(language, score) of each text."""
        out = []
        for piece in _pieces(texts):
            hashes, number, total = grams(piece)
            starts = np.concatenate([[0], np.cumsum(total)[:-1]])
            some = total > 0
            hits = np.zeros((len(piece), len(self.languages)))
            slots = _slots(hashes)
            for word in range(len(self.masks)):
                found = self.masks[word][slots[0]]
                for slot in slots[1:]:
                    found &= self.masks[word][slot]
                for i in range(64 * word, min(len(self.languages), 64 * word + 64)):
                    if some.any():
                        bit = ((found >> np.uint64(i % 64)) & np.uint64(1)).astype(np.int64)
                        hits[some, i] = np.add.reduceat(bit, starts[some])
            share = (hits / np.maximum(total, 1)[:, None] - self.false_rate) / (1 - np.minimum(self.false_rate, 0.999))
            share = np.maximum(share, 0)
            if not self.languages:
                out += [("und", 0.0)] * len(piece)
                continue
            best = share.argmax(axis=1)
            top = share[np.arange(len(piece)), best]
            whole = share.sum(axis=1)
            score = np.where(whole > 0, top / np.where(whole > 0, whole, 1), 0.0)
            out += [(self.languages[b], float(s)) if n else ("und", 0.0) for b, s, n in zip(best, score, total)]
        return out


def held_out(id_column):
    return crc_remainder(id_column, 4) == 2


def fit(docs, per_language=SAMPLE_PER_LANGUAGE):
    """Filters from at most ``per_language`` documents of each language, held-out ones aside.

    They are documents with the smallest hashed ids. What comes to the driver is
    the list of languages and at most one row per slot of the filter.
    """
    known = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id")))
    order = Window.partitionBy("lang").orderBy("key", "doc_id")
    ids = known.select("doc_id", "lang", F.xxhash64("doc_id").alias("key"))
    # One row per language, as in the filter.
    sizes = F.broadcast(ids.groupBy("lang").agg(F.count("*").alias("n")))
    ids = ids.join(sizes, "lang").where(below_share(F.col("key"), per_language, F.col("n")))
    ids = ids.withColumn("number", F.row_number().over(order)).where(F.col("number") <= per_language)
    ids = ids.select(F.col("doc_id").alias("_id"), F.col("lang").alias("_lang")).distinct()
    chosen = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("lang") == F.col("_lang"))
    # At most ``per_language`` ids of each language, of which the filter holds a bit each.
    sample = known.join(F.broadcast(ids), chosen, "left_semi").select("lang", "text")
    counts = sample.mapInArrow(_counted, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    counts = counts.where(F.col("n") > 1).persist()
    totals = counts.groupBy("lang").agg(F.sum("n").alias("total")).orderBy("lang")
    languages = [(r.lang, r.total) for r in totals.collect()]
    if not languages:
        return LanguageFilter([], [])
    rate = F.col("n") / F.element_at(F.create_map(*[F.lit(x) for pair in languages for x in pair]), F.col("lang"))
    index = F.element_at(F.create_map(*[F.lit(x) for i, (lang, _) in enumerate(languages) for x in (lang, i)]), F.col("lang"))
    rated = counts.select("gram", index.alias("i"), rate.alias("rate"))
    top = rated.groupBy("gram").agg(F.max("rate").alias("top"))
    held = rated.join(top, "gram").where(F.col("rate") >= LEAST_SHARE * F.col("top"))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("i") % 64)
    slot = [F.shiftrightunsigned("gram", SLOT_BITS * p).bitwiseAND((1 << SLOT_BITS) - 1).cast("int") for p in range(PROBES)]
    masks = held.select((F.col("i") / 64).cast("int").alias("word"), bit.alias("bit"), F.explode(F.array(*slot)).alias("slot"))
    masks = masks.groupBy("word", "slot").agg(F.bit_or("bit").alias("mask")).toArrow()
    counts.unpersist()
    columns = [masks.column(c).to_numpy() for c in ("word", "slot", "mask")]
    return LanguageFilter([lang for lang, _ in languages], zip(columns[0], columns[1], columns[2].view(np.uint64)))


def predicted(spark, docs, id_col="doc_id", text_col="text", lang_col="lang"):
    """One row per row of ``docs``: doc_id, held_out, lang_pred, score.

    lang_pred is a learned language, or ``und`` where the text is null, has no letter,
    or nothing was learned; a tie goes to the first by code point. score is the share
    of the winner among the corrected shares of all languages. Repeated rows get equal
    results, an empty table none. Other columns are not read.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    model = spark.sparkContext.broadcast(fit(rows))

    @F.pandas_udf("lang string, score double")
    def judge(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame(model.value.judge(texts), columns=["lang", "score"])

    return rows.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), judge("text").alias("j")).select(
        "doc_id", "held_out", F.col("j.lang").alias("lang_pred"), F.col("j.score").alias("score")
    )


def op9_language_id(spark, sf_dir):
    return predicted(spark, table(spark, sf_dir, "documents"))
