"""Repeated lines and passages: normalised units, global digests, first occurrence stays.

Three kinds of units are looked at, all as runs of words, lower-cased:

* every line that has a word, however short;
* from every start of a sentence or line as many of both as make ``LEAST_WORDS`` words,
  over line breaks, so that short lines and sentences count together;
* where a sentence has more than ``LONG_WORDS`` words, runs between content-defined cuts, at
  least ``LEAST_WORDS`` words long, that reach into it. A cut stands before a word whose
  hash, with the next word, is the smallest of some ``WINDOW`` words in a row, so it depends
  on the words around it alone.

A passage of ``SURE_WORDS`` words holds a whole unit wherever it stands, also in mid-sentence:
either its own sentences are short and a run of them lies inside, or a long one brings
cuts, at most ``WINDOW`` words apart and alike from the tenth word to the tenth last.

Units are compared by 128-bit digests.
"""

import re
from bisect import bisect_left

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import functions as F

from orderlens.llm.common import saved, table

LEAST_WORDS = 8
WINDOW = 11
LONG_WORDS = 16
#: Room for what decides a cut and a gap of cuts on either side, and a unit between.
SURE_WORDS = 4 * WINDOW + LEAST_WORDS
_UNIT = "digest binary, doc_id long, row long, start int, end int, words int"
_WORD = re.compile(r"[^\W_]+")
_SENTENCE_END = re.compile(r"[.!?][\"')\]%$&#*]*\s+")
_REMEMBERED = 200_000


class _Hashes(dict):
    """Hashes of words, most of them remembered."""

    def __missing__(self, word):
        if len(self) > _REMEMBERED:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass"))
        return value


_hashes = _Hashes()


def _cuts(words):
    """Places among the words where content-defined units begin and end."""
    one = np.fromiter(map(_hashes.__getitem__, words), np.uint64, len(words))
    two = (one[:-1] * np.uint64(0x9E3779B97F4A7C15)) ^ one[1:]
    two = (two ^ (two >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    if len(two) < WINDOW:
        return np.zeros(0, np.int64)
    least = np.lib.stride_tricks.sliding_window_view(two, WINDOW).argmin(axis=1)
    return np.unique(least + np.arange(len(least)))


def _pieces(text):
    """Lines as (start, end, starts of the sentences in it)."""
    start, size = 0, len(text)
    while start < size:
        end = text.find("\n", start)
        end = size if end < 0 else end
        yield start, end, [start, *[m.end() for m in _SENTENCE_END.finditer(text, start, end) if m.end() < end]]
        start = end + 1


def units(text):
    """(start, end, normalised text, words) of the units of a text, in its own offsets."""
    found = list(_WORD.finditer(text))
    starts, words = [m.start() for m in found], [m.group().lower() for m in found]
    spans, pieces = {}, []
    for start, end, sentences in _pieces(text):
        i, j = bisect_left(starts, start), bisect_left(starts, end)
        if i < j:
            spans[i, j] = start, end
            for a, b in zip(sentences, [*sentences[1:], end]):
                low, high = bisect_left(starts, a), bisect_left(starts, b)
                if low < high:
                    pieces.append((low, high, a, b))
    last = 0
    for i, _, a, _ in pieces:
        while last < len(pieces) and pieces[last][1] - i < LEAST_WORDS:
            last += 1
        if last == len(pieces):
            break
        spans.setdefault((i, pieces[last][1]), (a, pieces[last][3]))
    long = [(i, j) for i, j, _, _ in pieces if j - i > LONG_WORDS]
    if long:
        reached = np.zeros(len(words) + 1, np.int64)
        for i, j in long:
            reached[i + 1 : j + 1] = 1
        reached = np.cumsum(reached)
        cuts = _cuts(words)
        to = np.searchsorted(cuts, cuts + LEAST_WORDS)
        cuts, ends = cuts[to < len(cuts)], cuts[to[to < len(cuts)]]
        held = reached[ends] > reached[cuts]
        for i, j in zip(cuts[held].tolist(), ends[held].tolist()):
            spans.setdefault((i, j), (starts[i], found[j - 1].end()))
    for (i, j), (start, end) in spans.items():
        yield start, end, " ".join(words[i:j]), j - i


def _unit_batches(batches):
    def packed(rows):
        columns = list(zip(*rows)) or [()] * 6
        kinds = [pa.binary(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32()]
        arrays = [pa.array(c, kind) for c, kind in zip(columns, kinds)]
        return pa.RecordBatch.from_arrays(arrays, [c.split()[0] for c in _UNIT.split(", ")])

    for batch in batches:
        rows = []
        for doc_id, row, text in zip(batch.column("doc_id").to_pylist(), batch.column("row").to_pylist(), batch.column("text")):
            for start, end, norm, words in units(text.as_py()):
                rows.append((xxhash.xxh3_128_digest(norm.encode("utf-8", "surrogatepass")), doc_id, row, start, end, words))
            if len(rows) > 50_000:
                yield packed(rows)
                rows = []
        yield packed(rows)


def _rows(docs, id_col, text_col):
    return docs.where(F.col(text_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), F.monotonically_increasing_id().alias("row")
    )


def _repeats(spark, texts):
    """Units that occurred before, with the row they are in."""
    found = saved(spark, texts.mapInArrow(_unit_batches, _UNIT))
    place = F.struct(F.col("doc_id").isNull(), F.col("doc_id").alias("id"), F.col("row").alias("row"), F.col("start").alias("start"))
    firsts = found.groupBy("digest").agg(F.min(place).alias("first"), F.count("*").alias("n")).where("n > 1")
    # Saved, so that the join stands alone and a frequent digest can be split among tasks.
    again = found.join(saved(spark, firsts.select("digest", "first")), "digest")
    return again.where((F.col("row") != F.col("first.row")) | (F.col("start") != F.col("first.start")))


def repeated_units(spark, docs, id_col="doc_id", text_col="text"):
    """Every unit that occurred before: doc_id, start, end, words, first_doc_id, first_start.

    Occurrences are ranked by (doc_id, row, start), rows without doc_id last; rows that
    share a doc_id, or have none, are told apart and rank as they stand in the input. The
    first stays and is named beside the others. Offsets count characters of the original
    text, end exclusive. Copies of a document repeat all its units. Null, empty and
    wordless texts have no units; texts of any length are read whole. An empty table gives an
    empty result. Other columns are not read, whatever their names.
    """
    return _repeats(spark, _rows(docs, id_col, text_col)).select(
        "doc_id", "start", "end", "words", F.col("first.id").alias("first_doc_id"), F.col("first.start").alias("first_start")
    )


_CUT = "doc_id long, text string, removed array<struct<start:int,end:int>>"


def _without(batches):
    for batch in batches:
        texts, lists = [], []
        for text, spans in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist()):
            removed = []
            for span in sorted(spans, key=lambda s: (s["start"], s["end"])):
                if removed and span["start"] <= removed[-1]["end"]:
                    removed[-1]["end"] = max(span["end"], removed[-1]["end"])
                else:
                    removed.append(dict(span))
            ends = [0, *[s["end"] for s in removed]]
            starts = [*[s["start"] for s in removed], len(text)]
            texts.append("".join(text[a:b] for a, b in zip(ends, starts)))
            lists.append(removed)
        kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
        columns = [batch.column("doc_id"), pa.array(texts, pa.string()), pa.array(lists, kind)]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "text", "removed"])


def without_repeats(spark, docs, id_col="doc_id", text_col="text"):
    """doc_id, text without its repeated units, and the removed spans in original offsets.

    Only rows that lose something are listed, one by one also where they share a doc_id or
    have none. Spans that touch or overlap count as one. A document's spans are gathered
    in one place, bounded by its own length.
    """
    texts = saved(spark, _rows(docs, id_col, text_col))
    spans = _repeats(spark, texts).groupBy("row").agg(F.collect_set(F.struct("start", "end")).alias("spans"))
    return texts.join(spans, "row").select("doc_id", "text", "spans").mapInArrow(_without, _CUT)


def op8_substring_dedup(spark, sf_dir):
    return repeated_units(spark, table(spark, sf_dir, "documents"))
