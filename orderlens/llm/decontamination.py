"""Benchmark questions in documents, also with other numbers, names and units.

Both sides are turned into templates: numbers, names (capitalised words inside a
sentence) and units become typed slots, other words are lower-cased and stripped of
marks. A capitalised word that begins a sentence is read both ways, on both sides.
Windows of ``WINDOW`` template words are joined by hash. Windows of a document
that stand at the same distance from the windows of an item make one occurrence.
Windows whose slots have the item's own values count always; others only if the
occurrence is consistent: one value in the item is one value in the document
throughout. Two values of the item may become one. An item is in a document if at
least ``COVERAGE`` of its windows are found so.

A bitmap of the benchmark's hashes, of fixed size, keeps other windows of the
documents out of the shuffle.
"""

import re
from array import array
from functools import reduce
from operator import and_

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from orderlens.llm.common import free_name, hash_bitmap, in_bitmap, saved, table

WINDOW = 8
#: Windows with fewer plain words than this say nothing, unless the item has no others.
LEAST_PLAIN = 3
COVERAGE = 0.3

# Words that are read as units of measure.
UNITS = frozenset(
    "mm cm km ft yd mi mg kg oz lb lbs ml cl dl gal sec min hr hrs ms hz khz mhz ghz kw mw kj cal kcal pa kpa bar "
    "psi mph kph km/h m/s °c °f % $ € £ ¥ usd eur gbp cents dollars euros pounds meters metres kilometers kilometres "
    "miles inches feet yards grams kilograms liters litres gallons seconds minutes hours days weeks months years "
    "degrees percent".split()
)
_MARKS = re.compile(r"^[^\w%$€£¥°]+|[^\w%$€£¥°]+$")
_JUNK = re.compile(r"^[\W_]+|[\W_]+$")
_NUMBER = re.compile(r"[+-]?[$€£¥]?\d[\d.,:/]*(?:st|nd|rd|th|%)?$")
_END = re.compile(r"[.!?][\W_]*$")
_TYPES = (b"\x00number", b"\x00unit", b"\x00name")
_REMEMBERED = 1 << 18
_PIECE_BYTES = 1 << 22


class _Lexicon(dict):
    """Numbers words; per number what they are at the start of and inside a sentence."""

    def __init__(self):
        self.start, self.inside = array("Q"), array("Q")
        self.start_slot, self.inside_slot, self.ends = array("b"), array("b"), array("b")
        self.value = []

    def __missing__(self, word):
        text = word.decode("utf-8", "replace")
        core = _MARKS.sub("", text)
        bare = _JUNK.sub("", text)
        low = bare.lower()
        if _NUMBER.match(core):
            first = inside = _TYPES[0]
        elif core.lower() in UNITS:
            first = inside = _TYPES[1]
        else:
            first = low.encode()
            inside = _TYPES[2] if len(bare) > 1 and bare[0].isupper() and bare[1:].islower() else first
        number = len(self.value)
        self.start.append(xxh64_intdigest(first) if first else 0)
        self.inside.append(xxh64_intdigest(inside) if inside else 0)
        self.start_slot.append(first in _TYPES)
        self.inside_slot.append(inside in _TYPES)
        self.ends.append(bool(_END.search(text)))
        self.value.append(low or core)
        self[word] = number
        return number


class _Templates:
    """Template words of some texts, one after the other.

    hashes and slots: the first reading, ``other`` and ``other_slots`` the second, which
    differs where a word that begins a sentence is capitalised: it may be a name. ids
    are word numbers, text tells which text a word is of. Words without a letter, digit
    or unit are left out.
    """

    def __init__(self, texts, lexicon):
        numbered = []
        for text in texts:
            words = text.split()
            numbered.append(np.fromiter(map(lexicon.__getitem__, words), np.int64, len(words)))
        ids = np.concatenate([np.zeros(0, np.int64), *numbered])
        text = np.repeat(np.arange(len(numbered)), [len(x) for x in numbered])
        start, inside = np.array(lexicon.start, np.uint64), np.array(lexicon.inside, np.uint64)
        start_slot, inside_slot, ends = (np.array(x, bool) for x in (lexicon.start_slot, lexicon.inside_slot, lexicon.ends))
        first = np.ones(len(ids), bool)
        first[1:] = ends[ids[:-1]] | (text[1:] != text[:-1])
        kept = start[ids] != 0
        first, self.ids, self.text = first[kept], ids[kept], text[kept]
        self.other, self.other_slots = inside[self.ids], inside_slot[self.ids]
        self.hashes = np.where(first, start[self.ids], self.other)
        self.slots = np.where(first, start_slot[self.ids], self.other_slots)


def readings(t, length, most):
    """(places, hashes, slots, second) of the windows of so many words, in all their readings.

    The first yield has every window in the first reading. ``second`` marks the words
    that are taken in their second reading. Windows with more than ``most`` words of
    two readings are read with every ``most``-th of those alike.
    """
    n = len(t.hashes) - length + 1
    if n <= 0:
        return

    def within(mask):
        sums = np.concatenate([[0], np.cumsum(mask)])
        return sums[length:] - sums[:-length]

    whole = t.text[:n] == t.text[length - 1 :]
    double = t.hashes != t.other
    k = min(most, int(within(double)[whole].max(initial=0)))
    number = np.cumsum(double) - 1
    groups = [double & (number % k == i) for i in range(k)]
    held = [within(group) > 0 for group in groups]
    for reading in range(1 << k):
        second, here = np.zeros(len(double), bool), whole.copy()
        for i in range(k):
            if reading >> i & 1:
                second |= groups[i]
                here &= held[i]
        at = np.flatnonzero(here)
        yield at, windows(np.where(second, t.other, t.hashes), length, at), np.where(second, t.other_slots, t.slots), second


def _in_pieces(batch):
    """Rows of a batch as (keys, texts), a few megabytes at a time; a key is the other columns."""
    others = [name for name in batch.schema.names if name != "text"]
    keys, texts, size = [], [], 0
    for row in range(batch.num_rows):
        keys.append(tuple(batch.column(name)[row].as_py() for name in others))
        texts.append(batch.column("text")[row].as_py())
        size += len(texts[-1])
        if size >= _PIECE_BYTES or row == batch.num_rows - 1:
            yield keys, texts
            keys, texts, size = [], [], 0


def windows(hashes, length, at):
    """One hash per window of so many template words, at the given places."""
    out = np.full(len(at), length, np.uint64)
    for j in range(length):
        out = (out ^ hashes[at + j]) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(32)
    return out


_SLOTS = "array<struct<j:int,value:string,start:boolean>>"
_SLOT_LIST = pa.list_(pa.struct([("j", pa.int32()), ("value", pa.string()), ("start", pa.bool_())]))


def _slot_values(lexicon, t, at, length, slots, second):
    """The slots of a window; ``start`` where a word that begins a sentence is taken for a name."""
    return [
        {"j": int(j), "value": lexicon.value[t.ids[at + j]], "start": bool(second[at + j])} for j in np.flatnonzero(slots[at : at + length])
    ]


def _item_windows(batches):
    """Windows of benchmark items: of full length, or the whole of a shorter item.

    Those that say too little in a further reading are weak: only exact copies count.
    """
    lexicon = _Lexicon()
    for batch in batches:
        rows = []
        for item_id, text in ((i, text) for keys, texts in _in_pieces(batch) for (i,), text in zip(keys, texts)):
            t = _Templates([text], lexicon)
            length = min(WINDOW, len(t.hashes))
            if not length:
                continue
            told = None
            for at, hashed, slots, second in readings(t, length, WINDOW):
                plain = np.convolve(~slots, np.ones(length, int), "valid")
                enough = plain >= min(LEAST_PLAIN, length)
                weak = np.zeros(len(enough), bool) if told is None else ~enough
                if told is None:
                    told = enough if enough.any() else np.ones(len(enough), bool)
                of = int(told.sum())
                for place, value in zip(at[told[at]].tolist(), hashed.view(np.int64)[told[at]].tolist()):
                    values = _slot_values(lexicon, t, place, length, slots, second)
                    rows.append((item_id, value, place, length, of, values, bool(weak[place])))
        columns = list(zip(*rows)) or [()] * 7
        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), _SLOT_LIST, pa.bool_()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds)], ["item_id", "hash", "at", "length", "of", "slots", "weak"]
        )


#: Up to so many capitalised words that begin sentences in a window have all their readings in documents.
_DOUBLE = 3


def _document_windows(bitmap, lengths):
    def run(batches):
        lexicon = _Lexicon()
        for batch in batches:
            rows = []
            for keys, texts in _in_pieces(batch):
                if len(lexicon) > _REMEMBERED:
                    lexicon = _Lexicon()
                t = _Templates(texts, lexicon)
                begins = np.searchsorted(t.text, np.arange(len(texts)))
                for length in lengths:
                    for at, hashed, slots, second in readings(t, length, _DOUBLE):
                        hit = np.flatnonzero(in_bitmap(bitmap.value, hashed))
                        for place, value in zip(at[hit].tolist(), hashed.view(np.int64)[hit].tolist()):
                            text = t.text[place]
                            values = _slot_values(lexicon, t, place, length, slots, second)
                            rows.append((*keys[text], value, place - int(begins[text]), values))
            columns = list(zip(*rows)) or [()] * 5
            kinds = [pa.int64(), pa.binary(), pa.int64(), pa.int32(), _SLOT_LIST]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], [*_DOCUMENT, "hash", "doc_at", "doc_slots"])

    return run


def _bytes(df, id_col, text_col):
    return df.where(F.col(text_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("binary").alias("text")
    )


#: Rows of equal id and text are one document, so a digest of the text tells apart what the id does not.
_TEXT = "_text_digest"
_DOCUMENT = ["doc_id", _TEXT]


def _digest(text_col):
    return F.unhex(F.md5(F.col(text_col).cast("binary")))


def _leaking(spark, docs, benchmark, id_col="doc_id", text_col="text"):
    """The rows of ``leaks`` per document, which is to say per doc_id and text."""
    kind = f"item_id long, hash long, at int, length int, of int, slots {_SLOTS}, weak boolean"
    items = saved(spark, _bytes(benchmark, "item_id", text_col).mapInArrow(_item_windows, kind))
    # At most WINDOW lengths.
    lengths = sorted(r[0] for r in items.select("length").distinct().collect())
    bitmap = spark.sparkContext.broadcast(hash_bitmap(items, "hash"))
    kind = f"doc_id long, {_TEXT} binary, hash long, doc_at int, doc_slots {_SLOTS}"
    texts = _bytes(docs, id_col, text_col).withColumn("digest", _digest("text"))
    called = texts.mapInArrow(_document_windows(bitmap, lengths), kind)
    found = called.join(items, "hash").withColumn("shift", F.col("doc_at") - F.col("at"))
    values = [F.transform(c, lambda s: s["value"]) for c in ("slots", "doc_slots")]
    found = found.where(F.size("slots") == F.size("doc_slots")).withColumn("same", values[0] == values[1])
    found = saved(spark, found.where(~F.col("weak") | F.col("same")))
    place = [*_DOCUMENT, "item_id", "shift"]
    # One value of the document for one of the item, within an occurrence. Where a word
    # that begins a sentence may be no name, a clash is one of its own windows only.
    zipped = F.arrays_zip("slots", "doc_slots")
    pairs = found.select(*place, F.explode(zipped).alias("z")).select(
        *place,
        F.col("z.slots.value").alias("mine"),
        F.col("z.doc_slots.value").alias("theirs"),
        (F.col("z.slots.start") | F.col("z.doc_slots.start")).alias("start"),
    )
    pairs = pairs.groupBy(*place, "mine", "theirs").agg(F.min("start").alias("start"))
    many = pairs.groupBy(*place, "mine").agg(F.count("*").alias("n"), F.count_if(~F.col("start")).alias("sure")).where("n > 1")
    # The values of one occurrence: bounded by the length of its item.
    clashes = many.groupBy(*place).agg(F.max(F.col("sure") > 1).alias("clash"), F.collect_set("mine").alias("unsure"))
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in place]
    clashes = clashes.toDF(*[f"_{c}" for c in place], "clash", "unsure")
    torn = F.exists(zipped, lambda z: (z["slots"]["start"] | z["doc_slots"]["start"]) & F.array_contains("unsure", z["slots"]["value"]))
    kept = found.join(clashes, reduce(and_, same), "left").where(F.col("same") | F.col("clash").isNull() | ~(F.col("clash") | torn))
    kept = kept.groupBy(*_DOCUMENT, "item_id", "at").agg(
        F.first("of").alias("of"),
        F.min("doc_at").alias("low"),
        F.max(F.col("doc_at") + F.col("length")).alias("high"),
        F.max("same").alias("exact"),
    )
    whole = kept.groupBy(*_DOCUMENT, "item_id").agg(
        F.max("of").alias("windows"),
        F.count("*").cast("int").alias("windows_found"),
        F.min("low").alias("first_word"),
        F.max("high").alias("last_word"),
        F.min("exact").alias("exact"),
    )
    return whole.withColumn("coverage", F.col("windows_found") / F.col("windows")).where(F.col("coverage") >= COVERAGE)


def leaks(spark, docs, benchmark, id_col="doc_id", text_col="text"):
    """One row per (document, item_id) where the item is found in the document.

    windows: of the item, windows_found: distinct ones found with the item's values or in consistent occurrences,
    coverage: their ratio; first_word and last_word: where they lie, in template words
    of the document; exact: every slot has the item's own value. Null and empty texts
    on either side match nothing; documents without doc_id are listed with a null,
    rows that repeat both doc_id and text count as one document, other texts of an id
    are documents of their own; items that repeat an item_id count as one item. An
    empty table on either side gives an empty result. Other columns are not read.
    """
    return _leaking(spark, docs, benchmark, id_col, text_col).drop(_TEXT)


def without_items(spark, docs, benchmark):
    """The rows of ``docs`` that hold no benchmark item, whether they have a doc_id or not."""
    digest, *leaking_names = (free_name(docs, name) for name in (_TEXT, "_leaks_id", "_leaks_text"))
    found = _leaking(spark, docs, benchmark).select(*[F.col(c).alias(name) for c, name in zip(_DOCUMENT, leaking_names)])
    marked = docs.withColumn(digest, _digest("text"))
    same = [F.col(c).eqNullSafe(F.col(name)) for c, name in zip(("doc_id", digest), leaking_names)]
    return marked.join(saved(spark, found.distinct()), reduce(and_, same), "left_anti").select(docs.columns)


def clean(spark, docs, benchmark):
    """As ``without_items``, but rows without doc_id stay."""
    return without_items(spark, docs.where(F.col("doc_id").isNotNull()), benchmark).unionByName(docs.where(F.col("doc_id").isNull()))


def op10_decontamination(spark, sf_dir):
    return leaks(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
