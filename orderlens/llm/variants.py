"""Spelling variants: Bloom-guided neighbourhoods of a vocabulary.

Two words are near if they differ by one inserted, deleted or replaced code point. Every
word generates its deletions and replacements (an insertion is the longer word's deletion)
as hashes alone, all positions at once, and probes them against blocked Bloom filters, one
for each word length. Only what they let through becomes text, and an exact join with the
vocabulary removes their false positives.

A filter grows with the words of its length. At most ``PASS_BYTES`` of filters are
broadcast at a time: lengths that together need more are probed in several passes, and a
length that needs more alone is divided by hash.
"""

import re
from collections import Counter, defaultdict
from functools import reduce
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.llm.common import crc_sql, crc_table_sql, saved, table

# Letters of words after A-Z are lower-cased, as code points.
LETTERS = [*range(ord("a"), ord("z") + 1), *range(0xC0, 0x100)]
LEAST_LENGTH = 6
LEAST_COUNT = 5
RATIO = 5
TORN_EVERY = 199

PASS_BYTES = 16 << 20
BLOCK_BITS = 512
PROBES = 6
BITS_PER_WORD = 16
_LEAST_BLOCKS = 64
_CHUNK_BLOCKS = 64  # blocks that are built in one row: 4 KiB
_AT_ONCE = 1 << 20
_HELD = 200_000

_ALPHABET = np.array(LETTERS, np.uint64)
_BASE = np.uint64(0x9E3779B97F4A7C15)  # odd, hence with an inverse modulo 2**64
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


# --- counting words -----------------------------------------------------------------


def torn(run, doc, every):
    """``run`` as a document spells it: without one code point where the crc of both says so."""
    h = crc32(run.encode(), doc)
    if h % every:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def _run_counts(batches, least_length, every):
    runs_of = re.compile(f"[a-zÀ-ÿ]{{{least_length},}}").findall
    counts = Counter()

    def rows():
        words = [w for w in counts if len(w) >= least_length]
        columns = [pa.array(words, pa.string()), pa.array([counts[w] for w in words], pa.int64())]
        counts.clear()
        return pa.RecordBatch.from_arrays(columns, ["word", "n"])

    for batch in batches:
        for doc, text in zip(batch.column("id").to_pylist(), batch.column("text")):
            if not text.is_valid:
                continue
            found = Counter(runs_of(text.as_py().lower().decode()))
            seed = crc32(f"{doc}:".encode())
            for run, n in found.items():
                counts[torn(run, seed, every) if every else run] += n
            if len(counts) > _HELD:
                yield rows()
    yield rows()


def word_counts(spark, docs, id_col="doc_id", text_col="text", least_length=LEAST_LENGTH, least_count=LEAST_COUNT, torn_every=None):
    """word and n (occurrences) of the words of ``docs``, saved.

    Words are maximal runs of A-Z, a-z and U+00C0 to U+00FF, A-Z lower-cased, with at least
    ``least_length`` code points and ``least_count`` occurrences. With ``torn_every`` a run
    loses one code point in the documents where that number divides the crc32 of
    ``<id>:<run>``. Null and empty texts have no words, a missing id is an empty one, rows
    that repeat count each. Texts and runs of any length are read whole.
    """
    text = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), F.col(text_col).cast("binary").alias("text"))
    runs = text.mapInArrow(lambda batches: _run_counts(batches, least_length, torn_every), "word string, n long")
    return saved(spark, runs.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count))


# --- hashes -------------------------------------------------------------------------


def _mix(x):
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def _powers(n):
    out = np.full(n, _BASE, np.uint64)
    out[:1] = 1
    return np.cumprod(out)


def _codes(words):
    """Code points of words of one length, a row per word."""
    flat = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
    return flat.reshape(len(words), -1).astype(np.uint64)


def raw_hashes(codes):
    """Polynomial hashes of rows of code points: an edit changes them by one term."""
    return (codes * _powers(codes.shape[1])).sum(axis=1, dtype=np.uint64)


def deletions(codes):
    """Raw hashes of the words without one code point: (word, position, hash), without repeats."""
    terms = codes * _powers(codes.shape[1])
    upto = np.cumsum(terms, axis=1, dtype=np.uint64)
    hashes = upto - terms + (upto[:, -1:] - upto) * _INVERSE
    own = np.ones(codes.shape, bool)
    own[:, 1:] = codes[:, 1:] != codes[:, :-1]  # of equal neighbours one suffices
    word, at = np.nonzero(own)
    return word, at, hashes[word, at]


def replacements(codes, first, last):
    """Raw hashes with the code point at positions first..last-1 replaced by a larger letter: (word, position, letter, hash)."""
    powers, whole = _powers(codes.shape[1]), raw_hashes(codes)
    word, at, letter = np.nonzero(codes[:, first:last, None] < _ALPHABET)
    at += first
    return word, at, _ALPHABET[letter], whole[word] + (_ALPHABET[letter] - codes[word, at]) * powers[at]


# --- filters --------------------------------------------------------------------------


class Shard:
    """Where the filter of a word length, or one part of it, stands: blocks first..first+blocks-1."""

    def __init__(self, part, parts, first, blocks):
        self.part, self.parts, self.first, self.blocks = part, parts, first, blocks

    def places(self, raw):
        """(is it of this part, block, hash of the bits) of raw hashes."""
        mixed = _mix(raw)
        mine = _mix(mixed ^ _BASE) % np.uint64(self.parts) == self.part
        block = ((mixed >> np.uint64(32)) * np.uint64(self.blocks)) >> np.uint64(32)
        return mine, block.astype(np.int64) + self.first, _mix(mixed + _BASE)


def _bit(bits_hash, probe):
    return (bits_hash >> np.uint64(9 * probe)) & np.uint64(BLOCK_BITS - 1)


def passes(lengths, pass_bytes=PASS_BYTES):
    """Shards by length of every pass, from the number of words of each length.

    A word's neighbourhood grows with its length, and so do the bits spent on it.
    """
    room = pass_bytes * 8 // BLOCK_BITS
    out, used = [{}], 0
    for length, words in sorted(lengths.items()):
        bits = words * BITS_PER_WORD * max(1, length // 32)
        blocks = max(_LEAST_BLOCKS, -(-bits // BLOCK_BITS))
        parts = -(-blocks // room)
        for part in range(parts):
            if used and used + -(-blocks // parts) > room:
                out.append({})
                used = 0
            out[-1][length] = Shard(part, parts, used, -(-blocks // parts))
            used += -(-blocks // parts)
    return out


def _by_length(batch, wanted):
    words = defaultdict(list)
    for row, word in enumerate(batch.column("word").to_pylist()):
        if wanted(len(word)):
            words[len(word)].append((row, word))
    return words


def _filter(vocabulary, shards):
    """The blocked filters of one pass as bytes; at most ``PASS_BYTES`` come to the driver."""
    size = _CHUNK_BLOCKS * BLOCK_BITS // 8

    def placed(batches):
        for batch in batches:
            for length, words in _by_length(batch, shards.__contains__).items():
                mine, block, bits = shards[length].places(raw_hashes(_codes([w for _, w in words])))
                columns = [block[mine] // _CHUNK_BLOCKS, block[mine] % _CHUNK_BLOCKS, bits[mine].view(np.int64)]
                yield pa.RecordBatch.from_arrays(list(map(pa.array, columns)), ["chunk", "block", "bits"])

    def packed(batches):
        for batch in batches:
            rows = []
            for entries in batch.column("entries"):
                block, bits = (entries.values.field(c).to_numpy() for c in ("block", "bits"))
                chunk = np.zeros(size * 8, np.uint8)
                for probe in range(PROBES):
                    chunk[block * BLOCK_BITS + _bit(bits.view(np.uint64), probe).astype(np.int64)] = 1
                rows.append(np.packbits(chunk, bitorder="little").tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("chunk"), pa.array(rows, pa.binary())], ["chunk", "bits"])

    blocks = max(s.first + s.blocks for s in shards.values())
    out = np.zeros(-(-blocks // _CHUNK_BLOCKS) * size, np.uint8)
    entries = vocabulary.mapInArrow(placed, "chunk long, block long, bits long")
    chunks = entries.groupBy("chunk").agg(F.collect_list(F.struct("block", "bits")).alias("entries"))
    for chunk, bits in chunks.mapInArrow(packed, "chunk long, bits binary").collect():
        out[chunk * size : (chunk + 1) * size] = np.frombuffer(bytes(bits), np.uint8)
    return out


def held(bits, shard, raw):
    """Which of the raw hashes the filter of a shard lets through, as positions."""
    mine, block, hashes = shard.places(raw)
    left = np.flatnonzero(mine)
    for probe in range(PROBES):
        at = block[left] * BLOCK_BITS + _bit(hashes[left], probe).astype(np.int64)
        left = left[(bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1]
    return left


def _candidates(batches, shards, bits):
    """(word, n, near): edits of the words that a pass's filters let through."""
    bits = bits.value
    for batch in batches:
        n = batch.column("n").to_pylist()
        for length, words in _by_length(batch, lambda k: k in shards or k - 1 in shards).items():
            at_once = max(1, _AT_ONCE // (length * len(LETTERS)))
            span = max(1, _AT_ONCE // len(LETTERS))
            for a in range(0, len(words), at_once):
                some = words[a : a + at_once]
                codes, out = _codes([w for _, w in some]), []
                if length - 1 in shards:
                    word, at, raw = deletions(codes)
                    for k in held(bits, shards[length - 1], raw):
                        row, text = some[word[k]]
                        out.append((row, text, text[: at[k]] + text[at[k] + 1 :]))
                for first in range(0, length if length in shards else 0, span):
                    word, at, letter, raw = replacements(codes, first, min(first + span, length))
                    for k in held(bits, shards[length], raw):
                        row, text = some[word[k]]
                        out.append((row, text, text[: at[k]] + chr(letter[k]) + text[at[k] + 1 :]))
                if out:
                    rows, texts, near = zip(*out)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(texts, pa.string()), pa.array([n[r] for r in rows], pa.int64()), pa.array(near, pa.string())], ["word", "n", "near"]
                    )


# --- the operator ---------------------------------------------------------------------


def near_words(spark, vocabulary, pass_bytes=PASS_BYTES):
    """Each pair of near words of a vocabulary (word, n) in both directions: word, near, near_n."""
    lengths = vocabulary.groupBy(F.length("word").alias("length")).count()
    found = []
    for shards in passes({r[0]: r[1] for r in lengths.collect()}, pass_bytes):
        if shards:
            bits = spark.sparkContext.broadcast(_filter(vocabulary, shards))
            probe = lambda batches, shards=shards, bits=bits: _candidates(batches, shards, bits)
            found.append(saved(spark, vocabulary.mapInArrow(probe, "word string, n long, near string")))
            bits.unpersist()
    if not found:
        return vocabulary.select("word", F.col("word").alias("near"), F.col("n").alias("near_n")).where(F.lit(False))
    known = vocabulary.select(F.col("word").alias("near"), F.col("n").alias("near_n"))
    pairs = reduce(DataFrame.unionByName, found).join(known, "near")
    there = F.struct("word", "near", "near_n")
    back = F.struct(F.col("near").alias("word"), F.col("word").alias("near"), F.col("n").alias("near_n"))
    return pairs.select(F.inline(F.array(there, back)))


def variants(spark, vocabulary, ratio=RATIO, pass_bytes=PASS_BYTES):
    """word, n, n_near, form, form_n and root of every word of a vocabulary (word, n).

    A vocabulary has each word once, in letters a-z and U+00C0 to U+00FF; words with null n
    are not read. n_near counts the near words. form is the near word of largest n (of
    equal ones the smallest by code point) if that is at least ``ratio`` times the word's
    own n, form_n its n; both are null otherwise. root is where following the forms from a
    word ends: each step multiplies n, so it always ends, and jumps of doubled length
    get there in a few rounds. An empty vocabulary gives an empty result.
    """
    vocabulary = vocabulary.where(F.col("word").isNotNull() & F.col("n").isNotNull()).select("word", "n")
    best = F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best")
    near = near_words(spark, vocabulary, pass_bytes).groupBy("word").agg(F.count("*").alias("n_near"), best)
    much = -F.col("best.less") >= ratio * F.col("n")
    forms = saved(
        spark,
        vocabulary.join(near, "word", "left").select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(much, F.col("best.near")).alias("form"),
            F.when(much, -F.col("best.less")).alias("form_n"),
        ),
    )
    roots = forms.where(F.col("form").isNotNull()).select("word", F.col("form").alias("root"))
    while True:
        onward = roots.select(F.col("word").alias("root"), F.col("root").alias("further"))
        step = roots.join(onward, "root", "left").select("word", F.coalesce("further", "root").alias("root"), "further")
        step = saved(spark, step)
        roots = step.select("word", "root")
        if step.where(F.col("further").isNotNull()).isEmpty():
            break
    return forms.join(roots, "word", "left").withColumn("root", F.coalesce("root", "word"))


def op13_variants(spark, sf_dir):
    """Spelling variants among the words of all documents."""
    words = word_counts(spark, table(spark, sf_dir, "documents"), torn_every=TORN_EVERY)
    return variants(spark, words).select("word", "form", "root", "n", "n_near", "form_n")


_CODES = """flatten(list_transform(string_split(doc || ':' || run, ''),
    lambda x: CASE WHEN unicode(x) < 128 THEN [unicode(x)::BIGINT] ELSE [192 + (unicode(x) >> 6)::BIGINT, 128 + (unicode(x) & 63)::BIGINT] END))"""

OP13_SQL = f"""
WITH RECURSIVE {crc_table_sql()}, runs AS (
  SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS doc,
         translate(unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
  FROM documents
), counted AS (
  SELECT doc, run, count(*) AS n FROM runs WHERE length(run) >= {LEAST_LENGTH} GROUP BY doc, run
), hashed AS (
  SELECT run, n, {crc_sql(_CODES, "tab")} AS h FROM counted, crc_table
), spelled AS (
  SELECT n, CASE WHEN h % {TORN_EVERY} = 0
                 THEN substr(run, 1, (h % length(run))::BIGINT) || substr(run, (h % length(run))::BIGINT + 2) ELSE run END AS word
  FROM hashed
), words AS MATERIALIZED (
  SELECT word, CAST(sum(n) AS BIGINT) AS n FROM spelled WHERE length(word) >= {LEAST_LENGTH} GROUP BY word HAVING sum(n) >= {LEAST_COUNT}
), shorter AS (
  SELECT word, n, place, substr(word, 1, place - 1) || substr(word, place + 1) AS rest
  FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS place FROM words)
), pairs AS (
  SELECT a.word, b.word AS near, b.n AS near_n
  FROM shorter a JOIN shorter b ON a.place = b.place AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT s.word, w.word, w.n FROM shorter s JOIN words w ON s.rest = w.word
  UNION SELECT w.word, s.word, s.n FROM shorter s JOIN words w ON s.rest = w.word
), best AS (
  SELECT word, count(*) AS n_near, max(near_n) AS most FROM pairs GROUP BY word
), forms AS MATERIALIZED (
  SELECT w.word, w.n, coalesce(b.n_near, 0) AS n_near, CASE WHEN b.most >= {RATIO} * w.n THEN b.most END AS form_n,
         CASE WHEN b.most >= {RATIO} * w.n THEN (SELECT min(near) FROM pairs p WHERE p.word = w.word AND p.near_n = b.most) END AS form
  FROM words w LEFT JOIN best b ON b.word = w.word
), chain(word, reached, depth) AS (
  SELECT word, word, 0 FROM forms
  UNION ALL
  SELECT c.word, f.form, c.depth + 1 FROM chain c JOIN forms f ON f.word = c.reached WHERE f.form IS NOT NULL
)
SELECT f.word, f.form, r.root, f.n, f.n_near, f.form_n
FROM forms f JOIN (SELECT word, arg_max(reached, depth) AS root FROM chain GROUP BY word) r ON r.word = f.word
"""
