"""SimHash near-duplicates: pigeonhole blocks, Hamming check, components.

A fingerprint of 64 bits is cut into six blocks. Two fingerprints that differ in at
most three bits agree in at least three of the blocks, so each is listed under its
twenty choices of three blocks (32 bits or so) and compared with those that share a
key. Fingerprints are made distinct first, so copies cost one row per key.

Keys are handled as sorted runs in bounded memory. A key with more than ``RUN_LIMIT``
fingerprints is cut again by the same rule on its remaining bits; at least 47 bits are
then fixed, so that such a run has 2**17 members at most. No pairs of a run leave the
task: its links are contracted to one link per fingerprint to the smallest it is
connected with, which keeps the components exact and the rows linear.
"""

from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from orderlens.llm.common import components, free_name, numbered, saved, table

SHINGLE_WORDS = 3
SEED = 42
DISTANCE = 3
BLOCKS = 2 * DISTANCE
RUN_LIMIT = 512
_CHUNK = 1 << 16
_NUMBER_AT = 40  # a key's choice of blocks stands above its bits


def _cuts(bits, blocks=BLOCKS):
    """(shift, width) of blocks of nearly equal width."""
    edges = [round(i * bits / blocks) for i in range(blocks + 1)]
    return [(low, high - low) for low, high in zip(edges, edges[1:])]


_CUTS = _cuts(64)
_CHOICES = list(combinations(range(BLOCKS), BLOCKS - DISTANCE))


def fingerprint(text):
    """SimHash of the lower-cased three-word shingles of a text given as bytes."""
    words = text.lower().split() if text else []
    if not words:
        return 0
    total = max(1, len(words) - SHINGLE_WORDS + 1)
    ones = np.zeros(64, np.int64)
    for at in range(0, total, _CHUNK):
        part = words[at : at + _CHUNK + SHINGLE_WORDS - 1]
        shingles = zip(part, part[1:], part[2:]) if total > 1 or len(words) == SHINGLE_WORDS else [words]
        hashes = np.fromiter(map(xxh64_intdigest, map(b" ".join, shingles), repeat(SEED)), np.uint64)
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > total, bitorder="little").view(np.int64)[0])


def _fingerprint_batches(batches):
    for batch in batches:
        prints = pa.array([fingerprint(text.as_py()) for text in batch.column("text")], pa.int64())
        names = [name for name in batch.schema.names if name != "text"]
        yield pa.RecordBatch.from_arrays([*map(batch.column, names), prints], [*names, "fp"])


def fingerprints(docs, id_col="doc_id", text_col="text", keep=None):
    """doc_id and fp (the fingerprint as a signed long) of every row; ``keep`` names a string beside them."""
    kept = [keep] if keep else []
    text = F.col(text_col).cast("binary").alias("text")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), *kept, text)
    return rows.mapInArrow(_fingerprint_batches, ", ".join(["doc_id long", *[f"`{name}` string" for name in kept], "fp long"]))


def _keys(fp):
    """The twenty keys of a fingerprint: number of the choice, then the bits of its blocks."""
    out = []
    for number, choice in enumerate(_CHOICES):
        key = F.lit(0).cast("long")
        for block in choice:
            shift, width = _CUTS[block]
            bits = F.shiftrightunsigned(fp, shift).bitwiseAND(F.lit((1 << width) - 1).cast("long"))
            key = F.shiftleft(key, width).bitwiseOR(bits)
        out.append(key.bitwiseOR(F.lit(number << _NUMBER_AT).cast("long")))
    return F.explode(F.array(*out))


def _finer(batches):
    """Rows of crowded keys under twenty finer keys each, cut from their remaining bits."""
    for batch in batches:
        key, fp = batch.column("key").to_numpy(), batch.column("fp").to_numpy().view(np.uint64)
        number = key >> _NUMBER_AT
        for n in np.unique(number):
            mine = number == n
            rest, used = np.zeros(mine.sum(), np.uint64), 0
            for block in set(range(BLOCKS)) - set(_CHOICES[n]):
                shift, width = _CUTS[block]
                rest |= ((fp[mine] >> np.uint64(shift)) & np.uint64((1 << width) - 1)) << np.uint64(used)
                used += width
            cuts = _cuts(used)
            for m, choice in enumerate(_CHOICES):
                low = np.zeros(len(rest), np.uint64)
                for block in choice:
                    shift, width = cuts[block]
                    low = (low << np.uint64(width)) | ((rest >> np.uint64(shift)) & np.uint64((1 << width) - 1))
                fine = (low | np.uint64(m << 20)).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key[mine]), pa.array(fine), pa.array(fp[mine].view(np.int64))], ["key", "fine", "fp"]
                )


def _contracted(run, fp):
    """Links of equal runs as (fingerprint, smallest position it is connected with)."""
    n = len(fp)
    label = np.arange(n)
    ends, held = [], 0

    def join(a, b):
        while True:
            low = np.minimum(label[a], label[b])
            if (label[a] == low).all() and (label[b] == low).all():
                return
            np.minimum.at(label, label[a], low)
            np.minimum.at(label, label[b], low)
            while (label[label] != label).any():
                label[:] = label[label]

    at, step = np.arange(n), 1
    while True:
        at = at[: np.searchsorted(at, n - step)]
        at = at[run[at] == run[at + step]]
        if not len(at):
            break
        near = at[np.bitwise_count(fp[at] ^ fp[at + step]) <= DISTANCE]
        if len(near):
            ends.append((near, near + step))
            held += len(near)
        if held > 1 << 19:
            join(*map(np.concatenate, zip(*ends)))
            ends, held = [], 0
        step += 1
    if ends:
        join(*map(np.concatenate, zip(*ends)))
    moved = np.flatnonzero(label != np.arange(n))
    return fp[moved].view(np.int64), fp[label[moved]].view(np.int64)


def _run_links(batches):
    """Links within the runs of equal (key, fine) of sorted rows; an open run waits."""

    def links(key, fine, fp):
        starts = np.ones(len(key), np.int64)
        starts[1:] = (key[1:] != key[:-1]) | (fine[1:] != fine[:-1])
        a, b = _contracted(np.cumsum(starts), fp)
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    kept = [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)]
    for batch in batches:
        new = [batch.column("key").to_numpy(), batch.column("fine").to_numpy(), batch.column("fp").to_numpy().view(np.uint64)]
        kept = [np.concatenate(x) for x in zip(kept, new)]
        if not len(kept[0]):
            continue
        is_last = (kept[0] == kept[0][-1]) & (kept[1] == kept[1][-1])
        cut = len(is_last) - int(is_last.sum())
        if cut:
            yield links(*[x[:cut] for x in kept])
            kept = [x[cut:] for x in kept]
    if len(kept[0]):
        yield links(*kept)


def links(spark, prints):
    """Contracted links (a, b) between distinct fingerprints of a column ``fp``."""
    keyed = prints.select(_keys(F.col("fp")).alias("key"), "fp")
    crowded = saved(spark, keyed.groupBy("key").count().where(F.col("count") > RUN_LIMIT).select("key"))
    whole = keyed.join(crowded, "key", "left_anti").select("key", F.lit(0).cast("long").alias("fine"), "fp")
    finer = keyed.join(crowded, "key", "left_semi").select("key", "fp")
    finer = finer.mapInArrow(_finer, "key long, fine long, fp long")
    found = []
    for rows in (whole, finer):
        runs = rows.repartition("key", "fine").sortWithinPartitions("key", "fine")
        found.append(runs.mapInArrow(_run_links, "a long, b long"))
    return found[0].unionByName(found[1])


def near_duplicates(spark, docs, id_col="doc_id", text_col="text"):
    """One row per row of ``docs``: doc_id, fingerprint, component_id.

    Words are runs of anything but ASCII white space, A-Z lower-cased. Null, empty and
    blank texts have the fingerprint zero and link like any other; a text of one or
    two words is one shingle. component_id is the smallest doc_id reachable over links
    of at most three differing bits, itself included; rows without doc_id join a
    component but never name it (null if it has no other member). Repeated rows get
    equal results, an empty table none. Other columns of ``docs`` are not read.
    """
    marked = saved(spark, fingerprints(docs, id_col, text_col))
    rooted = _rooted(spark, marked)
    named = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = saved(spark, rooted.join(named, "root").select("fp", "component_id"))
    return marked.join(named, "fp", "left").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def _rooted(spark, marked):
    """fp, first_id (its smallest doc_id) and root of every distinct fingerprint."""
    distinct = saved(spark, marked.groupBy("fp").agg(F.min("doc_id").alias("first_id")))
    joined = components(spark, links(spark, distinct))
    return distinct.join(joined.withColumnRenamed("node", "fp"), "fp", "left").withColumn(
        "root", F.coalesce("root", "fp")
    )


def one_of_each_group(spark, docs):
    """One row of ``docs`` of each component, the one with the smallest doc_id.

    Of rows that repeat that doc_id within the component the first by file and place
    stays; a row without doc_id stays only where no other has one. Rows of different
    components all stay, also if they share a doc_id or have none.
    """
    row = free_name(docs, "_row")
    known = numbered(spark, docs, row)
    marked = saved(spark, fingerprints(known, keep=row))
    # Per fingerprint first, so that a large component is one row per task.
    place = F.min(F.struct(F.col("doc_id").isNull().alias("missing"), "doc_id", row)).alias("place")
    firsts = marked.groupBy("fp").agg(place)
    firsts = firsts.join(_rooted(spark, marked).select("fp", "root"), "fp")
    stay = firsts.groupBy("root").agg(F.min("place").alias("place")).select(F.col("place")[row].alias(row))
    # As many rows as stay: never broadcast, at any size.
    return known.join(saved(spark, stay).hint("merge"), row, "left_semi").select(docs.columns)


def op1_simhash(spark, sf_dir):
    return near_duplicates(spark, table(spark, sf_dir, "documents"))
