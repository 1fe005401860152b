"""Exact duplicates through an exchange of Golomb-coded fingerprints.

Documents are handled in blocks. A block sorts its fingerprints, cuts them by owner
(ranges of the fingerprint) and sends each owner the gaps, Golomb-Rice coded: about
ten bits more than the logarithm of the spacing. Owners answer with one bit per
fingerprint, set where another block sent the same. Documents whose bit is set, or
whose fingerprint repeats within the block, are suspects; only their texts are
shuffled, and compared byte by byte.
"""

import math
import uuid

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import functions as F

from orderlens.llm.common import SPACE, hash_bitmap, in_bitmap, saved, table

BLOCK_ROWS = 1 << 17
OWNER_ROWS = 1 << 20
#: Bits of a fingerprint beyond the logarithm of the number of rows: one document in
#: 2**8 or so is a suspect for nothing.
SPARE_BITS = 8
_CODED = 1 << 14  # values coded at a time


def golomb_encode(values):
    """Golomb-Rice code of sorted distinct values from 0: (k, unary, rest).

    Quotients of the gaps in unary and their low k bits stand in streams of their own,
    so that both can be read without a loop.
    """
    gaps = np.diff(values, prepend=0).astype(np.int64)
    k = max(0, int(math.log2(max(1, int(values[-1]) / len(values) * math.log(2))))) if len(values) else 0
    quotient = gaps >> k
    unary = np.zeros(int(quotient.sum()) + len(gaps), np.uint8)
    unary[np.cumsum(quotient + 1) - 1] = 1
    rest = []
    for at in range(0, len(gaps), _CODED):  # so many codes are whole bytes
        bits = (gaps[at : at + _CODED, None] >> np.arange(k)) & 1
        rest.append(np.packbits(bits.astype(np.uint8).reshape(-1)).tobytes())
    return k, np.packbits(unary).tobytes(), b"".join(rest)


def golomb_decode(n, k, unary, rest):
    ones = np.flatnonzero(np.unpackbits(np.frombuffer(unary, np.uint8)))[:n]
    gaps = (np.diff(ones, prepend=-1) - 1) << k
    rest = np.frombuffer(rest, np.uint8)
    for at in range(0, n, _CODED):
        rows = min(_CODED, n - at)
        first = at * k // 8
        bits = np.unpackbits(rest[first : first + (rows * k + 7) // 8])[: rows * k].reshape(rows, k)
        gaps[at : at + rows] += (bits.astype(np.int64) << np.arange(k)).sum(axis=1)
    return np.cumsum(gaps)


_OUTBOX = "block string, owner int, n int, k int, unary binary, rest binary, repeats binary, doc_ids array<long>"


def _outbox(width, owner_bits, block_rows):
    def packed(ids, prints):
        ids, prints = pa.concat_arrays(ids), np.concatenate(prints)
        order = np.argsort(prints, kind="stable")
        ids, prints = ids.take(pa.array(order)), prints[order]
        values, first, counts = np.unique(prints, return_index=True, return_counts=True)
        owner = values >> (width - owner_bits)
        block, rows = uuid.uuid4().hex, []
        for number in np.unique(owner):
            a, b = np.searchsorted(owner, [number, number + 1])
            end = first[b] if b < len(first) else len(prints)
            k, unary, rest = golomb_encode(values[a:b] - (int(number) << (width - owner_bits)))
            repeats = counts[a:b].astype(np.int32).tobytes()
            rows.append((block, int(number), int(b - a), k, unary, rest, repeats, ids.slice(first[a], end - first[a])))
        columns = list(zip(*rows))
        offsets = np.cumsum([0, *map(len, columns[-1])])
        lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.concat_arrays(columns[-1]))
        kinds = [pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]
        arrays = [pa.array(c, kind) for c, kind in zip(columns, kinds)]
        return pa.RecordBatch.from_arrays([*arrays, lists], [c.split()[0] for c in _OUTBOX.split(", ")])

    def run(batches):
        ids, prints, held = [], [], 0
        for batch in batches:
            ids.append(batch.column("doc_id"))
            prints.append(batch.column("fp").to_numpy())
            held += batch.num_rows
            if held >= block_rows:
                yield packed(ids, prints)
                ids, prints, held = [], [], 0
        if held:
            yield packed(ids, prints)

    return run


def _answers(messages):
    """For each block's message a bitmap of its values that other blocks sent too."""
    rows = messages.select(["n", "k", "unary", "rest"]).to_pylist()
    lists = [golomb_decode(r["n"], r["k"], r["unary"], r["rest"]) for r in rows]
    values, counts = np.unique(np.concatenate(lists), return_counts=True)
    bits = [np.packbits(counts[np.searchsorted(values, x)] > 1).tobytes() for x in lists]
    return pa.table({"block": messages["block"], "owner": messages["owner"], "shared": pa.array(bits, pa.binary())})


def _suspects(batches):
    for batch in batches:
        for row in range(batch.num_rows):
            n = batch.column("n")[row].as_py()
            shared = np.unpackbits(np.frombuffer(batch.column("shared")[row].as_py(), np.uint8))[:n] == 1
            repeats = np.frombuffer(batch.column("repeats")[row].as_py(), np.int32)
            flagged = np.repeat(shared | (repeats > 1), repeats)
            ids = batch.column("doc_ids")[row].values.filter(pa.array(flagged))
            yield pa.RecordBatch.from_arrays([ids], ["doc_id"])


def suspects(spark, prints, block_rows=BLOCK_ROWS):
    """doc_id of every row of (doc_id, hash) that shares its shortened hash with another."""
    rows = max(2, prints.count())
    width = min(62, math.ceil(math.log2(rows)) + SPARE_BITS)
    owner_bits = max(3, math.ceil(math.log2(rows / OWNER_ROWS)))
    short = prints.select("doc_id", F.shiftrightunsigned("hash", 64 - width).alias("fp"))
    outbox = saved(spark, short.mapInArrow(_outbox(width, owner_bits, block_rows), _OUTBOX))
    messages = outbox.select("block", "owner", "n", "k", "unary", "rest")
    answers = messages.groupBy("owner").applyInArrow(_answers, "block string, owner int, shared binary")
    found = outbox.select("block", "owner", "n", "repeats", "doc_ids").join(answers, ["block", "owner"])
    return found.mapInArrow(_suspects, "doc_id long")


def exact_duplicates(spark, docs, id_col="doc_id", text_col="text", block_rows=BLOCK_ROWS):
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when they are after each run of ASCII white space became one space;
    null counts as empty. Of equal texts the row with the smallest doc_id stays (of
    rows that repeat it, the first in the input; rows without doc_id come last, and
    keep_id is null where all lack one). text_sha256 is that of the normalised text.
    An empty table gives an empty result. Other columns are not read.
    """
    norm = F.regexp_replace(F.coalesce(F.col(text_col), F.lit("")), SPACE, " ")
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), norm.alias("norm"))
    marked = saved(
        spark,
        texts.select(
            "doc_id",
            F.sha2(F.col("norm").cast("binary"), 256).alias("text_sha256"),
            F.xxhash64("norm").alias("hash"),
            F.monotonically_increasing_id().alias("row"),
        ),
    )
    bitmap = spark.sparkContext.broadcast(
        hash_bitmap(suspects(spark, marked, block_rows).select(F.xxhash64("doc_id").alias("hash")), "hash")
    )

    @F.pandas_udf("boolean")
    def suspected(hashes: pd.Series) -> pd.Series:
        return pd.Series(in_bitmap(bitmap.value, hashes.to_numpy().view(np.uint64)))

    # The bitmap may let a few others through; they end as texts that occur once.
    called = texts.where(suspected(F.xxhash64("doc_id"))).select(
        "norm", F.sha2(F.col("norm").cast("binary"), 256).alias("sha")
    )
    equal = called.groupBy("sha", "norm").agg(F.count("*").alias("n"))
    verified = equal.groupBy("sha").agg(F.sum("n").alias("n"), F.count("*").alias("texts")).where("n > 1")
    clash = F.raise_error(F.lit("different texts with one SHA-256"))
    verified = saved(spark, verified.select(F.when(F.col("texts") == 1, F.col("sha")).otherwise(clash).alias("sha")))
    first = F.struct(F.col("doc_id").isNull(), F.col("doc_id").alias("id"), F.col("row").alias("row"))
    # Summed up before they are joined, so that a large group of copies is one row, and
    # saved, so that the last join stands alone and can split such a group among tasks.
    groups = marked.groupBy("text_sha256").agg(F.min(first).alias("first"), F.count("*").alias("n"))
    groups = saved(spark, groups.join(verified, F.col("text_sha256") == F.col("sha")).select("sha", "first", "n"))
    out = marked.join(groups, F.col("text_sha256") == F.col("sha"), "left")
    return out.select(
        "doc_id",
        F.when(F.col("n").isNull(), F.col("doc_id")).otherwise(F.col("first.id")).alias("keep_id"),
        F.coalesce("n", F.lit(1)).cast("long").alias("group_size"),
        (F.col("n").isNull() | (F.col("row") == F.col("first.row"))).alias("kept"),
        "text_sha256",
    )


def op3_exact_dedup(spark, sf_dir):
    return exact_duplicates(spark, table(spark, sf_dir, "documents"))


OP3_SQL = """
WITH n AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', ' ', 'g') AS t FROM documents
)
SELECT doc_id, min(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
       doc_id = min(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256
FROM n
"""
