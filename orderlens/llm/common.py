"""Helpers that several operators share: saved tables, total orders, bitmaps, components."""

import uuid

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orderlens.session import workspace

# Fixed value: the word pattern of all operators, and the space between words.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"


def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def saved(spark, df: DataFrame, compression="snappy") -> DataFrame:
    """Write a table to the shared folder and read it back.

    Later jobs, and repeats of lost tasks, see the same rows: what was drawn from the
    order or the partitions of the input is fixed from here on.
    """
    path = f"{workspace(spark)}/llm/{uuid.uuid4().hex}"
    df.write.parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)


def free_name(df, name):
    """``name``, or one like it, that no column of ``df`` has."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def numbered(spark, docs, name):
    """``docs`` with a text beside each row that tells rows apart, the same at every reading.

    Rows of files are known by file and place; only what is not read straight from files
    is written first, with numbers.
    """
    try:
        if "_metadata" in docs.columns:
            raise AnalysisException("a column of the table itself")
        place = F.concat(F.col("_metadata.file_path"), F.lit("#"), F.col("_metadata.row_index").cast("string"))
        return docs.withColumn(name, place)
    except AnalysisException:
        return saved(spark, docs.withColumn(name, F.monotonically_increasing_id().cast("string")))


def crc_remainder(id_column, divisor):
    """crc32 of the id as text, modulo a divisor; documents without an id count as empty."""
    text = F.coalesce(id_column.cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % divisor


def crc_table_sql():
    """CTE crc_table: ``tab``, the 256 remainders of the polynomial of crc32."""
    return """crc_steps(i, c, k) AS (
  SELECT i::BIGINT, i::BIGINT, 0 FROM range(256) r(i)
  UNION ALL
  SELECT i, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM crc_steps WHERE k < 8
), crc_table AS (SELECT list(c ORDER BY i) AS tab FROM crc_steps WHERE k = 8)"""


def crc_sql(codes, table_column):
    """crc32 of a list of byte values; the list starts with the initial remainder."""
    return f"xor(list_reduce(list_prepend(4294967295, {codes}), lambda c, b: xor(c >> 8, {table_column}[(xor(c, b) & 255) + 1])), 4294967295)"


def below_share(key_column, wanted, n):
    """Rows whose hash is among the smallest, about twice as many as ``wanted`` of ``n``.

    What is left for an exact choice of the smallest is then of bounded size, wherever
    it meets. All rows, where there are no more than twice as many.
    """
    place = F.shiftrightunsigned(key_column, 11) / F.lit(float(1 << 53))
    return place * n <= 2.0 * wanted


def running_totals(spark, df, order, sums=()):
    """Position of every row in a total order, and running sums up to and with it.

    The rows are dealt out by ranges of the order and numbered within each range;
    the ranges' totals, one row per partition, carry the numbering on. Adds ``pos``
    (from 1) and ``run_<column>``. The order has to tell all rows apart.
    """
    ranged = saved(spark, df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()))
    totals = ranged.groupBy("_part").agg(
        F.count("*").alias("pos"), *[F.sum(c).alias(f"run_{c}") for c in sums]
    )
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    names = ["pos", *[f"run_{c}" for c in sums]]
    offsets = totals.select("_part", *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"_{c}") for c in names])
    inside = Window.partitionBy("_part").orderBy(*order)
    upto = inside.rowsBetween(Window.unboundedPreceding, 0)
    # One row per partition of the range sort: small by construction.
    joined = ranged.join(F.broadcast(offsets), "_part")
    added = {"pos": F.row_number().over(inside) + F.col("_pos")}
    added |= {f"run_{c}": F.sum(c).over(upto) + F.col(f"_run_{c}") for c in sums}
    return joined.withColumns(added).drop("_part", *[f"_{c}" for c in names])


# --- bitmaps of hashes ------------------------------------------------------------

BITMAP_BITS = 26  # 8 MiB, whatever the number of hashes
_CHUNK_BITS = 15


def hash_bitmap(df, column):
    """A bitmap of 2**26 slots of the hashes in a column, as bytes.

    Of fixed size, so it may be broadcast: it lets through every hash of the column
    and, of other hashes, the share of slots in use. At most 2048 rows of 4 KiB come
    to the driver.
    """
    slot = F.shiftrightunsigned(F.col(column), 64 - BITMAP_BITS)
    slots = df.where(F.col(column).isNotNull()).select(
        F.shiftright(slot, _CHUNK_BITS).cast("int").alias("chunk"),
        slot.bitwiseAND((1 << _CHUNK_BITS) - 1).cast("int").alias("slot"),
    )
    chunks = slots.distinct().groupBy("chunk").agg(F.collect_list("slot").alias("slots"))

    def packed(batches):
        for batch in batches:
            rows = []
            for used in batch.column("slots").to_pylist():
                bits = np.zeros(1 << _CHUNK_BITS, np.uint8)
                bits[used] = 1
                rows.append(np.packbits(bits, bitorder="little").tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("chunk"), pa.array(rows, pa.binary())], ["chunk", "bits"])

    out = np.zeros(1 << (BITMAP_BITS - 3), np.uint8)
    size = 1 << (_CHUNK_BITS - 3)
    for chunk, bits in chunks.mapInArrow(packed, "chunk int, bits binary").collect():
        out[chunk * size : (chunk + 1) * size] = np.frombuffer(bytes(bits), np.uint8)
    return out


def in_bitmap(bitmap, hashes):
    """Which of the unsigned 64-bit hashes have their slot set."""
    slot = hashes >> np.uint64(64 - BITMAP_BITS)
    return (bitmap[(slot >> np.uint64(3)).astype(np.int64)] >> (slot & np.uint64(7)).astype(np.uint8)) & 1 == 1


# --- connected components ---------------------------------------------------------


def components(spark, edges):
    """Smallest member of the connected component of every node that has an edge.

    ``edges`` has two columns of one type, ``a`` and ``b``. Large-star and small-star
    steps alternate until the edges no longer change, every round saved. Returns
    ``node`` and ``root``.
    """
    edges = edges.where(F.col("a") != F.col("b")).select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    )
    edges, before = saved(spark, edges.distinct()), None
    while True:
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before or state[0] == 0:
            break
        before = state
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = saved(spark, small.unionByName(low.select("a", F.col("m").alias("b"))).distinct())
    nodes = edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("root"))
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return nodes.unionByName(roots)
