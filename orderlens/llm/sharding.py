"""Shards by a consistent-hash ring with virtual nodes and bounded loads.

The ring has 65,536 cells. Each shard stands at ``VNODES`` of them, a document belongs
to the cell of its id's hash and goes to the first shard clockwise. A shard takes no
more rows than its capacity; rows over it go on clockwise to the next shard that has
room. The capacities add up to the number of rows and differ by one at most, so every
shard ends full: row counts are at most one apart.

Only counts of cells leave the cluster, at most one per cell whatever the input. The
walk round the ring is done on them; what comes back is a table of about as many
pieces (cell, range of ranks, shard), and the documents take their place by their rank
within the cell.
"""

import hashlib
from bisect import bisect_left

from pyspark.sql import Window
from pyspark.sql import functions as F

from orderlens.llm.common import free_name, saved, table

SHARDS = 24
VNODES = 128
CELL_BITS = 16
CELLS = 1 << CELL_BITS
#: A cell with more rows than this is ranked in ``SALTS`` parts.
CROWDED_ROWS = 1 << 20
SALTS = 64
ADDED = ("size", "text_crc32", "law", "shard", "slot", "grown_shard")


def ring(shards, vnodes=VNODES):
    """Cells of the virtual nodes and their shards, in order of cells."""
    taken = {}
    for node in range(vnodes):
        for shard in range(shards):
            digest = hashlib.md5(f"shard {shard} node {node}".encode()).digest()
            taken.setdefault(int.from_bytes(digest[:4], "big") % CELLS, shard)
    return sorted(taken.items())


def capacities(rows, shards):
    return [rows // shards + (shard < rows % shards) for shard in range(shards)]


def walk(loads, owners, free):
    """Where the rows of each arc go: (arc, first row, end row, shard, first slot).

    All arcs offer their rows to their own shard, then what is left to the shard of
    the next virtual node, and so on, in ring order within a round.
    """
    free, filled, segments = list(free), [0] * len(free), []
    waiting = [(arc, 0) for arc, load in enumerate(loads) if load]
    step = 0
    while waiting:
        left = []
        for arc, start in waiting:
            shard = owners[(arc + step) % len(owners)]
            fits = min(loads[arc] - start, free[shard])
            if fits:
                segments.append((arc, start, start + fits, shard, filled[shard]))
                free[shard] -= fits
                filled[shard] += fits
            if start + fits < loads[arc]:
                left.append((arc, start + fits))
        waiting, step = left, step + 1
    return segments


def pieces(counts, shards, vnodes=VNODES):
    """(cell, low, high, shard, shift): rows of ranks low..high-1 get slot rank + shift."""
    nodes = ring(shards, vnodes)
    places, owners = [c for c, _ in nodes], [s for _, s in nodes]
    cells = [[] for _ in nodes]
    loads = [0] * len(nodes)
    # Cells past the last node belong to the first one; they come before its others.
    for cell in sorted(counts, key=lambda c: (c <= places[-1], c)):
        arc = bisect_left(places, cell) % len(nodes)
        cells[arc].append((cell, loads[arc], loads[arc] + counts[cell]))
        loads[arc] += counts[cell]
    out, reached = [], [0] * len(nodes)
    for arc, start, end, shard, slot in walk(loads, owners, capacities(sum(loads), shards)):
        k = reached[arc]
        while k < len(cells[arc]):
            cell, low, high = cells[arc][k]
            a, b = max(low, start), min(high, end)
            if a < b:
                out.append((cell, a - low, b - low, shard, slot + a - start - (a - low)))
            if high > end:
                break
            k += 1
        reached[arc] = k
    return out


def assign(spark, docs, shards=SHARDS, id_col="doc_id", text_col="text", carry=None, crowded_rows=CROWDED_ROWS):
    """Rows of ``docs`` with size, text_crc32, law, shard and slot (gapless from 0).

    ``carry`` names the columns to keep beside them (the id alone unless given); one
    that has the name of an added column gives way to it.
    size: UTF-8 bytes of the text, none for null, plus 8; text_crc32 of a null text
    is that of an empty one. Rows that repeat an id, or have none, share a cell and
    are placed one by one; which of equal rows gets which slot is fixed by their place
    in the input. An empty table gives an empty result.
    """
    names = ("_size", "_crc", "_cell", "_row", "_salt", "_n", "_first", "_rank", "_place", "_low", "_high", "_shift")
    size, crc, cell, row, salt, n, first, rank, place, low, high, shift = (free_name(docs, name) for name in names)
    text = F.coalesce(F.col(text_col), F.lit(""))
    carry = [c for c in carry or [id_col] if c not in ADDED]
    base = saved(
        spark,
        docs.select(
            *[F.col(c) for c in carry],
            (F.octet_length(text) + 8).cast("long").alias(size),
            F.crc32(text.cast("binary")).alias(crc),
            F.shiftrightunsigned(F.xxhash64(F.col(id_col)), 64 - CELL_BITS).cast("int").alias(cell),
            F.monotonically_increasing_id().alias(row),
        ),
    )
    # At most one row per cell of the ring.
    counts = {r[0]: r[1] for r in base.groupBy(cell).count().collect()}
    crowded = [number for number, rows in counts.items() if rows > crowded_rows]
    order = Window.partitionBy(cell).orderBy(F.col(id_col), row)
    if crowded:
        part = F.when(F.col(cell).isin(crowded), F.pmod(row, F.lit(SALTS))).otherwise(F.lit(0)).cast("int")
        base = base.withColumn(salt, part)
        earlier = Window.partitionBy(cell).orderBy(salt).rowsBetween(Window.unboundedPreceding, -1)
        parts = base.groupBy(cell, salt).agg(F.count("*").alias(n))
        parts = parts.select(cell, salt, F.coalesce(F.sum(n).over(earlier), F.lit(0)).alias(first))
        order = Window.partitionBy(cell, salt).orderBy(F.col(id_col), row)
        ranked = base.withColumn(rank, F.row_number().over(order)).join(parts, [cell, salt])
        ranked = ranked.withColumn(rank, F.col(rank) - 1 + F.col(first))
    else:
        ranked = base.withColumn(rank, (F.row_number().over(order) - 1).cast("long"))
    rows = pieces(counts, shards)
    places = spark.createDataFrame(rows, f"{place} int, {low} long, {high} long, shard int, {shift} long")
    here = (F.col(cell) == F.col(place)) & (F.col(rank) >= F.col(low)) & (F.col(rank) < F.col(high))
    # About one row per cell of the ring: bounded whatever the input.
    placed = ranked.join(F.broadcast(places), here)
    return placed.select(
        *[F.col(c) for c in carry],
        F.col(size).alias("size"),
        F.col(crc).alias("text_crc32"),
        F.lit("rows").alias("law"),
        F.col("shard").alias("shard"),
        (F.col(rank) + F.col(shift)).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op6_sharding(spark, sf_dir):
    return assign(spark, table(spark, sf_dir, "documents"))
