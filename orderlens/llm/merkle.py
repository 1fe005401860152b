"""Merkle manifest of a table: a persistent tree whose versions copy one path each.

Every row is a leaf; the leaves of a group stand in order and runs of ``ARITY`` become
their parent, level by level, up to the group's root; the groups' roots become one root
the same way. The tree is built in aligned blocks of ``ARITY ** HEIGHT`` nodes, one row
of arrays per block: a pass turns blocks into their top nodes, the next pass blocks those.

Nodes are never changed. A changed leaf makes a version: the ancestors of that leaf
inside its block are copied, all other nodes are shared with the first tree. Above the
block the version goes on with the siblings that its block's top node has in the upper
passes; these siblings come down pass by pass, one row per block, so no task holds more
than a block and the versions of its own leaves.
"""

from functools import partial
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F

from orderlens.llm.common import crc_sql, crc_table_sql, saved, table

ARITY = 8
#: Levels of a block: 512 nodes at most.
HEIGHT = 3

# The columns of a leaf, in order, and the mark of a missing value.
LEAF_COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
MISSING = "-"

_UP, _LOW = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_STEPS = "array<struct<left: string, right: string>>"
_ARROW_STEPS = pa.list_(pa.struct([("left", pa.string()), ("right", pa.string())]))


def digest(text):
    return sha256(text.encode()).hexdigest()


# --- one block as a persistent tree -------------------------------------------------


class Node:
    """An inner node; its children are nodes or, at the bottom, digests."""

    __slots__ = ("children", "hash")

    def __init__(self, children):
        self.children = children
        self.hash = digest("".join(_hash(c) for c in children))


def _hash(node):
    return node if isinstance(node, str) else node.hash


def grown(leaves, height):
    """The top node over at most ``ARITY ** height`` digests, ``height`` levels up."""
    nodes = leaves
    for _ in range(height):
        nodes = [Node(tuple(nodes[i : i + ARITY])) for i in range(0, len(nodes), ARITY)]
    return nodes[0]


def _slots(at, height):
    """Which child leads to leaf ``at``, from the top node down."""
    return [at // ARITY**level % ARITY for level in reversed(range(height))]


def steps(top, at, height):
    """The siblings of leaf ``at`` and its ancestors below ``top``: (left, right), bottom first."""
    found, node = [], top
    for slot in _slots(at, height):
        hashes = [_hash(c) for c in node.children]
        found.append(("".join(hashes[:slot]), "".join(hashes[slot + 1 :])))
        node = node.children[slot]
    return found[::-1]


def replaced(top, at, leaf, height):
    """The version of ``top`` whose leaf ``at`` is another: only the leaf's ancestors are new."""
    if height == 0:
        return leaf
    slot = at // ARITY ** (height - 1) % ARITY
    child = replaced(top.children[slot], at, leaf, height - 1)
    return Node((*top.children[:slot], child, *top.children[slot + 1 :]))


def copied(version, at, height):
    """Digests of a version's own nodes, bottom first."""
    found, node = [], version
    for slot in _slots(at, height):
        found.append(node.hash)
        node = node.children[slot]
    return found[::-1]


def folded(leaf, path):
    """Digests above a leaf, one per (left, right) of its siblings, bottom first."""
    found = []
    for left, right in path:
        leaf = digest(left + leaf + right)
        found.append(leaf)
    return found


def _height(total, most):
    """Levels that a pass of ``most`` climbs in a tree that has ``total`` nodes at its start."""
    levels = 0
    while total > 1 and levels < most:
        total = -(-total // ARITY)
        levels += 1
    return levels


# --- positions ----------------------------------------------------------------------


def _placed(spark, rows, tree, order):
    """Adds ``pos`` (from 0, within each tree) and ``total`` (rows of the tree) to rows.

    Rows are dealt out by ranges of (tree, order) and numbered within each range; the
    counts per range and tree carry the numbering on. ``order`` has to tell rows apart,
    and the columns of ``tree`` hold no nulls.
    """
    ranged = rows.repartitionByRange(*tree, *order).withColumn("_part", F.spark_partition_id())
    ranged = saved(spark, ranged)
    counts = ranged.groupBy("_part", *tree).agg(F.count("*").alias("_n"))
    whole = Window.partitionBy(*tree)
    earlier = whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(
        "_part", *tree, F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"), F.sum("_n").over(whole).alias("total")
    )
    inside = Window.partitionBy("_part", *tree).orderBy(*order)
    joined = ranged.join(counts, ["_part", *tree]).withColumn("pos", F.row_number().over(inside) - 1 + F.col("_before"))
    return joined.drop("_part", "_before")


# --- passes -------------------------------------------------------------------------


def _blocks(spark, nodes, tree, height, carried=()):
    """One saved row per aligned block: its nodes in order, as ``nodes`` (pos, hash, *carried).

    A block has ``ARITY ** height`` nodes at most, whatever the input.
    """
    block = F.floor(F.col("pos") / ARITY**height).cast("long")
    node = F.struct("pos", "hash", *carried)
    return saved(
        spark,
        nodes.groupBy(*tree, block.alias("block")).agg(
            F.first("total").alias("total"), F.array_sort(F.collect_list(node)).alias("nodes")
        ),
    )


def _rebuilt(batch, row, most):
    """(top node, height, hashes) of one block."""
    hashes = batch.column("nodes")[row].values.field("hash").to_pylist()
    height = _height(batch.column("total")[row].as_py(), most)
    return grown(hashes, height), height, hashes


def _tops(batches, most):
    for batch in batches:
        tops = [_rebuilt(batch, row, most) for row in range(batch.num_rows)]
        total = [-(-n // ARITY**height) for n, (_, height, _) in zip(batch.column("total").to_pylist(), tops)]
        tree = [n for n in batch.schema.names if n not in ("block", "total", "nodes")]
        columns = [*map(batch.column, tree), batch.column("block"), pa.array(total, pa.int64()), pa.array([_hash(t) for t, _, _ in tops])]
        yield pa.RecordBatch.from_arrays(columns, [*tree, "pos", "total", "hash"])


def _field(df, name):
    return f"{name} {df.schema[name].dataType.simpleString()}"


def _climb(spark, nodes, tree, most, carried=()):
    """Blocks of every pass, lowest first, and the saved root of every tree (*tree, hash)."""
    passes = []
    while True:
        blocks = _blocks(spark, nodes, tree, most, () if passes else carried)
        passes.append(blocks)
        schema = ", ".join([*(_field(blocks, c) for c in tree), "pos long, total long, hash string"])
        hashes = F.transform("nodes", lambda n: F.struct(n["hash"].alias("hash")))
        read = blocks.select(*tree, "block", "total", hashes.alias("nodes"))
        nodes = saved(spark, read.mapInArrow(partial(_tops, most=most), schema))
        if (nodes.agg(F.max("total")).first()[0] or 1) == 1:
            return passes, nodes.select(*tree, "hash")


def _path(batch, row):
    return [(step["left"], step["right"]) for step in batch.column("path")[row].as_py()]


def _pairs(path):
    return [{"left": left, "right": right} for left, right in path]


def _repeated(batch, row, name, times):
    return pa.array([batch.column(name)[row].as_py()] * times, batch.schema.field(name).type)


def _lowered(batches, most):
    """The path of every node of blocks: its siblings there, then those of the block's top."""
    for batch in batches:
        same = [n for n in batch.schema.names if n not in ("block", "total", "nodes", "path")]
        for row in range(batch.num_rows):
            top, height, hashes = _rebuilt(batch, row, most)
            first, above = batch.column("block")[row].as_py() * ARITY**most, _path(batch, row)
            paths = [_pairs([*steps(top, at, height), *above]) for at in range(len(hashes))]
            columns = [_repeated(batch, row, name, len(hashes)) for name in same]
            at = pa.array(range(first, first + len(hashes)), pa.int64())
            yield pa.RecordBatch.from_arrays([*columns, at, pa.array(paths, _ARROW_STEPS)], [*same, "block", "path"])


def _descend(passes, paths, tree, most):
    """The lowest pass's blocks with ``path``, the siblings above each, bottom first.

    ``paths`` has one row per tree: *tree, path (the siblings above its root) and what is
    to stand beside every block.
    """
    beside = [c for c in paths.columns if c not in ("path", *tree)]
    blocks = passes[-1].join(paths, list(tree))  # the last pass has one block per tree
    for lower in reversed(passes[:-1]):
        same = [*(_field(lower, c) for c in tree), *(f"{c} string" for c in beside)]
        above = blocks.select(*tree, "block", "total", "nodes", "path", *beside)
        above = above.mapInArrow(partial(_lowered, most=most), ", ".join([*same, "block long", f"path {_STEPS}"]))
        blocks = lower.join(above, [*tree, "block"])
    return blocks


# --- the operator ---------------------------------------------------------------------


def leaf_hash(columns):
    """Digest of columns, each as its UTF-8 byte count, a colon and its value, or as missing."""
    parts = []
    for column in columns:
        value = column.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit(MISSING)))
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def _versions(batches, most):
    """Proof and version of every leaf of blocks, a block at a time."""
    for batch in batches:
        for row in range(batch.num_rows):
            top, height, hashes = _rebuilt(batch, row, most)
            nodes, above = batch.column("nodes")[row].values, _path(batch, row)
            new = nodes.field("new").to_pylist()
            proofs, versions = [], []
            for at, leaf in enumerate(hashes):
                proofs.append(_pairs([*steps(top, at, height), *above]))
                version = replaced(top, at, new[at], height)
                own = copied(version, at, height)
                versions.append([*own, *folded(_hash(version), above)])
            columns = [
                *map(nodes.field, ("row", "pos", "hash", "new")), *(_repeated(batch, row, name, len(hashes)) for name in ("subroot", "root")),
                pa.array(proofs, _ARROW_STEPS), pa.array(versions, pa.list_(pa.string())),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["row", "pos", "leaf", "new_leaf", "subroot", "root", "proof", "version"])


def _group_paths(batches, most):
    """named, group, subroot, root and path of every group, from the upper tree's blocks."""
    for batch in batches:
        for row in range(batch.num_rows):
            top, height, hashes = _rebuilt(batch, row, most)
            nodes, above = batch.column("nodes")[row].values, _path(batch, row)
            paths = [_pairs([*steps(top, at, height), *above]) for at in range(len(hashes))]
            columns = [*map(nodes.field, ("named", "group", "hash")), _repeated(batch, row, "root", len(hashes)), pa.array(paths, _ARROW_STEPS)]
            yield pa.RecordBatch.from_arrays(columns, ["named", "group", "subroot", "root", "path"])


def versions(spark, docs, changed, columns=LEAF_COLUMNS, id_col="doc_id", group_col="lang", height=HEIGHT):
    """Manifest of ``docs`` and, for every row, the version of it in which that row alone is changed.

    ``changed`` maps names of ``columns`` to what stands there afterwards. One row per row
    of ``docs``: the id, pos (the leaf's place in its group, from 0), leaf, new_leaf,
    subroot, root, proof (siblings left and right of the leaf and of each ancestor, bottom
    first) and version (the digests of the nodes that the version copies, bottom first; the
    last is its root). A row that is the only leaf of the only group is its own root, with
    an empty proof and an empty version.

    Groups stand by code point, the missing one first; leaves by id, missing ids first, then
    by digest and place in the input. Missing values and empty ones give different leaves.
    Repeated rows are leaves of their own. Texts of any length are hashed whole, on the JVM.
    An empty table has no leaf and no root: no rows. Other columns are not read.
    ``height`` is the number of levels of a block; it changes no result.
    """
    values = {c: F.col(c) for c in columns}
    rows = docs.select(
        F.col(id_col).alias("row"),
        F.col(group_col).isNotNull().alias("named"),
        F.coalesce(F.col(group_col).cast("string"), F.lit("")).alias("group"),
        leaf_hash(values.values()).alias("hash"),
        leaf_hash((values | changed).values()).alias("new"),
        F.monotonically_increasing_id().alias("_row"),
    )
    tree = ["named", "group"]
    order = [F.col("row").asc_nulls_first(), F.col("hash"), F.col("_row")]
    leaves = _placed(spark, saved(spark, rows), tree, order)
    passes, subroots = _climb(spark, leaves, tree, height, ("row", "new"))
    # The groups' roots are leaves of the upper tree, the only tree of its kind.
    one = _placed(spark, subroots.withColumn("all", F.lit(True)), ["all"], [F.col(c) for c in tree])
    upper, roots = _climb(spark, one, ["all"], height, tree)
    roots = roots.select("all", F.col("hash").alias("root"), F.array().cast(_STEPS).alias("path"))
    groups = _descend(upper, roots, ["all"], height)
    paths = f"named boolean, group string, subroot string, root string, path {_STEPS}"
    blocks = _descend(passes, groups.mapInArrow(partial(_group_paths, most=height), paths), tree, height)
    schema = f"row {docs.schema[id_col].dataType.simpleString()}, pos long, leaf string, new_leaf string, subroot string, root string, proof {_STEPS}, version array<string>"
    return blocks.mapInArrow(partial(_versions, most=height), schema).withColumnRenamed("row", id_col)


def manifest(spark, docs, columns=LEAF_COLUMNS, id_col="doc_id", group_col="lang"):
    """``versions`` of an unchanged table: the id, pos, leaf, subroot, root and proof of every row."""
    return versions(spark, docs, {}, columns, id_col, group_col).drop("new_leaf", "version")


def op11_merkle(spark, sf_dir):
    """Every document's proof, checked against a version in which some texts are lower-cased."""
    third = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    text = F.when(third, F.translate("text", _UP, _LOW)).otherwise(F.col("text"))
    found = versions(spark, table(spark, sf_dir, "documents"), {"text": text})
    siblings = F.array_join(F.transform("proof", lambda s: F.concat(s["left"], s["right"])), "")
    root = F.coalesce(F.try_element_at("version", F.lit(-1)), "new_leaf")
    return found.select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        F.sha2(siblings.cast("binary"), 256).alias("proof_sha256"),
        root.alias("folded_root"),
        (root == F.col("root")).alias("verified"),
    )


def _levels_sql(nodes, levels, tree):
    """CTEs nodes_1 .. nodes_n over nodes_0 (tree, idx, h); trees of one node stay as they are."""
    out = []
    for n in range(levels):
        out.append(f"""{nodes}_{n + 1} AS (
  SELECT {tree}, CASE WHEN total = 1 THEN 0 ELSE idx // 8 END AS idx,
         CASE WHEN max(total) = 1 THEN min(h) ELSE sha256(string_agg(h, '' ORDER BY idx)) END AS h
  FROM (SELECT *, count(*) OVER (PARTITION BY {tree}) AS total FROM {nodes}_{n})
  GROUP BY {tree}, CASE WHEN total = 1 THEN 0 ELSE idx // 8 END, total
)""")
    return ", ".join(out)


def _climb_sql(nodes, levels, tree, start):
    """CTEs up_<nodes>_1 .. n: place, siblings so far and digest of every row, level by level."""
    out, before = [], start
    for n in range(levels):
        out.append(f"""up_{nodes}_{n + 1} AS (
  SELECT b.doc, any_value(b.{tree}) AS {tree}, any_value(b.idx) // 8 AS idx,
         any_value(b.proof) || coalesce(string_agg(o.h, '' ORDER BY o.idx) FILTER (o.idx <> b.idx), '') AS proof,
         CASE WHEN any_value(t.total) = 1 THEN any_value(b.h)
              ELSE sha256(string_agg(CASE WHEN o.idx = b.idx THEN b.h ELSE o.h END, '' ORDER BY o.idx)) END AS h
  FROM {before} b JOIN {nodes}_{n} o ON o.{tree} = b.{tree} AND o.idx // 8 = b.idx // 8
       JOIN (SELECT {tree}, count(*) AS total FROM {nodes}_{n} GROUP BY {tree}) t ON t.{tree} = b.{tree}
  GROUP BY b.doc
)""")
        before = f"up_{nodes}_{n + 1}"
    return ", ".join(out), before


def _field_sql(column):
    return f"coalesce(strlen(CAST({column} AS VARCHAR)) || ':' || {column}, '-')"


def _op11_sql(levels=9, upper=4):
    """Levels suffice for 8 ** levels documents of a language and 8 ** upper languages."""
    climb, reached = _climb_sql("leaf", levels, "tree", "start")
    top, end = _climb_sql("top", upper, "one", "lifted")
    codes = "list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: ascii(x)::BIGINT)"
    return f"""
WITH RECURSIVE {crc_table_sql()}, docs AS (
  SELECT row_number() OVER () AS doc, doc_id, source, lang, n_chars, text,
         CASE WHEN {crc_sql(codes, "tab")} % 3 = 0 THEN translate(text, '{_UP}', '{_LOW}') ELSE text END AS tampered
  FROM documents, crc_table
), hashed AS (
  SELECT doc, doc_id, CASE WHEN lang IS NULL THEN '' ELSE 'x' || lang END AS tree,
         sha256({" || ".join(map(_field_sql, LEAF_COLUMNS))}) AS leaf,
         sha256({" || ".join(map(_field_sql, (*LEAF_COLUMNS[:-1], "tampered")))}) AS new
  FROM docs
), leaves AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf, doc) - 1 AS idx FROM hashed
), leaf_0 AS (SELECT tree, idx, leaf AS h FROM leaves),
{_levels_sql("leaf", levels, "tree")},
start AS (SELECT doc, tree, idx, '' AS proof, new AS h FROM leaves), {climb},
subroots AS (SELECT tree, h AS subroot, row_number() OVER (ORDER BY tree) - 1 AS idx FROM leaf_{levels}),
top_0 AS (SELECT 1 AS one, idx, subroot AS h FROM subroots),
{_levels_sql("top", upper, "one")},
lifted AS (SELECT r.doc, 1 AS one, s.idx, r.proof, r.h FROM {reached} r JOIN subroots s USING (tree)), {top}
SELECT l.doc_id, l.leaf, s.subroot, t.h AS root, sha256(e.proof) AS proof_sha256, e.h AS folded_root, e.h = t.h AS verified
FROM leaves l JOIN {end} e USING (doc) JOIN subroots s ON s.tree = l.tree, top_{upper} t
"""


OP11_SQL = _op11_sql()
