"""Mixing sources to target weights by weighted fair queueing.

Every source is a queue of its documents in shuffled order, two rounds long. An item
finishes at the virtual time (words of its queue up to and with it) / (target of its
source). All items are sorted by that time over the whole cluster and taken until the
total budget is spent: each queue then stands at about the same virtual time, which is
to say at the same share of its target.
"""

from pyspark.sql import functions as F

from orderlens.llm.common import WORD, free_name, numbered, running_totals, saved, table

WEIGHTS = (3, 1, 2)
BUDGET = 1.5
ROUNDS = 2


def source_targets(spark, sized):
    """source, source_size, before (words of earlier sources), target; and the budget.

    Sources stand by code point, null last. A target is level * weight, at most
    ``ROUNDS`` times the source's size; the level makes the targets sum to the budget.
    It is found among the sources sorted by the level at which they are full: the first
    source that is not full at the level which the full ones before it leave.
    """
    sums = saved(spark, sized.groupBy("source").agg(F.sum("size").alias("source_size")))
    ranked = running_totals(spark, sums, [F.col("source").asc_nulls_last()], ["source_size"])
    weights = F.array(*[F.lit(w).cast("long") for w in WEIGHTS])
    ranked = saved(
        spark,
        ranked.select(
            "source",
            "source_size",
            (F.col("run_source_size") - F.col("source_size")).alias("before"),
            F.element_at(weights, ((F.col("pos") - 1) % len(WEIGHTS) + 1).cast("int")).alias("weight"),
            (F.col("source_size") * ROUNDS).alias("most"),
            F.col("pos").alias("rank"),
        ),
    )
    total, weight = ranked.agg(F.sum("source_size"), F.sum("weight")).first()
    budget = BUDGET * (total or 0)
    full_at = F.col("most") / F.col("weight")
    filled = running_totals(spark, ranked.withColumn("full_at", full_at), ["full_at", "rank"], ["most", "weight"])
    left = (F.lit(budget) - (F.col("run_most") - F.col("most"))) / (F.lit(weight or 0) - (F.col("run_weight") - F.col("weight")))
    found = filled.select("pos", "full_at", left.alias("level")).where("level <= full_at")
    level = found.agg(F.min_by("level", "pos")).first()[0]
    share = F.lit(level).cast("double")
    target = F.when(full_at <= share, F.col("most").cast("double")).otherwise(share * F.col("weight"))
    return ranked.select("source", "source_size", "before", target.alias("target")), budget


def mix(spark, docs, id_col="doc_id", text_col="text", source_col="source"):
    """One row per row of ``docs``: doc_id, size, source_size, target, copies, taken.

    size counts the words of the text (0 for null and empty texts). copies (0, 1 or 2)
    is how often the mix takes the document, taken = copies * size. The shuffled order
    hangs on the doc_id alone; rows that share a doc_id, or have none, are separate
    items side by side. Documents without words are taken or not, at no cost. An empty
    table gives an empty result. Reruns agree.
    """
    return _copies(spark, docs, F.monotonically_increasing_id(), id_col, text_col, source_col).select(
        "doc_id", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken")
    )


def _copies(spark, docs, row, id_col="doc_id", text_col="text", source_col="source"):
    """row, doc_id, size, source_size, target and copies per row of ``docs``; ``row`` tells its rows apart."""
    size = F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long")
    key = F.md5(F.concat(F.lit("mix/"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))).cast("binary"))
    sized = saved(
        spark,
        docs.select(
            F.col(id_col).alias("doc_id"),
            F.col(source_col).alias("source"),
            size.alias("size"),
            F.conv(F.substring(key, 1, 15), 16, 10).cast("long").alias("shuffle"),
            row.alias("row"),
        ),
    )
    targets, budget = source_targets(spark, sized)
    order = [F.col("source").asc_nulls_last(), F.col("shuffle"), F.col("doc_id"), F.col("row")]
    queued = running_totals(spark, sized, order, ["size"]).withColumnRenamed("source", "_source")
    queued = queued.join(targets, F.col("_source").eqNullSafe(F.col("source")))
    at = F.col("run_size") - F.col("before")

    def finish(earlier):
        return F.when(F.col("target") > 0, (at + F.col("source_size") * earlier) / F.col("target")).otherwise(F.lit(0.0))

    finishes = {f"finish_{n}": finish(n) for n in range(ROUNDS)}
    queued = saved(spark, queued.select("row", "doc_id", "size", "source_size", "target", "pos", *[c.alias(n) for n, c in finishes.items()]))
    rounds = F.explode(F.array(*[F.struct(F.col(f"finish_{n}").alias("finish"), F.lit(n).alias("round")) for n in range(ROUNDS)]))
    items = queued.select("size", F.col("pos").alias("item"), rounds.alias("r")).select("size", "item", "r.*")
    sent = running_totals(spark, items, ["finish", "round", "item"], ["size"])
    last = sent.where(F.col("run_size") <= F.lit(budget)).agg(F.max(F.struct("finish", "round", "item"))).first()[0]

    def taken(n):
        if last is None:
            return F.lit(0)
        item = F.struct(F.col(f"finish_{n}").alias("finish"), F.lit(n).alias("round"), F.col("pos").alias("item"))
        bound = F.struct(F.lit(last[0]).alias("finish"), F.lit(last[1]).alias("round"), F.lit(last[2]).cast("long").alias("item"))
        return (item <= bound).cast("long")

    copies = sum((taken(n) for n in range(1, ROUNDS)), taken(0)).cast("long")
    return queued.select("row", "doc_id", "size", "source_size", "target", copies.alias("copies"))


def mixed(spark, docs):
    """The rows of ``docs``, each as often as the mix takes it, also where they share a doc_id or have none."""
    row, number, copy = (free_name(docs, name) for name in ("_row", "_copies", "_copy"))
    known = numbered(spark, docs, row)
    copies = _copies(spark, known, F.col(row)).where("copies > 0").select(F.col("row").alias(row), F.col("copies").alias(number))
    # About as many rows as are taken: never broadcast, at any size.
    taken = known.join(copies.hint("merge"), row)
    return taken.withColumn(copy, F.explode(F.array_repeat(F.lit(1), F.col(number).cast("int")))).select(docs.columns)


def op2_mixing(spark, sf_dir):
    return mix(spark, table(spark, sf_dir, "documents")).drop("copies")


OP2_SQL = """
WITH sized AS (
  SELECT doc_id, source,
         CAST(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS BIGINT) AS size,
         CAST('0x' || substr(md5('mix/' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS BIGINT) AS shuffle
  FROM documents
), sums AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS rank
  FROM sized GROUP BY source
), weighed AS (
  SELECT *, CASE (rank - 1) % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS weight, 2 * source_size AS most FROM sums
), filled AS (
  SELECT *, most / weight AS full_at,
         (1.5::DOUBLE * sum(source_size) OVER () - (sum(most) OVER o - most)::DOUBLE)
           / (sum(weight) OVER () - (sum(weight) OVER o - weight))::DOUBLE AS level,
         row_number() OVER o AS pos
  FROM weighed WINDOW o AS (ORDER BY most / weight, rank)
), leveled AS (
  SELECT arg_min(level, pos) AS level FROM filled WHERE level <= full_at
), targets AS (
  SELECT source, source_size,
         CASE WHEN full_at <= l.level THEN most::DOUBLE ELSE l.level * weight END AS target
  FROM filled, leveled l
), queued AS (
  SELECT s.doc_id, s.size, t.source_size, t.target,
         row_number() OVER (ORDER BY s.source NULLS LAST, shuffle, doc_id) AS pos,
         CAST(sum(size) OVER (PARTITION BY s.source ORDER BY shuffle, doc_id) AS BIGINT) AS run
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
), items AS (
  SELECT q.*, r.round, CASE WHEN target > 0 THEN (q.run + source_size * r.round)::DOUBLE / target ELSE 0 END AS finish
  FROM queued q, (VALUES (0), (1)) r(round)
), sent AS (
  SELECT *, sum(size) OVER (ORDER BY finish, round, pos ROWS UNBOUNDED PRECEDING) AS sent_words FROM items
), counted AS (
  SELECT pos, CAST(count(*) AS BIGINT) AS copies FROM sent
  WHERE sent_words <= (SELECT 1.5::DOUBLE * sum(size) FROM sized) GROUP BY pos
)
SELECT doc_id, size, source_size, target, coalesce(copies, 0) * size AS taken
FROM queued LEFT JOIN counted USING (pos)
"""
