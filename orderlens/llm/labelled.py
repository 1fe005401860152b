"""Bounded samples of labelled documents, for the operators that learn from labels."""

from pyspark.sql import functions as F

from orderlens.llm.common import below_share, crc_remainder

#: Largest number of labelled documents that a model is fitted on.
SAMPLE_ROWS = 20_000


def labelled_sample(docs, labels, label, held_out, rows=SAMPLE_ROWS):
    """(doc_id, text, label) of at most ``rows`` labelled documents that are not held out.

    They are those whose hashed doc_id is smallest, so the same rows at every run.
    Rows without doc_id or label are left out; several labels of one document count
    as their majority (1 for a tie), several documents of one doc_id all count.
    """
    ids = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & ~held_out(F.col("doc_id")))
    ids = ids.groupBy("doc_id").agg((F.avg(label) >= 0.5).cast("int").alias("label"))
    labelled = ids.count()
    ids = ids.where(below_share(F.xxhash64("doc_id"), rows, F.lit(labelled)))
    ids = ids.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    texts = docs.select(F.col("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    # At most ``rows`` ids.
    return texts.join(F.broadcast(ids), "doc_id")


def one_in_three(id_column):
    return crc_remainder(id_column, 3) == 1
