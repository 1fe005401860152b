"""Corpus preparation: five stages over the documents table.

Every stage works on all rows its predecessor kept, and is written as Parquet and read
again before the next. All but the last return the columns of the documents.
"""

from pyspark.sql import functions as F

from orderlens.llm import decontamination, mixing, quality, sharding, simhash
from orderlens.llm.common import free_name, saved, table


def quality_filter(spark, docs, sf_dir):
    """Documents that the quality model does not reject."""
    score = free_name(docs, "_score")
    marked = quality.scored(docs, table(spark, sf_dir, "labels"), name=score)
    return marked.where(F.col(score) >= 0.5).select(docs.columns)


def near_duplicates(spark, docs, sf_dir):
    """One document of each group of near-duplicates."""
    return simhash.one_of_each_group(spark, docs)


def decontaminate(spark, docs, sf_dir):
    """Documents that hold no benchmark item."""
    return decontamination.without_items(spark, docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark, docs, sf_dir):
    """Documents as often as the mix of sources takes them."""
    return mixing.mixed(spark, docs)


def shard(spark, docs, sf_dir):
    """Every row with its shard and its slot there, beside the columns of the documents."""
    return sharding.assign(spark, docs, carry=docs.columns).drop("law", "grown_shard")


STAGES = [
    ("quality classifier", quality_filter),
    ("SimHash near-dedup", near_duplicates),
    ("benchmark decontamination", decontaminate),
    ("mixing sources", mix_sources),
    ("sharding", shard),
]

#: Fingerprints by XXH64 and the fitted quality model are beyond SQL.
ORACLE_SQL = None


def run(spark, sf_dir):
    """The last stage's rows for the documents of a folder."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = saved(spark, stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
