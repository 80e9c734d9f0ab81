"""Corpus preparation: five stages from raw documents to packed sequences.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor
kept: toxic documents go, exact copies go, near copies go, documents with
benchmark items go, and what is left is packed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from millrace.llm.common import scratch, table, tidy
from millrace.llm.decontaminate import drop_contaminated
from millrace.llm.exact_dedup import drop_exact_copies
from millrace.llm.near_dedup import drop_near_copies
from millrace.llm.packing import pack_documents
from millrace.llm.toxicity import drop_toxic


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score stays below the filter's cut, by a model
    fitted on the labelled documents among those given.  Null and empty texts are
    scored like any other; ids may be null or repeat; extra columns stay."""
    return drop_toxic(docs, table(spark, sf_dir, "labels"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts: the longest, then the one with
    the smallest doc_id (null last).  Null and empty texts are one group."""
    return drop_exact_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one with the smallest
    doc_id (null last).  Of texts without words one stays."""
    return drop_near_copies(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item is verified; null and empty texts
    hold none."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Place of every piece of every document in the training sequences; null
    and empty texts are the end id alone, repeated rows are placed each."""
    return pack_documents(docs)


STAGES = [
    ("toxicity", toxicity),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("packing", packing),
]

#: No stage but the second can be said in SQL; tests/llm holds each of the
#: others, and the whole run, against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        with tidy(spark):
            made = stage(spark, docs, sf_dir)
            path = scratch(spark, f"stage-{name}")
            made.write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
