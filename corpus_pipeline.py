"""A cleaning pipeline over ``documents``: each stage applies one operator of ``topicframe.llm``.

A stage takes (spark, docs, sf_dir) and works on all that the stage before
kept. The first four return the columns of ``documents``; the last returns
the packed pieces. Tables that a stage keeps in the shared folder are removed
when the next one begins, so its result is to be written by then.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from topicframe.llm.common import checkpointed, read_table, stage
from topicframe.llm.decontaminate import drop_leaking
from topicframe.llm.ngram_join import keep_one_of_each
from topicframe.llm.packing import pack_documents
from topicframe.llm.secrets import redact_secrets
from topicframe.llm.toxicity import drop_toxic


@stage(first=True)
def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifiers score below 0.7; they learn from ``labels``."""
    return drop_toxic(docs, read_table(spark, sf_dir, "labels").select("doc_id", "toxic"))


@stage
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one with the smallest id, of each group that links of 5-word Jaccard 0.75 make."""
    return keep_one_of_each(docs)


@stage
def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of ``benchmark``."""
    return drop_leaking(docs, read_table(spark, sf_dir, "benchmark"))


@stage
def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets replaced by a mark."""
    return redact_secrets(docs)


@stage
def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with the sequences that hold them."""
    return pack_documents(docs)


STAGES = [
    ("toxicity", toxicity),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("secret scans", secrets),
    ("best-fit packing", packing),
]

#: The stages train classifiers, sample embeddings, compress and tokenise, which SQL cannot express; tests/llm hold brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order over ``documents``; each result but the last is written as Parquet and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for name, work in STAGES[:-1]:
        docs = checkpointed(work(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
