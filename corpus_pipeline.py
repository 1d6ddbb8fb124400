"""From raw documents to packed training sequences, stage by stage.

Each stage takes (spark, docs, sf_dir), works on all that the stage before it kept and
returns a DataFrame; all but the last return rows and columns of documents. run() writes the
result of each stage as Parquet into the shared folder and reads it again for the next, so a
lost executor never costs a finished stage.

In every stage null text counts as empty, null and repeated doc_ids are rows like any other, texts
are read whole however long they are, columns of any name keep their values, and an empty table
gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from litfunnel.llm import decontaminate, exact_dedup, ngram_join, packing, toxicity
from litfunnel.llm.common import hidden, staged, table

TOXIC_FROM = 0.7


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below TOXIC_FROM. Texts without words get the score of no
    evidence and stay; a score at the limit goes. Without any label the default model decides."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    score = hidden()
    return toxicity.score_toxicity(docs, model, score).where(F.col(score) < TOXIC_FROM).select(*docs.columns)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of texts that are equal but for white space: the one of the least doc_id
    (null last); of rows that repeat it, one. Empty texts are equal to each other."""
    return exact_dedup.without_duplicates(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of documents linked by the Jaccard similarity of their word 5-grams: the one
    of the least doc_id (null last), then text hash. Documents without words are linked with nothing and stay."""
    return ngram_join.one_of_each(docs, size=5, percent=80)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item is found. Null and blank items are found nowhere; an empty
    benchmark leaves all documents."""
    return decontaminate.without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences, with their ids. A document without text is a piece of one id."""
    return packing.pack(docs)


STAGES = [("toxicity", drop_toxic), ("exact_dedup", drop_copies), ("ngram_join", drop_near_copies), ("decontaminate", drop_contaminated), ("pack", pack)]

#: Toxicity, edit distance and tokenisation aren't SQL; the tests hold run() against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
