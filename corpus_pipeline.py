"""From documents to packed training sequences: toxicity, boilerplate lines, near copies, mix, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stowage.llm.jaccard_join import one_of_each
from stowage.llm.line_dedup import line_dedup
from stowage.llm.mixing import mixed_documents
from stowage.llm.packing import pack_documents
from stowage.llm.queries import BYTES, RANKS, table
from stowage.llm.toxicity import drop_toxic
from stowage.session import share


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents predicted to be toxic go; texts without words have a low score and stay."""
    return drop_toxic(docs, table(spark, sf_dir, "labels"))


def without_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Boilerplate lines go from all documents but the one with the smallest id; every document stays, null texts too."""
    return line_dedup(docs).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, that of the smallest id; documents without words all stay."""
    return one_of_each(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents, or runs of their words, as often as the mix takes them; documents without words are never taken."""
    return mixed_documents(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the mixed documents with their places in the training sequences; a null text is its end id alone."""
    return pack_documents(docs, RANKS, BYTES)


STAGES = [
    ("toxicity", without_toxic),
    ("line dedup", without_boilerplate),
    ("near copies", without_copies),
    ("mixing", mixed),
    ("packing", packed),
]

ORACLE_SQL = None  # models, tokenizers and random draws have no SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what one hands to the next is written to the shared folder.

    Null, empty and blank texts pass the first three stages; they hold no words, so the mix never draws them. Rows
    that repeat an id become one among the near copies. Null ids stay, nulls in other columns are carried along, texts
    of any length are read whole, ties go to the smaller id, an empty table gives no pieces, and columns may have any
    names besides those of ``documents``.
    """
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = share(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
