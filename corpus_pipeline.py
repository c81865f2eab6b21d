"""From raw documents to packed training sequences, in five stages, each one operator of ``framekeel.llm``.

A stage takes the session, the documents that its predecessor kept, and the folder of the tables, and gives back
documents; the last one gives the pieces of the sequences, with their token ids. Between stages the documents are
written and read again, so a lost executor costs no more than a part of one stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from framekeel.llm import jaccard, mixing, packing, recipes, toxicity
from framekeel.llm.common import staged, table
from framekeel.llm.queries import tokenizer_path
from framekeel.session import configure


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a classifier of the labelled ones rejects go."""
    return toxicity.clean_documents(docs, table(configure(spark), sf_dir, "labels"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal text, but for white space, the one with the least id stays."""
    configure(spark)
    return recipes.distinct_documents(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by a similarity of 0.8 in their five-word shingles the one with the least id stays."""
    configure(spark)
    return jaccard.representative_documents(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them; a row that is taken twice comes twice."""
    configure(spark)
    return mixing.mixed_documents(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of documents in sequences of 2048 tokens; ``row_id`` tells rows of one ``doc_id`` apart."""
    configure(spark)
    return packing.packed_documents(docs, tokenizer_path())


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("ngram_jaccard", drop_near_copies),
    ("source_mix", mix_sources),
    ("best_fit_packing", pack_sequences),
]

#: SQL expresses neither the classifier nor the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
