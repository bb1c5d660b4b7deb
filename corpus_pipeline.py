"""The corpus pipeline: stages over ``documents``, each written as Parquet and read again as the next one's input.

Every stage works on all rows that its predecessor kept.  All but the last
return the columns of ``documents``; the last adds the encoding.  Null texts
count as empty, empty tables give empty tables, and further columns travel
along under any names (the encoding replaces columns of its own names).  Rows
that repeat the id and text of a document that stays, stay with it.  The mix
repeats documents, so rows after it are not unique.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from readloom.llm.exact_dedup import drop_exact_copies
from readloom.llm.mixing import mixed_documents
from readloom.llm.near_dedup import drop_near_copies
from readloom.llm.shared import read_table, stored
from readloom.llm.toxicity import drop_toxic, fit_toxicity, training_labels
from readloom.llm.word_bpe import compile_lexicon, encode_columns

WORDS = public_tokenizers.path("word_bpe_49k.json")


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity score of one half or more go."""
    return drop_toxic(docs, fit_toxicity(docs, training_labels(read_table(spark, sf_dir, "labels"))))


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts that are equal up to white space the smallest doc_id stays."""
    return drop_exact_copies(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document stays of each class of near copies: five-word shingles, similarity 0.8 or more."""
    return drop_near_copies(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources are brought to their target weights; a document appears once for each copy the mix takes."""
    return mixed_documents(docs)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every row's text, and the text that they decode to."""
    return encode_columns(docs, WORDS, compile_lexicon(docs, WORDS))


STAGES = [("toxicity", toxicity), ("exact_copies", exact_copies), ("near_copies", near_copies), ("mixing", mixing), ("encoding", encoding)]
#: SQL can't express the stages; ``tests/llm/test_pipeline.py`` compares each with a version written out in plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to ``documents``."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
