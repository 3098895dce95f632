"""From raw documents to packed training sequences, stage by stage.

Each stage gets what its predecessor kept, written as Parquet and read again.

Nulls and odd rows, in every stage: a null doc_id is a key like any other; rows that
share a doc_id are judged each on its own text; a null text has no letter, line, word
or hit; further columns are kept as they are, whatever their names, by all stages but
the last; an empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerloom.llm import decontaminate, language, line_runs, packing, simhash
from ledgerloom.llm.base import materialise, read
from ledgerloom.llm.encoding import public_path


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a recognised language go: null and empty texts and those without
    a letter. All others stay, whatever the score; ties between languages go to the first
    name. A null lang is filled in."""
    return language.of_known_language(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of repeated line runs go, and documents that are nothing else. The
    first copy in the order of doc_id (null first), then of the text's hash, stays; of rows
    alike one is first. Documents without a line stay as they are."""
    return line_runs.without_repeats(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class stays: the one of least doc_id (null last),
    then of least text hash; of rows alike one. Texts without words are one class."""
    return simhash.one_of_each(docs, shingle=3, radius=3)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold ten words in a row of a benchmark item go (of a shorter item: all
    its words). Items without words hit nothing, and an empty benchmark drops nothing."""
    return decontaminate.decontaminate(docs, read(spark, sf_dir, "benchmark"), window=10)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document stands in the training sequences. A null or empty
    text is one piece, the end id; rows alike are packed each on its own; which of several
    pieces of one length goes where is settled by a hash."""
    return packing.pack_documents(docs, public_path("word_bpe_49k.json"), end_id=1, capacity=4096)


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("best_fit_packing", best_fit_packing),
]

#: The network of the first stage cannot be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
