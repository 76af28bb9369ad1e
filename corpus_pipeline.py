"""A corpus pipeline over ``documents``: drop toxic and poor documents, keep one of each group of near copies, cut repeated passages, pack.

Each stage takes the rows that its predecessor kept. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from orchardflow.llm import packing, quality, simhash, suffix_dedup, toxicity
from orchardflow.llm._common import stored
from orchardflow.llm.queries import _table, _vocabulary


def toxic_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier chain rejects go."""
    return toxicity.without_toxic(docs, _table(spark, sf_dir, "labels"))


def poor_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score is below 0.3 go."""
    return quality.good_only(docs, _table(spark, sf_dir, "labels"))


def near_copies_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return simhash.one_of_each(docs)


def passages_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of over 50 words that occur again are cut from the texts: runs of repeated strings of 240 bytes. A character cut in part goes whole."""
    return suffix_dedup.without_repeats(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents in sequences of at most 2048 tokens."""
    return packing.pack(docs, _vocabulary("word_bpe_49k.json"), keep_ids=False)


STAGES = [
    ("toxicity", toxic_out),
    ("quality", poor_out),
    ("simhash", near_copies_out),
    ("suffix_array", passages_out),
    ("packing", packed),
]

#: Classifiers, SimHash components and token ids are beyond SQL; tests hold each stage against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each stage's rows written to the shared folder before the next reads them."""
    docs = _table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = stored(docs, name)
    return docs
