"""Documents to packed training sequences, in four stages, each written and read again by the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tessera.llm.near_dedup import Rule, one_of_each
from tessera.llm.packing import pack_documents
from tessera.llm.quality import accepted, fit
from tessera.llm.queries import tokenizer_file
from tessera.llm.shared import stored, table
from tessera.llm.suffix_dedup import cut_repeats, repeated_spans
from tessera.session import ship


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts; it learns from the labelled ones among them.

    A null text counts as empty and is scored as such; rows that repeat stay or go alike; texts of any length count
    whole; without rows or labels nothing is learned, and without rows nothing returned. Other columns are passed on.
    """
    ship(spark)
    return accepted(docs, fit(docs, table(spark, sf_dir, "labels")))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each near-duplicate component (five words, 80 %).

    Rows that repeat an id and its text are copies, of which one stays; different texts with one id are documents of
    their own. Rows without id and texts without words (null, empty) all stay. Other columns are passed on.
    """
    ship(spark)
    return one_of_each(docs, Rule(words=5, percent=80))


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of 50 words or more that stand before them.

    A document of which no word is left goes. Null, empty and short texts and rows without id stay as they are; rows
    that repeat an id and its text are cut alike. Other columns are passed on, but n_chars follows the text.
    """
    ship(spark)
    return cut_repeats(docs, repeated_spans(docs))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of 2048 tokens.

    A null or empty text is its end id alone; rows with equal or null ids are packed as documents of their own; texts
    of any length are packed whole; without rows there are no pieces. No other column is read.
    """
    ship(spark)
    return pack_documents(docs, tokenizer_file("byte_bpe_50k.json"))


STAGES = [("quality", quality), ("near_dedup", near_dedup), ("suffix_dedup", suffix_dedup), ("packing", packing)]

#: A trained classifier and a tokenizer are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
