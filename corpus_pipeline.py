"""The corpus pipeline: language ID, SimHash near-dedup, mixing, best-fit packing.

Each stage takes (spark, docs, sf_dir) and works on all rows that its predecessor kept; what it returns is written as
Parquet and read again as the next stage's docs. All but the last return the columns of documents, unchanged.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from brachis.llm import langid, mixing, packing, simhash
from brachis.llm.common import read_table, stage_table


def identify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the documents whose language is identified."""
    return langid.keep_identified(docs)


def dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each SimHash component."""
    return simhash.drop_near_duplicates(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeat or leave out documents so that sources meet their target weights."""
    return mixing.mixed_rows(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Place every token piece of the mix in a sequence."""
    return packing.pack(docs)


STAGES = [("language_id", identify), ("simhash_dedup", dedup), ("mixing", mix), ("packing", pack)]

#: Learned models, XXH64 fingerprints and tokenizer ids are beyond SQL: the pipeline is tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over ``documents``."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stage_table(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
