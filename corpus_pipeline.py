"""The corpus pipeline: documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and
read again as the docs of the next.  All but the last return the columns of documents.

1. language_id  documents whose language cannot be told (no text, no letter, a score under langid.LEAST_SCORE) go
2. exact_dedup  of equal texts the one with the largest doc_id stays
3. near_dedup   of SimHash components the one with the smallest doc_id stays
4. mixing       sources are drawn to their target weights, by whole documents and copies
5. packing      what is left, copies apart, in sequences of fixed length

Defined cases, beside those of the operators: documents of null or empty text, or without a letter, go at stage 1; a null lang is not
learned from and a null source is a source; null doc_ids are kept (of equal texts a row with an id stays rather, of a component
the smallest id); rows that repeat both id and text end as one at stage 2; very long texts pass whole and are cut into sequences at
stage 5; an empty table stays empty through all stages; extra columns, whatever their names, are carried to stage 5.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from auditlane.llm import exact, langid, mixing, packing, simhash
from auditlane.llm.common import Scratch, table


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return langid.keep_identified(docs, langid.learn(docs))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact.drop_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.drop_near_copies(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs).select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES = [
    ("language_id", language_id),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

# Language identification and SimHash hashes cannot be said in SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole table of documents; each but the last is written and read again."""
    scratch, docs = Scratch(spark, "pipeline"), table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = scratch.write(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
