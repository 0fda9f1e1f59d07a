"""Cleaning pipeline over ``documents``: five stages, each on all that the one before kept.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes
each result as Parquet below the shared checkpoint folder and reads it back as
the next stage's documents.  All but the last return the columns of documents.

Null or empty texts, repeated rows, ties, empty tables and extra columns pass
every stage with the results that its operator defines.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clearbid.llm import decontaminate, line_dedup, simhash, toxicity
from clearbid.llm.common import fresh, materialize, read_table
from clearbid.llm.queries import packed


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier rejects go; a text scored 0.5 or more is rejected."""
    score = toxicity.scorer(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))
    return docs.filter(score < 0.5)


def drop_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that are boilerplate of their host and copies of long passages go; ``n_chars`` follows the text."""
    dropped, = fresh(docs, "n_dropped")
    clean = line_dedup.dedup_lines(docs, dropped=dropped)
    counted = F.when(F.col(dropped) > 0, F.char_length("text").cast("long")).otherwise(F.col("n_chars"))
    return clean.select(*[counted.alias(c) if c == "n_chars" else F.col(c) for c in docs.columns])


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash class stays."""
    return simhash.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents contaminated with benchmark passages go."""
    return decontaminate.drop_documents(docs, read_table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left, as pieces of token sequences with their ids."""
    return packed(docs)


STAGES = [("toxicity", drop_toxic), ("line_dedup", drop_boilerplate), ("near_duplicates", drop_near_copies),
          ("decontamination", drop_contaminated), ("packing", pack)]

#: The classifier, the fingerprints and the token ids have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
