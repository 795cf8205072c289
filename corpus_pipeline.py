"""Documents to training tokens: filter, deduplicate, mix, encode.

Each stage takes (spark, docs, sf_dir) and returns what it keeps. ``run`` writes
every stage's rows to the shared folder and reads them for the next one. Whole
texts are read, null ones as empty; rows without an identifier, repeated rows,
empty tables and further columns pass as the operators say, and all stages but
the last return the columns they were given.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import exact_dedup, mixing, sentencepiece_fst, simhash_pivot, toxicity
from tidemark.llm.common import stored, table


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model rejects go; null and empty texts have no features and are judged alike."""
    return toxicity.survivors(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def unique(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts (null as empty) the row with the largest doc_id stays, once if repeated."""
    return exact_dedup.survivors(docs)


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group whose fingerprints (three-word shingles) link at 3 bits, the row with the smallest doc_id stays."""
    return simhash_pivot.survivors(docs, words=3, bits=3)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources, null ones too, at their target weights: rows are left out or repeated as the mix says."""
    return mixing.mix(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix with the piece ids of every text, what they decode to, whether that is the text, and their number."""
    rows = sentencepiece_fst.encode(docs, sentencepiece_fst.compile_model(), proof=True)
    return rows.withColumn("n_tokens", F.size("ids").cast("bigint"))


STAGES = [
    ("toxicity", clean),
    ("exact_dedup", unique),
    ("near_dedup", distinct),
    ("mixing", mixed),
    ("encoding", encoded),
]

#: SQL has no shortest path over pieces; tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
