"""Corpus pipeline over ``documents``.

Language ID (rejects go), exact deduplication, near-duplicate removal (word
shingles of five, similarity 0.8), mixing of sources to target weights, packing
into sequences.  Every stage works on all rows that the stage before kept; its
result is written as Parquet and reread.  No SQL expresses the classifier, so
``ORACLE_SQL`` is None and the tests hold each stage against brute force.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import common, exact_dedup, langid, mixing, near_dedup, packing
from tessera.llm.queries import tokenizer_path
from tessera.sources.io import read_table

def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is identified; no letter, no text: rejected."""
    learn = F.col("doc_id").isNotNull() & ~common.held_out(F.col("doc_id"))
    return langid.keep_identified(docs, langid.train(docs, learn=learn))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact_dedup.deduplicate(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return near_dedup.remove_near_copies(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents, whole, as often as the target weights take them."""
    return mixing.repeated(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the mix, placed into sequences."""
    return packing.pack(docs, tokenizer_path())


STAGES = [
    ("language_id", language_id),
    ("exact_dedup", exact),
    ("near_dedup", near),
    ("source_mix", mix),
    ("packing", pack),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``.  A stage's scratch tables go as soon as
    its result is written, and the result once the next one is; what the last
    stage reads stays until the interpreter ends."""
    docs, written = read_table(spark, sf_dir, "documents"), []
    for name, stage in STAGES[:-1]:
        before = common.scratch_tables()
        path = common.scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        made = [p for p in common.scratch_tables() if p not in before and p != path]
        common.release(spark, [*made, *written])
        docs, written = spark.read.parquet(path), [path]
    return STAGES[-1][1](spark, docs, sf_dir)
