"""Shared pieces of the llm operators: written tables in the shared folder,
row fingerprints, and per-process caches of Python workers."""

from __future__ import annotations

import sys
import types

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.session import release, scratch_path, scratch_tables  # noqa: F401  (used through this module)

# The six ASCII white-space characters of [\x20\x09-\x0D].
ASCII_SPACE = " \t\n\x0b\f\r"
WORD_PATTERN = r"[^\x20\x09-\x0D]+"


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts the lineage with files that every executor can read again after a
    loss; unlike an eager checkpoint the plan runs once and the rows are stored
    column-wise and compressed.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def held_out(doc_id: Column) -> Column:
    """True for rows that no model may learn labels from: crc32 of the id's
    decimal text leaves remainder 2 modulo 4.  NULL ids: false."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def small_enough(df: DataFrame, rows: int) -> bool:
    """Whether ``df`` has at most ``rows`` rows; reads no more than needed."""
    return df.limit(rows + 1).count() <= rows


def join_bounded(left: DataFrame, right: DataFrame, on, how: str, max_rows: int) -> DataFrame:
    """Join with ``right`` broadcast when its counted size allows, else by
    shuffle (where adaptive execution splits skewed keys)."""
    return left.join(F.broadcast(right) if small_enough(right, max_rows) else right, on, how)


def worker_cache(key: str, make):
    """An object kept for the life of a Python worker process.

    Functions are shipped by value, so module globals would be new in every
    task; the cache lives in a module object of the interpreter instead.
    """
    store = sys.modules.setdefault("_tessera_worker_cache", types.ModuleType("_tessera_worker_cache"))
    found = store.__dict__.get(key)
    if found is None:
        found = make()
        store.__dict__[key] = found
    return found
