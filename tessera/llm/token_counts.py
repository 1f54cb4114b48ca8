"""Token counts through a digest cache.

The cache is a table in a shared folder: digest of the normalised content,
digest of the tokenizer's file, count.  Counting joins the documents' digests
to it, encodes each distinct missing content once, appends the new counts, and
joins again.  A run that was cut short leaves whole files only; entries that
are stored twice are equal and count once.

Content is normalised only where the count cannot change: for a tokenizer
that drops white space, runs of ASCII white space become one space.

Defined results: NULL counts as the empty text, 0 tokens and 0 bytes; repeated
rows and equal texts share one cache entry.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import join_bounded, staged, worker_cache
from tessera.llm.tokens import drops_white_space, encoder, version_digest

CACHE_SCHEMA = T.StructType(
    [
        T.StructField("content", T.BinaryType()),
        T.StructField("tokenizer", T.StringType()),
        T.StructField("n_tokens", T.LongType()),
    ]
)
#: Up to this many missing digests (32 bytes each) are broadcast.
MAX_BROADCAST_MISSES = 200_000


def normaliser(tokenizer: str):
    """The rewriting of content that keeps this tokenizer's counts."""
    if not tokenizer.endswith(".model"):
        with open(tokenizer, encoding="utf-8") as f:
            if drops_white_space(json.load(f)):
                return lambda c: F.regexp_replace(c, r"[\x20\x09-\x0D]+", " ")
    return lambda c: c


def content_digest(content: Column) -> Column:
    return F.unhex(F.sha2(content, 256))


def read_cache(spark: SparkSession, cache: str, version: str) -> DataFrame | None:
    """Stored counts of one tokenizer version; None when nothing is stored."""
    path = spark._jvm.org.apache.hadoop.fs.Path(cache)
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return None
    stored = spark.read.schema(CACHE_SCHEMA).parquet(cache).filter(F.col("tokenizer") == version)
    return stored.groupBy("content").agg(F.max("n_tokens").alias("n_tokens"))


def encode_counts(texts: DataFrame, tokenizer: str, version: str) -> DataFrame:
    """(content, norm) -> cache rows; runs the tokenizer on every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = worker_cache(f"encoder:{tokenizer}", lambda: encoder(tokenizer))
        for b in batches:
            norm = b["norm"]
            counts = [len(encode(norm[i].as_py())) // 4 for i in range(len(norm))]
            yield pa.RecordBatch.from_arrays(
                [b["content"], pa.array([version] * len(counts), pa.string()), pa.array(counts, pa.int64())],
                ["content", "tokenizer", "n_tokens"],
            )

    return texts.mapInArrow(run, CACHE_SCHEMA)


def count_tokens(
    docs: DataFrame, tokenizer: str, cache: str, limit: int = 2048, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Per row: doc_id, n_bytes, n_tokens, over_limit.  ``cache`` is a folder
    that all executors share; it grows by the contents not met before."""
    spark = docs.sparkSession
    version, norm = version_digest(tokenizer), normaliser(tokenizer)
    content = F.coalesce(docs[text], F.lit(""))
    texts = docs.select(docs[doc_id].cast("long").alias("doc_id"), content.alias("raw"), norm(content).alias("norm"))
    texts = texts.withColumn("content", content_digest(F.col("norm")))
    rows = staged(texts.select("doc_id", F.octet_length("raw").cast("long").alias("n_bytes"), "content"), "digests")
    stored = read_cache(spark, cache, version)
    wanted = texts.select("content", "norm")
    if stored is not None:
        missing = staged(rows.select("content").distinct().join(stored, "content", "left_anti"), "misses")
        wanted = join_bounded(wanted, missing, "content", "left_semi", MAX_BROADCAST_MISSES)
    # copies collapse before the shuffle; every distinct miss is encoded once
    distinct = wanted.groupBy("content").agg(F.first("norm").alias("norm"))
    encode_counts(distinct, tokenizer, version).write.mode("append").parquet(cache)
    counted = rows.join(read_cache(spark, cache, version), "content")
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
