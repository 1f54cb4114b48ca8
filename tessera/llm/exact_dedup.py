"""Exact deduplication through an extendible-hash index on shared files.

Texts are equal when they are identical without ASCII white space.  The key of
a text is a 64-bit hash of what is left; the leading bits of the key choose a
slot of the directory.

* Directory: one pass counts distinct keys and bytes per slot.  The directory
  starts with one bucket and doubles (one more leading bit) as long as some
  bucket holds more than its share; a bucket that fits keeps its local depth,
  so several slots point to it.
* Buckets: rows are grouped by (bucket, key, whole normalised text).  The
  grouping compares bytes, copies collapse before the shuffle, so a text that
  a third of all rows carry costs one row per task.
* Index files: owner tasks take ranges of (bucket, key), number the entries
  that collide in a key (the chain), and write them to the shared folder.
* Look-up: each document finds its entry by (bucket, key, digest).

Defined results: NULL text counts as empty; empty texts are one group.  The
row with the most code points stays, then the smallest doc_id (NULL last).
Rows that repeat both doc_id and text are reported alike by :func:`mark`;
:func:`deduplicate` returns one row per group in any case.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm.common import ASCII_SPACE, scratch_path, staged

#: Slots of the directory have at most this many bits (a million slots, the
#: proven bound of the broadcast directory).
MAX_DEPTH = 20
BUCKET_BYTES = 64 << 20
BUCKET_KEYS = 1 << 20
_ID_TOP = "9223372036854775807"


def normalised(text: Column) -> Column:
    return F.translate(F.coalesce(text, F.lit("")), ASCII_SPACE, "")


def slot_of(key: Column, depth: int) -> Column:
    """The ``depth`` leading bits of a 64-bit key."""
    return F.shiftrightunsigned(key, 64 - depth) if depth else F.lit(0).cast("long")


def precedence(n_chars: Column, doc_id: Column) -> Column:
    """One number that is largest for the row that stays: code points first,
    then the smallest doc_id; a NULL id comes after every other."""
    inverse = F.coalesce(
        F.lit(_ID_TOP).cast("decimal(20,0)") - doc_id.cast("decimal(20,0)") + F.lit(1), F.lit(0)
    ).cast("decimal(20,0)")
    return (n_chars.cast("decimal(10,0)") * F.lit("100000000000000000000").cast("decimal(21,0)") + inverse).cast(
        "decimal(38,0)"
    )


def _id_of(best: Column) -> Column:
    inverse = (best % F.lit("100000000000000000000").cast("decimal(21,0)")).cast("decimal(20,0)")
    return F.when(inverse == 0, F.lit(None)).otherwise(
        (F.lit(_ID_TOP).cast("decimal(20,0)") - inverse + F.lit(1)).cast("long")
    )


@dataclass
class Directory:
    """``depth`` global bits; ``buckets`` has (slot, bucket, local_depth)."""

    depth: int
    buckets: DataFrame


def build_directory(
    spark: SparkSession,
    keys: DataFrame,
    bucket_bytes: int = BUCKET_BYTES,
    bucket_keys: int = BUCKET_KEYS,
) -> Directory:
    """Double the directory until every bucket fits, from (key, bytes) rows.

    The histogram has 2^MAX_DEPTH rows at most.  A bucket at the depth limit,
    or one whose single key is overfull, is left as it is: its entries chain.
    """
    fine = staged(
        keys.groupBy("key").agg(F.max("bytes").alias("bytes"))
        .groupBy(slot_of(F.col("key"), MAX_DEPTH).alias("fine"))
        .agg(F.count("*").alias("keys"), F.sum("bytes").alias("bytes")),
        "slots",
    )
    fits = (F.col("keys") <= bucket_keys) & (F.col("bytes") <= bucket_bytes)
    depth, settled = 0, None
    while True:
        slot = F.shiftrightunsigned(F.col("fine"), MAX_DEPTH - depth)
        filled = fine.groupBy(slot.alias("slot")).agg(F.sum("keys").alias("keys"), F.sum("bytes").alias("bytes"))
        if depth:
            # a bucket of this depth exists where its parent (two slots) was overfull
            pair = Window.partitionBy(F.shiftrightunsigned(F.col("slot"), 1))
            parent = (F.sum("keys").over(pair) > bucket_keys) | (F.sum("bytes").over(pair) > bucket_bytes)
            filled = filled.withColumn("split", parent).filter("split").drop("split")
        closed = filled if depth == MAX_DEPTH else filled.filter(fits)
        part = closed.select(F.lit(depth).alias("local_depth"), "slot")
        settled = part if settled is None else settled.unionAll(part)
        if depth == MAX_DEPTH or not filled.filter(~fits).count():
            break
        depth += 1
    # a bucket of local depth l owns 2^(depth - l) slots of the directory
    span = F.pow(F.lit(2), F.lit(depth) - F.col("local_depth")).cast("long")
    first = F.col("slot") * span
    buckets = settled.select(
        F.explode(F.sequence(first, first + span - 1)).alias("slot"), first.alias("bucket"), "local_depth"
    )
    return Directory(depth, staged(buckets, "directory"))


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, key, sha, n_chars, bytes) of each row, written once."""
    rows = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"),
        normalised(F.col(text)).alias("norm"),
        F.length(F.coalesce(F.col(text), F.lit(""))).alias("n_chars"),
    )
    return staged(
        rows.select(
            "doc_id",
            F.xxhash64("norm").alias("key"),
            F.unhex(F.sha2("norm", 256)).alias("sha"),
            "n_chars",
            F.octet_length("norm").cast("long").alias("bytes"),
        ),
        "fingerprints",
    )


def bucketed(rows: DataFrame, directory: Directory) -> DataFrame:
    """Add the bucket of each row's key (look-up in the directory)."""
    slots = directory.buckets.select(F.col("slot").alias("_slot"), F.col("bucket"))
    return rows.withColumn("_slot", slot_of(F.col("key"), directory.depth)).join(F.broadcast(slots), "_slot").drop(
        "_slot"
    )


def build_index(docs: DataFrame, directory: Directory, path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Write the index of ``docs`` to ``path`` and return it.

    Entries: bucket, key, chain (position among the texts that share the key),
    sha, keep_id, keep_chars, group_size.
    """
    rows = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"),
        normalised(F.col(text)).alias("norm"),
        F.length(F.coalesce(F.col(text), F.lit(""))).alias("n_chars"),
    ).withColumn("key", F.xxhash64("norm"))
    entries = (
        bucketed(rows, directory)
        .groupBy("bucket", "key", "norm")
        .agg(F.max(precedence(F.col("n_chars"), F.col("doc_id"))).alias("best"), F.count("*").alias("group_size"))
        .select(
            "bucket",
            "key",
            F.unhex(F.sha2("norm", 256)).alias("sha"),
            _id_of(F.col("best")).alias("keep_id"),
            "group_size",
        )
    )
    owned = entries.repartitionByRange("bucket", "key").withColumn(
        "chain", F.row_number().over(Window.partitionBy("bucket", "key").orderBy("sha")) - 1
    )
    owned.write.parquet(path)
    return docs.sparkSession.read.schema(owned.schema).parquet(path)


def mark(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", index_path: str | None = None) -> DataFrame:
    """Per row: doc_id, keep_id, group_size, kept, text_sha256 (and chain, the
    entry's position among texts that share its key)."""
    spark = docs.sparkSession
    prints = fingerprints(docs, doc_id, text)
    directory = build_directory(spark, prints.select("key", "bytes"))
    index = build_index(docs, directory, index_path or scratch_path(spark, "index"), doc_id, text)
    found = prints.join(index.select("key", "sha", "keep_id", "group_size", "chain"), ["key", "sha"])
    return found.select(
        "doc_id",
        "keep_id",
        F.col("group_size").cast("long").alias("group_size"),
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
        "chain",
    )


def deduplicate(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row, with all its columns, of each group of equal texts.

    Groups form in the buckets of the directory as in :func:`mark`; the whole
    row travels as the value of its group, so repeated rows cannot multiply.
    """
    spark = docs.sparkSession
    prints = fingerprints(docs, doc_id, text)
    directory = build_directory(spark, prints.select("key", "bytes"))
    rows = docs.select(
        F.struct(*[docs[c] for c in docs.columns]).alias("row"),
        normalised(docs[text]).alias("norm"),
        precedence(F.length(F.coalesce(docs[text], F.lit(""))), docs[doc_id].cast("long")).alias("rank"),
    ).withColumn("key", F.xxhash64("norm"))
    best = bucketed(rows, directory).groupBy("bucket", "key", "norm").agg(F.max_by("row", "rank").alias("row"))
    return best.select("row.*")
