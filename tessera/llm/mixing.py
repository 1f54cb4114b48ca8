"""Mixing sources to target weights by capped water-filling.

Sources are ordered by code point (NULL last) and weigh ``weights`` in turn,
repeating.  They share a volume (a multiple of all words) in proportion to
their weights; a source whose share is above ``max_epochs`` times its size is
clamped there, and the excess goes to the others in proportion, until none is
above.  Water-filling needs only sums over the table of sources, one small
aggregate per round.

A source with target t and size s repeats every document floor(t / s) times;
the rest of the target is taken from its documents in the order of a seeded
digest, until it is used up.  :func:`mark` counts only the missing words of the
last of these documents, so a source's total is its rounded target;
:func:`repeated` takes that document whole or not at all.  Prefix sums
over the digest order come from a histogram of the digest and, inside the one
bin where the rest runs out, from a window; both have about sqrt(rows of the
largest source) rows, so a hot source is never ordered in one task.

Defined results: NULL or blank text has size 0 and takes 0 words; a source
without words has target 0; rows that repeat are separate rows.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import WORD_PATTERN, small_enough, staged

#: Above this many sources, the table of sources is joined by salted shuffle.
MAX_BROADCAST_SOURCES = 100_000
SALTS = 64


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD_PATTERN)).cast("long")


def measured(docs: DataFrame, doc_id: str, text: str, source: str, seed: int) -> list[Column]:
    """size, source, and the seeded digest that orders a source's documents."""
    return [
        word_count(docs[text]).alias("size"),
        docs[source].cast("string").alias("source"),
        F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(docs[doc_id].cast("string"), F.lit(""))).cast("binary")).alias("digest"),
        docs[doc_id].cast("long").alias("doc_id"),
        F.xxhash64(docs[text]).alias("print"),
    ]


def numbered(sources: DataFrame) -> DataFrame:
    """Add ``place``, the position by code point, NULL last: rows are sorted by
    range, numbered inside each range, and shifted by the ranges before."""
    ranged = staged(
        sources.repartitionByRange(F.col("source").isNull(), "source").withColumn("part", F.spark_partition_id()),
        "sources",
    )
    # one row per partition
    sizes = ranged.groupBy("part").agg(F.count("*").alias("n"))
    shift = sizes.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("shift"))
    inside = F.row_number().over(Window.partitionBy("part").orderBy(F.col("source").asc_nulls_last()))
    return (
        ranged.withColumn("inside", inside)
        .join(F.broadcast(shift), "part")
        .withColumn("place", F.col("inside") + F.col("shift") - 1)
        .drop("part", "inside", "shift")
    )


def water_level(sources: DataFrame, volume: float) -> float:
    """The level at which sum(min(cap, weight * level)) reaches ``volume``.

    Each round clamps the sources whose share is above their cap and spreads
    the rest over the open ones; the level only rises, so rounds end as soon as
    no further source is clamped.
    """
    clamped, level = -1, 0.0
    while True:
        over = F.col("weight") * F.lit(level) > F.col("cap")
        row = sources.agg(
            F.count(F.when(over, 1)).alias("n"),
            F.coalesce(F.sum(F.when(over, F.col("cap"))), F.lit(0.0)).alias("held"),
            F.coalesce(F.sum(F.when(~over & (F.col("source_size") > 0), F.col("weight"))), F.lit(0.0)).alias("open"),
        ).first()
        if row["n"] == clamped:
            return level
        clamped = row["n"]
        if row["open"] == 0:
            return math.inf
        level = (volume - row["held"]) / row["open"]


@dataclass
class Mix:
    """``rows``: the measured documents; ``sources``: per source its size,
    target, whole repetitions and where the fractional one ends."""

    rows: DataFrame
    sources: DataFrame
    bins: int
    broadcast: bool


def _bin(digest: Column, bins: int) -> Column:
    lead = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")
    return F.floor(lead * F.lit(bins) / F.lit(4294967296)).cast("long")


def plan_mix(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: tuple[float, ...] = (5, 2, 1),
    share: float = 1.5,
    max_epochs: float = 2.0,
    seed: int = 17,
) -> Mix:
    """Measure the documents (one scan of the texts) and fill the targets."""
    rows = staged(docs.select(*measured(docs, doc_id, text, source, seed)), "sizes")
    sums = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n"))
    place = numbered(sums)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    place = staged(
        place.withColumn("weight", weight).withColumn("cap", F.col("source_size") * F.lit(float(max_epochs))), "weights"
    )
    total = place.agg(F.coalesce(F.sum("source_size"), F.lit(0)).alias("t"), F.coalesce(F.max("n"), F.lit(1)).alias("n")).first()
    level = water_level(place, share * total["t"])
    bins = max(1, math.isqrt(total["n"]))
    filled = F.when(F.col("source_size") == 0, F.lit(0.0))
    filled = filled.otherwise(F.col("cap") if math.isinf(level) else F.least(F.col("cap"), F.col("weight") * F.lit(level)))
    targets = place.select("source", "source_size", filled.alias("target"))
    whole = F.when(F.col("source_size") == 0, F.lit(0)).otherwise(
        F.floor(F.round("target") / F.greatest(F.col("source_size"), F.lit(1)))
    )
    targets = targets.withColumn("whole", whole.cast("long")).withColumn(
        "rest", F.round("target").cast("long") - F.col("whole") * F.col("source_size")
    )
    # where the fractional repetition ends: the last bin that starts within it
    hist = rows.groupBy("source", _bin(F.col("digest"), bins).alias("bin")).agg(F.sum("size").alias("words"))
    upto = Window.partitionBy("source").orderBy("bin")
    hist = hist.withColumn("before", F.sum("words").over(upto) - F.col("words")).withColumnRenamed("source", "s")
    cut = (
        hist.join(targets.select(F.col("source").alias("t"), "rest"), F.col("s").eqNullSafe(F.col("t")))
        .filter(F.col("before") <= F.col("rest"))
        .groupBy("s")
        .agg(F.max(F.struct("bin", "before")).alias("cut"))
    )
    found = targets.join(cut, F.col("source").eqNullSafe(F.col("s"))).select(
        "source", "source_size", "target", "whole", "rest",
        F.col("cut.bin").alias("cut_bin"), F.col("cut.before").alias("cut_before"),
    )
    found = staged(found, "targets")
    return Mix(rows, found, bins, small_enough(found, MAX_BROADCAST_SOURCES))


def taken(mix: Mix, rows: DataFrame) -> DataFrame:
    """Add source_size, target, whole and ``taken`` (words, repeats counted)
    to rows that have the columns of :func:`measured`."""
    rows = rows.withColumn("bin", _bin(F.col("digest"), mix.bins))
    table = mix.sources.withColumnRenamed("source", "s")
    same = F.col("source").eqNullSafe(F.col("s"))
    if mix.broadcast:
        joined = rows.join(F.broadcast(table), same)
    else:
        table = table.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        rows = rows.withColumn("pick", F.pmod(F.xxhash64("digest"), F.lit(SALTS)).cast("int"))
        joined = rows.join(table, same & (F.col("pick") == F.col("salt"))).drop("pick", "salt")
    joined = joined.drop("s")
    edge = F.col("bin") == F.col("cut_bin")
    outside = joined.filter(~edge).withColumn(
        "part", F.when(F.col("bin") < F.col("cut_bin"), F.col("size")).otherwise(F.lit(0)).cast("long")
    )
    # rows of the one bin per source in which the rest runs out
    order = Window.partitionBy("source").orderBy("digest", "doc_id", "size", "print")
    before = F.coalesce(F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    left = F.col("rest") - F.col("cut_before") - before
    inside = joined.filter(edge).withColumn(
        "part", F.greatest(F.lit(0), F.least(F.col("size"), left)).cast("long")
    )
    both = outside.unionByName(inside)
    return both.withColumn("taken", F.col("whole") * F.col("size") + F.col("part")).drop("bin", "cut_bin", "cut_before")


def mark(docs: DataFrame, **options) -> DataFrame:
    """Per row: doc_id, size, source_size, target, taken."""
    mix = plan_mix(docs, **options)
    return taken(mix, mix.rows).select("doc_id", "size", "source_size", "target", "taken")


def repeated(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", source: str = "source", seed: int = 17, **options) -> DataFrame:
    """The mix itself: every row as often as it is taken, all columns kept.

    The document in which a fractional repetition ends is taken whole or not at
    all, whichever brings its source nearer to the target (whole on a tie), so
    every text is an input text and a source ends within one document of its
    target.  Rows without words add nothing and are not taken.
    """
    mix = plan_mix(docs, doc_id=doc_id, text=text, source=source, seed=seed, **options)
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), *measured(docs, doc_id, text, source, seed))
    more = (2 * F.col("part") >= F.col("size")).cast("long")
    copies = taken(mix, rows).filter("size > 0").select("row", (F.col("whole") + more).alias("copies")).filter("copies > 0")
    return copies.select("row", F.explode(F.sequence(F.lit(1).cast("long"), "copies"))).select("row.*")
