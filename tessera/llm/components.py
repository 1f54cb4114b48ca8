"""Connected components of an edge table by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import staged


def _large_star(edges: DataFrame) -> DataFrame:
    """Every node hands its larger neighbours to its smallest one."""
    both = edges.select("u", "v").unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    moved = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.filter("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node hands its smaller neighbours, and itself, to the smallest."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    own = least.select("u", F.col("m").alias("v"))
    return moved.unionAll(own).filter("u <> v").distinct()


def connected(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root) for every node with an edge; root is the component's
    smallest node, and roots are listed too.

    Each round is written to the shared folder and compared by count and sum
    of row hashes.  The number of rounds grows with the logarithm of the
    longest path; no node's neighbours meet in one task's memory.
    """
    now = staged(edges.select(F.col(a).alias("u"), F.col(b).alias("v")).filter("u <> v"), "edges")

    def state(df: DataFrame):
        h = F.xxhash64("u", "v").cast("decimal(38,0)")
        return tuple(df.agg(F.count("*"), F.sum(h)).first())

    seen = None
    while True:
        now = staged(_small_star(_large_star(now)), "edges")
        found = state(now)
        if found == seen or found[0] == 0:
            break
        seen = found
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionAll(roots)
