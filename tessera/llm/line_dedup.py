"""Removal of lines that many documents share.

* Lines: every whole text is split at ``\\n``; the key of a line is the line
  without ASCII white space at both ends, A-Z in lower case.
* Counting: each row's distinct keys are exploded as 128-bit hashes and counted
  by one grouping (partial counts first, so a line that every row carries costs
  one row per task).  Keys found in at least ``min_docs`` rows are hot.
* Marking: a row's line hashes are looked up in the hot keys.  Up to
  ``MAX_BROADCAST`` hot keys (counted first) are sent to the tasks as sorted
  arrays, and no text is moved.  Beyond it the most frequent ones (their number
  is bounded: each holds more than a fixed share of all exploded keys) go that
  way, and the others are joined by shuffle with (text digest, position, hash)
  rows, whose positions come back to the texts by digest.
* Reassembly: the lines at the positions that stay, in order, joined by ``\\n``.

Defined results: a NULL or empty text is one empty line, which stays (keys of
less than ``min_chars`` code points are never dropped).  Every row is a
document of its own, rows that repeat included.  A text all of whose lines go
becomes empty.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import ASCII_SPACE, small_enough, staged

#: Hot keys sent to every task (16 bytes each).
MAX_BROADCAST = 1_000_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    bare = F.btrim(line, F.lit(ASCII_SPACE))
    # lower() is plain A-Z where every character is one byte
    ascii_only = F.octet_length(bare) == F.length(bare)
    return F.when(ascii_only, F.lower(bare)).otherwise(F.translate(bare, UPPER, LOWER))


def _hashes(key: Column) -> tuple[Column, Column]:
    return F.xxhash64(key), F.xxhash64(F.lit(1), key)


def hot_lines(docs: DataFrame, min_docs: int = 10, min_chars: int = 1, text: str = "text") -> DataFrame:
    """(h1, h2, n_docs) of the keys found in at least ``min_docs`` rows."""
    keys = F.array_distinct(F.transform(lines_of(docs[text]), line_key))
    each = docs.select(F.explode(keys).alias("key")).filter(F.length("key") >= min_chars)
    h1, h2 = _hashes(F.col("key"))
    counted = each.select(h1.alias("h1"), h2.alias("h2")).groupBy("h1", "h2").agg(F.count("*").alias("n_docs"))
    return counted.filter(F.col("n_docs") >= min_docs)


def _kept_positions(hot: DataFrame):
    """A column function: two arrays of line hashes -> positions not in ``hot``."""
    table = hot.select("h1", "h2").toPandas().sort_values("h1", kind="stable")
    shared = hot.sparkSession.sparkContext.broadcast(
        (table["h1"].to_numpy(np.int64), table["h2"].to_numpy(np.int64))
    )

    @F.arrow_udf("array<int>")
    def kept(h1: pa.Array, h2: pa.Array) -> pa.Array:
        first, second = shared.value
        a, b = h1.flatten().to_numpy(), h2.flatten().to_numpy()
        lengths = h1.value_lengths().to_numpy()
        found = np.zeros(len(a), bool)
        # keys that share h1 lie next to each other: step until none is left
        at = np.searchsorted(first, a)
        todo = np.arange(len(a))
        while len(todo):
            inside = at[todo] < len(first)
            todo = todo[inside]
            todo = todo[first[at[todo]] == a[todo]]
            found[todo] |= second[at[todo]] == b[todo]
            at[todo] += 1
        starts = np.concatenate([[0], np.cumsum(lengths)])
        position = np.arange(len(a)) - np.repeat(starts[:-1], lengths)
        kept_before = np.concatenate([[0], np.cumsum(~found)])[starts]
        return pa.ListArray.from_arrays(
            pa.array(kept_before, pa.int32()), pa.array(position[~found], pa.int32())
        )

    return kept


def _digest(text: Column) -> Column:
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")), 256))


def _marked_by_join(docs: DataFrame, light: DataFrame, text: str) -> DataFrame:
    """(digest, gone): positions of ``light`` hot lines in each distinct text."""
    h1, h2 = _hashes(line_key(F.col("line")))
    lines = docs.select(_digest(docs[text]).alias("_digest"), F.posexplode(lines_of(docs[text])).alias("pos", "line"))
    places = lines.select("_digest", "pos", h1.alias("h1"), h2.alias("h2")).dropDuplicates()
    met = places.join(light.select("h1", "h2"), ["h1", "h2"])
    return met.groupBy("_digest").agg(F.collect_set("pos").alias("_gone"))


def drop_lines(
    docs: DataFrame, min_docs: int = 10, min_chars: int = 1, text: str = "text", max_broadcast: int = MAX_BROADCAST
) -> DataFrame:
    """``docs`` with the text that stays in ``text`` and two further columns,
    n_lines (before) and n_dropped (long; they replace columns of these names)."""
    hot = staged(hot_lines(docs, min_docs, min_chars, text), "hot-lines")
    light = None
    if not small_enough(hot, max_broadcast):
        total = hot.agg(F.sum("n_docs")).first()[0]
        # fewer than max_broadcast keys can hold more than this many rows each
        heavy = F.col("n_docs") > total // max_broadcast
        hot, light = hot.filter(heavy), hot.filter(~heavy)
    columns = [docs[c] for c in docs.columns if c not in (text, "n_lines", "n_dropped")]
    row = docs.select(F.struct(*columns).alias("_row") if columns else F.lit(None).alias("_row"), docs[text].alias("_text"))
    if light is not None:
        gone = _marked_by_join(docs, light, text)
        row = row.withColumn("_digest", _digest(F.col("_text"))).join(gone, "_digest", "left")
    keys = F.transform(lines_of(F.col("_text")), line_key)
    h1, h2 = F.transform(keys, lambda k: _hashes(k)[0]), F.transform(keys, lambda k: _hashes(k)[1])
    marked = row.withColumn("_kept", _kept_positions(hot)(h1, h2))
    if light is not None:
        kept = F.array_except("_kept", F.coalesce("_gone", F.array().cast("array<int>")))
        marked = marked.withColumn("_kept", kept)
    lines = lines_of(F.col("_text"))
    stays = F.array_join(F.transform("_kept", lambda i: F.get(lines, i)), "\n")
    n_lines, n_kept = F.size(lines), F.size("_kept")
    out = {
        text: F.when(n_lines == n_kept, F.col("_text")).otherwise(stays),
        "n_lines": n_lines.cast("long"),
        "n_dropped": (n_lines - n_kept).cast("long"),
    }
    order = [c for c in docs.columns if c not in ("n_lines", "n_dropped")] + ["n_lines", "n_dropped"]
    return marked.select(*[out[c].alias(c) if c in out else F.col("_row").getField(c).alias(c) for c in order])
